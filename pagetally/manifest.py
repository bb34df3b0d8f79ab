"""Which folders of a table count, in numbered versions that are written once.

A writer puts its files into a new folder first and then commits a version that names it. Readers
take the folders of the last version, so they see all of a commit or nothing of it, and list no
folder but that of the versions. Two writers cannot make the same version: the later one reads the
new state and tries again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import SparkSession

from .session import children, delete, read_text, write_new

_DIGITS = 20
_ATTEMPTS = 20


@dataclass(frozen=True)
class Entry:
    """A folder below the table, and what it is there for: a key that a later commit replaces."""

    folder: str
    key: str


@dataclass(frozen=True)
class Manifest:
    """Versions below `path`/_versions; folders are below `path`."""

    path: str

    def _versions(self, spark: SparkSession) -> list[str]:
        names = [p.rsplit("/", 1)[1] for p in children(spark, f"{self.path}/_versions")]
        return sorted(n for n in names if n.isdigit())

    def _entries(self, spark: SparkSession, version: str) -> list[Entry]:
        return [Entry(**e) for e in json.loads(read_text(spark, f"{self.path}/_versions/{version}"))]

    def entries(self, spark: SparkSession) -> list[Entry]:
        """The folders of the last version; none before the first."""
        versions = self._versions(spark)
        return self._entries(spark, versions[-1]) if versions else []

    def folders(self, spark: SparkSession) -> list[str]:
        return [f"{self.path}/{e.folder}" for e in self.entries(spark)]

    def new_folder(self) -> str:
        return f"data/{uuid4().hex}"

    def commit(self, spark: SparkSession, change: Callable[[list[Entry]], list[Entry]]) -> None:
        """The next version: what `change` makes of the last one. It may be asked again."""
        for _ in range(_ATTEMPTS):
            versions = self._versions(spark)
            found = self._entries(spark, versions[-1]) if versions else []
            number = int(versions[-1]) + 1 if versions else 0
            text = json.dumps([vars(e) for e in change(found)])
            if write_new(spark, f"{self.path}/_versions/{number:0{_DIGITS}}", text):
                return
        raise RuntimeError(f"{self.path}: other writers were always faster")

    def add(self, spark: SparkSession, folder: str | None, key: str) -> None:
        """Commit a folder in place of what has its key; None only takes that away."""
        added = [Entry(folder, key)] if folder else []
        self.commit(spark, lambda found: [e for e in found if e.key != key] + added)

    def replace(self, spark: SparkSession, old: list[Entry], folder: str, key: str) -> None:
        """Commit one folder in place of several; all of them still have to be there."""

        def change(found: list[Entry]) -> list[Entry]:
            if not set(old) <= set(found):
                raise RuntimeError(f"{self.path}: the table was rewritten meanwhile")
            return [Entry(folder, key)] + [e for e in found if e not in old]

        self.commit(spark, change)

    def clean(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove versions but the last `keep`, and the folders that only the removed ones name.
        Readers that began under a version that is kept are not disturbed."""
        versions = self._versions(spark)
        old, kept = versions[:-keep], versions[-keep:]
        live = {e.folder for v in kept for e in self._entries(spark, v)}
        gone = {e.folder for v in old for e in self._entries(spark, v)} - live
        for folder in sorted(gone):
            delete(spark, f"{self.path}/{folder}")
        for version in old:
            delete(spark, f"{self.path}/_versions/{version}")
