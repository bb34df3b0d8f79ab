"""Result tables. A sink appends one finished DataFrame, from a batch job or a micro-batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .manifest import Entry, Manifest
from .session import children, delete, exists
from .sources.dimensions import driver_settings


class Batch(NamedTuple):
    """A micro-batch: the id of its query, the same over restarts, and its number there."""

    query: str
    id: int


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def as_result(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order and types of a result table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


@dataclass(frozen=True)
class JdbcTable:
    """Plain appends to a database table: a replayed micro-batch appends its rows again."""

    url: str
    table: str
    schema: StructType
    connection: dict[str, str] = field(default_factory=dict)
    max_connections: int = 8
    batch_size: int = 1_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "numPartitions": str(self.max_connections),
            "batchsize": str(self.batch_size),
            **driver_settings(self.url),
            **self.connection,
        }

    def prepared(self, df: DataFrame) -> DataFrame:
        """Rows in one partition per connection. The exchange keeps the report itself at full
        parallelism: left to the writer, its last stage would shrink to so many tasks.
        """
        return as_result(df, self.schema).repartition(self.max_connections)

    def write(self, df: DataFrame, batch: Batch | None = None) -> None:
        rows = self.prepared(df)
        rows.write.format("jdbc").options(**self.options()).mode("append").save()


@dataclass(frozen=True)
class FileTable:
    """Parquet files.

    Each micro-batch owns a folder, so its replay replaces its own rows, and each query has its
    folders in one of its own: batches of another checkpoint have the same numbers. A batch
    without rows leaves no folder behind.
    """

    path: str
    schema: StructType

    def write(self, df: DataFrame, batch: Batch | None = None) -> None:
        rows = as_result(df, self.schema)
        if batch is None:
            rows.write.mode("append").parquet(self.path)
            return
        spark, folder = df.sparkSession, f"{self.path}/query={batch.query}/batch_id={batch.id}"
        rows = rows.persist()  # the few rows of closed windows, looked at and then written
        try:
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(folder)
            elif exists(spark, folder):  # what an earlier try has written
                delete(spark, folder)
        finally:
            rows.unpersist()

    def read(self, spark, upto: Batch | None = None) -> DataFrame:
        """All rows, or those that one query has written up to a micro-batch; none where nothing
        was ever written."""
        paths = [self.path] if exists(spark, self.path) else []
        if upto is not None:
            folders = children(spark, f"{self.path}/query={upto.query}")
            paths = [f for f in folders if int(f.rsplit("batch_id=", 1)[1]) <= upto.id]
        if not paths:
            return spark.createDataFrame([], self.schema)
        files = spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return files.parquet(*paths)


@dataclass(frozen=True)
class SnapshotTable:
    """Parquet files that count once a version of the table names them.

    Readers follow the last version: they see a whole write or nothing of it, also while the table
    is compacted, and no folders are listed. A replayed micro-batch takes the place of its first
    try. Rename has to be atomic in the file system, as in HDFS or a mounted folder.
    """

    path: str
    schema: StructType

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> SnapshotTable:
        """A table that is there, with the columns that its files have."""
        folders = Manifest(path).folders(spark)
        return cls(path, spark.read.parquet(folders[0]).schema if folders else StructType())

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path)

    def write(self, df: DataFrame, batch: Batch | None = None) -> None:
        spark, folder = df.sparkSession, self.manifest.new_folder()
        key = f"{batch.query}/{batch.id}" if batch else f"/{uuid.uuid4().hex}"
        as_result(df, self.schema).write.parquet(f"{self.path}/{folder}")
        if self._folders(spark, [folder]).isEmpty():
            delete(spark, f"{self.path}/{folder}")
            folder = None
        if folder or key in {e.key for e in self.manifest.entries(spark)}:
            self.manifest.add(spark, folder, key)

    def _folders(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, spark: SparkSession, upto: Batch | None = None) -> DataFrame:
        """All rows, or those that one query has written up to a micro-batch."""
        found = self.manifest.entries(spark)
        if upto is not None:
            own = [(e, *e.key.rsplit("/", 1)) for e in found]
            found = [e for e, query, n in own if query == upto.query and int(n) <= upto.id]
        return self._folders(spark, [e.folder for e in found])

    def compact(
        self, spark: SparkSession, merged: Callable[[DataFrame], DataFrame] = lambda rows: rows
    ) -> None:
        """One folder for each query in place of those of its micro-batches, and one for all plain
        writes, with what `merged` makes of their rows. The last micro-batch of a query may still be
        replayed and stays as it is."""
        groups: dict[str, list[Entry]] = {}
        for entry in self.manifest.entries(spark):
            groups.setdefault(entry.key.rsplit("/", 1)[0], []).append(entry)
        for query, own in groups.items():
            if query:
                own = sorted(own, key=lambda e: int(e.key.rsplit("/", 1)[1]))[:-1]
            if len(own) < 2:
                continue
            folder = self.manifest.new_folder()
            rows = self._folders(spark, [e.folder for e in own])
            merged(rows).hint("rebalance").write.parquet(f"{self.path}/{folder}")
            try:
                self.manifest.replace(spark, own, folder, own[-1].key)
            except Exception:
                delete(spark, f"{self.path}/{folder}")
                raise


@dataclass(frozen=True)
class Console:
    """Print every row, on the task that has it: nothing passes through the driver."""

    schema: StructType
    show: Callable[[str], None] = print

    def write(self, df: DataFrame, batch: Batch | None = None) -> None:
        names, show = self.schema.fieldNames(), self.show

        def print_rows(rows) -> None:
            for row in rows:
                show(", ".join(f"{n}={v}" for n, v in zip(names, row, strict=True)))

        as_result(df, self.schema).foreachPartition(print_rows)
