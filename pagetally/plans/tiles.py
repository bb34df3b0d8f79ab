"""Visits counted once by hour, in increments, so that reports sum tiles instead of reading logs.

A tile is the number of visits of a client, a section or an article in one hour. Tiles of several
increments simply add up, and so do the hours of a window: any report whose windows begin and end
on the hour comes from them. Every increment notes the log files that it has counted, and the next
one reads only files that no increment has noted. Tiles and notes of an increment are committed
together or not at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import JobConfig
from ..manifest import Entry, Manifest
from ..operators import dimensions as D
from ..operators.parsing import visit_facts
from ..schemas import RAW_LINE
from ..session import delete
from ..sources import lines
from . import reports
from .reports import PageKind

CLIENT = "client"
_TILE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("client", T.StringType()),
        T.StructField("hour", T.TimestampType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_forum", T.LongType()),
    ]
)
_INPUT = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])
_HOURS = {"hour": 1, "day": 24, "week": 168}


def whole_hours(width: str) -> str:
    """A width or shift of windows; an error if tiles of an hour cannot make it up."""
    found = re.findall(r"(\d+)\s+(hour|day|week)s?\b", width)
    if not found or re.sub(r"\d+\s+(hour|day|week)s?\b", "", width).strip():
        raise ValueError(f"{width}: tiles make up windows of whole hours, days and weeks")
    return f"{sum(int(n) * _HOURS[unit] for n, unit in found)} hours"


def tiles(visits: DataFrame) -> DataFrame:
    """kind, id, client, hour, n, n_forum; counts combine before the one exchange. n_forum are the
    visits of section and article pages."""
    forum = ((F.col("section_id") > 0) | (F.col("article_id") > 0)).cast("long").alias("forum")
    nothing, nobody = F.lit(0).cast("long"), F.lit(None).cast("string")
    of = [(CLIENT, nothing, F.col("client_ip")), ("section", F.col("section_id"), nobody), ("article", F.col("article_id"), nobody)]
    each = F.array(*[F.struct(F.lit(k).alias("kind"), i.alias("id"), c.alias("client")) for k, i, c in of])
    hour = F.window("event_time", "1 hour")["start"].alias("hour")
    rows = visits.select(hour, forum, F.inline(each).alias("kind", "id", "client"))
    known = rows.where((F.col("kind") == CLIENT) | (F.col("id") > 0))
    sums = F.count("*").alias("n"), F.sum("forum").alias("n_forum")
    return known.groupBy("kind", "id", "client", "hour").agg(*sums)


@dataclass(frozen=True)
class TileStore:
    """Tiles below a folder. `honor_offset` says how dates are read, for all increments alike."""

    path: str
    honor_offset: bool = False

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path)

    def _read(self, spark: SparkSession, part: str, schema: T.StructType, entries: list[Entry]) -> DataFrame:
        paths = [f"{self.path}/{e.folder}/{part}" for e in entries]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def tiles(self, spark: SparkSession, kind: str) -> DataFrame:
        """All tiles of a kind; several of an id and hour where increments had both."""
        found = self._read(spark, "tiles", _TILE, self.manifest.entries(spark))
        return found.where(F.col("kind") == kind)

    def new_files(self, spark: SparkSession, path: str) -> DataFrame:
        """path and length of the files that no increment has counted. Files have to be finished:
        one that has another length than when it was counted is an error."""
        here = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
        counted = self._read(spark, "inputs", _INPUT, self.manifest.entries(spark))
        both = here.join(counted.withColumnRenamed("length", "counted"), "path", "left")
        changed = both.where(F.col("counted") != F.col("length")).select("path").take(3)
        if changed:
            raise ValueError(f"files have changed since they were counted: {[r.path for r in changed]}")
        return both.where(F.col("counted").isNull()).select("path", "length")

    def new_lines(self, spark: SparkSession, files: DataFrame, form: str = "text") -> DataFrame:
        """The lines of these files; nothing else is read."""
        paths = [r.path for r in files.select("path").collect()]  # as a reader of files lists them
        if not paths:
            return spark.createDataFrame([], RAW_LINE)
        return lines.spread(spark.read.schema(RAW_LINE).format(form).load(paths))

    def _commit(self, spark: SparkSession, write: Callable[[str], None], old: list[Entry]) -> None:
        folder = self.manifest.new_folder()
        write(f"{self.path}/{folder}")
        try:
            if old:
                self.manifest.replace(spark, old, folder, folder)
            else:
                self.manifest.add(spark, folder, folder)
        except Exception:
            delete(spark, f"{self.path}/{folder}")
            raise

    def add(self, spark: SparkSession, path: str, form: str = "text") -> int:
        """Count the files below a path that are new, as text or Parquet lines; their number.

        One increment runs at a time. One that fails leaves nothing that counts.
        """
        files = self.new_files(spark, path)
        noted = spark.createDataFrame(files.collect(), _INPUT)
        n = noted.count()
        if n == 0:
            return 0

        def write(folder: str) -> None:
            visits = visit_facts(self.new_lines(spark, noted, form), self.honor_offset)
            tiles(visits).hint("rebalance").sortWithinPartitions("kind", "id", "hour").write.parquet(f"{folder}/tiles")
            noted.write.parquet(f"{folder}/inputs")

        self._commit(spark, write, [])
        return n

    def compact(self, spark: SparkSession) -> None:
        """One folder with the summed tiles in place of all. Readers that have begun are not
        disturbed; `manifest.clean` removes the old folders later."""
        old = self.manifest.entries(spark)
        if len(old) < 2:
            return

        def write(folder: str) -> None:
            keys = ("kind", "id", "client", "hour")
            found = self._read(spark, "tiles", _TILE, old)
            summed = found.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "n_forum")])
            summed.hint("rebalance").sortWithinPartitions("kind", "id", "hour").write.parquet(f"{folder}/tiles")
            self._read(spark, "inputs", _INPUT, old).hint("rebalance").write.parquet(f"{folder}/inputs")

        self._commit(spark, write, old)


def _windowed(found: DataFrame, key: str, count: str, width: str, start: str | None) -> DataFrame:
    start = whole_hours(start) if start else None
    window = F.window("hour", whole_hours(width), startTime=start).alias("window")
    return found.groupBy(F.col(key), window).agg(F.sum(count).alias("pv")).where("pv > 0")


def page_counts(store: TileStore, dim: DataFrame, kind: PageKind, cfg: JobConfig) -> DataFrame:
    """Visits of known pages per page and window, with names; `dim` is prepared by its kind."""
    name = kind.visit_key.removesuffix("_id")
    found = store.tiles(dim.sparkSession, name).withColumnRenamed("id", kind.visit_key)
    counts = _windowed(found, kind.visit_key, "n", cfg.hot_window, cfg.window_start_time)
    return D.name_counts(counts, dim, kind.visit_key, kind.dim_key)


def page_report(store: TileStore, dim: DataFrame, kind: PageKind, cfg: JobConfig = JobConfig()) -> DataFrame:
    return reports.page_report(page_counts(store, kind.prepare(dim), kind, cfg), kind, cfg)


def top_pages(store: TileStore, dim: DataFrame, kind: PageKind, cfg: JobConfig = JobConfig()) -> DataFrame:
    return reports.top_pages(page_counts(store, kind.prepare(dim), kind, cfg), kind, cfg)


def client_access(spark: SparkSession, store: TileStore, cfg: JobConfig = JobConfig()) -> DataFrame:
    found = store.tiles(spark, CLIENT).withColumnRenamed("client", "client_ip")
    count = "n_forum" if cfg.forum_pages_only else "n"
    counts = _windowed(found, "client_ip", count, cfg.client_window, cfg.window_start_time)
    return reports.client_report(counts, cfg)
