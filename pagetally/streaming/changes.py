"""A dimension as a stream of changes, and the hot-page report that follows it.

The state of one query holds the newest version of every page and writes what has changed to a
table of snapshots. The report counts pages by id and looks names up in the newest version whenever
it reports a window: a title that is edited while the report runs is in the next window, and a page
that is created meanwhile is counted from its first visit on. Neither query is started again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import JobConfig
from ..operators import dimensions as D
from ..operators.parsing import visit_facts
from ..plans import reports
from ..plans.reports import PageKind
from ..sinks import Batch, SnapshotTable
from .runner import AVAILABLE_NOW, start_writing


def change_schema(kind: PageKind) -> T.StructType:
    """Columns of a change: the id, the name from then on, and a version that grows. A page without
    a name, or with an empty one, is unknown from then on."""
    fields = [(kind.dim_key, T.LongType()), (kind.name, T.StringType()), ("version", T.LongType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def newest(changes: DataFrame, kind: PageKind) -> DataFrame:
    """The newest version of every id; of equal versions the greatest name."""
    last = F.max(F.struct("version", kind.name)).alias("last")
    return changes.groupBy(kind.dim_key).agg(last).select(kind.dim_key, f"last.{kind.name}", "last.version")


def start_dimension(
    changes: DataFrame,
    kind: PageKind,
    table: SnapshotTable,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep the newest versions of a stream of changes, in any order, in a table."""
    key, name = kind.dim_key, kind.name
    typed = changes.select(F.col(key).cast("long").alias(key), name, F.col("version").cast("long").alias("version"))

    def write(batch: DataFrame, at: Batch) -> None:
        table.write(batch, at)

    versions = newest(typed.where(F.col(key) > 0), kind)
    return start_writing(versions, write, checkpoint, f"dimension_{key}", trigger, mode="update")


def names(spark: SparkSession, table: SnapshotTable, kind: PageKind) -> DataFrame:
    """Pages that are known now."""
    last = newest(table.read(spark), kind).drop("version")
    return last.where(F.col(kind.name) != "")


def compact(spark: SparkSession, table: SnapshotTable, kind: PageKind) -> None:
    """One row per page in place of all its versions; readers are not disturbed."""
    table.compact(spark, lambda rows: newest(rows, kind))


def start_hot_pages(
    lines: DataFrame,
    kind: PageKind,
    table: SnapshotTable,
    sink,
    checkpoint: str,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """The hot-page report with the names of the moment at which a window is reported.

    All pages are counted, and those that are unknown then are left out; the watermark follows the
    visits of all pages of the kind.
    """
    visits = visit_facts(lines, cfg.honor_offset)
    counts = reports.page_counts(visits, None, kind, cfg)

    def write(counted: DataFrame, at: Batch) -> None:
        known = names(counted.sparkSession, table, kind)
        named = D.name_counts(counted, known, kind.visit_key, kind.dim_key)
        sink.write(reports.top_pages(named, kind, cfg), at)

    return start_writing(counts, write, checkpoint, f"hot_{kind.visit_key}_changing", trigger)
