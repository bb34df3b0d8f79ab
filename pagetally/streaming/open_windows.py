"""Counts of the windows that a running report has not closed yet, from the state of its query.

A stream reports a window once, when the watermark passes its end; until then its counters are in
the state store. They are read from there as of one finished micro-batch, without a second reading
of the logs and without disturbing the query. Together with what the query has reported up to the
same micro-batch they are all that was counted: a counter leaves the state in the micro-batch that
reports it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import JobConfig
from ..operators import dimensions as D
from ..plans import reports
from ..plans.reports import PageKind
from ..session import children
from ..sinks import Batch, FileTable, query_id

_WINDOW = T.StructType([T.StructField(c, T.TimestampType()) for c in ("start", "end")])


def last_batch(spark: SparkSession, checkpoint: str) -> Batch | None:
    """The last finished micro-batch of the query that owns a checkpoint."""
    names = [path.rsplit("/", 1)[1] for path in children(spark, f"{checkpoint}/commits")]
    done = [int(n) for n in names if n.isdigit()]
    return Batch(query_id(spark, checkpoint), max(done)) if done else None


def open_counts(
    spark: SparkSession, checkpoint: str, key: str, kind: T.DataType, batch: Batch | None = None
) -> DataFrame:
    """Key, window and pv of every open window as of a micro-batch, the last one by default; no
    rows where none has finished."""
    batch = batch or last_batch(spark, checkpoint)
    if batch is None:
        fields = [T.StructField(key, kind), T.StructField("window", _WINDOW)]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("pv", T.LongType())]))
    state = spark.read.format("statestore").option("batchId", batch.id).load(checkpoint)
    counted = F.col("value")[state.schema["value"].dataType[0].name].alias("pv")
    return state.select(F.col(f"key.{key}").alias(key), F.col("key.window").alias("window"), counted)


def open_client_access(
    spark: SparkSession, checkpoint: str, cfg: JobConfig = JobConfig(), batch: Batch | None = None
) -> DataFrame:
    """The client report of the open windows so far."""
    counts = open_counts(spark, checkpoint, "client_ip", T.StringType(), batch)
    return reports.client_report(counts, cfg)


def open_pages(
    spark: SparkSession,
    checkpoint: str,
    dim: DataFrame,
    kind: PageKind,
    cfg: JobConfig = JobConfig(),
    batch: Batch | None = None,
) -> DataFrame:
    """The top pages of the open windows so far, with the names that the dimension has now."""
    counts = open_counts(spark, checkpoint, kind.visit_key, T.LongType(), batch)
    named = D.name_counts(counts, kind.prepare(dim), kind.visit_key, kind.dim_key, how="left")
    return reports.top_pages(named, kind, cfg)


def client_access_so_far(
    spark: SparkSession, table: FileTable, checkpoint: str, cfg: JobConfig = JobConfig()
) -> DataFrame:
    """Closed and open windows of one query, as of its last finished micro-batch."""
    batch = last_batch(spark, checkpoint)
    closed = table.read(spark, batch) if batch else spark.createDataFrame([], table.schema)
    return closed.unionByName(open_client_access(spark, checkpoint, cfg, batch))
