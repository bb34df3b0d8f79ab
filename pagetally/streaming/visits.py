"""Visits of a stream as a table, late ones apart.

A row is late if its window had ended by the watermark of the micro-batch that brings it: the
greatest time of all earlier micro-batches, less the delay. Such rows are stored beside the others
instead of being dropped by the counters behind, so every visit is either counted or in the table
of late ones. Reports read the visits that are in time as a stream; they parse no text, and several
reports share one parsing.

A micro-batch appears as a whole, by the rename of a folder, and is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import JobConfig
from ..operators.parsing import visit_facts
from ..plans import reports
from ..schemas import VISIT
from ..session import children, exists, read_text, rename, write_new
from ..sinks import Batch
from .runner import AVAILABLE_NOW, start_writing

_STORED = T.StructType(
    [*VISIT.fields, T.StructField("batch_id", T.LongType()), T.StructField("late", T.BooleanType())]
)


def _greatest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Microseconds of the greatest time that earlier micro-batches have; none before the first."""
    names = [p.rsplit("/", 1)[1] for p in children(spark, f"{path}/greatest")]
    earlier = [int(n) for n in names if n.isdigit() and int(n) < batch_id]
    if not earlier:
        return None
    text = read_text(spark, f"{path}/greatest/{max(earlier)}")
    return int(text) if text else None


def _store(visits: DataFrame, path: str, batch_id: int, width: str, cfg: JobConfig) -> None:
    spark, done = visits.sparkSession, f"{path}/visits/batch_id={batch_id}"
    if exists(spark, f"{path}/greatest/{batch_id}"):
        return
    greatest = _greatest_before(spark, path, batch_id)
    if not exists(spark, done):
        late = F.lit(False)
        if greatest is not None:
            ends = F.window("event_time", width, startTime=cfg.window_start_time)["end"]
            limit = F.timestamp_micros(F.lit(greatest)) - F.expr(f"interval {cfg.watermark_delay}")
            late = ends <= limit
        staged = f"{path}/_staged/{batch_id}"
        flagged = visits.select(*VISIT.fieldNames(), late.alias("late"))
        flagged.write.mode("overwrite").partitionBy("late").parquet(staged)
        rename(spark, staged, done)
    found = spark.read.schema(VISIT).option("recursiveFileLookup", "true").parquet(done)
    now = found.agg(F.max(F.unix_micros("event_time"))).first()[0]
    known = [x for x in (greatest, now) if x is not None]
    write_new(spark, f"{path}/greatest/{batch_id}", str(max(known)) if known else "")


def start_visits(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    width: str | None = None,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Store the visits of a stream of lines. `width` is that of the windows that decide which are
    late, those of the client report by default."""
    width = width or cfg.client_window

    def write(batch: DataFrame, at: Batch) -> None:
        _store(batch, path, at.id, width, cfg)

    return start_writing(visit_facts(lines, cfg.honor_offset), write, checkpoint, "visits", trigger)


def visit_stream(spark: SparkSession, path: str) -> DataFrame:
    """Visits in time, as a stream that takes whole micro-batches of the one before."""
    found = spark.readStream.schema(_STORED).parquet(f"{path}/visits")
    return found.where(~F.col("late")).select(*VISIT.fieldNames())


def late_visits(spark: SparkSession, path: str) -> DataFrame:
    """Visits whose window had ended, with the micro-batch that brought them."""
    if not exists(spark, f"{path}/visits"):
        return spark.createDataFrame([], T.StructType(_STORED.fields[:-1]))
    found = spark.read.schema(_STORED).parquet(f"{path}/visits")
    return found.where("late").drop("late")


def start_client_access(
    visits: DataFrame, sink, checkpoint: str, cfg: JobConfig = JobConfig(), trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """The client report over a stream of visits."""
    counts = reports.client_counts(visits, cfg)
    return start_writing(counts, sink.write, checkpoint, "client_access", trigger)


def corrections(spark: SparkSession, path: str, cfg: JobConfig = JobConfig()) -> DataFrame:
    """What late visits add to the client report, in its columns."""
    return reports.client_counts(late_visits(spark, path), cfg)

