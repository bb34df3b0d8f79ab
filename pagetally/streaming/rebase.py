"""A running report that goes on in a new query, as with more state partitions.

The number of state partitions of a query is fixed by its first start. A new query takes over what
the earlier one has: its open windows are read from its state and come as first rows, with their
counts; windows that it has closed stay closed; and lines that it has read are not read again. What
is taken over is written once into the checkpoint of the new query, so that its restarts find it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import exists, read_text, write_new
from ..sinks import Batch
from .open_windows import last_batch, open_counts


@dataclass(frozen=True)
class Taken:
    """Open windows as rows (key, event_time, n), a stream, and the watermark in milliseconds up
    to which windows are closed."""

    rows: DataFrame
    closed: int

    def going_on(self, visits: DataFrame, width: str, start: str | None, **others: Column) -> DataFrame:
        """Visits whose window was not reported yet, each counted once, and the open windows;
        these have the `others` for further columns."""
        ends = F.unix_millis(F.window("event_time", width, startTime=start)["end"])
        ended = visits.select(*visits.columns, ends.alias("_end"))
        fresh = ended.where(F.col("_end") > self.closed).drop("_end")
        return fresh.withColumn("n", F.lit(1).cast("long")).unionByName(self.rows.withColumns(others))


def _offsets(spark: SparkSession, checkpoint: str, batch: Batch) -> list:
    """What a query has noted for a micro-batch: its settings, then a position for each source."""
    return [json.loads(x) for x in read_text(spark, f"{checkpoint}/offsets/{batch.id}").splitlines()[1:]]


def processed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """`path` of the files that a query over a folder has finished."""
    batch = last_batch(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], "path string")
    upto = _offsets(spark, checkpoint, batch)[1 + source]["logOffset"]
    noted = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    parsed = noted.select(F.from_json("value", "path string, batchId long").alias("f")).select("f.*")
    return parsed.where(F.col("batchId") <= upto).select("path").distinct()


def source_position(spark: SparkSession, checkpoint: str, source: int = 0) -> str | None:
    """Where a query over a topic or over tailed files has ended, as starting offsets of another;
    None for one that has read nothing."""
    batch = last_batch(spark, checkpoint)
    return json.dumps(_offsets(spark, checkpoint, batch)[1 + source]) if batch else None


def take_over(
    spark: SparkSession, earlier: str | None, checkpoint: str, key: str, kind: T.DataType
) -> Taken | None:
    """What the query of a checkpoint goes on from; None for one that begins from nothing.

    `earlier` is the checkpoint of a query that has ended for good. It counts at the first start
    of the new query alone; later ones find what was written then.
    """
    folder = f"{checkpoint}/taken"
    schema = T.StructType(
        [T.StructField(key, kind), T.StructField("event_time", T.TimestampType()), T.StructField("n", T.LongType())]
    )
    if earlier and not exists(spark, f"{folder}/closed"):
        batch = last_batch(spark, earlier)
        counts = open_counts(spark, earlier, key, kind, batch)
        rows = counts.select(key, F.col("window.start").alias("event_time"), F.col("pv").alias("n"))
        rows.write.mode("overwrite").parquet(f"{folder}/rows")
        closed = _offsets(spark, earlier, batch)[0]["batchWatermarkMs"] if batch else 0
        write_new(spark, f"{folder}/closed", str(closed))
    if not exists(spark, f"{folder}/closed"):
        return None
    rows = spark.readStream.schema(schema).parquet(f"{folder}/rows")
    return Taken(rows, int(read_text(spark, f"{folder}/closed")))
