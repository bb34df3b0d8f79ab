"""Tumbling-window counts and the top rows of each window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import run_dir

#: Slots of a histogram of each window, and the most rows of a window that one task ranks.
_SLOTS = 4096
_RANKED = 10_000


def tumbling_count(
    df: DataFrame, keys: list[str], width: str, start_time: str | None = None
) -> DataFrame:
    """Rows per key and event-time window, as `pv`; a row counts `n` times where it has that column.

    Counts combine before the shuffle, so a key that holds a third of all rows still sends
    one row per task. In a stream the state is one counter per key and open window.
    """
    window = F.window("event_time", width, startTime=start_time)
    counted = F.sum("n") if "n" in df.columns else F.count("*")
    return df.groupBy(*keys, window.alias("window")).agg(counted.alias("pv"))


def top_n(counts: DataFrame, n: int, tie: str) -> DataFrame:
    """The n rows with the highest `pv` of each window; equal counts in order of `tie`, a number.

    For small n Spark keeps n rows per task before the shuffle (WindowGroupLimit). Above the
    threshold of that rule the rows are selected by histograms instead.
    """
    limit = int(
        counts.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    )
    return _first_rows(counts, n, tie) if n <= limit else select_top(counts, n, tie)


def select_top(counts: DataFrame, n: int, tie: str) -> DataFrame:
    """The same rows without ranking a window: no task sees more of it than its share.

    The counts are stored once. A histogram of each window tells the range of counts in which its
    n-th row is; all rows above it stay. That range is divided again, and once it is a single count
    by `tie`, until a window has few rows in it; only these are ranked. What is collected is one
    range for each window.
    """
    spark, path = counts.sparkSession, run_dir(counts.sparkSession, "top")
    counts.write.parquet(path)
    rows = spark.read.schema(counts.schema).parquet(path).withColumn("_at", F.unix_micros("window.start"))
    size, wanted = F.count("*").alias("size"), F.lit(n).cast("long").alias("left")
    whole = rows.groupBy("_at").agg(size, *_ends(tie)).select("_at", *_ENDS, "size", wanted)
    # Windows of n rows and less stay as they are; they have no range.
    found, done = whole.where("size > left").collect(), []
    while found:
        small = [r for r in found if r.size <= _RANKED or (r.pv_lo, r.tie_lo) == (r.pv_hi, r.tie_hi)]
        large = [r for r in found if r not in small]
        done += small
        found = _narrowed(rows, spark.createDataFrame(large, _RANGE), tie).collect() if large else []
    placed = rows.join(F.broadcast(spark.createDataFrame(done, _RANGE)), "_at", "left")
    last_count = (F.col("pv_lo") == F.col("pv_hi")) & (F.col("pv") == F.col("pv_hi"))
    above = (F.col("pv") > F.col("pv_hi")) | (last_count & (F.col(tie) < F.col("tie_lo")))
    sure = placed.where(F.col("left").isNull() | above)
    edge = _ranked(placed.where(_inside(tie)), tie).where(F.col("_rank") <= F.col("left"))
    return sure.select(*counts.columns).unionByName(edge.select(*counts.columns))


_ENDS = ["pv_lo", "pv_hi", "tie_lo", "tie_hi"]
#: Of each window, by its start in microseconds: where its n-th row is, how many rows are there,
#: and how many of these are wanted.
_RANGE = ", ".join(f"{c} long" for c in ("_at", *_ENDS, "size", "left"))


def _ends(tie: str) -> list[Column]:
    pairs = [(f, c) for c in ("pv", tie) for f in (F.min, F.max)]
    return [f(c).cast("long").alias(name) for (f, c), name in zip(pairs, _ENDS, strict=True)]


def _inside(tie: str) -> Column:
    """Rows in the range of their window."""
    counted = F.col("pv").between(F.col("pv_lo"), F.col("pv_hi"))
    return counted & F.col(tie).between(F.col("tie_lo"), F.col("tie_hi"))


def _narrowed(rows: DataFrame, ranges: DataFrame, tie: str) -> DataFrame:
    """The slot of each range that has the last row wanted, as a range of its own."""
    inside = rows.join(F.broadcast(ranges), "_at").where(_inside(tie))

    def slot_of(value: str, lo: str, hi: str) -> Column:
        width = (F.col(hi) - F.col(lo)).cast("double") + 1
        return F.floor((F.col(value) - F.col(lo)).cast("double") * _SLOTS / width)

    # High counts come first, and small ties.
    by_count = F.lit(_SLOTS) - slot_of("pv", "pv_lo", "pv_hi")
    by_tie = slot_of(tie, "tie_lo", "tie_hi")
    slot = F.when(F.col("pv_lo") < F.col("pv_hi"), by_count).otherwise(by_tie).alias("slot")
    slots = inside.groupBy("_at", "left", slot).agg(F.count("*").alias("size"), *_ends(tie))
    upto = F.sum("size").over(Window.partitionBy("_at").orderBy("slot"))
    counted = slots.withColumn("before", upto - F.col("size"))
    edge = counted.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("size") >= F.col("left")))
    return edge.select("_at", *_ENDS, "size", (F.col("left") - F.col("before")).alias("left"))


def _ranked(df: DataFrame, tie: str) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("pv"), F.asc(tie))
    return df.withColumn("_rank", F.row_number().over(order))


def _first_rows(df: DataFrame, n: int, tie: str) -> DataFrame:
    return _ranked(df, tie).where(F.col("_rank") <= n).drop("_rank")


def with_bounds(df: DataFrame) -> DataFrame:
    """Replace `window` by its start (inclusive) and end (exclusive) as text."""
    return df.select(
        *[c for c in df.columns if c != "window"],
        C.time_text(F.col("window.start")).alias("time_beg"),
        C.time_text(F.col("window.end")).alias("time_end"),
    )
