"""Section and article dimensions and the lookup of visits in them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _unique(dim: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key. Repeated keys would multiply visits; the greatest name is kept."""
    return dim.groupBy(key).agg(F.max(name).alias(name))


def sections(dim: DataFrame) -> DataFrame:
    """Sections by id. Id 0 stands for visits of no section, so no section has it."""
    return _unique(dim.select("fid", "name").where(F.col("fid") > 0), "fid", "name")


def articles(dim: DataFrame) -> DataFrame:
    """Articles with a subject; empty and NULL subjects are left out, and id 0 with them."""
    kept = dim.select("tid", "subject").where((F.col("subject") != "") & (F.col("tid") > 0))
    return _unique(kept, "tid", "subject")


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether the optimizer's size estimate is within spark.sql.autoBroadcastJoinThreshold.

    The estimate comes from file sizes; a source of unknown size counts as too large.
    """
    spark = dim.sparkSession
    jconf = spark._jsparkSession.sessionState().conf()
    limit = jconf.autoBroadcastJoinThreshold()
    size = dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit >= 0 and int(str(size)) <= limit


#: Ids of one bucket of a bitmap, and the bytes that they take.
_BUCKET_BYTES = 4096
#: Counters of a sketch of frequent ids: some for each id that can be frequent, and Spark's limit.
_COUNTERS_EACH, _MOST_COUNTERS = 16, 1_000_000


def known_ids(dim: DataFrame, dim_key: str) -> DataFrame:
    """Which ids above 0 there are: `_bucket`, and `_bits` of 4 KB for 32,768 ids each."""
    ids = dim.select(F.col(dim_key).cast("bigint").alias("id")).where("id > 0")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("_bits")
    return ids.groupBy(F.bitmap_bucket_number("id").alias("_bucket")).agg(bits)


def with_known_id(
    visits: DataFrame, dim: DataFrame, visit_key: str, dim_key: str, limit: int
) -> DataFrame | None:
    """The visits whose id is in the dimension, without a move of any visit; None if the bitmap of
    the ids would exceed `limit` bytes. Its size is counted before it is broadcast: a dimension
    numbered without gaps takes an eighth of a byte for each id, whatever its rows hold."""
    bitmap = known_ids(dim, dim_key)
    if bitmap.count() * _BUCKET_BYTES > limit:
        return None
    bucket, at = (f(F.col(visit_key)).alias(n) for f, n in ((F.bitmap_bucket_number, "_bucket"), (F.bitmap_bit_position, "_at")))
    placed = visits.where(F.col(visit_key) > 0).select("*", bucket, at)
    joined = placed.join(F.broadcast(bitmap), "_bucket")
    byte = F.substring("_bits", (F.col("_at") / 8).cast("int") + 1, F.lit(1))
    value = F.ascii(F.decode(byte, "ISO-8859-1"))
    known = F.expr("_at % 8").cast("int")
    return joined.where(F.getbit(value, known) == 1).select(*visits.columns)


def exchange_partitions(spark: SparkSession) -> int:
    """The partitions that an exchange of a join begins with."""
    conf = spark._jsparkSession.sessionState().conf()
    return conf.numShufflePartitions()


def hot_keys(visits: DataFrame, visit_key: str, share: float) -> dict[int, float]:
    """Ids that more than a share of all visits has, with their shares, as a sketch tells them;
    1 / share ids at most. The visits are read once: a sketch of the frequent ids and the number of
    all visits are one aggregate, merged from those of the tasks."""
    most = math.ceil(1 / share)
    counters = min(_COUNTERS_EACH * most, _MOST_COUNTERS)
    most = min(most, counters)
    sketch = F.expr(f"approx_top_k(cast({visit_key} as bigint), {most}, {counters})").alias("top")
    row = visits.where(F.col(visit_key) > 0).agg(F.count("*").alias("n"), sketch).first()
    return {r["item"]: r["count"] / row.n for r in row.top or [] if r["count"] > share * row.n}


def lookup(
    visits: DataFrame,
    dim: DataFrame,
    visit_key: str,
    dim_key: str,
    salts: int = 8,
    bitmap_bytes: int = 64 << 20,
) -> DataFrame:
    """Inner join of every visit with its dimension row (N:1); `dim` has unique keys above 0.

    Visits without a page (id 0) are left out before anything is moved. A dimension of checked
    size is broadcast: no shuffle of visits, no skew. For a larger one a bitmap of its ids leaves
    out the visits of unknown pages where they are, unless it exceeds `bitmap_bytes`; a dimension
    of ids alone needs no more than that. The others are joined by key and salt. In a batch a sketch
    of one more reading finds the hot pages, and each gets as many salts as its share fills
    partitions twice over, so that it spreads as evenly as all others; only its dimension row is
    repeated. A stream cannot count ahead: there each key has `salts` of them.
    """
    spark = visits.sparkSession
    visits = visits.where(F.col(visit_key) > 0)
    kind = visits.schema[visit_key].dataType
    columns, others = visits.columns, [c for c in dim.columns if c != dim_key]
    dim = dim.select(F.col(dim_key).cast(kind).alias(visit_key), *others)
    if fits_broadcast(dim):
        return visits.join(F.broadcast(dim), visit_key)
    known = with_known_id(visits, dim, visit_key, visit_key, bitmap_bytes)
    if known is not None and not others:
        return known
    visits = visits if known is None else known
    number = F.lit(salts)
    if not visits.isStreaming:
        partitions = exchange_partitions(spark)
        hot = hot_keys(visits, visit_key, 0.25 / partitions)
        number = F.lit(1)
        if hot:
            rows = [(k, int(4 * v * partitions) + 1) for k, v in hot.items()]
            table = spark.createDataFrame(rows, f"{visit_key} {kind.simpleString()}, _salts int")
            visits, dim = (df.join(F.broadcast(table), visit_key, "left") for df in (visits, dim))
            number = F.coalesce("_salts", F.lit(1))
    drawn = F.pmod(F.xxhash64("client_ip", "event_time"), number).cast("int").alias("_salt")
    salted = visits.select(*columns, drawn)
    every = F.explode(F.sequence(F.lit(0), number - 1)).alias("_salt")
    repeated = dim.select(visit_key, *others, every)
    return salted.join(repeated, [visit_key, "_salt"]).drop("_salt")


def name_counts(
    counts: DataFrame, dim: DataFrame, count_key: str, dim_key: str, how: str = "inner"
) -> DataFrame:
    """Finished counts with the names of the dimension.

    Counts hold one row per key and window, so there is no skew left to salt against; Spark
    picks broadcast or sort-merge by size, at run time where AQE is on. A left join keeps the
    counts of a page that has left the dimension since, without a name.
    """
    kind = counts.schema[count_key].dataType
    others = [c for c in dim.columns if c != dim_key]
    named = dim.select(F.col(dim_key).cast(kind).alias(count_key), *others)
    return counts.join(named, count_key, how)
