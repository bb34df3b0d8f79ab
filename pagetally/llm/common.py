"""What several operators share: words, batches, hashes and intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagetally.session import delete, run_dir

#: Characters that part words: blank, tab, newline, vertical tab, form feed, carriage return.
BLANKS = " \t\n\v\f\r"


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8. bytes.split() parts at exactly the characters of BLANKS."""
    return (text or "").encode().split()


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case; bytes.lower() leaves all other characters alone."""
    return (text or "").encode().lower().split()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small pieces of Arrow batches, so that a task holds few texts as Python strings at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def whole_texts(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """The same rows, for a session whose Arrow batches hold few of them: texts are long, and a
    batch of very long ones must still fit."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= rows:
        conf.set(setting, str(rows))
    return docs


def stored(df: DataFrame, name: str, trail: list[str] | None = None) -> DataFrame:
    """The rows written as a table in the shared folder and read again: no lineage is left,
    and a lost executor takes nothing of it away. The folder is added to the trail, if any."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    if trail is not None:
        trail.append(path)
    return spark.read.schema(df.schema).parquet(path)


def only_last(spark: SparkSession, trail: list[str]) -> None:
    """Remove the tables of a trail but the last one, which no longer needs them."""
    for path in trail[:-1]:
        delete(spark, path)
    del trail[:-1]


class Shared:
    """An object of bounded size that is sent to all tasks, its classes by value: executors need no
    copy of this package for it."""

    def __init__(self, spark: SparkSession, value: object):
        self.pickled = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return cloudpickle.loads(self.pickled.value)


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; folds are remainders of it. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def parts(df: DataFrame, per_input: int = 1) -> int:
    """Partitions for an exchange of what a scan yields: they follow the size of the input."""
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(setting, per_input * df.rdd.getNumPartitions())


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n numbers that repartition(n, key) sends to n different partitions. A number of buckets
    like the number of partitions, but named 0, 1, ..., would leave some of these empty and
    bring several buckets to others."""
    tried = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("partition"))
    rows = tried.groupBy("partition").agg(F.min("id").alias("id")).collect()  # n rows at most
    found = sorted(r["id"] for r in rows)
    return found + [64 * n + i for i in range(n - len(found))]


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of a DataFrame and more fields after it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
