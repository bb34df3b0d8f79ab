"""Raw log lines as a DataFrame with one column, `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_LINE

DEFAULT_TOPIC = "user_access_logs"
# Settings of a plain consumer that Spark decides by itself.
CONSUMER_ONLY = {
    "key.deserializer",
    "value.deserializer",
    "auto.offset.reset",
    "group.id",
    "enable.auto.commit",
}


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate, which comes from the sizes of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, bytes_each: int = 64 << 20) -> DataFrame:
    """Deal rows out where the input has few partitions, as with a few large gzip files.

    Parsing is the costly step, so it pays to use every core, and to use partitions of a size
    that a task can hold: one per core at least, and one per `bytes_each` of the files. An input
    that can be split has enough partitions by itself and is not shuffled.
    """
    spark = df.sparkSession
    cores, have, size = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions(), input_bytes(df)
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if have >= cores and size <= 2 * split * have:
        return df
    return df.repartition(max(cores, -(-size // bytes_each))) if size < 1 << 60 else df.repartition(cores)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(RAW_LINE).text(path))


def without_files(stream: DataFrame, processed: DataFrame) -> DataFrame:
    """The rows of a folder's stream but those of files that an earlier query has processed
    (`path`), when a new query goes on in its place."""
    # Spark writes the same file with one slash after the scheme, or with three.
    same = lambda path: F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/").alias("_path")
    named = stream.select("*", same(F.col("_metadata.file_path")))
    return named.join(processed.select(same(F.col("path"))), "_path", "left_anti").drop("_path")


def text_line_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files moved into a folder. Files are read whole and once, oldest first."""
    reader = spark.readStream.schema(RAW_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder)


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines stored by the landing job."""
    return spread(spark.read.schema(RAW_LINE).parquet(path))


def landed_line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(RAW_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def kafka_options(
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    consumer: dict[str, str] | None = None,
    ended: str | None = None,
) -> dict[str, str]:
    """Reader options. Offsets live in the checkpoint; `starting_offsets` counts only for
    the first start, and an offset reset among the consumer settings is one. `min_partitions`
    lets more tasks than topic partitions read and parse. Deserializers, groups and commits are
    Spark's own and are left out. `ended` are the offsets at which an earlier query has ended.
    """
    consumer = consumer or {}
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": ended or consumer.get("auto.offset.reset", starting_offsets),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    options |= {f"kafka.{k}": v for k, v in consumer.items() if k not in CONSUMER_ONLY}
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message payloads as text. Needs the spark-sql-kafka package on the cluster."""
    messages = spark.readStream.format("kafka").options(**options).load()
    return messages.selectExpr("CAST(value AS STRING) AS value")
