"""Dimension tables: JDBC or files, and a snapshot of them for one job start."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import children, delete, run_dir, shared_dir


def driver_settings(url: str) -> dict[str, str]:
    """What the MySQL driver needs to honour Spark's fetch and batch sizes: without a cursor it
    holds a whole result in the task, and without rewriting it sends batches row by row."""
    if not url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return {}
    return {"useCursorFetch": "true", "rewriteBatchedStatements": "true"}


def jdbc_options(
    url: str, table: str, connection: dict[str, str] | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    return {**options, **driver_settings(url), **(connection or {})}


def jdbc_dimension(
    spark: SparkSession,
    options: dict[str, str],
    schema: StructType,
    parts: int = 1,
) -> DataFrame:
    """The columns of `schema` from a database table; filters and columns are pushed down.

    With parts > 1 the first column, the numeric key, is split into that many ranges, each
    read by its own task and connection. The range ends are asked from the database.
    """
    columns = schema.fieldNames()
    if parts > 1:
        key = columns[0]
        bounds_query = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {options['dbtable']}"
        once = {k: v for k, v in options.items() if k != "dbtable"}
        bounds = spark.read.format("jdbc").options(**once, query=bounds_query).load().first()
        if bounds and bounds[0] is not None:
            options = {
                **options,
                "partitionColumn": key,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]),
                "numPartitions": str(parts),
            }
    return spark.read.format("jdbc").options(**options).load().select(*columns)


def snapshot(dim: DataFrame, name: str, owner: str | None = None) -> DataFrame:
    """Write a prepared dimension once to the shared folder and read it from there.

    A stream then looks up one fixed state of the table, does not query the database per
    micro-batch, survives lost executors, and Spark knows the size for its join choice. With an
    `owner`, the checkpoint of the one query that reads it, earlier snapshots of that owner are
    removed once the new one is written.
    """
    spark = dim.sparkSession
    if owner is None:
        path = run_dir(spark, f"dim-{name}")
    else:
        mark = hashlib.sha256(owner.encode()).hexdigest()[:16]
        folder = f"{shared_dir(spark)}/pagetally/dim-{name}-{mark}"
        earlier = children(spark, folder)
        path = f"{folder}/{uuid.uuid4().hex}"
    dim.write.parquet(path)
    for old in earlier if owner is not None else []:
        delete(spark, old)
    return spark.read.schema(dim.schema).parquet(path)
