"""Visits as a table: parse the text once, then let every report read four columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parsing import visit_facts
from ..schemas import VISIT

_STORED = T.StructType([*VISIT.fields, T.StructField("visit_date", T.DateType())])


def write_visits(
    lines: DataFrame,
    path: str,
    honor_offset: bool = False,
    cluster_days: bool = True,
    replace_days: bool = False,
) -> None:
    """Store the visits by day, after those that are there or, with `replace_days`, in place of
    all visits of the days that the lines have: then a run can be repeated.

    Each day is brought together before writing, or every task would write a file into every day
    it meets; large days are split over several tasks and small ones merged at run time. Log
    files that hold few days each need no such shuffle (`cluster_days=False`).
    """
    dated = visit_facts(lines, honor_offset).withColumn("visit_date", F.to_date("event_time"))
    if cluster_days:
        dated = dated.hint("rebalance", "visit_date")
    writer = dated.write.mode("overwrite" if replace_days else "append").partitionBy("visit_date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_visits(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Stored visits, only the folders of the given days (both inclusive)."""
    visits = spark.read.schema(_STORED).parquet(path)
    if first:
        visits = visits.where(F.col("visit_date") >= F.lit(first))
    if last:
        visits = visits.where(F.col("visit_date") <= F.lit(last))
    return visits.drop("visit_date")
