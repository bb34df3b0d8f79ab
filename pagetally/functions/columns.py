"""Column expressions over the parts of a log line. All built-in, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P


def once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a costly column that is worked out exactly once per row.

    A filter on a plain projected column is pushed below the projection, which evaluates
    the expression a second time. Predicates do not move below a generator, so the column
    is generated from a one-element array.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def event_time(date_time: Column, honor_offset: bool = False) -> Column:
    """Bracketed log date to TIMESTAMP; NULL where the date is missing or not valid.

    By default the zone offset is dropped and the wall clock is read in the session zone.
    """
    if honor_offset:
        text = F.regexp_extract(date_time, r"\[(.*)]", 1)
        return F.try_to_timestamp(text, F.lit(P.LOG_DATE_WITH_ZONE))
    text = F.regexp_extract(date_time, P.DATE_IN_BRACKETS, 1)
    return F.try_to_timestamp(text, F.lit(P.LOG_DATE))


def request_part(request: Column, index: int) -> Column:
    """Part 0, 1 or 2 of a request that has exactly three parts, else NULL."""
    parts = F.split(request, " ")
    return F.when(F.size(parts) == 3, parts[index])


def page_id(request: Column, pattern: str) -> Column:
    """Numeric page id named by the request; 0 if it names none or the id exceeds BIGINT.

    The empty match is turned into NULL before the cast: try_cast of '' raises and catches
    an exception for each row inside the JVM, which costs more than all the parsing.
    """
    digits = F.regexp_extract(request_part(request, 1), pattern, 2)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def time_text(ts: Column) -> Column:
    return F.date_format(ts, P.RESULT_DATE)
