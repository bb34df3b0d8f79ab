"""Explicit schemas of every source and result table; nothing is inferred."""

from pyspark.sql import types as T

RAW_LINE = T.StructType([T.StructField("value", T.StringType())])

SECTION_DIM = T.StructType(
    [T.StructField("fid", T.IntegerType()), T.StructField("name", T.StringType())]
)
ARTICLE_DIM = T.StructType(
    [T.StructField("tid", T.IntegerType()), T.StructField("subject", T.StringType())]
)

VISIT = T.StructType(
    [
        T.StructField("client_ip", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("section_id", T.LongType()),
        T.StructField("article_id", T.LongType()),
    ]
)


def _result(key: str, key_type: T.DataType, *rest: T.StructField) -> T.StructType:
    bounds = [T.StructField(c, T.StringType()) for c in ("time_beg", "time_end")]
    return T.StructType([T.StructField(key, key_type), *rest, *bounds])


# Result tables as the sinks receive them: ids and counts are BIGINT, window bounds are text.
HOT_SECTION = _result(
    "section_id",
    T.LongType(),
    T.StructField("name", T.StringType()),
    T.StructField("section_pv", T.LongType()),
)
HOT_ARTICLE = _result(
    "article_id",
    T.LongType(),
    T.StructField("subject", T.StringType()),
    T.StructField("article_pv", T.LongType()),
)
REJECTED = T.StructType([T.StructField(c, T.StringType()) for c in ("value", "reason")])
CLIENT_IP_ACCESS = _result(
    "client", T.StringType(), T.StructField("client_access_cnt", T.LongType())
)
