"""Schemas of the stored tables."""

from pyspark.sql import types as T

PAIR = T.StructType([T.StructField("user", T.StringType()), T.StructField("assistant", T.StringType())])

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])

MESSAGE_LIST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("messages", T.ArrayType(T.StructType([T.StructField("turn", T.LongType()), *MESSAGE.fields]))),
    ]
)

TURN = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

CHUNK = T.StructType(
    [
        T.StructField("rid", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("is_last", T.BooleanType()),
    ]
)

SAMPLE = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("repeat_no", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

LOG_INPUT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("input", T.StringType()),
    ]
)
