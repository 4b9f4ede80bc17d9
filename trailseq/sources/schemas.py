"""Explicit schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T

LONGS = T.ArrayType(T.LongType())
VECTOR = T.ArrayType(T.DoubleType())

ENVIRONMENT = T.StructType([
    T.StructField("ids", T.MapType(T.IntegerType(), T.LongType())),
    T.StructField("integers", T.MapType(T.IntegerType(), T.IntegerType())),
    T.StructField("lists", T.MapType(T.IntegerType(), T.ArrayType(T.IntegerType()))),
])

EVENT_CONTEXT = T.StructType([T.StructField("environment", ENVIRONMENT)])

USER_HISTORY = T.StructType([
    T.StructField("user", LONGS),
    T.StructField("history", LONGS),
])

FEATURE_RECORD = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("features", T.MapType(T.StringType(), T.StringType())),
])

LOOKUP = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("vec", VECTOR),
])

RESOLVED = T.StructType([
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("vec", VECTOR),
    ]))),
])

TRAINABLE = T.StructType([T.StructField("value", T.ArrayType(VECTOR))])
