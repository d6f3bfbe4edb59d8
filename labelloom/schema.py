"""Declared schemas. Nothing in this package infers types from data."""

from pyspark.sql import types as T

RAW = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("category", T.StringType())]
)

ENCODED = T.StructType([*RAW.fields, T.StructField("label", T.LongType())])

LABEL_DIM = T.StructType(
    [T.StructField("label", T.LongType()), T.StructField("category", T.StringType())]
)

LABEL_MAP = T.StructType(
    [
        T.StructField("label2id", T.MapType(T.StringType(), T.LongType())),
        T.StructField("id2label", T.MapType(T.StringType(), T.StringType())),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("phase", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

SPLITS = ("train", "validation", "test")
