"""Record types that cross stage borders."""

from __future__ import annotations

from pyspark.sql import types as T

POST = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

SENTIMENT = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("sentiment", T.IntegerType()),
    ]
)

ANALYSES = "array<struct<lemma:string,tag:string>>"
RECOGNISED = f"array<struct<token:string,analyses:{ANALYSES}>>"
TAGGED = "array<struct<token:string,lemma:string,tag:string>>"
