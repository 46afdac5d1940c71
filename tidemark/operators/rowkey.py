"""Salted row keys for a sink whose key ranges would otherwise be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import settle

BUCKETS = 32
WIDTH = len(str(BUCKETS))


def salt_key(key: Column, bucket_of: Column | None = None) -> Column:
    """Prefix ``key`` with a two-digit bucket, ``00`` to ``31``.

    The bucket is a hash of the key, so any task computes it alone and a retry
    gives the same key. ``bucket_of`` takes a number to spread on instead.
    """
    source = F.xxhash64(key) if bucket_of is None else bucket_of
    bucket = F.pmod(source, F.lit(BUCKETS)).cast("string")
    return F.concat(F.lpad(bucket, WIDTH, "0"), key)


def salt_round_robin(df: DataFrame, key: str, within: str, order: str) -> DataFrame:
    """Round-robin salts, counted separately in each ``within`` group.

    A group is numbered in pieces: rows are dealt to ranges of (group, order),
    so a large group spans many ranges, each range numbers its own rows, and
    the sizes of the ranges before it are added. Ranges are settled, as they
    are sampled and a second reading could cut them elsewhere. Rows that agree
    in group and order come in the order of their keys.
    """
    ranged = settle(
        df.repartitionByRange(F.col(within), F.col(order), F.col(key)).withColumn("_range", F.spark_partition_id())
    )
    sizes = settle(ranged.groupBy(within, "_range").agg(F.count("*").alias("_size")))
    before = Window.partitionBy(within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(within).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    place = F.col(within).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at"))
    own = F.row_number().over(Window.partitionBy(within, "_range").orderBy(order, key)) - 1
    turns = ranged.join(starts, place).withColumn("_turn", own + F.col("_start"))
    return turns.withColumn("salted_key", salt_key(F.col(key), F.col("_turn"))).select(*df.columns, "salted_key")


def original_key(salted: Column) -> Column:
    return F.substr(salted, F.lit(WIDTH + 1))


def key_source(key: Column) -> Column:
    """Second ``_`` field of a key; null where there is none."""
    return F.get(F.split(key, "_"), F.lit(1))
