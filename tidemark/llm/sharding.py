"""Proportional stratified interleaving of sources into shards.

Rows are shuffled by a seeded hash and ranked within their source. A rank's
share of its source, moved by a hash of the source so that small sources spread
too, places the row among all; equal cuts of that order give shards that each
match the mixture. Law ``rows``: counts differ by one at most.

Both orders are found by buckets: the bucket sizes are counted, added up in
order, and rows are numbered within their bucket only. Bucket keys are hashes
or shares, so they are even whatever the sources are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain, settled

SHARDS, SEED = 24, 20
_TOP = 1 << 32


def _unit(*columns: Column) -> Column:
    """A hash of the columns as a 32-bit number."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 32)


def _numbered(rows: DataFrame, within: list[str], order: list) -> DataFrame:
    """``rows`` with ``rank`` from 0 along (bucket, order) in each ``within``.

    The counts are settled, so the join is between plain exchanges on the keys
    by which the rows are numbered next: the rows move once.
    """
    keys = [*within, "bucket"]
    sizes = settled(rows.groupBy(*keys).count(), "sizes")
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    on = [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in keys]
    joined = rows.join(starts, on).drop(*[f"s_{k}" for k in keys])
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return joined.withColumn("rank", F.col("start") + number - 1).drop("start", "bucket")


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot), one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8, ``slot`` counts from 0 in each
    shard along the interleaved order. A null source is a source of its own; a
    null text has the checksum of an empty one; rows that agree in all these
    columns are interchangeable. An empty table gives an empty one; extra
    columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = plain(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = settled(rows, "rows")
    total = rows.count()
    buckets = 4 * math.isqrt(total) + 1
    # Without a source the seed alone is hashed, so null differs from no source's hash only by chance.
    mixed = rows.withColumn("h", _unit(F.lit(seed), "doc_id", "text_crc32", "size"))
    shuffled = mixed.withColumn("bucket", F.floor(F.col("h") * buckets / _TOP))
    ranked = settled(_numbered(shuffled, ["source"], ["h", "doc_id", "text_crc32", "size"]), "ranked")
    sizes = ranked.groupBy("source").agg(F.count("*").alias("n")).select(F.col("source").alias("s"), "n")
    sizes = settled(sizes, "sources")
    offset = _unit(F.lit(seed), F.lit("source"), "source") / _TOP
    placed = ranked.join(sizes, F.col("source").eqNullSafe(F.col("s"))).withColumn("share", (F.col("rank") + offset) / F.col("n"))
    placed = placed.select("doc_id", "source", "size", "text_crc32", "h", "share")
    placed = placed.withColumn("bucket", F.least(F.floor(F.col("share") * buckets), F.lit(buckets - 1)))
    placed = settled(placed, "placed")
    along = _numbered(placed, [], ["share", "source", "h", "doc_id", "text_crc32", "size"])
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    cut = along.withColumn("shard", shard)
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return cut.select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("rank") - first).alias("slot")
    )
