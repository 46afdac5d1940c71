"""SimHash near-duplicates, found by meet-in-the-middle ball hashing.

Two fingerprints at most 2k bits apart have a common variant at most k bits
from each. So each distinct fingerprint emits its ball of radius k, and the
shuffle on variants brings linked fingerprints together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, keep_rows, parts, plain, row_key, settled
from tidemark.llm.graph import components

SHINGLE = 3
SEED = 42
RADIUS = 2
_BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of a whole text; zero if it has no word."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(joined, SEED)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    count, total = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, total, _BLOCK):
        stop = min(at + _BLOCK, total)
        spans = zip(ends[at:stop], ends[at + SHINGLE : stop + SHINGLE])
        hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), np.uint64, stop - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "text"):
        found = np.array([fingerprint(t.as_py()) for t in column_of(part, "text")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [column_of(part, "doc_id").cast(pa.int64()), column_of(part, "text_key"), pa.array(found.view(np.int64))],
            ["doc_id", "text_key", "print"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, print): one row per document, print as signed long."""
    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(_fingerprints, "doc_id bigint, text_key bigint, print bigint")


def _ball(k: int) -> list[int]:
    """All 64-bit masks of at most ``k`` set bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for n in range(k + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect all of ``prints`` (distinct) within ``radius``.

    Around one variant all members are within ``radius`` of each other, so each
    is linked to the least one: as many edges as members, not pairs, and the
    same components. A variant has at most its ball of members.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    emitted = prints.select("print", F.explode(F.lit(_ball(radius // 2)).cast("array<bigint>")).alias("mask"))
    met = emitted.select("print", F.col("print").bitwiseXOR(F.col("mask")).alias("variant"))
    least = met.withColumn("least", F.min("print").over(Window.partitionBy("variant")))
    pairs = least.filter("print <> least").select(F.col("print").alias("u"), F.col("least").alias("v")).distinct()
    return pairs.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_key, print, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, itself
    included. A null or blank text has fingerprint zero and is linked like any
    other. Rows without doc_id get the component of their fingerprint, null if
    nobody in it has an id. Repeated rows all appear; extra columns are ignored.
    Equal fingerprints are one node, so copies are never paired.
    """
    prints = settled(fingerprints(docs), "prints")
    nodes = settled(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("print"), radius))
    placed = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    placed = settled(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = settled(placed.join(ids, "root").select("print", "component_id"), "classes")
    return prints.join(classes, "print").select("doc_id", "text_key", "print", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: the one with its id.

    In a component where no row has an id, all rows stay, as no id can name one.
    """
    found = near_duplicates(docs, radius)
    return keep_rows(docs, found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
