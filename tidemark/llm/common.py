"""Helpers shared by the operators: settled tables, batches, row identity."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import settle as settled  # noqa: F401  (the operators take it from here)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``most`` bytes of ``column`` each.

    A part has at least one row, so a longer text is a part of its own.
    """
    sizes = (len(t.as_buffer()) if t.is_valid else 0 for t in column_of(batch, column).cast(pa.large_string()))
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def parts(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column)


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that clashing extra ones play no part."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def row_key() -> list:
    """What names a row in a decision: its id and a hash of its text."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, text_key, kept) keep.

    Rows that agree in id and text cannot be told apart; one of them stays if
    any is kept. Only such rows are grouped again.
    """
    kept = (
        decisions.groupBy("doc_id", "text_key")
        .agg(F.max("kept").alias("kept"), F.count("*").alias("copies"))
        .filter("kept")
    )
    kept = settled(kept, "kept")
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__side_key"))

    def held(rule: str) -> DataFrame:
        side = kept.filter(rule).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__side_key"))
        return keyed.join(side, on, "left_semi")

    twins = held("copies > 1").dropDuplicates(["doc_id", "__key"])
    return held("copies = 1").unionByName(twins).drop("__key").select(*[f"`{c}`" for c in docs.columns])
