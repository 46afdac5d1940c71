"""Exact deduplication with a partitioned cuckoo-filter index.

Digests are spread over partitions. Each partition keeps a cuckoo filter of
16-bit tags and, beside it, the live keys in buckets of content. The filter
answers for digests it has never seen; a hit is verified in the content bucket.
A filter that overflows is rebuilt twice as large from the stored keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, keep_rows, plain, settled

BLANK = " \t\n\x0b\x0c\r"
#: Rows that one index partition holds on average.
PART_ROWS = 200_000
#: Live keys after which a task hands its partial groups on and starts anew.
FLUSH_KEYS = 200_000


class CuckooIndex:
    """Live digests with a value each: insert, look up, delete, resize.

    A bucket has four tag slots. A digest may lie in two buckets, the second
    found from the first and the tag alone, so tags can move without the key.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 64):
        self.buckets = 1 << max(1, math.ceil(math.log2(buckets)))
        self.content: dict[int, dict[bytes, object]] = {}
        self.size = self.resizes = self.false_hits = 0
        self._clear()

    def _clear(self) -> None:
        self.tags = [0] * (self.buckets * self.SLOTS)

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ ((tag * 0x5BD1E995) & (self.buckets - 1))

    def _slot(self, bucket: int, tag: int) -> int:
        at = bucket * self.SLOTS
        for i in range(at, at + self.SLOTS):
            if self.tags[i] == tag:
                return i
        return -1

    def maybe(self, digest: bytes) -> bool:
        """The filter's answer: false is certain, true must be verified."""
        tag, first, other = self._place(digest)
        return self._slot(first, tag) >= 0 or self._slot(other, tag) >= 0

    def _bucket(self, digest: bytes) -> dict[bytes, object]:
        return self.content.setdefault(int.from_bytes(digest[10:12], "little"), {})

    def get(self, digest: bytes):
        """The value of a live digest, or None."""
        if not self.maybe(digest):
            return None
        found = self._bucket(digest).get(digest)
        self.false_hits += found is None
        return found

    def put(self, digest: bytes, value) -> None:
        """Insert a digest, or replace the value of a live one."""
        bucket = self._bucket(digest)
        known = self.maybe(digest) and digest in bucket
        bucket[digest] = value
        if not known:
            self.size += 1
            if not self._add(digest):
                self._resize()

    def _add(self, digest: bytes) -> bool:
        tag, first, other = self._place(digest)
        for b in (first, other):
            if (i := self._slot(b, 0)) >= 0:
                self.tags[i] = tag
                return True
        bucket = other
        for kick in range(self.KICKS):
            i = bucket * self.SLOTS + kick % self.SLOTS
            tag, self.tags[i] = self.tags[i], tag
            bucket = self._other(bucket, tag)
            if (i := self._slot(bucket, 0)) >= 0:
                self.tags[i] = tag
                return True
        return False

    def _resize(self) -> None:
        """Twice the buckets, filled from the stored keys, until all fit."""
        while True:
            self.buckets *= 2
            self.resizes += 1
            self._clear()
            if all(self._add(d) for d, _ in self.items()):
                return

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest; its tag leaves one of its two buckets."""
        if self.get(digest) is None:
            return False
        del self._bucket(digest)[digest]
        tag, first, other = self._place(digest)
        i = self._slot(first, tag)
        self.tags[i if i >= 0 else self._slot(other, tag)] = 0
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.content.values():
            yield from bucket.items()


#: Of two rows with equal texts the one that sorts first stays: the most code
#: points, then the smallest id (a missing id last), then the earlier row.
def _order(length: int, doc_id: int | None, row: int) -> tuple:
    return (-length, doc_id is None, doc_id or 0, row)


_GROUP = "digest binary, length bigint, keep_id bigint, keep_row bigint, group_size bigint"
_FIELDS = ["digest", "length", "keep_id", "keep_row", "group_size"]
_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _emit(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for digest, (order, doc_id, n) in index.items():
        rows.append((digest, -order[0], doc_id, order[3], n))
        if len(rows) == 10_000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _FIELDS)


def _grouping(flush: int | None) -> Callable:
    """Group rows by digest through an index, handing on after ``flush`` keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, length, doc_id, row, n in zip(*[column_of(batch, f).to_pylist() for f in _FIELDS]):
                order, held = _order(length, doc_id, row), index.get(digest)
                if held is None:
                    index.put(digest, (order, doc_id, n))
                elif order < held[0]:
                    index.put(digest, (order, doc_id, n + held[2]))
                else:
                    index.put(digest, (held[0], held[1], n + held[2]))
            if flush and index.size >= flush:
                yield from _emit(index)
                index = CuckooIndex()
        yield from _emit(index)

    return run


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def exact_duplicates(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, digest, keep_id, group_size, kept.

    Equal texts form a group; the row with the most code points, then the
    smallest doc_id stays. A missing id sorts last; of repeated rows (same id,
    same text) one stays, whichever was read first. An empty table gives an
    empty one; extra columns are ignored. A group is combined in each reading
    task before the shuffle, so copies cost one row per task, and the join back
    is between plain exchanges, which lets Spark split a hot digest.
    """
    rows = plain(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("length"),
    )
    rows = settled(rows, "digests")
    singles = rows.select(
        "digest", "length", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("bigint").alias("group_size")
    )
    spread = max(1, math.ceil(rows.count() / part_rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    local = singles.mapInArrow(_grouping(FLUSH_KEYS), _GROUP)
    groups = settled(local.repartition(spread, "digest").mapInArrow(_grouping(None), _GROUP), "groups")
    return rows.join(groups.select("digest", "keep_id", "keep_row", "group_size"), "digest").select(
        "doc_id", "text_key", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return keep_rows(docs, exact_duplicates(docs))


def live_index(docs: DataFrame, parts: int = 64) -> DataFrame:
    """A stored index of ``docs``: (part, digest, n), one row per live digest."""
    return apply_changes(docs.sparkSession.createDataFrame([], _INDEX), docs, None, parts)


_INDEX = "part int, digest binary, n bigint"


def _digests(docs: DataFrame, parts: int, sign: int) -> DataFrame:
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    counted = plain(docs, "text").select(digest.alias("digest")).groupBy("digest").agg((sign * F.count("*")).alias("n"))
    return counted.select(F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int").alias("part"), "digest", "n")


def apply_changes(index: DataFrame, added: DataFrame | None, removed: DataFrame | None, parts: int = 64) -> DataFrame:
    """The index after inserting ``added`` and then deleting ``removed`` texts.

    ``n`` counts the live rows of a digest. A digest whose last row goes is
    deleted from its filter; deleting more rows than live ones ends at none.
    Each partition streams: stored keys first, then insertions, then deletions.
    """
    steps = [index.select("part", "digest", "n", F.lit(0).alias("step"))]
    if added is not None:
        steps.append(_digests(added, parts, 1).withColumn("step", F.lit(1)))
    if removed is not None:
        steps.append(_digests(removed, parts, -1).withColumn("step", F.lit(2)))
    every = steps[0]
    for s in steps[1:]:
        every = every.unionByName(s)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live: dict[int, CuckooIndex] = {}
        for batch in batches:
            for part, digest, n in zip(*[column_of(batch, f).to_pylist() for f in ("part", "digest", "n")]):
                at = live.setdefault(part, CuckooIndex())
                left = (at.get(digest) or 0) + n
                if left > 0:
                    at.put(digest, left)
                else:
                    at.delete(digest)
        for part, at in live.items():
            found = list(at.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(found), pa.int32()), pa.array([d for d, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())],
                ["part", "digest", "n"],
            )

    return every.repartition(parts, "part").sortWithinPartitions("step").mapInArrow(run, _INDEX)


def contains(index: DataFrame, docs: DataFrame, parts: int = 64) -> DataFrame:
    """The rows of ``docs`` (all columns) with ``seen``: is the text live?

    Each distinct digest asks the filter of its partition, into which the
    stored keys stream first; what the filter does not rule out is verified in
    the content. Null counts as empty; repeated rows are answered each; an empty
    index has seen nothing. Columns of ``docs`` may have any names but
    ``__digest`` and ``seen``. The answers are settled and joined back by plain
    exchanges, so a hot text is split.
    """
    keyed = docs.withColumn("__digest", F.unhex(F.sha2(normalised(F.col("text")), 256)))
    asked = keyed.select(F.col("__digest").alias("digest")).distinct()
    every = index.select("digest", F.lit(0).alias("step")).union(asked.select("digest", F.lit(1).alias("step")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        for batch in batches:
            hits = []
            for digest, step in zip(*[column_of(batch, c).to_pylist() for c in ("digest", "step")]):
                if step == 0:
                    live.put(digest, True)
                elif live.get(digest):
                    hits.append(digest)
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.binary())], ["digest"])

    ordered = every.repartition(parts, "digest").sortWithinPartitions("step")
    found = settled(ordered.mapInArrow(run, "digest binary"), "live")
    out = keyed.join(found.withColumnRenamed("digest", "__live"), F.col("__digest") == F.col("__live"), "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__live").isNotNull().alias("seen"))
