"""Retrieval packing: documents that resemble each other share a sequence.

Whole windows are cut off every document where it is tokenised; only what is
left of it, shorter than a window, is packed. A BM25 index over these rests is
sharded: rests are ordered by the terms that weigh most in them and dealt to
shards of about equal size, so rests on one subject lie in one shard. In a
shard a seed asks the index for the unused rests that are nearest to it and
takes them in turn until its window is full; the one that is cut to fit goes on
as the next seed. Terms are token ids. Document frequencies and the mean length
are those of all rests, not of the shard.

Every window but a shard's last is full, and the last is cut at powers of two,
which are not padded. A shard's size is bounded, so their number grows with the
input; copies fill as many shards as they need.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import byte_characters
from tidemark.llm.common import column_of, parts, plain, settled

WINDOW, END = 2048, 1
#: A shard holds about so many tokens at most, and so many rests.
SHARD_TOKENS, SHARD_RESTS = 1 << 21, 1 << 13
#: BM25's saturation and length weights (fixed values), and the terms of a seed's query, its heaviest.
K1, B, QUERY_TERMS = 1.2, 0.75, 32


class Encoder:
    """The ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

    Where the file's merges are in the order of their ids, as in the public
    files, a second encoder of the same vocabulary gives the same ids several
    times faster; tests compare the two. The library takes any other file, and
    the texts that the second one refuses (millions of blanks in a run).
    """

    def __init__(self, path: str, pattern: str):
        # A task has its own cores; the library's thread pool would take those of others.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, first = model["vocab"], len(model["vocab"]) - len(model["merges"])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.quick = None
        if all(vocabulary["".join(pair)] == first + i for i, pair in enumerate(pairs)):
            byte_of = {c: b for b, c in enumerate(byte_characters())}
            ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocabulary.items()}
            added = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
            self.quick = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.quick is not None:
            try:
                return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
            except ValueError:
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path, pattern)


_CUT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
_CUT_NAMES = [c.split()[0] for c in _CUT.split(", ")]
_CUT_TYPES = [*[pa.int64()] * 5, pa.binary()]


def cut(docs: DataFrame, path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids): whole windows without ids, and rests with theirs.

    A document's ids end with ``END``; a null text has that one only. A
    document of a multiple of ``window`` has no rest.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for part in parts(batches, "text"):
            out: list[tuple] = []
            for doc_id, text in zip(column_of(part, "doc_id").to_pylist(), column_of(part, "text")):
                ids = np.append(coder.encode(text.as_py()), np.array([END], "<u4")).astype("<u4")
                whole, n = len(ids) // window * window, len(ids)
                out += [(doc_id, at, window, zlib.crc32(ids[at : at + window].tobytes()), n, None) for at in range(0, whole, window)]
                if whole < n:
                    out.append((doc_id, whole, n - whole, None, n, ids[whole:].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _CUT_TYPES)], _CUT_NAMES)

    return plain(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _CUT)


def _ids(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<u4")


def document_frequencies(rests: DataFrame) -> DataFrame:
    """(term, df): how many of ``rests`` (ids) hold each term. A task sends one row per term that it met."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in column_of(batch, "ids"):
                terms = np.unique(_ids(value))
                if len(terms) and terms[-1] >= len(total):
                    total = np.pad(total, (0, int(terms[-1]) + 1 - len(total)))
                total[terms] += 1
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["term", "df"])

    return rests.select("ids").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


class Weights:
    """BM25 weights of terms in a rest, by the statistics of all rests."""

    def __init__(self, terms: np.ndarray, df: np.ndarray, rests: int, mean: float):
        self.idf = np.zeros(int(terms.max()) + 1 if len(terms) else 1, np.float64)
        self.idf[terms] = np.log1p((rests - df + 0.5) / (df + 0.5))
        self.mean = mean

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct terms of ``ids``, and their weights."""
        terms, tf = np.unique(ids, return_counts=True)
        return terms, self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / self.mean))


def heaviest(terms: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` heaviest terms, heaviest first; of equal ones the lower id first."""
    return terms[np.lexsort((terms, -weights))[:most]]


class Index:
    """An inverted index over the rests of one shard."""

    def __init__(self, rests: list[np.ndarray], weights: Weights):
        found = [weights.of(ids) for ids in rests]
        self.queries = [heaviest(t, w, QUERY_TERMS) for t, w in found]
        terms = np.concatenate([t for t, _ in found])
        order = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(rests)), [len(t) for t, _ in found])[order]
        self.weights = np.concatenate([w for _, w in found])[order]
        self.starts = np.zeros(int(terms.max()) + 2, np.int64)
        np.cumsum(np.bincount(terms.astype(np.int64)), out=self.starts[1:])

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every rest for the seed's query."""
        asked = self.queries[seed]
        first, sizes = self.starts[asked], self.starts[asked + 1] - self.starts[asked]
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        return np.bincount(self.docs[at], self.weights[at], len(self.queries))

    def nearest(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused rests, best score first; of equal scores the earlier one first. Every one comes, however low."""
        scores = self.scores(seed)
        left = np.flatnonzero(~used)
        scores, want = scores[left], 16
        while want < len(left):
            least = np.partition(scores, len(left) - want)[len(left) - want]
            top = np.flatnonzero(scores >= least)
            yield from left[top[np.argsort(-scores[top], kind="stable")]].tolist()
            left, scores, want = left[scores < least], scores[scores < least], want * 8
        yield from left[np.argsort(-scores, kind="stable")].tolist()


def fill(rests: list[np.ndarray], weights: Weights, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(sequence, offset, rest, from, to): each rest's ids in pieces, each id in one of them."""
    index = Index(rests, weights)
    used, sequence, done = np.zeros(len(rests), bool), 0, 0
    seed, start = 0, 0
    while True:
        if not start:
            while done < len(rests) and used[done]:
                done += 1
            if done == len(rests):
                return
            seed = done
            used[seed] = True
        pieces, room = [(seed, start, len(rests[seed]))], window - (len(rests[seed]) - start)
        start, near = 0, index.nearest(seed, used)
        while room:
            rest = next(near, None)
            if rest is None:
                break
            used[rest], take = True, min(room, len(rests[rest]))
            pieces.append((rest, 0, take))
            room -= take
            if take < len(rests[rest]):
                seed, start = rest, take
        for chunk in [pieces] if not room else powers(pieces, window - room):
            offset = 0
            for rest, a, b in chunk:
                yield sequence, offset, rest, a, b
                offset += b - a
            sequence += 1


def powers(pieces: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """``pieces`` of ``total`` ids cut into sequences as long as the powers of two of that number."""
    queue = list(reversed(pieces))
    for size in (1 << b for b in reversed(range(total.bit_length())) if total >> b & 1):
        chunk = []
        while size:
            rest, a, b = queue.pop()
            take = min(size, b - a)
            chunk.append((rest, a, a + take))
            size -= take
            if a + take < b:
                queue.append((rest, a + take, b))
        yield chunk


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_PIECE_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


def _keyed(rests: DataFrame, weights: Weights) -> DataFrame:
    """``rests`` with the two terms that weigh most in each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.full((batch.num_rows, 2), -1, np.int64)
            for i, value in enumerate(column_of(batch, "ids")):
                top = heaviest(*weights.of(_ids(value)), 2)
                keys[i, : len(top)] = top
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])], [*batch.schema.names, "first", "second"])

    return rests.mapInArrow(run, "uid bigint, doc_id bigint, start bigint, doc_tokens bigint, ids binary, first bigint, second bigint")


def _packed(weights: Weights, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("uid", "shard", "doc_id", "start", "doc_tokens")
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*[column_of(batch, c).to_pylist() for c in names], [_ids(v).copy() for v in column_of(batch, "ids")])
        if not rows:
            return
        rows.sort(key=lambda r: r[0])
        rests, out = [r[-1] for r in rows], []
        for sequence, offset, rest, a, b in fill(rests, weights, window):
            _, shard, doc_id, start, doc_tokens, ids = rows[rest]
            out.append((doc_id, start + a, b - a, zlib.crc32(ids[a:b].tobytes()), doc_tokens, (shard << 32 | sequence) * 2 + 1, offset))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], _PIECE_NAMES)

    return run


def pack(
    docs: DataFrame,
    path: str,
    pattern: str,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    shard_rests: int = SHARD_RESTS,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    Each id of a document, ``END`` included, lies in one piece. A null or empty
    text is its end alone; very long texts are mostly whole windows. Documents
    without or with the same doc_id, and repeated rows, are documents of their
    own. Equal scores go to the earlier row. Extra columns are ignored; an
    empty table has no pieces. What goes to the tasks is one number per term,
    bounded by the vocabulary.
    """
    pieces = settled(cut(docs, path, pattern, window).withColumn("uid", F.monotonically_increasing_id()), "cut")
    whole = pieces.filter("ids is null").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rests = pieces.filter("ids is not null").select("uid", "doc_id", "start", "doc_tokens", "ids")
    count, tokens = pieces.filter("ids is not null").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    if not count:
        return whole
    size = encoder(path, pattern).whole.get_vocab_size()
    table = document_frequencies(rests).limit(size + 1).toPandas()
    weights = Weights(table["term"].to_numpy(np.int64), table["df"].to_numpy(np.int64), count, tokens / count)
    shards = math.ceil(max(tokens / shard_tokens, count / shard_rests))
    dealt = _keyed(rests, weights).repartitionByRange(shards, "first", "second", "uid").withColumn("shard", F.spark_partition_id().cast("bigint"))
    return whole.union(dealt.mapInArrow(_packed(weights, window), _PIECES))
