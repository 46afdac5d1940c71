"""Benchmark decontamination by spaced-seed hashing.

A window of a benchmark item counts as found in a document where the tokens
agree but for a few substitutions. Fixed masks leave out some positions of the
window. They are chosen so that, whichever positions differ, one mask has left
all of them out; its hash then agrees, and hits are verified token by token.

Items of under five tokens allow no substitution. Where all their tokens are
common words they say nothing inside a longer text, so such an item is found
only where it is a document's whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import chain, combinations, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, parts, plain, settled

#: Tokens of a window, and the share of them that must agree.
WINDOW, AGREE = 13, 0.8
#: Items with fewer tokens are short; one of common words only has to be the whole text.
SHORT = 5
#: The tokens of the public vocabulary that count as common words, the first by rank.
COMMON = 8192
#: Bits of the prefilter, as a power of two: its size is fixed, 8 MB.
FILTER_BITS = 26
_KNOWN_TOKENS, _KNOWN_LENGTH = 1 << 18, 40
_BLOCK = 1 << 15

# Scripts that are written without spaces: kana, Han, Thai, Lao, Burmese, Khmer (fixed values).
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_words = re.compile(rf"[^\W_{_UNSPACED}]+|[^\W_]").findall


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits; single ones in scripts written without spaces."""
    return _words((text or "").lower())


@lru_cache(maxsize=1)
def common_words() -> frozenset[str]:
    """Lower-cased words among the first public ranks; single letters and digits are common as well."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        first = [base64.b64decode(line.split()[0]) for line in islice(lines, COMMON)]
    return frozenset(t[1:].decode().lower() for t in first if t[:1] == b" " and t[1:].isalpha())


def says_nothing(words: list[str]) -> bool:
    """Whether an item with these tokens has to be a document's whole text."""
    return len(words) < SHORT and all(len(w) == 1 or w.isdigit() or w in common_words() for w in words)


@dataclass(frozen=True)
class Mask:
    """A window's length, its number in that length, and the positions that count."""

    length: int
    number: int
    groups: int
    kept: tuple[int, ...]


def allowed(length: int) -> int:
    """Substitutions that a window of this length may have."""
    return int(length - np.ceil(length * AGREE - 1e-9))


def masks(length: int) -> list[Mask]:
    """Masks that between them miss any ``allowed(length)`` positions.

    Positions are dealt to m + 2 groups in turn, and each mask leaves out m of
    the groups. Whatever m positions differ lie in at most m groups.
    """
    m = allowed(length)
    groups = m + 2
    keeps = list(combinations(range(groups), groups - m))
    return [Mask(length, i, groups, keep) for i, keep in enumerate(keeps)]


class TokenHashes(dict):
    """What stands between white space, to the 64-bit hashes of its tokens.

    It remembers the short ones, and forgets all when it holds too many.
    """

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(xxhash.xxh64_intdigest(t.encode()) for t in tokens(word))
        if len(word) <= _KNOWN_LENGTH:
            if len(self) > _KNOWN_TOKENS:
                self.clear()
            self[word] = found
        return found


def token_hashes(text: str | None, known: TokenHashes) -> np.ndarray:
    return np.fromiter(chain.from_iterable(map(known.__getitem__, (text or "").split())), np.uint64)


def _odd(*parts_: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(repr(parts_).encode()) | 1)


def seed_hashes(h: np.ndarray, length: int) -> list[np.ndarray]:
    """For each mask of ``length``, the hash at every start in ``h``."""
    n = len(h) - length + 1
    if n <= 0:
        return [np.zeros(0, np.uint64) for _ in masks(length)]
    chosen = masks(length)
    sums = np.zeros((chosen[0].groups, n), np.uint64)
    for i in range(length):
        sums[i % chosen[0].groups] += h[i : i + n] * _odd(length, i)
    out = []
    for mask in chosen:
        mixed = reduce(np.add, [sums[k] for k in mask.kept]) * _odd(length, -1, mask.number)
        mixed ^= mixed >> np.uint64(29)
        out.append(mixed)
    return out


def whole_seed(h: np.ndarray) -> np.ndarray:
    """The one seed of a whole short text, told from those of windows by its length's sign."""
    return seed_hashes(h, len(h))[0] * _odd(len(h), -2)


def _seeds_of_items(window: int) -> Callable:
    """Items to (seed, length, item_id, at) for every window and mask; a whole text has its length negated."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenHashes()
        for part in parts(batches, "text"):
            for item, text in zip(column_of(part, "item_id").to_pylist(), column_of(part, "text")):
                h = token_hashes(text.as_py(), known)
                if not len(h):
                    continue
                length, seeds = min(window, len(h)), None
                if says_nothing(tokens(text.as_py())):
                    length, seeds = -len(h), [whole_seed(h)]
                for found in seeds or seed_hashes(h, length):
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array([length] * n, pa.int32()), pa.array([item] * n, pa.int64()), pa.array(range(n), pa.int32())],
                        ["seed", "length", "item_id", "at"],
                    )

    return run


def _bits_of(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = np.uint64((1 << FILTER_BITS) - 1)
    return seeds & keep, (seeds >> np.uint64(32)) & keep


def prefilter(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit table of the seeds, and the window lengths there are.

    It is combined by Spark; at most its own 8 MB reach the driver, however
    large the benchmark. It only saves work: each seed that passes is joined.
    """
    halves = seeds.select(F.explode(F.array(F.col("seed"), F.shiftrightunsigned("seed", 32))).alias("half"))
    words = halves.select(F.col("half").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit")).select(
        F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits")
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table[np.asarray(found["word"])] = np.asarray(found["bits"])
    lengths = sorted(r.length for r in seeds.select("length").distinct().collect())
    return table.view(np.uint8), lengths


_REGION = (
    "doc_id bigint, text_key bigint, region int, first int, hashes array<bigint>, "
    "hits array<struct<start:int,seed:bigint,length:int>>"
)


_HITS = pa.list_(pa.struct([("start", pa.int32()), ("seed", pa.int64()), ("length", pa.int32())]))


def _hits(table: np.ndarray, h: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(starts, seeds, length) of the windows in ``h`` whose seed passes."""

    def passes(bits: np.ndarray) -> np.ndarray:
        return ((table[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)

    for start in range(0, len(h), _BLOCK):
        for length in (n for n in lengths if n > 0):
            for found in seed_hashes(h[start : start + _BLOCK + length - 1], length):
                one, two = _bits_of(found)
                at = np.flatnonzero(passes(one))
                at = at[passes(two[at])]
                if len(at):
                    yield at + start, found[at], length


def _search(table, lengths: list[int], longest: int) -> Callable:
    """Documents to their regions: runs of hits with ``longest`` tokens around.

    The documents of a part are searched as one row of tokens; a window that
    reaches over a document's end is no hit. A region's hits are listed beside
    the token hashes that verifying needs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = TokenHashes(), table.value
        reach = max(lengths, default=0)
        for part in parts(batches, "text"):
            each = [token_hashes(t.as_py(), known) for t in column_of(part, "text")]
            ends = np.cumsum([0, *map(len, each)])
            h = np.concatenate(each)
            hits: dict[int, list[tuple[int, int, int]]] = {}
            for at, seeds, length in _hits(bits, h, lengths):
                doc = np.searchsorted(ends, at, "right") - 1
                inside = at + length <= ends[doc + 1]
                for d, start, seed in zip(doc[inside].tolist(), (at - ends[doc])[inside].tolist(), seeds[inside].view(np.int64).tolist()):
                    hits.setdefault(d, []).append((start, seed, length))
            for d, own in enumerate(each):
                if -len(own) in lengths:
                    hits.setdefault(d, []).append((0, int(whole_seed(own).view(np.int64)[0]), -len(own)))
            if not hits:
                continue
            ids, keys = column_of(part, "doc_id").to_pylist(), column_of(part, "text_key").to_pylist()
            rows = []
            for d, found in hits.items():
                for number, run_ in enumerate(_runs(sorted(found), longest)):
                    first = max(0, run_[0][0] - longest)
                    around = each[d][first : run_[-1][0] + longest + reach].view(np.int64)
                    rows.append((ids[d], keys[d], number, first, around, [{"start": s, "seed": v, "length": n} for s, v, n in run_]))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), _HITS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], ["doc_id", "text_key", "region", "first", "hashes", "hits"]
            )

    return run


def _runs(hits: list[tuple], longest: int) -> Iterator[list[tuple]]:
    """Hits, by start, cut where the next one is over ``longest`` tokens away."""
    held: list[tuple] = []
    for hit in hits:
        if held and (hit[0] - held[-1][0] > longest or hit[0] - held[0][0] > 64 * longest):
            yield held
            held = []
        held.append(hit)
    if held:
        yield held


def _verify(window: int) -> Callable:
    """Aligned regions and items to the best window of each."""

    def best(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
        """Most agreeing tokens in any window of the item laid at ``shift``."""
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        length = min(window, len(item))
        if high - low < length:
            return 0, 0, length
        same = np.concatenate([[0], np.cumsum(doc[low + shift : high + shift] == item[low:high])])
        counts = same[length:] - same[:-length]
        at = int(counts.argmax())
        return int(counts[at]), low + at, length

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("doc_id", "text_key", "item_id", "first", "shift", "hashes", "tokens")
            columns = [column_of(batch, c) for c in names]
            rows = []
            for doc_id, key, item_id, first, shift, hashes, item in zip(*columns):
                doc, item = np.asarray(hashes.values), np.asarray(item.values)
                count, at, length = best(doc, item, shift.as_py() - first.as_py())
                if count >= length - allowed(length):
                    rows.append((doc_id.as_py(), key.as_py(), item_id.as_py(), shift.as_py() + at, at, length, count))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _FOUND_NAMES)

    return run


_FOUND_NAMES = ["doc_id", "text_key", "item_id", "doc_at", "item_at", "length", "agree"]
_FOUND = "doc_id bigint, text_key bigint, item_id bigint, doc_at int, item_at int, length int, agree int"


def _item_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = TokenHashes()
    for part in parts(batches, "text"):
        found = [token_hashes(t.as_py(), known).view(np.int64) for t in column_of(part, "text")]
        yield pa.RecordBatch.from_arrays([column_of(part, "item_id"), pa.array(found, pa.list_(pa.int64()))], ["item_id", "tokens"])


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, item_id, doc_at, item_at, length, agree): verified overlaps.

    One row for each document and item with a window of ``window`` tokens (all
    of a shorter item) of which four fifths or more agree in place; an item of
    one to four common words only has to be all of the document. It tells the best such window, the earliest among equals. Null
    and empty texts have no overlap, repeated rows count as one, items without
    item_id are found too, a text that repeats one token has a hit for each
    start and each place of the item where it stands, and an empty table on either side gives no rows.
    Extra columns are ignored.
    """
    spark = docs.sparkSession
    # The same item twice would double its hits; equal items stay apart.
    items = plain(benchmark, "item_id", "text").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    item_tokens = settled(items.mapInArrow(_item_tokens, "item_id bigint, tokens array<bigint>"), "items")
    seeds = settled(items.mapInArrow(_seeds_of_items(window), "seed bigint, length int, item_id bigint, at int"), "seeds")
    table, lengths = prefilter(seeds)
    longest = item_tokens.agg(F.max(F.size("tokens"))).first()[0] or 0
    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    search = _search(spark.sparkContext.broadcast(table), lengths, longest)
    regions = settled(rows.mapInArrow(search, _REGION), "regions")
    hits = regions.select("doc_id", "text_key", "region", F.explode("hits").alias("h")).select(
        "doc_id", "text_key", "region", F.col("h.start").alias("start"), F.col("h.seed").alias("seed"), F.col("h.length").alias("length")
    )
    pairs = hits.join(seeds, ["seed", "length"]).select(
        "doc_id", "text_key", "region", "item_id", (F.col("start") - F.col("at")).alias("shift")
    )
    pairs = settled(pairs.distinct(), "pairs")
    place = ["doc_id", "text_key", "region"]
    bodies = regions.select(*place, "first", "hashes").dropDuplicates(place).select(
        *[F.col(c).alias(f"b_{c}") for c in place], "first", "hashes"
    )
    bodies = settled(bodies, "bodies")
    placed = pairs.join(bodies, F.col("doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("text_key") == F.col("b_text_key")) & (F.col("region") == F.col("b_region")))
    named = item_tokens.select(F.col("item_id").alias("i_item_id"), "tokens")
    aligned = placed.join(named, F.col("item_id").eqNullSafe(F.col("i_item_id"))).select(
        "doc_id", "text_key", "item_id", "first", "shift", "hashes", "tokens"
    )
    found = aligned.mapInArrow(_verify(window), _FOUND)
    order = F.struct("agree", (-F.col("doc_at")).alias("d"), (-F.col("item_at")).alias("i"), "length")
    best = found.groupBy("doc_id", "text_key", "item_id").agg(F.max(order).alias("b"))
    return best.select(
        "doc_id", "text_key", "item_id", (-F.col("b.d")).alias("doc_at"), (-F.col("b.i")).alias("item_at"), F.col("b.length").alias("length"), F.col("b.agree").alias("agree")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark; all other rows stay."""
    found = settled(overlaps(docs, benchmark, window).select("doc_id", "text_key").distinct(), "contaminated")
    named = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(named, on, "left_anti")
