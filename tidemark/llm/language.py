"""Hierarchical language identification with linear support vector machines.

Texts become shares of hashed letter n-grams. One machine for each pair of
families tells the family, then one for each pair of languages within it tells
the language. Machines are trained in Spark, one group for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, parts, plain, settled

#: Expected labelled rows for each language; the fit's bound, chosen by hash.
PER_LANGUAGE = 300
#: Distinct languages that may be named; more are an error, never cut.
MOST_LANGUAGES = 1000
#: What all machines may measure, as they go to the driver and from it to every task.
MOST_BYTES = 128 << 20
#: Hash bits for 1-, 2- and 3-grams of letters.
BITS = (9, 11, 12)
SIZE = sum(1 << b for b in BITS)
PENALTY, EPOCHS, SLOPE = 20.0, 30, 4.0
HELD_OUT_MOD, HELD_OUT = 4, 2
UNKNOWN = "und"
_BLOCK = 1 << 19

#: Language to family (fixed values); a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "indo_aryan": "hi ur bn pa mr gu ne si",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "semitic": "ar he am mt",
    "baltic": "lt lv",
    "celtic": "ga cy gd br",
    "austronesian": "id ms tl jv",
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"only:{lang}")


_folds: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code point to its small letter, or to a space if it is no letter."""
    if not _folds:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x33480):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _folds.append(table)
    return _folds[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams over a whole text, or None if it has no letter."""
    points = np.frombuffer(((text or "") + " ").encode("utf-32-le"), "<u4")
    counts, seen = np.zeros(SIZE), False
    for start in range(0, len(points), _BLOCK):
        c = _folded()[points[start : start + _BLOCK]]
        letter = c != 32
        seen = seen or bool(letter.any())
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one space after each run of letters
        c = np.concatenate([[np.uint32(32)], c[keep]]).astype(np.uint32)
        h, at = np.zeros(len(c), np.uint32), 0
        for n, bits in enumerate(BITS):
            m = len(c) - n
            if m <= 0:
                break
            h = (h[:m] * np.uint32(0x01000193)) ^ c[n:]
            slot = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
            counts[at : at + (1 << bits)] += np.bincount(slot, minlength=1 << bits)
            at += 1 << bits
    return counts if seen else None


def features(text: str | None) -> np.ndarray | None:
    """Roots of the n-grams' shares, and a constant; its length is about one."""
    counts = ngram_counts(text)
    if counts is None:
        return None
    return np.append(np.sqrt(counts / counts.sum()), 0.1).astype(np.float32)


def train_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by dual coordinate descent.

    ``y`` is +1 or -1; both sides have the same total penalty.
    """
    weight = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * len(y) / 2
    diagonal = 1 / (2 * PENALTY * weight)
    square = (x * x).sum(axis=1) + diagonal
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], np.float64)
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            after = max(0.0, alpha[i] - slope / square[i])
            if after != alpha[i]:
                w += (after - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(after - alpha[i]))
                alpha[i] = after
        if moved < 1e-3:
            break
    return w


@dataclass
class LanguageModel:
    """Languages by family, and a machine for each pair that is ever compared."""

    families: dict[str, list[str]] = field(default_factory=dict)
    machines: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def _winner(self, names: list[str], x: np.ndarray, kind: str) -> tuple[str, float]:
        """Most pairs won, then the larger sum of margins, then the first name."""
        if len(names) == 1:
            return names[0], 1.0
        margin = {n: {} for n in names}
        for a, b in combinations(names, 2):
            m = float(x @ self.machines[f"{kind}:{a}", f"{kind}:{b}"])
            margin[a][b], margin[b][a] = m, -m
        best = min(names, key=lambda n: (-sum(v > 0 for v in margin[n].values()), -sum(margin[n].values()), n))
        return best, 1 / (1 + math.exp(-SLOPE * max(-50.0, min(50.0, min(margin[best].values())))))

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.families:
            return UNKNOWN, 0.0
        family, sure = self._winner(sorted(self.families), x, "family")
        lang, also = self._winner(self.families[family], x, "lang")
        return lang, sure * also


def held_out(doc_id) -> F.Column:
    """Rows that are not learnt from; a row without an id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_MOD == HELD_OUT, F.lit(True))


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "text"):
        rows = [(lang, features(t.as_py())) for lang, t in zip(column_of(part, "lang").to_pylist(), column_of(part, "text"))]
        rows = [(lang, x.tobytes()) for lang, x in rows if x is not None]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])


def _train_pair(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["side", "lang", "x"])  # the same order however rows arrive
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1)
    w = train_machine(x, np.where(rows["side"], 1.0, -1.0))
    return pd.DataFrame({"a": [rows["a"].iloc[0]], "b": [rows["b"].iloc[0]], "w": [w.astype(np.float32).tobytes()]})


def machine_bytes(families: dict[str, list[str]]) -> int:
    """The size of all machines that these languages need."""
    pairs = math.comb(len(families), 2) + sum(math.comb(len(langs), 2) for langs in families.values())
    return pairs * (SIZE + 1) * np.dtype(np.float32).itemsize


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = MOST_BYTES) -> LanguageModel:
    """Fit on about ``per_language`` rows of each language, the first by hash.

    Rows that are held out, and rows without a language or a letter, are not
    learnt from. The model's size depends on the languages only; it is reckoned
    before anything is trained, and over ``most_bytes`` is an error.
    """
    known = plain(docs, "doc_id", "text", "lang").filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages are named")
    if not counts:
        return LanguageModel()
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], per_language / r["count"])])
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 32) / (1 << 32)
    chosen = known.filter(place < F.element_at(share, F.col("lang"))).select("lang", "text")
    sample = settled(chosen.mapInArrow(_vectors, "lang string, x binary"), "sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    model = LanguageModel()
    for lang in langs:
        model.families.setdefault(family_of(lang), []).append(lang)
    size = machine_bytes(model.families)
    if size > most_bytes:
        raise ValueError(f"{len(langs)} languages in {len(model.families)} families need {size} bytes of machines, over {most_bytes}")
    pairs = []
    for a, b in combinations(sorted(model.families), 2):
        pairs += [(lang, f"family:{a}", f"family:{b}", True) for lang in model.families[a]]
        pairs += [(lang, f"family:{a}", f"family:{b}", False) for lang in model.families[b]]
    for family in model.families.values():
        for a, b in combinations(family, 2):
            pairs += [(a, f"lang:{a}", f"lang:{b}", True), (b, f"lang:{a}", f"lang:{b}", False)]
    if pairs:
        sides = docs.sparkSession.createDataFrame(pairs, "lang string, a string, b string, side boolean")
        trained = sample.join(sides, "lang").groupBy("a", "b").applyInPandas(_train_pair, "a string, b string, w binary")
        model.machines = {(r.a, r.b): np.frombuffer(bytes(r.w), np.float32) for r in trained.collect()}
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``; only the text counts.

    A null text, and one without a letter, is ``und`` with score 0, and so is
    every text if nothing was learnt. Ties go to the first name. Repeated rows
    are all answered, an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts(batches, "text"):
            found = [own.predict(t.as_py()) for t in column_of(part, "text")]
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "doc_id").cast(pa.int64()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
