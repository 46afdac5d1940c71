"""Quality scores: random Fourier features of document statistics, ridge, isotonic.

Cosines of random projections approximate a Gaussian kernel over standardised
statistics of a text. Each partition sums its part of the normal equations, per
fold; the folds' sums give the model and, by leaving one out at a time, scores
of training rows that their own model has not seen. Isotonic regression over
those scores calibrates the model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import column_of, parts, plain, settled

#: Random features, the width of the kernel against the number of statistics,
#: the ridge against the number of rows, and bins of raw scores for calibration.
FEATURES, WIDTH, RIDGE, BINS, SEED = 192, 1.5, 1e-4, 4000, 7
FOLDS, HELD_FOLD = 5, 0
REJECT_BELOW = 0.3

_SYMBOLS = "#$%&*|!@^_~=+<>/\\{}[]"
_CLASSES = 8
_table: list[np.ndarray] = []


def _char_classes() -> np.ndarray:
    """Code point to class: other, lower, upper, digit, space, line end, mark, symbol."""
    if not _table:
        table = np.zeros(0x110000, np.uint8)
        for i in range(0x30000):
            c = chr(i)
            if c.isalpha():
                table[i] = 2 if c.isupper() else 1
            elif c.isdigit():
                table[i] = 3
            elif c == "\n":
                table[i] = 5
            elif c.isspace():
                table[i] = 4
        for c in ".,;:?'\"()-":
            table[ord(c)] = 6
        for c in _SYMBOLS:
            table[ord(c)] = 7
        _table.append(table)
    return _table[0]


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; null counts as empty, which is defined too."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = max(1, len(points))
    shares = np.bincount(_char_classes()[points], minlength=_CLASSES) / n
    words, lines = text.split(), text.split("\n")
    w = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    most = counts.most_common(1)[0][1] if counts else 0
    repeats = sum(map(eq, words, islice(words, 1, None)))
    pairs = len(set(zip(words, islice(words, 1, None)))) if len(words) > 1 else 1
    caps = sum(map(str.istitle, words))
    loud = sum(map(str.isupper, words))
    bare = sum(map(str.isalpha, words))
    marks = [text.count(c) / n for c in "!|#%&*$@"]
    return [
        math.log1p(len(points)),
        math.log1p(len(words)),
        *shares.tolist(),
        *[math.sqrt(m) for m in marks],
        float(lengths.mean()),
        float(lengths.std()),
        len(counts) / w,
        most / w,
        math.sqrt(repeats / w),
        pairs / max(1, w - 1),
        caps / w,
        loud / w,
        bare / w,
        text.count(".") / w,
        text.count(",") / w,
        len(set(lines)) / len(lines),
        math.log1p(len(lines) / w),
    ]


_SIZE = len(statistics(""))


@dataclass(frozen=True)
class QualityModel:
    """Everything a task needs to score a text; a few kilobytes, whatever the input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return random_features((x - self.mean) / self.scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores from 0 to 1 for rows of statistics.

        A thousandth of the raw score keeps an order where calibration is flat.
        """
        raw = np.clip(self.features(x) @ self.weights, -0.5, 1.5)
        level = np.interp(raw, self.knots, self.levels)
        return 0.999 * level + 0.001 * (raw + 0.5) / 2


def random_features(x: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    directions = rng.normal(size=(d, FEATURES)) / (WIDTH * math.sqrt(d))
    phases = rng.uniform(0, 2 * math.pi, FEATURES)
    waves = math.sqrt(2 / FEATURES) * np.cos(np.clip(x, -6, 6) @ directions + phases)
    return np.hstack([waves, np.ones((len(x), 1))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(column_of(batch, "x").flatten()).reshape(-1, _SIZE)


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "text"):
        x = [statistics(t.as_py()) for t in column_of(part, "text")]
        yield pa.RecordBatch.from_arrays([column_of(part, "doc_id").cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])


def fold_of(doc_id) -> F.Column:
    """The row's fold; a row without an id is held out, as no label can name it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(HELD_FOLD)).cast("int")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, fold, x): the statistics of every row of ``docs``."""
    rows = plain(docs, "doc_id", "text").mapInArrow(_measure, "doc_id bigint, x array<double>")
    return settled(rows.select("doc_id", fold_of(F.col("doc_id")).alias("fold"), "x"), "statistics")


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, y, x) of labelled rows outside the held-out fold.

    Several labels of one id count by their mean; null labels do not count.
    """
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    marked = marked.filter("y is not null").groupBy("doc_id").agg(F.avg("y").alias("y"))
    return stats.filter(F.col("fold") != HELD_FOLD).join(marked, "doc_id").select("fold", "y", "x")


def _partial_equations(mean: np.ndarray, scale: np.ndarray) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = random_features((_matrix(batch) - mean) / scale)
            y, fold = np.array(column_of(batch, "y")), np.array(column_of(batch, "fold"))
            for f in np.unique(fold):
                at = fold == f
                right = np.hstack([z[at], y[at, None]])
                sums[int(f)] = sums.get(int(f), 0) + z[at].T @ right
        for f, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                ["fold", "i", "sums"],
            )

    return run


def _add_equations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for f, i, raw in zip(*[column_of(batch, c).to_pylist() for c in ("fold", "i", "sums")]):
            sums[f, i] = sums.get((f, i), 0) + np.frombuffer(raw)
    for (f, i), total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([f], pa.int32()), pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["fold", "i", "sums"]
        )


_EQUATIONS = "fold int, i int, sums binary"


def normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold, the (features x features + 1) sums of the normal equations.

    Each task emits one row per feature and fold; their sums, which alone come
    to the driver, have the same size for any input.
    """
    partial = rows.mapInArrow(_partial_equations(mean, scale), _EQUATIONS)
    total = partial.repartition("fold", "i").mapInArrow(_add_equations, _EQUATIONS).collect()
    out: dict[int, np.ndarray] = {}
    for r in total:
        out.setdefault(r.fold, np.zeros((FEATURES + 1, FEATURES + 2)))[r.i] = np.frombuffer(bytes(r.sums))
    return out


def solve(equations: np.ndarray) -> np.ndarray:
    n = equations[-1, -2]
    ridge = RIDGE * max(n, 1) * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(equations[:, :-1] + ridge, equations[:, -1])


def isotonic(hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing means closest to ``hits / counts`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for h, c in zip(hits, counts):
        blocks.append([h, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h1, c1, k1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + h1, blocks[-1][1] + c1, blocks[-1][2] + k1]
    return np.concatenate([np.full(int(k), h / c) for h, c, k in blocks])


def _binned(models: dict[int, np.ndarray], mean: np.ndarray, scale: np.ndarray) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = random_features((_matrix(batch) - mean) / scale)
            fold = np.array(column_of(batch, "fold"))
            raw = np.zeros(len(z))
            for f, weights in models.items():
                raw[fold == f] = z[fold == f] @ weights
            bins = np.round((np.clip(raw, -0.5, 1.5) + 0.5) / 2 * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), column_of(batch, "y")], ["bin", "y"])

    return run


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on all labelled rows outside the held-out fold.

    Without training rows every text scores 0.5; with one class, that class.
    """
    rows = settled(training_rows(stats, labels), "training")
    moments = rows.select(
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(_SIZE)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(_SIZE)]
    ).first()
    if moments["m0"] is None:
        flat = np.zeros(_SIZE)
        return QualityModel(flat, flat + 1, np.zeros(FEATURES + 1), np.array([-0.5, 1.5]), np.array([0.5, 0.5]))
    mean = np.array([moments[f"m{i}"] for i in range(_SIZE)])
    scale = np.array([moments[f"s{i}"] for i in range(_SIZE)])
    scale[scale < 1e-9] = 1
    equations = normal_equations(rows, mean, scale)
    every = sum(equations.values())
    others = {f: solve(every - e) if len(equations) > 1 else solve(every) for f, e in equations.items()}
    found = rows.mapInArrow(_binned(others, mean, scale), "bin int, y double")
    bins = found.groupBy("bin").agg(F.sum("y").alias("hits"), F.count("*").alias("n")).collect()
    bins.sort(key=lambda r: r.bin)
    levels = isotonic(np.array([r.hits for r in bins]), np.array([float(r.n) for r in bins]))
    knots = np.array([r.bin / BINS * 2 - 0.5 for r in bins])
    return QualityModel(mean, scale, solve(every), knots, levels)


def score_statistics(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, fold, score) for each row of ``measured``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), column_of(batch, "fold"), pa.array(score)], ["doc_id", "fold", "score"])

    return stats.mapInArrow(run, "doc_id bigint, fold int, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, fold, score), one row per row of ``docs``, repeated rows included.

    An empty or null text has statistics like any other; an empty table gives
    an empty one. Texts are read once; the model is fitted and applied on their
    statistics.
    """
    stats = measured(docs)
    return score_statistics(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores ``least`` or more.

    A text is measured once: the rows are settled with their statistics, the
    model is fitted on those, and the rows are judged where they lie, so none
    is shuffled. Null and empty texts are judged like others, repeated rows
    each; an empty table gives an empty one. Columns of ``docs`` keep their
    names and order, whatever they are called, but for ``__x``.
    """
    kept = docs.schema.fields

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "text"):
            x = [statistics(t.as_py()) for t in column_of(part, "text")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(x, pa.list_(pa.float64()))], [*part.schema.names, "__x"])

    rows = settled(docs.mapInArrow(measure, T.StructType([*kept, T.StructField("__x", T.ArrayType(T.DoubleType()))])), "judged")
    doc_id = F.col("doc_id").cast("bigint")
    model = fit(rows.select(doc_id.alias("doc_id"), fold_of(doc_id).alias("fold"), F.col("__x").alias("x")), labels)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(column_of(batch, "__x").flatten()).reshape(-1, _SIZE)
            yield batch.filter(pa.array(model.score(x) >= least)).select([f.name for f in kept])

    return rows.mapInArrow(judge, docs.schema)
