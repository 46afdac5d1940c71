import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality as q
from tidemark.llm import queries


def auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def brute(rows, labels):
    """Scores by the method over all rows at once, without Spark: kernel features, ridge, isotonic means by max-min."""
    x = {i: np.array(q.statistics(t)) for i, t in rows}
    fold = {i: zlib.crc32(str(i).encode()) % q.FOLDS for i in x}
    train = [i for i in x if fold[i] != q.HELD_FOLD and i in labels]
    raw = np.array([x[i] for i in train])
    mean, scale = raw.mean(axis=0), raw.std(axis=0)
    scale[scale < 1e-9] = 1
    z = {i: q.random_features(((v - mean) / scale)[None])[0] for i, v in x.items()}

    def ridge(ids):
        a, y = np.array([z[i] for i in ids]), np.array([labels[i] for i in ids], float)
        penalty = q.RIDGE * len(ids) * np.eye(a.shape[1])
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(a.T @ a + penalty, a.T @ y)

    clipped = lambda weights, i: min(1.5, max(-0.5, z[i] @ weights))
    hits = {}
    for f in {fold[i] for i in train}:
        weights = ridge([i for i in train if fold[i] != f])
        for i in train:
            if fold[i] == f:
                hits.setdefault(round((clipped(weights, i) + 0.5) / 2 * q.BINS), []).append(labels[i])
    bins = sorted(hits)
    h, n = (np.array([float(of(hits[b])) for b in bins]) for of in (sum, len))
    # mean[a, b] over bins a..b by running sums; the isotonic value is the largest over a of the least over b.
    hs, ns = (np.concatenate([[0], np.cumsum(v)]) for v in (h, n))
    means = (hs[None, 1:] - hs[:-1, None]) / np.where(ns[None, 1:] > ns[:-1, None], ns[None, 1:] - ns[:-1, None], np.nan)
    level = [max(np.nanmin(means[a, i:]) for a in range(i + 1)) for i in range(len(bins))]
    every = ridge(train)
    value = {i: clipped(every, i) for i in x}
    knots = np.array(bins) / q.BINS * 2 - 0.5
    return {i: 0.999 * np.interp(v, knots, level) + 0.001 * (v + 0.5) / 2 for i, v in value.items()}


def test_query_equals_brute_force(spark, sf):
    """Every score of the query against one pass over all rows in memory."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = brute(rows, labels)
    got = {r.doc_id: r.score for r in queries.op5_quality(spark, sf).collect()}
    assert got.keys() == want.keys()
    off = {i: abs(got[i] - want[i]) for i in want}
    # A value on the edge between two bins may fall to either side by the order of summing.
    assert sorted(off.values())[int(len(off) * 0.95)] < 1e-6 and max(off.values()) < 0.05


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op5_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert auc(held) > 0.9


def test_equations_equal_one_pass_over_all_rows(spark, docs):
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    train = q.training_rows(q.measured(docs(*rows)), labels)
    got = q.normal_equations(train, np.zeros(q._SIZE), np.ones(q._SIZE))
    kept = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    z = q.random_features(np.array([q.statistics(rows[i][1]) for i in kept]))
    want = z.T @ np.hstack([z, np.array([[i % 2] for i in kept])])
    assert np.allclose(sum(got.values()), want)


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(1, 5, 8).astype(float)
        h = np.floor(rng.random(8) * (n + 1))
        got = q.isotonic(h, n)
        # Max-min formula of the isotonic means.
        want = [max(min(h[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, 8)) for a in range(i + 1)) for i in range(8)]
        assert np.allclose(got, want)


def test_edge_cases(spark, docs):
    rows = [(1, None), (2, ""), (3, "a b " * 100_000), (4, "x"), (4, "x"), (None, "y")]
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    odd = docs(*rows).withColumn("x", F.lit(1)).withColumn("fold", F.lit("f"))
    got = q.quality_scores(odd, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = q.quality_scores(odd, labels.limit(0)).collect()
    assert all(abs(r.score - 0.5) < 0.01 for r in none)
    assert q.quality_scores(docs().limit(0), labels).count() == 0
    kept = q.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= 6


def test_kept_rows_are_those_that_score(spark, docs):
    """The stage against the scores of the query, with repeated rows, nulls and clashing columns."""
    rng = np.random.default_rng(7)
    words = ["river", "mill", "town", "the", "of", "and", "qqq", "zzz!!", "1234"]
    rows = [(i, " ".join(rng.choice(words[:6] if i % 2 else words[6:], 20 + i % 30))) for i in range(200)]
    rows += [(300, None), (301, ""), (5, rows[5][1]), (None, rows[4][1])]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    odd = docs(*rows).withColumn("x", F.lit("x")).withColumn("fold", F.lit("f")).withColumn("score", F.lit("s"))
    score = {(r.doc_id, r.text): None for r in odd.collect()}
    by_id = {r.doc_id: r.score for r in q.quality_scores(odd, labels).collect()}
    kept = q.keep_good(odd, labels)
    got = kept.collect()
    assert kept.schema == odd.schema
    want = sorted((r for r in odd.collect() if by_id[r.doc_id] >= q.REJECT_BELOW), key=repr)
    assert sorted(got, key=repr) == want and 90 < len(want) < len(score)
    assert q.keep_good(odd.limit(0), labels).count() == 0
