import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup as ed
from tidemark.llm import queries


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        key = hashlib.sha256("".join(c for c in text if c not in ed.BLANK).encode()).hexdigest()
        groups.setdefault(key, []).append((-len(text), doc_id is None, doc_id or 0, doc_id))
    return {k: (sorted(g)[0][3], len(g)) for k, g in groups.items()}


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    got = queries.op3_exact_dedup(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)


def test_edge_cases(docs):
    rows = [(1, "a b"), (2, "ab  "), (3, "a b"), (4, None), (5, ""), (6, " \t\r\n\x0b\x0c"), (7, "ab"), (None, "a  b  "), (8, "x" * 300_000), (8, "x" * 300_000)]
    got = ed.exact_duplicates(docs(*rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].keep_id is None and by[1][0].group_size == 4  # the row without an id is the longest
    assert by[3][0].kept and by[3][0].group_size == 1
    assert by[4][0].keep_id == 6 and by[6][0].kept and not by[5][0].kept
    assert sorted(r.kept for r in by[8]) == [False, True]
    kept = ed.drop_exact_duplicates(docs(*rows)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 3, 6, 8]


def test_empty_and_clashing_columns(spark, docs):
    assert ed.exact_duplicates(docs().limit(0)).count() == 0
    odd = docs((1, "a"), (2, "a")).withColumn("digest", F.lit(1)).withColumn("row", F.lit(2)).withColumn("kept", F.lit(0))
    out = ed.drop_exact_duplicates(odd)
    assert out.columns == odd.columns and [r.doc_id for r in out.collect()] == [1]


def test_cuckoo_index_inserts_deletes_and_resizes():
    rng, index, model = random.Random(5), ed.CuckooIndex(2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(20_000):
        k = rng.choice(keys)
        if rng.random() < 0.4:
            assert index.delete(k) == (model.pop(k, None) is not None)
        else:
            index.put(k, step)
            model[k] = step
    assert dict(index.items()) == model and index.size == len(model)
    assert all(index.get(k) == model.get(k) for k in keys)
    assert index.resizes > 0


def test_live_index(docs):
    index = ed.live_index(docs((1, "a b"), (2, "ab"), (3, "c")), parts=4)
    assert sorted(r.n for r in index.collect()) == [1, 2]
    after = ed.apply_changes(index, docs((4, "d")), docs((1, "ab"), (3, "c"), (9, "never")), parts=4)
    seen = {r.text: r.seen for r in ed.contains(after, docs((1, "ab"), (2, "c"), (3, "d"), (4, None))).collect()}
    assert seen == {"ab": True, "c": False, "d": True, None: False}


def test_contains_asks_the_index(spark, docs):
    """Against a set, after insertions and deletions, with repeats, odd columns and an empty index."""
    rng = random.Random(11)
    texts = [f"text {i}" for i in range(400)]
    first, more, gone = (rng.sample(texts, 150) for _ in range(3))
    index = ed.live_index(docs(*enumerate(first)), parts=4)
    index = ed.apply_changes(index, docs(*enumerate(more)), docs(*enumerate(gone)), parts=4)
    count = {t: max(0, (t in first) + (t in more) - (t in gone)) for t in texts}
    asked = docs(*enumerate(texts), (500, texts[0]), (501, texts[0]), (502, None)).withColumn("digest", F.lit("mine")).withColumn("part", F.lit(0))
    got = ed.contains(index, asked, parts=3)
    assert got.columns == [*asked.columns, "seen"]
    rows = got.collect()
    assert len(rows) == 403 and all(r.seen == (count.get(r.text, 0) > 0) for r in rows)
    assert not any(r.seen for r in ed.contains(index.limit(0), asked).collect())
    assert ed.contains(index, asked.limit(0)).count() == 0


def test_a_column_named_text_key(docs):
    rows = docs((1, "a b"), (2, "ab"), (3, "c"), (3, "c")).withColumn("text_key", F.lit("mine"))
    got = ed.drop_exact_duplicates(rows).collect()
    assert sorted((r.doc_id, r.text_key) for r in got) == [(1, "mine"), (3, "mine")]
