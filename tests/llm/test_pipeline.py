import numpy as np
import public_tokenizers

import corpus_pipeline
from tests.llm import test_decontam, test_simhash
from tidemark.llm import byte_bpe, queries


def test_stages_on_their_own_input(spark, sf):
    """Each stage against brute force over what the stage before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    score = {r.doc_id: r.score for r in queries.op5_quality(spark, sf).collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf)
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        assert len(after) == len(rows)
        if name == "quality_classifier":
            assert after == {i for i in before if score[i] >= 0.3} and len(after) > len(before) / 2
        elif name == "exact_dedup":
            best = {}
            for i, r in before.items():
                key = "".join(c for c in r.text if c not in " \t\n\x0b\x0c\r")
                best[key] = min(best.get(key, (0, 0)), (-len(r.text), i)) if key in best else (-len(r.text), i)
            assert after == {i for _, i in best.values()}
        elif name == "simhash_near_dedup":
            roots = test_simhash.brute(sorted((i, test_simhash.slow_print(r.text)) for i, r in before.items()))
            assert after == set(roots.values())
        elif name == "benchmark_decontamination":
            bad = {i for i, _ in test_decontam.brute([(i, r.text) for i, r in before.items() if any(t[:40] in r.text or t[-40:] in r.text for _, t in items)], items)}
            assert bad and not after & bad
            assert all(any(t in before[i].text for _, t in items) or len(set(before) - after - bad) < 3 for i in set(before) - after)
        else:
            assert after == set(before)
            bpe = byte_bpe.codec(queries.RANKS, public_tokenizers.PATTERN)
            for r in rows:
                assert bpe.decode(np.array(r.ids)) == before[r.doc_id].text.encode() and r.n_tokens == len(r.ids)
        if name != "byte_bpe":
            assert docs.columns == columns
            assert all(r == before[r.doc_id] for r in rows)


def test_null_rows_and_empty_tables(spark, sf, docs):
    rows = docs((1, None), (2, ""), (None, None), (None, None), (3, "some words that are here"), (3, "some words that are here"))
    for frame in (rows, rows.limit(0)):
        now = frame
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf)
            now.collect()
