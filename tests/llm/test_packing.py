import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

WHOLE = Tokenizer.from_file(queries.VOCABULARY)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, documents, window=2048):
    """Every id in one piece, sequences gapless, full or a power of two; ``documents`` is a list of (doc_id, text)."""
    left = Counter((d, tuple(ids_of(t))) for d, t in documents)
    by, spans = {}, {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
        spans.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for own in by.values():
        own.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in own])
        assert [p.offset for p in own] == [0, *ends[:-1]] and ends[-1] <= window
        assert ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0
    for (doc_id, n), own in spans.items():
        options = [k for k in left if k[0] == doc_id and len(k[1]) == n]
        copies = sum(left[k] for k in options)
        covered = Counter(i for p in own for i in range(p.start, p.start + p.length))
        assert covered == Counter({i: copies for i in range(n)})
        for p in own:
            raw = {zlib.crc32(np.array(k[1][p.start : p.start + p.length], "<u4").tobytes()) for k in options}
            assert p.ids_crc32 in raw
    assert {(d, len(t)) for d, t in left} == set(spans)
    return by


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by = check(queries.op12_retrieval_packing(spark, sf).collect(), docs)
    tokens = sum(len(ids_of(t)) for _, t in docs)
    assert len(by) <= math.ceil(tokens / 2048) + 11


def pack(frame, **more):
    return packing.pack(frame, queries.VOCABULARY, public_tokenizers.PATTERN, **more).collect()


def test_edge_cases(spark, docs):
    long = "word " * 5000
    rows = [(1, None), (2, ""), (None, "no id"), (None, "no id"), (3, long), (3, long), (4, "a<|endoftext|>b"), (5, "x" * 30_000), (6, "日本語 \n\n  text\t")]
    for n in (2047, 2048, 2049, 4095):
        rows.append((100 + n, " the" * (n - 1)))
    odd = docs(*rows).withColumn("uid", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("start", F.lit(2))
    check(pack(odd), rows)
    assert pack(docs().limit(0)) == []
    check(pack(docs((7, "alone"))), [(7, "alone")])


def test_many_shards(spark, docs):
    dice = random.Random(12)
    rows = [(i, " ".join(dice.choice("tide mark salt reef sand gull wave".split()) + str(dice.randrange(40)) for _ in range(dice.randrange(1, 400)))) for i in range(300)]
    rows += [(1000 + i, "the same copy of one text, many times over") for i in range(150)]
    pieces = pack(docs(*rows), window=256, shard_tokens=4000, shard_rests=64)
    check(pieces, rows, 256)
    assert len({p.sequence_id >> 33 for p in pieces if p.sequence_id & 1}) >= 7


def test_encoder_equals_the_library():
    dice = random.Random(3)
    letters = "abz AZ09.,'’\n\t  \r\x0b  éßñ日本🙂🙂🏽‍́<|endoftext|>"
    coder = packing.encoder(queries.VOCABULARY, public_tokenizers.PATTERN)
    assert coder.quick is not None
    every = [f"a{chr(c)}{chr(c)} b {chr(c)}1{chr(c)}.  {chr(c)}{chr(c)}" for c in range(0, 0x20000, 3) if not 0xD800 <= c < 0xE000]
    for text, found in zip(every, WHOLE.encode_batch(every, add_special_tokens=False)):
        assert coder.encode(text).tolist() == found.ids
    blanks = " " * 3_000_000 + "x"
    assert coder.encode(blanks).tolist() == WHOLE.encode(blanks, add_special_tokens=False).ids
    for n in range(400):
        text = "".join(dice.choice(letters) for _ in range(dice.randrange(60)))
        if n % 7 == 0:
            text = text[:9] + "<|endoftext|>" + text[9:]
        assert coder.encode(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids
    assert coder.encode(" don't we'll I'VE").tolist() == WHOLE.encode(" don't we'll I'VE", add_special_tokens=False).ids


def brute_scores(rests, seed, df, total, mean):
    """BM25 written out, rest by rest."""
    counts = [Counter(r) for r in rests]

    def weight(t, i):
        tf, idf = counts[i][t], math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(rests[i]) / mean))

    asked = sorted(counts[seed], key=lambda t: (-weight(t, seed), t))[:32]
    return [sum(weight(t, i) for t in asked if t in counts[i]) for i in range(len(rests))]


def test_index_against_brute_force(spark, docs):
    dice = random.Random(4)
    rests = [[dice.choice([dice.randrange(30), dice.randrange(30, 900)]) for _ in range(dice.randrange(1, 200))] for _ in range(90)]
    rests += [rests[5]] * 4
    frame = spark.createDataFrame([(bytearray(np.array(r, "<u4").tobytes()),) for r in rests], "ids binary").repartition(4)
    table = {r.term: r.df for r in packing.document_frequencies(frame).collect()}
    assert table == Counter(t for r in rests for t in set(r))
    mean = sum(map(len, rests)) / len(rests)
    terms = np.array(sorted(table))
    weights = packing.Weights(terms, np.array([table[t] for t in terms]), len(rests), mean)
    index = packing.Index([np.array(r, "<u4") for r in rests], weights)
    for seed in range(0, len(rests), 7):
        want = brute_scores(rests, seed, table, len(rests), mean)
        assert index.scores(seed) == pytest.approx(want)
        used = np.array([i % 3 == 0 for i in range(len(rests))])
        got = list(index.nearest(seed, used))
        assert sorted(got) == [i for i in range(len(rests)) if i % 3]
        exact = index.scores(seed)
        assert got == sorted(got, key=lambda i: (-exact[i], i))


def test_windows_hold_one_subject(spark, docs):
    dice = random.Random(8)
    words = {s: [f"{s}{dice.randrange(10**6)}" for _ in range(60)] for s in ("ship", "bread", "stone", "music")}
    rows = [(i, " ".join(dice.choice(words[s]) for _ in range(60))) for i, s in enumerate(dice.choice(sorted(words)) for _ in range(200))]
    subject = {i: t[:4] for i, t in rows}
    pieces = pack(docs(*rows))
    by = check(pieces, rows)
    pure = [Counter(subject[p.doc_id] for p in own).most_common(1)[0][1] / len(own) for own in by.values() if len(own) > 2]
    assert np.mean(pure) > 0.9
