import random

import xxhash

from tidemark.llm import graph, queries, simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    root = {r: r for r, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if (x ^ y).bit_count() <= 2:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {a: find(a) for a, _ in rows}


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, slow_print(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    got = {r.doc_id: r for r in queries.op7_simhash(spark, sf).collect()}
    assert len(got) == len(rows)
    for doc_id, value in rows:
        assert got[doc_id].fingerprint == f"{value:016x}"
        assert got[doc_id].component_id == want[doc_id]


def test_chains_of_fingerprints(spark):
    rng = random.Random(3)
    values = {0, 1 << 63}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            values.add(at)
            at ^= 1 << rng.randrange(64)
            at ^= 1 << rng.randrange(64)
    rows = [(v - (1 << 64) if v >> 63 else v, v) for v in values]
    edges = simhash.links(spark.createDataFrame([(s,) for s, _ in rows], "print bigint"))
    got = {r.node: r.root for r in graph.components(edges).collect()}
    want = brute(sorted(rows))
    assert all(got.get(s, s) == want[s] for s, _ in rows)


def test_edge_cases(docs):
    long = " ".join(f"w{i}" for i in range(80_000))
    rows = [(4, None), (3, ""), (2, " \t"), (9, "A b"), (8, "a  B"), (7, "a\u00a0b"), (5, long), (6, long.upper()), (6, long.upper()), (None, "a b")]
    got = {r.doc_id: (r.print, r.component_id) for r in simhash.near_duplicates(docs(*rows)).collect()}
    assert got[4] == got[3] == got[2] == (0, 2)
    assert got[9][1] == got[8][1] == 8 and got[None][1] == 8 and got[7][1] == 7
    assert got[5][1] == got[6][1] == 5
    assert simhash.fingerprint(long) == slow_print(long)
    kept = simhash.drop_near_duplicates(docs(*rows)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 5, 7, 8]


def test_empty(docs):
    assert simhash.near_duplicates(docs().limit(0)).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(path + hub, "u bigint, v bigint")).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 301 + 400
