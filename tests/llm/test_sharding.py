import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import queries, sharding


def check_shards(rows, shards):
    by = Counter(r.shard for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [by.get(i, 0) for i in range(shards)]
    assert set(by) <= set(range(shards)) and max(counts) - min(counts) <= 1


def test_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op1_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    check_shards(got, 24)
    for r in got:
        raw = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


def test_every_shard_matches_the_mixture(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = rows.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    got = sharding.interleave(hot, 7).collect()
    check_shards(got, 7)
    total, each = Counter(r.source for r in got), Counter((r.shard, r.source) for r in got)
    for s, n in total.items():
        assert all(abs(each[i, s] - n / 7) <= 2 for i in range(7))


def brute(rows, shards, buckets_free=True):
    """The same order from one sort, without buckets."""
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = []
    for group in by.values():
        group.sort(key=lambda r: (r["h"], r["doc_id"]))
        order += [((i + r["u"]) / len(group), r["source"], r["doc_id"]) for i, r in enumerate(group)]
    order.sort()
    return {d: i * shards // len(order) for i, (_, _, d) in enumerate(order)}


def test_against_brute_force(docs):
    frame = docs(*[(i, f"t{i}", None, f"s{i % 5 if i % 2 else 0}") for i in range(500)])
    h = frame.select(
        "doc_id", "source",
        sharding._unit(F.lit(20), "doc_id", F.crc32("text"), (F.octet_length("text") + 8).cast("bigint")).alias("h"),
        (sharding._unit(F.lit(20), F.lit("source"), "source") / sharding._TOP).alias("u"),
    ).collect()
    want = brute([r.asDict() for r in h], 24)
    assert {r.doc_id: r.shard for r in sharding.interleave(frame).collect()} == want


def test_edge_cases(docs):
    rows = [(1, None, None, None), (2, "", None, "a"), (3, "ü" * 100_000, None, "a"), (None, "x", None, None), (4, "x", None, "b"), (4, "x", None, "b")]
    odd = docs(*rows).withColumn("bucket", F.lit(1)).withColumn("rank", F.lit(2))
    got = sharding.interleave(odd, 4).collect()
    assert len(got) == 6
    check_shards(got, 4)
    by = {r.doc_id: r for r in got}
    assert by[1].size == 8 and by[1].text_crc32 == 0 and by[3].size == 200_008
    assert sharding.interleave(docs().limit(0)).count() == 0
    check_shards(sharding.interleave(docs((1, "a")), 24).collect(), 24)
