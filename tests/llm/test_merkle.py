import hashlib
import zlib

from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from tidemark.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(digests):
    """All levels over a list of digests."""
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + 16]) for i in range(0, len(now), 16)])
    return levels


def walk(levels, i, start):
    """The digest that ``start`` at place ``i`` folds to, and the siblings passed."""
    seen = []
    for level in levels[:-1]:
        run, at = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
        seen += run[:at] + run[at + 1 :]
        start = h(*run[:at], start, *run[at + 1 :])
        i //= 16
    return start, seen


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = climb([leaf(r, r["text"]) for r in by[s]])
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            mine = leaf(r, r["text"])
            sub, seen = walk(trees[s], i, leaf(r, lower(r["text"])) if tampered else mine)
            root, more = walk(top, k, sub)
            out.append((r["doc_id"], mine, trees[s][-1][0], top[-1][0], h(*seen, *more), root, root == top[-1][0]))
    return sorted(out, key=repr)


def query(spark, frame, tmp_path, name):
    path = str(tmp_path / name)
    frame.write.parquet(f"{path}/documents.parquet")
    return queries.op11_merkle_manifest(spark, path)


def check(spark, rows, tmp_path, name, width=4):
    full = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    frame = spark.createDataFrame(rows, DOCS).repartition(width)
    odd = frame.withColumn("tree", F.lit("x")).withColumn("range", F.lit(1)).withColumn("hash", F.lit("y")).withColumn("lo", F.lit(2))
    got = sorted((tuple(r) for r in query(spark, odd, tmp_path, name).collect()), key=repr)
    assert got == brute(full)
    return got


def test_against_brute_force(spark, tmp_path):
    """A source of three levels, one of a full run, one of a run and a leaf, and more than a run of sources."""
    rows = [(i, f"Text {i} of ONE", "en", "big", i % 90) for i in range(301)]
    rows += [(1000 + i, f"t{i}", None, "sixteen", None) for i in range(16)]
    rows += [(2000 + i, f"T{i}", None, "seventeen", None) for i in range(17)]
    rows += [(3000 + i, "SMALL", "de", f"s{i:02d}", 5) for i in range(20)]
    got = check(spark, rows, tmp_path, "many")
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "A", None, None, 1), (5, "AB", "en", "Ünder", 2), (5, "B", "en", "Ünder", 1), (7, "", "en", "", 0)]
    rows += [(9, "SAME row", "en", "twice", 8)] * 40 + [(12, None, None, "twice", None), (15, "Z" * 300_000 + "ß", "de", "twice", 300_001)]
    check(spark, rows, tmp_path, "odd")


def test_one_row_one_source_and_none(spark, tmp_path):
    check(spark, [(15, "ALONE", None, None, None)], tmp_path, "one", 1)
    check(spark, [(i, "Xx", None, "only", 2) for i in range(5)], tmp_path, "source", 2)
    assert query(spark, spark.createDataFrame([], DOCS), tmp_path, "none").collect() == []


def test_labels_nest(spark):
    rows = [(i, "t", None, "a" if i % 3 else "b", 1) for i in range(120)]
    of = merkle.manifest(spark.createDataFrame(rows, DOCS))
    nodes = of.nodes().collect()
    by = {}
    for r in nodes:
        by.setdefault((r.scope, r.tree, r.level), []).append((r.lo, r.hi))
    for (scope, tree, level), spans in by.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        above = by.get((scope, tree, level + 1))
        if above:
            assert all(sum(a <= lo and hi <= b for a, b in above) == 1 for lo, hi in spans)
    assert len(by[("source", "a", 2)]) == 1 and len(by[("top", "0", 1)]) == 1
