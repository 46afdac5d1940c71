import random
from itertools import combinations

from pyspark.sql import functions as F

from tidemark.llm import decontam as dc
from tidemark.llm import queries


def brute(docs, items, window=dc.WINDOW):
    """Every alignment of every item with every document."""
    out = {}
    for doc_id, text in docs:
        d = dc.tokens(text)
        for item_id, itext in items:
            t = dc.tokens(itext)
            n = min(window, len(t))
            if not n or (dc.says_nothing(t) and d != t):
                continue
            best = max(
                (sum(a == b for a, b in zip(d[i : i + n], t[j : j + n])) for i in range(len(d) - n + 1) for j in range(len(t) - n + 1)),
                default=0,
            )
            if best >= n - dc.allowed(n):
                out[doc_id, item_id] = best
    return out


def found(frame):
    return {(r.doc_id, r.item_id): r.agree for r in frame.collect()}


def test_masks_miss_any_allowed_positions():
    for n in range(1, dc.WINDOW + 1):
        chosen = dc.masks(n)
        for bad in combinations(range(n), dc.allowed(n)):
            assert any(all(i % m.groups not in m.kept for i in bad) for m in chosen)


def test_against_brute_force(spark, docs):
    rng = random.Random(11)
    words = ["the", "of", "and", "to"] + [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 5, 6, 9, 10, 12, 13, 14, 30, 50])))) for i in range(40)]
    rows = []
    for i in range(300):
        text = rng.choices(words, k=rng.randrange(0, 80))
        if i % 3:
            planted = rng.choice(items)[1].split()
            cut = rng.randrange(0, max(1, len(planted) - 8))
            planted = planted[cut : cut + rng.randrange(5, 40)]
            for _ in range(rng.randrange(0, 5)):
                planted[rng.randrange(len(planted))] = rng.choice(words)
            at = rng.randrange(len(text) + 1)
            text[at:at] = planted
        rows.append((i, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = found(dc.overlaps(docs(*rows), bench))
    want = brute(rows, items)
    assert got == want and len(want) > 60


def test_whole_items_in_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    planted = {(r.doc_id, i.item_id) for r in rows for i in items if i.text in r.text}
    got = found(queries.op8_decontamination(spark, sf))
    assert planted <= set(got)
    grams = {}
    for i in items:
        t = dc.tokens(i.text)
        for k in range(len(t) - 6):
            grams.setdefault(tuple(t[k : k + 7]), set()).add(i.item_id)
    texts = {r.doc_id: dc.tokens(r.text) for r in rows}
    for doc_id, item_id in set(got) - planted:
        d = texts[doc_id]
        assert any(item_id in grams.get(tuple(d[k : k + 7]), ()) for k in range(len(d) - 6)), "a clean document"


def test_edge_cases(spark, docs):
    item = "Alpha beta, gamma delta; epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    long = "filler words here " * 50_000 + item.upper() + " tail" * 1000
    rows = [(1, None), (2, ""), (3, long), (4, item), (4, item), (None, item), (5, "alpha beta gamma"), (6, item.replace("beta", "x").replace("nu", "y"))]
    bench = spark.createDataFrame([(7, item), (7, item), (None, item), (8, None), (9, "one two")], "item_id bigint, text string")
    got = dc.overlaps(docs(*rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d in (3, 4, None, 6) for i in (7, None)}
    assert len(got) == 8
    place = {r.doc_id: r.doc_at for r in got}
    assert place[3] == 150_000 and place[4] == 0
    odd = docs(*rows).withColumn("tokens", F.lit(1)).withColumn("item_id", F.lit(2))
    clean = dc.drop_contaminated(odd, bench)
    assert clean.columns == odd.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 5]
    assert dc.overlaps(docs(*rows), bench.limit(0)).count() == 0
    assert dc.overlaps(docs().limit(0), bench).count() == 0


def test_items_of_every_length(spark, docs):
    """One to twenty tokens, in words and in scripts without spaces, with and without common words."""
    rng = random.Random(21)
    signs = "今日は天気がいいですね明後海山川田中村กขคงจฉ"
    common, rare = sorted(dc.common_words())[:400:10], [f"zq{i}" for i in range(40)]
    items = [(n, " ".join(rng.choices(common + rare[:9], k=n))) for n in range(1, 21)]
    items += [(100 + n, "".join(rng.choices(signs, k=n))) for n in range(1, 21)]
    items += [(200 + n, " ".join(rng.choices(common, k=n))) for n in range(1, 5)]
    items += [(300 + n, " ".join(rng.choices(rare, k=n))) for n in range(1, 5)]
    rows = []
    for i, (_, text) in enumerate(items * 3):
        glue = "" if text and text[0] in signs else " "
        around = ["".join(rng.choices(signs, k=4)) if not glue else " ".join(rng.choices(common + rare, k=6)) for _ in range(2)]
        body = list(text) if not glue else text.split()
        if i % 3 == 1 and len(body) > 5:
            body[rng.randrange(len(body))] = rng.choice(signs if not glue else rare)
        middle = glue.join(body)
        rows.append((i, middle.upper() if i % 4 == 0 else glue.join([around[0], middle, around[1]])))
    got = found(dc.overlaps(docs(*rows), spark.createDataFrame(items, "item_id bigint, text string")))
    want = brute(rows, items)
    assert got == want
    assert {i for _, i in want} >= {n for n, t in items if not dc.says_nothing(dc.tokens(t))}
    assert {n for n, t in items if len(dc.tokens(t)) < dc.SHORT and not dc.says_nothing(dc.tokens(t))}
    assert {i for _, i in want if 200 <= i < 300} == {i for i, t in items if 200 <= i < 300 and any(dc.tokens(x) == dc.tokens(t) for _, x in rows)}


def test_a_short_item_of_common_words_is_a_whole_text(spark, docs):
    bench = spark.createDataFrame([(1, "What is the time"), (2, "the"), (3, "zirconium lattice")], "item_id bigint, text string")
    rows = [(1, "He said what is the time and left"), (2, "what is the time?"), (3, "The"), (4, "a zirconium lattice of one sort"), (5, "the " * 9)]
    assert set(found(dc.overlaps(docs(*rows), bench))) == {(2, 1), (3, 2), (4, 3)}
