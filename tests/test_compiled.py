"""The compiled stages against the expressions."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tagger, train
from tidemark.operators.ner import recognise, word_lookup
from tidemark.operators.sentiment import PolarityTables, classify, content_words, compound_names
from tidemark.operators.tagger import PosTables, tag
from tidemark.schema import RECOGNISED, TAGGED

WORDS = """the The THE de of Of DE May may JUNE june I it dog Dog DOG good bad not London paid Ab Cd Bell7 kg tons hundred
hundreds million dollars $ euro 3 5 3,5 2015 20156 x7 ten , . : ; - " \u201c \u201d \u00bb ' '' `` ... ! ? # & / ~ a_b A_b _ x_ 0
#SENT# <blank> EMOT_POS EMOT_NEG \u00c1ngel \u00e1ngel \u0130x \u03a3\u03a3 \U0001f600 http://x Bell: x-y zorking slowly zork""".split()


def lists(spark):
    draw = random.Random(11)
    pick = lambda: draw.choices([*WORDS, ""] if draw.random() < 0.2 else WORDS, k=draw.randrange(40))
    rows = [(f"{i:03d}", pick(), [pick() for _ in range(draw.randrange(4))]) for i in range(300)]
    return spark.createDataFrame(rows, "rowkey string, tokens array<string>, sentence_tokens array<array<string>>")


def shown(df, column):
    return df.select("rowkey", F.to_json(column).alias("t")).orderBy("rowkey").collect()


@pytest.mark.parametrize("fixed", [False, True])
def test_compiled_recogniser_reads_as_the_expressions(spark, bundled, fixed):
    joined = word_lookup(bundled.dictionary, bundled.ambiguous, by="join")
    keys = lists(spark).withColumn("tokens", F.concat("tokens", F.flatten("sentence_tokens"))) if fixed else lists(spark)
    assert shown(recognise(keys, bundled.words, fixed), "analyses") == shown(recognise(keys, joined, fixed), "analyses")


@pytest.mark.parametrize("fixed", [False, True])
def test_no_stage_behind_the_tokens_is_interpreted_word_by_word(spark, bundled, fixed):
    done = classify(tag(recognise(lists(spark), bundled.words, fixed), bundled.pos, fixed), bundled.polarity, fixed)
    assert "lambda" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_compiled_scores_are_those_of_the_expressions(spark, bundled):
    draw = random.Random(5)
    lines = [(w, [(w, t)]) for w, t in (("the", "DT"), ("dog", "NN"), ("re", "IN"), ("7", "Z"), ("zork", "UNK"), ("that", "UNK"), ("slowly", "UNK"), (".", "Fp"))]
    lines += [("runs", [("run", "VBZ"), ("run", "NNS")]), ("like", [("like", "IN"), ("like", "VB"), ("like", "JJ")])]
    rows = [(f"{i:02d}", draw.choices(lines, k=draw.randrange(30)) + [(".", [(".", "Fp")])]) for i in range(60)]
    df = spark.createDataFrame(rows, f"rowkey string, analyses {RECOGNISED}")
    ways = []
    for tables in (bundled.pos, PosTables(bundled.pos_model, by="join")):
        bound, cond, prior = tagger.bind_tables(df, tables)
        ways.append(shown(bound.withColumn("s", tagger.all_scores(tagger.line_info(F.col("analyses")), tables, cond, prior)), "s"))
    assert ways[0] == ways[1]


def test_compiled_content_words_and_compounds_are_those_of_the_expressions(spark, bundled):
    draw = random.Random(3)
    polar = [r.word for r in bundled.lexicon.limit(6).collect()]
    listed = [w for n in sorted(bundled.polarity.lists) for w in bundled.polarity.lists[n][:2]]
    tags = ("JJ", "NN", "VB", "RB", "Fp", "IN", "DT", "")
    line = lambda w, t: (draw.choice([w, ":)", "EMOT_POS"]), w, t)
    rows = [(f"{i:02d}", [line(draw.choice([*polar, *listed, "dog", ""]), draw.choice(tags)) for _ in range(30)]) for i in range(80)]
    df = spark.createDataFrame(rows, f"rowkey string, tagged {TAGGED}")
    ways = []
    for tables in (bundled.polarity, PolarityTables(bundled.lexicon, bundled.nb_model, by="join")):
        bound, probe = tables.bind(df)
        words = bound.withColumn("words", content_words(F.col("tagged"), tables, probe))
        ways.append(shown(words.withColumn("both", F.struct("words", compound_names(F.col("words"), tables).alias("n"))), "both"))
    assert ways[0] == ways[1]


def test_features_and_examples(spark):
    the, runs, dot = ("The", [("the", "DT")]), ("runs", [("run", "VBZ"), ("run", "NNS")]), (".", [(".", "Fp")])
    df = spark.createDataFrame([("a", [the, ("zork", [("zork", "UNK")]), runs, dot, ("lost", [("lost", "UNK")])])], f"rowkey string, analyses {RECOGNISED}")
    lines = tagger.line_info(F.col("analyses"))
    row = df.select(lines.alias("lines"), *[tagger.context_features(lines, fixed).alias(str(fixed)) for fixed in (False, True)]).first()
    assert [(x.token, x.kind, [c.c for c in x.cands]) for x in row.lines] == [
        ("The", 0, ["DT"]), ("zork", 2, ["UN"]), ("runs", 1, ["VBZ", "NN"]), (".", 3, ["Fp"])
    ]
    assert row["False"] == ["R_VBZ", "R_VBZ_zork", "R_NN", "R_NN_zork", "L_DT", "L_DT_zork"]
    assert row["True"] == [*row["False"], "R_END"]
    tagged = spark.createDataFrame([("a", [("The", "the", "DT"), ("dog", "dog", "NN"), (".", ".", "Fp")])], f"rowkey string, tagged {TAGGED}")
    got = tagged.select(train.pos_examples(F.col("tagged")).alias("x")).first().x
    assert [(e.cat, e.feats) for e in got] == [("DT", ["R_NN", "R_NN_the", "L_BEGIN"]), ("NN", ["L_DT", "L_DT_dog"])]
