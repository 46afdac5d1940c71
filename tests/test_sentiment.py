import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sentiment import PolarityTables, classify, polarity_vote, with_scores
from tidemark.operators.train import fit_nb
from tidemark.schema import TAGGED
from tidemark.sources.resources import Model, load_nb_model, load_polarity_lexicon, model_lines

# The few model rows these cases need (fixed values).
MODEL = """<number_of_docs>48117</number_of_docs>
<cat>NEGATIVE 0.43608288131014</cat>
<cat>POSITIVE 0.56391711868986</cat>
<list>light_words come|take|get|go|be|should|must|have</list>
<list>neg_verb no|nor|not</list>
<list>neg_noun no|not|none|nothing</list>
<list>quant_adj too|many|much|very</list>
bad NEGATIVE 0.0137730543773531 312
bad POSITIVE 0.000847645021006855 312
emot_neg NEGATIVE 0.00490873564313968 111
emot_neg POSITIVE 0.000294833050784993 111
emot_pos NEGATIVE 0.00128675594528904 550
emot_pos POSITIVE 0.0192747106950689 550
good NEGATIVE 0.00109612543487585 400
good POSITIVE 0.0138940075182428 400
love NEGATIVE 0.00100081017966926 882
love POSITIVE 0.0317314070907349 882
not NEGATIVE 0.0266882714578468 788
not POSITIVE 0.0084027419473723 788
very NEGATIVE 0.000142972882809894 55
very POSITIVE 0.00191641483010245 55
"""
LEXICON = "good\tPOSITIVE\nlove\tPOSITIVE\nbad\tNEGATIVE\nno\tNEGATIVE\nnot\tNEGATIVE\ntied\tPOSITIVE\ntied\tNEGATIVE\nbroken\n"
CASES = [
    ("good/JJ", 1),
    ("not/RB good/JJ", -1),
    ("not/RB bad/JJ", 1),
    ("not/RB love/VB", -1),
    ("very/RB bad/JJ", -1),
    ("no/DT good/JJ", 1),
    ("table/NN", 0),
    ("bad/JJ EMOT_POS/NNP", 1),
    ("EMOT_POS/NNP EMOT_NEG/NNP good/JJ", 1),
    ("not/RB of/IN good/JJ", 1),
    ("not/RB ,/Fc good/JJ", -1),
    ("not/RB no/JJ good/JJ", 1),
    ("not/RB very/RB good/JJ", 1),
    ("tied/JJ", 0),
    ("good/NN café/JJ", 1),
    ("", 0),
]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("polarity")
    (folder / "model.txt").write_text(MODEL)
    (folder / "lexicon.txt").write_text("﻿" + LEXICON)
    return str(folder / "lexicon.txt"), str(folder / "model.txt")


@pytest.fixture(scope="module")
def loaded(spark, files):
    return load_polarity_lexicon(spark, files[0]), load_nb_model(spark, files[1])


def frame(spark, texts):
    parse = lambda t: [(w.split("/")[0], w.split("/")[0].lower(), w.split("/")[1]) for w in t.split()]
    rows = [(f"{i:03d}", parse(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"rowkey string, tagged {TAGGED}")


@pytest.mark.parametrize("bounds", [{}, {"by": "join"}])
def test_golden(spark, loaded, bounds):
    tables = PolarityTables(*loaded, **bounds)
    got = classify(frame(spark, [t for t, _ in CASES]), tables).orderBy("rowkey").collect()
    assert [r.sentiment for r in got] == [want for _, want in CASES]


def test_lists_of_any_size_are_joined(spark, loaded):
    """Over 10,000 listed words: an error in the row, the same results by joins."""
    lexicon, model = loaded
    more = spark.range(12_000).select(F.lit("neg_noun").alias("name"), F.format_string("w%d", "id").alias("word"))
    large = Model(model.n_docs, model.prior, model.cond, model.lists.select("name", "word").union(more))
    with pytest.raises(ValueError, match="lookup='join'"):
        PolarityTables(lexicon, large)
    texts = [t for t, _ in CASES] + ["w11999/NN good/JJ", "w12000/NN good/JJ", "w5/NN must/V good/JJ"]
    tables = PolarityTables(lexicon, large, by="join")
    got = classify(frame(spark, texts), tables).orderBy("rowkey")
    assert [r.sentiment for r in got.collect()] == [want for _, want in CASES] + [-1, 1, -1]
    assert got.columns == ["rowkey", "sentiment"]


@pytest.mark.parametrize("fixed", [False, True])
def test_both_ways_of_the_lists_agree(spark, loaded, fixed):
    """Random posts over listed, polar and other words, in both modes."""
    rng = random.Random(3)
    words = ["not/RB", "no/DT", "no/JJ", "very/RB", "too/RB", "none/NN", "must/VB", "good/JJ", "bad/NN", "love/VB", "of/IN", ",/Fc", "mill/NN"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(150)]
    ways = []
    for bounds in ({}, {"by": "join"}):
        scored = with_scores(frame(spark, texts), PolarityTables(*loaded, **bounds), fixed)
        ways.append([(r.rowkey, r.scores.hits, round(r.scores.pos, 9), round(r.scores.neg, 9)) for r in scored.orderBy("rowkey").collect()])
    assert ways[0] == ways[1] and len({w[1:] for w in ways[0]}) > 20


def test_score_of_one_word(spark, loaded):
    row = with_scores(frame(spark, ["good/JJ"]), PolarityTables(*loaded)).first()
    assert math.exp(row.scores.pos) == pytest.approx(0.03180025167514737, rel=1e-12)
    assert math.exp(row.scores.neg) == pytest.approx(0.00020844828792595561, rel=1e-12)


def test_fixed_negates_a_quantified_word_and_resets_at_marks(spark, loaded):
    texts = ["not/RB very/RB good/JJ", "not/RB ,/Fc good/JJ"]
    got = classify(frame(spark, texts), PolarityTables(*loaded), True).orderBy("rowkey").collect()
    assert [r.sentiment for r in got] == [-1, 1]
    assert got[0].p_positive < 0.5 < got[1].p_positive


def test_long_text_does_not_underflow(spark, loaded):
    (row,) = classify(frame(spark, ["good/JJ " * 2000]), PolarityTables(*loaded)).collect()
    assert row.sentiment == 1


def test_vote_and_rejects(spark, files, loaded):
    from tidemark.sources.resources import lexicon_rejects

    vote = {r.word: r.polarity for r in polarity_vote(loaded[0]).collect()}
    assert vote == {"good": 1, "love": 1, "bad": -1, "no": -1, "not": -1}
    assert [r.line for r in lexicon_rejects(spark, files[0]).collect()] == ["broken"]


def test_fit_nb_round_trips_through_the_text_format(spark, loaded, tmp_path):
    rows = [("POSITIVE", ["good", "good", "day"]), ("POSITIVE", ["day"]), ("NEGATIVE", ["bad", "day"])]
    fitted = fit_nb(spark.createDataFrame(rows, "cat string, tokens array<string>"), loaded[1].lists)
    lines = [r.line for r in model_lines(fitted).orderBy("part").collect()]
    assert lines[0] == "<number_of_docs>3</number_of_docs>"
    (tmp_path / "model.txt").write_text("\n".join(lines))
    again = load_nb_model(spark, str(tmp_path / "model.txt"))
    rows = lambda m: sorted((r.feat, r.cat, r.p, r.freq) for r in m.cond.collect())
    assert rows(again) == rows(fitted)
    assert ("day", "POSITIVE", 1.0, 3) in rows(again) and ("good", "POSITIVE", 0.5, 1) in rows(again)
    assert sorted(map(tuple, again.lists.collect())) == sorted(map(tuple, loaded[1].lists.collect()))
