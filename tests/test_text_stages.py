import pytest

from tidemark.functions.lookup import Lookup
from tidemark.operators.sentences import split_sentences
from tidemark.plans.pipeline import text_stages

# text, sentences, tokens as the compat mode gives them
COMPAT = [
    ("I love it. It's 3.5 stars... :)", ["I love it.", "It's 3.5 stars... :)"], "I love it . It '2 3.5 stars ... EMOT_POS"),
    ("amaaazing goooood keeeep niiice quiiick", None, "mazing god kep niiice quick"),
    (
        "She can't go, don't wanna. I'd say John's dog's",
        ["She can't go, don't wanna.", "I'd say John's dog's"],
        "She can not go , do not 1ant to . IAPOTEMPd say John 's dog '2",
    ),
    ("http://t.co/x @me #tag hi!", None, "hi !"),
    ("The U.S.A. is big. e.g. this", ["The U.S.A. is big.", "e.g.", "this"], "The U.S.A . is big . e.g . this"),
    ("hahaha :-( D: AAAA", None, "EMOT_POS EMOT_NEG EMOT_NEG A"),
    ('"Hello" 1,000 well-known Dr. Smith', None, ' " Hello " 1,000 well - known Dr . Smith'),
    ("", [], ""),
    ("one\n\n  two", ["one", "two"], "one two"),
    ("He won't, they'll I've xx's cannot musta 5'6 a: b/ c", None, "He will not , they will I have xx '2 can not must have 5'6 a : b / c"),
    ("2,1.5", None, "2,144 DOTQUANT775"),
    ("]] ![CDATA[ ok", None, "ok"),
    ("jaja ejej jiji haha heheh hihi", None, " ".join(["EMOT_POS"] * 6)),
    ("JAJA EJEJ JIJI HAHA HEHEH HIHI", None, " ".join(["EMOT_POS"] * 6)),
    ("jaj hah jajx xhaha jahe", None, "jaj hah jajx xhaha jahe"),
]
FIXED = [
    ("I love it. It's 3.5 stars... :)", "I love it . It 's 3.5 stars ... EMOT_POS"),
    ("amaaazing goooood keeeep niiice quiiick", "amazing god kep nice quick"),
    ("She can't go, don't wanna. I'd say John's dog's", "She can not go , do not want to . I 'd say John 's dog 's"),
    ("A.B", "AB"),
]


def test_compat(spark, posts):
    rows = text_stages(posts(*[t for t, _, _ in COMPAT])).orderBy("rowkey").collect()
    for row, (_, sentences, tokens) in zip(rows, COMPAT):
        assert " ".join(row.tokens) == tokens
        if sentences is not None:
            assert row.sentences == sentences


def test_fixed(spark, posts):
    rows = text_stages(posts(*[t for t, _ in FIXED]), fixed=True).orderBy("rowkey").collect()
    assert [" ".join(r.tokens) for r in rows] == [t for _, t in FIXED]


def test_normalised_keeps_a_blank_after_each_word(spark, posts):
    rows = text_stages(posts("hi  there.", "go @me :)."))
    got = [r.normalized for r in rows.orderBy("rowkey").collect()]
    assert got == [["hi there . "], ["go   EMOT_POS . "]]


def test_fixed_normalisation_is_idempotent(spark, posts):
    from tidemark.operators.normalize import normalize

    texts = ["soooo niiice, @you http://x.y :) ]] hahaha. ok", "a  b.. c., XD. \"q\" #t"]
    once = normalize(split_sentences(posts(*texts)), True)
    again = normalize(once.select("rowkey", once["normalized"].alias("sentences")), True)
    first = {r.rowkey: r.normalized for r in once.collect()}
    assert {r.rowkey: r.normalized for r in again.collect()} == first


@pytest.mark.parametrize("bounds", [{}, {"by": "join"}])
def test_abbreviations_protect_only_in_fixed_mode(spark, posts, bounds):
    table = spark.createDataFrame([("approx.",)], "abbr string")
    lookup = Lookup(table, "abbr", table["abbr"], **bounds)
    text = "it is approx. five. Done"
    fixed = split_sentences(posts(text), lookup, fixed=True).first().sentences
    compat = split_sentences(posts(text), lookup).first().sentences
    assert fixed == ["it is approx. five.", "Done"]
    assert compat == ["it is approx.", "five.", "Done"]
