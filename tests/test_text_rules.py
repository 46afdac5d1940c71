"""The text stages as they are run against the rules as they are listed, over random texts, and their plans."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import chomp, split_all
from tidemark.operators import normalize as norm
from tidemark.operators import sentences, tokens
from tidemark.plans.pipeline import text_stages

PARTS = (
    "a|b |I|'|''|s|ve|ll|re |m|d|t |. |.|...|....|,|1|2 |3.5|1,000|5'6|<<|>>|`|``|:|: |/|~|(|)|\t|\r|\x01|\x0b|\x1f|\u0085| |  |\n|\n |"
    "wanna|Cannot |gonna| woulda |musta|APOTEMP|APOTEMPt |APOTEMPve|GENs|3SUSP012|44DOTQUANT77|can't |won't|n't |He's |John's |é|€|“x”|😀|-|"
    "aa|eee|OOO|ui|UU|X|D|xD|Xo)|:)|:-(|dox|haha|AJAJ|ejej|hi|]]|![CDATA[|\"|\"q|@me|#t|http://x.y|news://|_https://z|"
    "U.S.A.|A.B|word, |Word. |x, |..|.,| , |<SIGLA-TMP>|<SIGLA-TMP>A.|a.b.c|1.2.3|1.23.4|.b|É.Á.|à.é.|.\"|.'|<ABR-TMP>|é.b|2.a|A.b"
).split("|")
TEXTS = ["", "\t", " ", " \t ", '"', "a.b.c.d", "U.S.A.", "1.23.4.5", "E.g. A. b", "....", "a:(b/)c.", "x:\r", "end.\r", "'s", "44DOTQUANT7744DOTQUANT77"]


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(7)
    every = TEXTS + ["".join(r.choice(PARTS) for _ in range(r.randint(1, r.choice((2, 5, 20))))) for _ in range(4000)]
    return spark.createDataFrame([(t,) for t in [None, *every]], "t string").repartition(4).cache()


def same(texts, one, other):
    rows = texts.select("t", one.alias("a"), other.alias("b"))
    assert rows.count() == texts.count()
    assert rows.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def in_turn(column, rules):
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, column)


def test_tokens_are_cut_as_by_the_rules_in_turn(texts):
    listed = split_all(in_turn(chomp(F.col("t")), tokens.SUBSTITUTIONS), "\\s")
    same(texts, split_all(tokens.sentence_tokens(F.col("t")), "\\s"), listed)


def test_stand_ins_are_restored_in_each_token_of_a_text(spark):
    text = "x3SUSP0123SUSP012  GENs\n144DOTQUANT772 44DOTQUANT7744DOTQUANT77 plain"
    assert spark.range(1).select(tokens.restore(F.lit(text))).first()[0] == "x...3SUSP012  's\n1.2 .44DOTQUANT77 plain"


def test_blank_sentences_and_empty_posts_keep_their_tokens(spark):
    rows = [[], [""], ["\t"], ["\t", "a"], ["", "\t"], [" ( b"], ["wanna", "\t"], ["a \x01 b\x01"], ["nAPOTEMPt"], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, normalized array<string>")
    got = [r.tokens for r in tokens.tokenize(df).orderBy("i").collect()]
    assert got == [[""], [], [""], ["", "a"], [], ["", "(", "b"], ["1ant", "to"], ["a", "b"], ["not"], None]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_without_a_pattern_are_replaced_as_texts(posts):
    found = plan(text_stages(posts("a")).select("tokens"))
    assert not [p for p, mark in tokens.SUBSTITUTIONS[:5] if f", {p}, {mark}, 1)" in found]


@pytest.mark.parametrize("fixed", [False, True])
def test_words_are_rewritten_as_by_the_rules_in_turn(texts, fixed):
    def listed(w):
        stop = (w.endswith(".") | w.endswith(",")) & w.rlike(norm.TAIL)
        word = F.when(stop, F.substr(w, F.lit(1), F.length(w) - 1)).otherwise(w)
        runs = "|".join(run for _, run in (norm.FIXED_RUNS if fixed else norm.TRIGGERS))
        done = norm.rewrite(F.when(word.rlike(runs), norm.collapse(word, fixed)).otherwise(word), fixed)
        return F.when(done == "", "").when(stop, F.concat_ws(" ", done, F.right(w, F.lit(1)))).otherwise(done)

    # A word of small letters before a line end keeps that, others lose it.
    words = texts.select(F.explode_outer(F.split(F.regexp_replace("t", "[\r\n]", ""), " ")).alias("t"))
    same(words, norm.normalize_word(F.col("t"), fixed), listed(F.col("t")))


def test_stops_and_blanks_of_plain_sentences(spark):
    df = spark.createDataFrame([(0, ["a,  b., c. d..", " x  , y.", "😀. é,", ", .", "cats\r", "Cats\r"]), (1, [])], "i int, sentences array<string>")
    got = [r.normalized for r in norm.normalize(df).orderBy("i").collect()]
    assert got == [["a , b., c . d.. ", "x , y . ", "😀 . é , ", ", . ", "cats\r ", "Cats "], []]


def test_single_blanks_are_not_replaced(posts):
    assert ",  +,  , 1)" not in plan(text_stages(posts("a")).select("normalized"))


def test_sentences_are_cut_as_by_the_rules_in_turn(texts):
    def listed(t):
        cut = F.regexp_replace(F.concat(in_turn(t, sentences.SUBSTITUTIONS), F.lit("\n")), "\n\\s+", "\n")
        for mark in (sentences.ABBREVIATION_DOT, sentences.DOT):
            cut = F.replace(cut, F.lit(mark), F.lit("."))
        return split_all(cut, "\n")

    same(texts, sentences.sentence_array(F.col("t")), listed(F.col("t")))


def test_hidden_dots_take_one_pass(posts):
    found = plan(text_stages(posts("a")).select("sentences"))
    assert not [p for p, _ in sentences.SUBSTITUTIONS[:6] if f", {p}, " in found]
