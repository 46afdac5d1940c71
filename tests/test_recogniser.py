import pytest

from tidemark.operators.ner import recognise, word_lookup
from tidemark.sources.resources import load_dictionary, with_flags

DICTIONARY = """the the DT
dog dog NN
runs run VBZ run NNS
good good JJ
bad bad JJ
not not RB
of of IN
paid pay VBD
like like VB like IN
it it PRP
london london NN
"""

TEN = "_".join(["Ab"] * 10) + "|" + "_".join(["ab"] * 10) + "/NNP"

CASES = [
    (
        "Anna Smith of London paid 5 million dollars .",
        "Anna_Smith_of_London|anna_smith_of_london/NNP paid|pay/VBD 5_million_dollars|5_million_dollars/Zm .|./Fp",
    ),
    ("3 of May , 2015 .", "3_of_May_,_2015|3_of_may_,_2015/W .|./Fp"),
    ("I like it 5 dollars", "I|i/UNK like|like/VB,like/IN it|it/PRP 5_dollars|5_dollars/Zm"),
    ("EMOT_POS", "EMOT_POS|emot_pos/NNP <blank>|<blank>/Fp"),
    (
        '" Big Apple " is THE DOG . Dog runs #',
        '"|"/Fe Big_Apple|big_apple/NNP "|"/Fe is|is/UNK THE|the/DT DOG|dog/NN .|./Fp Dog|dog/NN runs|run/VBZ,run/NNS #|#/ <blank>|<blank>/Fp',
    ),
    # trailing preposition and article are given back
    ("John of the paid .", "John|john/NNP of|of/IN the|the/DT paid|pay/VBD .|./Fp"),
    ("x Anna Bell of paid .", "x|x/NNP Anna_Bell|anna_bell/NNP of|of/IN paid|pay/VBD .|./Fp"),
    # eleven in a row are too many, but the last ten of them are not
    ("x " + "Ab " * 11 + ".", f"x|x/NNP Ab|ab/NNP {TEN} .|./Fp"),
    ("x " + "Ab " * 10 + ".", f"x|x/NNP {TEN} .|./Fp"),
    # after a comma inside a name word, only prepositions and articles join
    ("x Ab1,0 Cd .", "x|x/NNP Ab1,0|Ab1,0/Z Cd|cd/NNP .|./Fp"),
    ("x 3 kg . 4 hundred tons .", "x|x/NNP 3_kg|3_kg/Zu .|./Fp 4_hundred_tons|4_hundred_tons/Zu .|./Fp"),
    ("x May of 2015 .", "x|x/NNP May_of_2015|may_of_2015/W .|./Fp"),
    # a month-first date needs its day used in a number before
    ("x May the 3 , 2015 .", "x|x/NNP May|may/NNP the|the/DT 3|3/Z ,|,/Fc 2015|2015/Z .|./Fp"),
    ("x 3 kg May the 3 , 2015 .", "x|x/NNP 3_kg|3_kg/Zu May_the_3_,_2015|may_the_3_,_2015/W .|./Fp"),
    ("x 3 kg 3 x May the 3 , 2015 .", "x|x/NNP 3_kg|3_kg/Zu 3|3/Z x|x/UNK May|may/NNP the|the/DT 3|3/Z ,|,/Fc 2015|2015/Z .|./Fp"),
    # a merged name with a digit goes on as a number
    ("x Anna Bell7 dollars .", "x|x/NNP Anna_Bell7_dollars|anna_bell7_dollars/Zm .|./Fp"),
]


def shown(row):
    return " ".join(
        e.token + "|" + ",".join(f"{a.lemma}/{a.tag}" for a in e.analyses) for e in row.analyses
    )


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("res") / "dictionary.txt"
    path.write_text(DICTIONARY)
    return load_dictionary(spark, str(path)), spark.createDataFrame([("ace",)], "word string")


@pytest.mark.parametrize("bounds", [{}, {"by": "join"}])
def test_golden(spark, tables, bounds):
    rows = [(f"{i:03d}", text.split(" ")) for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "rowkey string, tokens array<string>")
    got = recognise(df, word_lookup(*tables, **bounds)).orderBy("rowkey").collect()
    assert [shown(r) for r in got] == [want for _, want in CASES]


def test_fixed_closes_each_sentence(spark, tables):
    rows = [("a", [], [["I", "like", "it", "5", "dollars"], ["May", "the", "3", ",", "2015"]])]
    df = spark.createDataFrame(rows, "rowkey string, tokens array<string>, sentence_tokens array<array<string>>")
    got = shown(recognise(df, word_lookup(*tables), fixed=True).first())
    assert got.endswith("5_dollars|5_dollars/Zm <blank>|<blank>/Fp May_the_3_,_2015|may_the_3_,_2015/W <blank>|<blank>/Fp")


def test_dictionary_flags(spark):
    rows = [("rome", [("rome", "NP00")]), ("of", [("of", "IN")]), ("dog", [("dog", "NN")])]
    df = spark.createDataFrame(rows, "form string, analyses array<struct<lemma:string,tag:string>>")
    got = {r.form: (r.is_stop, r.is_noamb) for r in with_flags(df).collect()}
    assert got == {"rome": (False, True), "of": (True, False), "dog": (False, False)}
