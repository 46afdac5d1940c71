import pytest

from tidemark.operators.tagger import PosTables, tag
from tidemark.operators.train import fit_pos
from tidemark.schema import RECOGNISED, TAGGED
from tidemark.sources.resources import load_pos_model

MODEL = """<number_of_docs>100</number_of_docs>
<cat>NN 0.3</cat>
<cat>VBZ 0.1</cat>
<cat>DT 0.2</cat>
<cat>VB 0.1</cat>
<cat>RB 0.1</cat>
<cat>JJ 0.1</cat>
<cat>NNP 0.1</cat>
L_NN VBZ 0.4 5
L_NN NN 0.05 5
L_BEGIN DT 0.5 10
R_NN DT 0.6 10
R_NN JJ 0.5 8
"""
LINES = [
    "the the DT|dog dog NN|runs run VBZ run NNS|. . Fp",
    "dog dog NN|zorking zorking UNK|# # |quickly quickly UNK|Zoo zoo UNK|<blank> <blank> Fp|lost lost UNK",
]


def parse(line):
    token, *rest = line.split(" ")
    return token, list(zip(rest[0::2], rest[1::2]))


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("res") / "pos.txt"
    path.write_text(MODEL)
    return load_pos_model(spark, str(path))


def run(spark, model, texts, fixed=False, **bounds):
    rows = [(f"{i:03d}", [parse(x) for x in t.split("|")] if t else []) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"rowkey string, analyses {RECOGNISED}")
    out = tag(df, PosTables(model, **bounds), fixed).orderBy("rowkey").collect()
    return [[(x.token, x.lemma, x.tag) for x in r.tagged] for r in out]


@pytest.mark.parametrize("bounds", [{}, {"by": "join"}])
def test_golden(spark, model, bounds):
    first, second, empty = run(spark, model, [*LINES, ""], **bounds)
    assert first == [("the", "the", "DT"), ("dog", "dog", "NN"), ("runs", "run", "NNS"), (".", ".", "Fp")]
    assert second == [
        ("dog", "dog", "NN"),
        ("zorking", "", "VBG"),
        ("quickly", "quickly", "RB"),
        ("Zoo", "Zoo", "NN"),
        ("<blank>", "<blank>", "Fp"),
    ]
    assert empty == []


def test_fixed(spark, model):
    first, second = run(spark, model, LINES, fixed=True)
    assert first[2] == ("runs", "run", "VBZ")
    assert second[1] == ("zorking", "zorking", "VBG")


def test_long_sentences_cross_scan_blocks(spark, model):
    words = "|".join(["dog dog NN", "runs run VBZ run NNS"] * 100 + [". . Fp"])
    (got,) = run(spark, model, [words])
    assert len(got) == 201
    assert set(got[1::2]) == {("runs", "run", "NNS")}


def test_fit_pos_counts(spark):
    rows = [("a", [("The", "the", "DT"), ("dog", "dog", "NN"), (".", ".", "Fp"), ("dog", "dog", "NN"), (".", ".", "Fp")])]
    fitted = fit_pos(spark.createDataFrame(rows, f"rowkey string, tagged {TAGGED}"))
    prior = {r.cat: r.p for r in fitted.prior.collect()}
    cond = {(r.feat, r.cat): (r.p, r.freq) for r in fitted.cond.collect()}
    assert prior == {"DT": pytest.approx(1 / 3), "NN": pytest.approx(2 / 3)}
    assert cond == {
        ("L_BEGIN", "DT"): (1.0, 2),
        ("L_BEGIN", "NN"): (0.5, 2),
        ("R_NN", "DT"): (1.0, 1),
        ("R_NN_the", "DT"): (1.0, 1),
        ("L_DT", "NN"): (0.5, 1),
        ("L_DT_dog", "NN"): (0.5, 1),
    }
