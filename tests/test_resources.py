"""Repeated lines, and models that name a feature twice."""

from pyspark.sql import functions as F

from tidemark import Resources
from tidemark.operators import train
from tidemark.operators.tagger import PosTables
from tidemark.operators.tokens import restore
from tidemark.sources import resources as res


def written(tmp_path, name, *lines):
    path = tmp_path / f"{name}.txt"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_the_last_line_of_a_key_counts(spark, tmp_path):
    filler = [f"w{i} w{i} NN" for i in range(3000)]
    path = written(tmp_path, "dictionary", "dog first NN", *filler, "dog second NN dog VB", *filler, "cat cat NN")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # the lines fall into many splits
    try:
        table = res.load_dictionary(spark, path)
        rows = {r.form: [tuple(a) for a in r.analyses] for r in table.filter("form in ('dog', 'cat')").collect()}
        assert table.count() == 3002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {"dog": [("second", "NN"), ("dog", "VB")], "cat": [("cat", "NN")]}
    path = written(tmp_path, "abbreviations", "e.g. one", "e.g. two", "plain x")
    assert [tuple(r) for r in res.load_abbreviations(spark, path).collect()] == [("e.g.", "two")]


def test_a_model_may_name_a_feature_twice(spark, tmp_path):
    path = written(
        tmp_path, "model", "<number_of_docs>10</number_of_docs>", "<cat>NN 0.1</cat>", "<cat>NN 0.4</cat>", "L_DT NN 0.2 3", "L_DT VB 0.1 3", "L_DT NN 0.5 3"
    )
    model = res.load_pos_model(spark, path)
    assert [tuple(r) for r in model.prior.collect()] == [("NN", 0.4)]
    tables = PosTables(model)
    got = tables.cond.table.select("key", F.col("value.lp").alias("lp")).collect()
    assert [(r.key, sorted((k, round(2.718281828 ** v, 6)) for k, v in r.lp.items())) for r in got] == [("L_DT", [("NN", 0.5), ("VB", 0.1)])]
    assert tables.open_prior["NN"] == 0.4


def test_a_stand_in_comes_back_once(spark):
    rows = spark.createDataFrame([("3SUSP012x3SUSP012",), ("a44DOTQUANT77b44COMMQUANT77c",), ("plain",)], "t string")
    assert [r[0] for r in rows.select(restore(F.col("t"))).collect()] == ["...x3SUSP012", "a.b,c", "plain"]


def test_fitting_is_lazy_and_counts_once(spark, capsys):
    docs = spark.createDataFrame([("A", ["x", "y"]), ("A", ["x"]), ("B", ["x", "z"])], "cat string, tokens array<string>")
    cond = train.fit_nb(docs).cond
    assert sorted(map(tuple, cond.collect())) == [("x", "A", 1.0, 3), ("x", "B", 1.0, 3), ("y", "A", 0.5, 1), ("z", "B", 1.0, 1)]
    cond.explain()
    plan = capsys.readouterr().out
    final = plan[: plan.index("== Initial Plan ==")]
    assert "ReusedExchange" in final and final.count("Generate") == 1


def test_sample_resources_load(spark):
    assert Resources(spark).words.table.count() > 0
