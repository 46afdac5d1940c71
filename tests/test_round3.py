"""Spread batches, one-pass noise and the listed classes of unknown words."""

import random

import pytest
from pyspark.sql import functions as F

from checks.oracle import NOISE
from checks.queries import _noise
from tidemark.config import SHARES
from tidemark.operators.tagger import PosTables, tag
from tidemark.schema import RECOGNISED
from tidemark.sources.posts import stream_posts
from tidemark.streaming import stream


def test_a_batch_of_one_file_is_dealt_to_all_cores(spark, bundled, posts, tmp_path, monkeypatch):
    posts(*["This is good :)"] * 40).coalesce(1).write.parquet(str(tmp_path / "in"))
    tasks = []
    monkeypatch.setattr(stream, "write_sentiment", lambda scored, *_: tasks.append(scored.rdd.getNumPartitions()))
    stream.run_stream(stream_posts(spark, str(tmp_path / "in")), str(tmp_path / "out"), bundled).awaitTermination()
    assert tasks == [SHARES * spark.sparkContext.defaultParallelism]


def test_noise_in_one_pass_is_the_replacements_in_turn(spark):
    words = [old.strip() for old, _ in NOISE] + ["x", "", "was\nwas", "Was", "good"]
    draw = random.Random(3)
    texts = [" ".join(draw.choices(words, k=draw.randrange(12))) for _ in range(400)]
    texts += [f"x {w} {w} {w} x {w}" for w in words] + [f"{w} {w} x" for w in words] + ["", " ", " was ", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", _noise(F.col("t")).alias("n")).collect()

    def in_turn(text):
        for old, new in NOISE:
            text = text.replace(old, new)
        return text

    assert [r.n for r in got] == [None if r.t is None else in_turn(r.t) for r in got]


@pytest.mark.parametrize("fixed", [False, True])
def test_listed_classes_are_those_worked_out(spark, bundled, fixed):
    """In-row lookups take most classes from the list; joined ones work each out."""
    single = [("the", "DT"), ("dog", "NN"), ("7", "Z"), (",", "Fc"), ("re", "IN"), ("#", "x"), (".", "Fp")]
    lines = [(w, [(w, t)]) for w, t in single] + [
        (w, [(w, "UNK")]) for w in ("zork", "that", "as", "st", "re", "slowly", "zorking", "Zork")
    ] + [("runs", [("run", "VBZ"), ("run", "NNS")]), ("like", [("like", "IN"), ("like", "VB"), ("like", "JJ")])]
    draw = random.Random(7)
    rows = [(f"{i}", draw.choices(lines, k=draw.randrange(60)) + [(".", [(".", "Fp")])]) for i in range(150)]
    df = spark.createDataFrame(rows, f"rowkey string, analyses {RECOGNISED}")
    listed, worked = [
        tag(df, tables, fixed).select("rowkey", F.to_json("tagged").alias("t")).orderBy("rowkey").collect()
        for tables in (bundled.pos, PosTables(bundled.pos_model, by="join"))
    ]
    assert bundled.pos.shortcut(fixed) is not None
    assert listed == worked
