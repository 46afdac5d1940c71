import time

import pytest
from pyspark.sql import functions as F

from tidemark import EngineConfig, Resources, build_pipeline
from tidemark.operators import rowkey, routing
from tidemark.jobs import run_batch, run_stream_job
from tidemark.sources.posts import read_posts, stream_posts
from tidemark.sources.sink import compact_sentiment, read_sentiment, write_sentiment
from tidemark.streaming.stream import run_stream

TEXTS = (
    "This is good :) hahaha",
    "Not good , I hate it. Very bad dog.",
    "Anna Smith paid 5 million dollars",
    "",
    "Re nt ou " * 3000,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_pipeline_has_no_exchange_and_reads_what_it_needs(spark, bundled, posts, tmp_path):
    posts(*TEXTS).write.parquet(str(tmp_path / "in"))
    text = plan(build_pipeline(read_posts(spark, str(tmp_path / "in")), bundled))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text
    assert "EqualTo(language,en)" in text and "IsNotNull(rowkey)" in text


@pytest.mark.parametrize("fixed", [False, True])
def test_join_path_gives_the_same_result(bundled, by_join, posts, fixed):
    df = posts(*TEXTS)
    assert rows(build_pipeline(df, by_join, fixed=fixed)) == rows(build_pipeline(df, bundled, fixed=fixed))


def test_copies_and_repeated_keys_keep_their_rows(spark, bundled, by_join, posts):
    df = posts(*TEXTS[:2])
    many = df.union(df).union(df.withColumn("rowkey", F.lit("000")))
    assert build_pipeline(many, by_join).count() == 6
    assert rows(build_pipeline(many, by_join)) == rows(build_pipeline(many, bundled))


def test_stream_equals_batch(spark, bundled, posts, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    posts(*TEXTS).repartition(3).write.parquet(path)
    batch = build_pipeline(read_posts(spark, path), bundled)
    for _ in range(2):  # a second run finds nothing new
        run_stream(stream_posts(spark, path, max_files=1), out, bundled, str(tmp_path / "cp")).awaitTermination()
        assert rows(read_sentiment(spark, out)) == rows(batch)


def test_stream_with_large_tables_equals_batch(spark, by_join, bundled, posts, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    posts(*TEXTS[:3]).coalesce(1).write.parquet(path)
    run_stream(stream_posts(spark, path), out, by_join, str(tmp_path / "cp")).awaitTermination()
    assert rows(read_sentiment(spark, out)) == rows(build_pipeline(read_posts(spark, path), bundled))


def made(spark, *r):
    return spark.createDataFrame(r, "rowkey string, sentiment int")


def test_sink_keeps_keys_that_a_write_does_not_hold(spark, tmp_path):
    out = str(tmp_path / "out")
    assert rows(read_sentiment(spark, out)) == []
    write_sentiment(made(spark, ("a", 1), ("b", -1)), out)
    write_sentiment(made(spark, ("c", 1)), out)
    write_sentiment(made(spark, ("a", -1)), out)
    assert rows(read_sentiment(spark, out)) == [("a", -1), ("b", -1), ("c", 1)]


def test_sink_repeats_are_safe_and_compaction_is_followed(spark, tmp_path):
    out = str(tmp_path / "out")
    write_sentiment(made(spark, ("a", 1), ("b", -1)), out, "s", 0)
    for _ in range(2):
        write_sentiment(made(spark, ("a", -1), ("a", 0), ("c", 1)), out, "s", 1)
    write_sentiment(made(spark, ("d", 1)), out, "t", 1)
    want = [("a", 0), ("b", -1), ("c", 1), ("d", 1)]
    assert rows(read_sentiment(spark, out)) == want
    before = read_sentiment(spark, out)
    for _ in range(2):
        compact_sentiment(spark, out)
        assert rows(read_sentiment(spark, out)) == want == rows(before)
    write_sentiment(made(spark, ("b", 0)), out, "s", 2)
    assert rows(read_sentiment(spark, out)) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    compact_sentiment(spark, out)
    assert rows(read_sentiment(spark, out)) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]


def test_sink_order_inside_a_write(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1, 1), ("a", -1, 2), ("b", -1, 1), ("b", 1, 2)], "rowkey string, sentiment int, ts int")
    write_sentiment(df, out, order=F.col("ts"))
    assert rows(read_sentiment(spark, out)) == [("a", -1), ("b", 1)]
    with pytest.raises(ValueError):
        write_sentiment(df, out, batch_id=3)


def test_routing(spark, posts):
    mixed = posts("a").union(posts("b", language="es")).union(posts("c", language=None)).union(posts(None))
    assert routing.drop_null_posts(mixed).count() == 3
    assert routing.count_null_posts(mixed).first().null_content == 1
    assert rows(routing.unrouted(mixed).select("content")) == [("b",), ("c",)]


def test_row_keys(spark):
    df = spark.createDataFrame([("k_s_1",), ("none",)], "k string").select(
        "k", rowkey.salt_key(F.col("k")).alias("salted")
    )
    for k, salted, back, source in df.select(
        "*", rowkey.original_key(F.col("salted")), rowkey.key_source(F.col("k"))
    ).collect():
        assert back == k and 0 <= int(salted[:2]) < 32
        assert source == (k.split("_") + [None])[1]


def test_round_robin_in_pieces(spark):
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, id % 7, -1) as g", "cast(id div 2 as int) as o", "concat('k', lpad(id, 5, '0')) as k"
    )
    got = rowkey.salt_round_robin(df.repartition(5), "k", "g", "o").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.o, r.k, int(r.salted_key[:2])))
    assert len(got) == 3000
    for g in groups.values():
        assert [x[2] for x in sorted(g)] == [i % 32 for i in range(len(g))]


def test_posts_are_not_moved(spark, bundled, posts, tmp_path):
    posts(*TEXTS).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert "Exchange" not in plan(build_pipeline(read_posts(spark, str(tmp_path / "one")), bundled))


def test_a_table_over_the_bound_is_an_error(spark, posts):
    small = Resources(spark, max_rows=3)
    with pytest.raises(ValueError, match="lookup='join'"):
        build_pipeline(posts("a"), small)
    with pytest.raises(ValueError):
        Resources(spark, lookup="guess").words


def test_jobs_use_every_setting(spark, posts, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    posts(*TEXTS[:3]).union(posts("x", language="es")).write.json(source)
    config = EngineConfig(input_path=source, input_format="json", output_path=out, lookup="join", fixed=True)
    run_batch(spark, config)
    want = rows(build_pipeline(posts(*TEXTS[:3]), Resources(spark), fixed=True).select("rowkey", "sentiment"))
    assert rows(read_sentiment(spark, out)) == want

    archive, streamed = str(tmp_path / "done"), str(tmp_path / "streamed")
    config = EngineConfig(
        input_path=source, input_format="json", output_path=streamed, max_files_per_trigger=1, after_read="archive", archive_path=archive
    )
    run_stream_job(spark, config).awaitTermination()
    compat = rows(build_pipeline(posts(*TEXTS[:3]), Resources(spark)))
    assert rows(read_sentiment(spark, streamed)) == compat
    # A file is archived after the batch that follows its own has been planned.
    posts("late post").withColumn("rowkey", F.lit("late")).write.mode("append").json(source)
    run_stream_job(spark, config).awaitTermination()
    assert [p for p in (tmp_path / "done").rglob("*.json")]
    assert rows(read_sentiment(spark, streamed)) == sorted([*compat, ("late", 0)])
    for missing in ("input_path", "output_path"):
        with pytest.raises(ValueError, match=missing):
            run_batch(spark, EngineConfig(**{"input_path": source, "output_path": out, missing: ""}))


def test_config(spark):
    text = "# buffers\ninput_path=/in\noutput_path = /out\nfixed=true\nmax_files_per_trigger=5\nother=1\n"
    config = EngineConfig.from_properties(text)
    assert (config.input_path, config.output_path, config.fixed, config.max_files_per_trigger) == ("/in", "/out", True, 5)
    spark.conf.set("spark.tidemark.language", "es")
    assert EngineConfig.from_session(spark).language == "es"
    spark.conf.unset("spark.tidemark.language")


@pytest.mark.parametrize("unit", ["Re nt ou the dog runs . ", "x 5 dollars "])
def test_a_long_post_costs_in_proportion(bundled, posts, unit):
    def seconds(words):
        df = posts(unit * (words // len(unit.split())))
        start = time.perf_counter()
        build_pipeline(df, bundled).collect()
        return time.perf_counter() - start

    seconds(100)
    assert seconds(96_000) <= 5 * seconds(24_000) + 1
