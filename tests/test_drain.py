"""A stream that fails between the two outputs of a batch, and goes on."""

import os
import subprocess
import sys

import pytest
from pyspark.errors import StreamingQueryException

from tidemark import EngineConfig
from tidemark.config import package_zip
from tidemark.jobs import run_batch, run_stream_job
from tidemark.sources.posts import read_posts, read_unrouted, write_unrouted
from tidemark.sources.sink import read_sentiment
from tidemark.streaming.stream import OBSERVED

POSTS = "rowkey string, content string, language string"
ROWS = [
    ("a", "This is good :)", "en"),
    ("b", "Not good , I hate it :-(", "en"),
    ("c", "nada", "es"),
    ("d", None, "en"),
    (None, "no key", "en"),
    ("e", None, None),
    ("f", "Very good :)", "en"),
]
WANT = [("a", 1), ("b", -1), ("f", 1)]
COUNTS = {"posts": 7, "unrouted": 2, "other": 0, "null_rowkey": 1, "null_content": 1, "scored": 3}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("after", ["archive", "delete"])
def test_a_failed_batch_is_read_again(spark, tmp_path, after):
    source, out, rest = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rest")
    for i, row in enumerate(ROWS):
        spark.createDataFrame([row], POSTS).coalesce(1).write.mode("append").parquet(str(source))
    config = EngineConfig(
        input_path=str(source), output_path=out, unrouted_path=rest, after_read=after, max_files_per_trigger=3,
        archive_path=str(tmp_path / "done") if after == "archive" else "",
    )
    failed = []

    def once(batch_id):
        if batch_id == 1 and not failed:
            failed.append(len(read_unrouted(spark, rest).collect()))
            raise RuntimeError("on purpose")

    with pytest.raises(StreamingQueryException, match="on purpose"):
        run_stream_job(spark, config, before_publish=once).awaitTermination()
    assert failed and len(rows(read_sentiment(spark, out))) < 3
    job = run_stream_job(spark, config, before_publish=once)
    job.awaitTermination()
    assert rows(read_sentiment(spark, out)) == WANT
    assert rows(read_unrouted(spark, rest)) == sorted([ROWS[2], ROWS[5]], key=repr)
    assert all(set(p.observedMetrics[OBSERVED].asDict()) == set(COUNTS) for p in job.recentProgress if p.numInputRows)
    left, done = [len(list(p.rglob("*.parquet"))) for p in (source, tmp_path / "done")]
    # The files of the last batch stay until another one is planned.
    assert left < len(ROWS) and done == (len(ROWS) - left if after == "archive" else 0)


def test_a_job_returns_its_counts(spark, tmp_path):
    source, rest = str(tmp_path / "in"), str(tmp_path / "rest")
    spark.createDataFrame(ROWS, POSTS).repartition(3).write.parquet(source)
    config = EngineConfig(input_path=source, output_path=str(tmp_path / "out"), unrouted_path=rest)
    assert run_batch(spark, config) == COUNTS
    assert rows(read_sentiment(spark, config.output_path)) == WANT
    assert rows(read_unrouted(spark, rest)) == sorted([ROWS[2], ROWS[5]], key=repr)
    spark.createDataFrame([], POSTS).write.parquet(str(tmp_path / "none"))
    empty = EngineConfig(input_path=str(tmp_path / "none"), output_path=str(tmp_path / "out2"), lookup="join")
    assert run_batch(spark, empty) == dict.fromkeys(COUNTS, 0)
    assert rows(read_unrouted(spark, str(tmp_path / "nowhere"))) == []


def test_a_repeated_batch_overwrites_its_unrouted_posts(spark, tmp_path):
    path = str(tmp_path / "rest")
    some = spark.createDataFrame(ROWS[:2], POSTS)
    for _ in range(2):
        write_unrouted(some, path, "w", 0)
    write_unrouted(some.limit(1), path, "v", 0)
    assert read_unrouted(spark, path).count() == 3


def test_rows_that_do_not_parse_come_out_unrouted(spark, tmp_path):
    """As raw text, from the batch job and from the stream."""
    good = ['{"rowkey": "a", "content": "This is good :)", "language": "en"}', '{"rowkey": "c", "content": "nada", "language": "es"}']
    bad = ['{"rowkey": "b", "content": "cut', "no json at all"]
    source = tmp_path / "in"
    source.mkdir()
    (source / "posts.json").write_text("\n".join([good[0], *bad, good[1]]))
    want = sorted([("c", "nada", "es"), *[(None, line, None) for line in bad]], key=repr)
    batch = EngineConfig(input_path=str(source), input_format="json", output_path=str(tmp_path / "o1"), unrouted_path=str(tmp_path / "r1"))
    assert run_batch(spark, batch) == {"posts": 4, "unrouted": 3, "other": 0, "null_rowkey": 0, "null_content": 0, "scored": 1}
    stream = EngineConfig(input_path=str(source), input_format="json", output_path=str(tmp_path / "o2"), unrouted_path=str(tmp_path / "r2"))
    run_stream_job(spark, stream).awaitTermination()
    for config in (batch, stream):
        assert rows(read_unrouted(spark, config.unrouted_path)) == want
        assert rows(read_sentiment(spark, config.output_path)) == [("a", 1)]
    (tmp_path / "posts.csv").write_text("a,fine,en\nonly one field\nb,fine,en,and,more\n")
    assert rows(read_posts(spark, str(tmp_path / "posts.csv"), "csv")) == sorted(
        [("a", "fine", "en"), (None, "only one field", None), (None, "b,fine,en,and,more", None)], key=repr
    )


def test_the_package_runs_from_its_zip(tmp_path):
    """A worker that has only the zip can import what the jobs send by name."""
    path = package_zip(str(tmp_path))
    code = f"import sys; sys.path[:] = [p for p in sys.path if p and 'repo' not in p]; sys.path.insert(0, {path!r}); import tidemark.operators.tagger as t; print(t.__file__)"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, check=True)
    assert path in found.stdout


def test_joined_tables_with_both_outputs(spark, tmp_path):
    """Tables that are joined in a stream: one read of a batch, two outputs, counts once."""
    source = str(tmp_path / "in")
    spark.createDataFrame(ROWS, POSTS).coalesce(1).write.parquet(source)
    config = EngineConfig(input_path=source, output_path=str(tmp_path / "out"), unrouted_path=str(tmp_path / "rest"), lookup="join")
    job = run_stream_job(spark, config)
    job.awaitTermination()
    assert rows(read_sentiment(spark, config.output_path)) == WANT
    assert rows(read_unrouted(spark, config.unrouted_path)) == sorted([ROWS[2], ROWS[5]], key=repr)
    assert [p.observedMetrics[OBSERVED].asDict() for p in job.recentProgress if p.numInputRows] == [COUNTS]
    assert not list((tmp_path / "out").rglob("staged"))
