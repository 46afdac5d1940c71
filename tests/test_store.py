"""The keyed store under many writers, many batches and reads of few keys."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rowkey
from tidemark.sources import sink
from tidemark.sources.sink import Log, compact_sentiment, read_log, read_sentiment, write_sentiment


def made(spark, *r):
    return spark.createDataFrame(r, "rowkey string, sentiment int")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("first, second", [(1, -1), (-1, 1)])
def test_the_later_publisher_wins(spark, tmp_path, monkeypatch, first, second):
    """Both writers have read the log and written their rows before either publishes."""
    out, publish = str(tmp_path / "out"), Log.publish
    write_sentiment(made(spark, ("a", 0)), out)

    def late(self, line):
        # This writer knows the log as it was; another one takes the number that it would take.
        before, seen = Log.live(self), []
        monkeypatch.setattr(Log, "publish", publish)
        write_sentiment(made(spark, ("a", first)), out)
        monkeypatch.setattr(Log, "live", lambda s: before if not seen and not seen.append(1) else live(s))
        return publish(self, line)

    live = Log.live
    monkeypatch.setattr(Log, "publish", late)
    assert write_sentiment(made(spark, ("a", second)), out) == 3
    monkeypatch.setattr(Log, "live", live)
    assert rows(read_sentiment(spark, out)) == [("a", second)]
    assert rows(read_log(spark, out)) == sorted([("a", 0, 1), ("a", first, 2), ("a", second, 3)])


def test_numbers_of_many_writers_differ(spark, tmp_path):
    out = str(tmp_path / "out")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: write_sentiment(made(spark, ("k", i % 3 - 1), (f"k{i}", 1)), out), range(16)))
    assert sorted(numbers) == list(range(1, 17))
    last = numbers.index(16) % 3 - 1
    assert rows(read_sentiment(spark, out)) == sorted([("k", last), *[(f"k{i}", 1) for i in range(16)]])


def test_a_line_is_taken_once(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: log._create("log/1", f"line {i}" * 100), range(64)))
    assert sum(won) == 1
    assert log._text("log/1") == f"line {won.index(True)}" * 100
    assert not list((tmp_path / "drafts").glob("[0-9a-f]*"))


def test_cost_of_a_write_stays_flat(spark, tmp_path):
    """After 1,000 published batches a write or read opens a summary and fewer lines than lie between two."""
    out = str(tmp_path / "out")
    write_sentiment(made(spark, ("a", 1)), out)
    log = Log(spark, out)
    for i in range(1000):
        log.publish({"writer": "w", "batch_id": i % 7, "folder": f"data/{i:032x}", "replaces": [], "salted": False})
    for reader in range(3):
        log = Log(spark, out)
        lines, last = log.live()
        assert last == 1001 + reader and len(lines) == 8 + reader
        assert log.files_read <= sink.SUMMARY_EVERY
        log.publish({"writer": f"x{reader}", "batch_id": 0, "folder": f"data/x{reader}", "replaces": [], "salted": False})
        assert log.files_read <= 2 * sink.SUMMARY_EVERY
    assert len(log._summaries()) == sink.SUMMARIES_KEPT


def test_summaries_do_not_change_what_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "SUMMARY_EVERY", 2)
    out, want = str(tmp_path / "out"), {}
    for i in range(9):
        write_sentiment(made(spark, (f"k{i % 4}", i % 3 - 1), ("all", i % 3 - 1)), out, "s", i)
        want |= {f"k{i % 4}": i % 3 - 1, "all": i % 3 - 1}
        if i == 5:
            compact_sentiment(spark, out)
        assert rows(read_sentiment(spark, out)) == sorted(want.items())
    write_sentiment(made(spark, ("k0", -1), ("all", -1)), out, "s", 8)
    assert rows(read_sentiment(spark, out)) == sorted((want | {"k0": -1, "all": -1}).items())


def test_a_write_during_a_compaction_comes_after_it(spark, tmp_path, monkeypatch):
    out, publish = str(tmp_path / "out"), Log.publish
    write_sentiment(made(spark, ("a", 1), ("b", 1)), out)
    write_sentiment(made(spark, ("a", 0)), out)

    def late(self, line):
        monkeypatch.setattr(Log, "publish", publish)
        write_sentiment(made(spark, ("a", -1)), out)
        return publish(self, line)

    monkeypatch.setattr(Log, "publish", late)
    compact_sentiment(spark, out)
    assert rows(read_log(spark, out)) == [("a", -1, 3), ("a", 0, 2), ("b", 1, 1)]
    assert rows(read_sentiment(spark, out)) == [("a", -1), ("b", 1)]


def _scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan parquet" in line]


def test_a_read_of_few_keys_opens_their_buckets(spark, tmp_path):
    out = str(tmp_path / "out")
    many = spark.range(4000).select(F.concat(F.lit("key"), "id").alias("rowkey"), (F.col("id") % 3 - 1).cast("int").alias("sentiment"))
    write_sentiment(many, out, salted=True)
    write_sentiment(made(spark, ("key7", -1), ("key9", 1)), out)
    compact_sentiment(spark, out)
    [folder] = [e["folder"] for e in Log(spark, out).live()[0]]
    files = [p for p in (tmp_path / "out" / folder).rglob("*.parquet")]
    buckets = {p.parent.name for p in files}
    assert len(buckets) == rowkey.BUCKETS
    one = read_sentiment(spark, out, ["key7"])
    [scan] = _scans(one)
    assert "PartitionFilters: [" in scan and "bucket#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(one) == [("key7", -1)]
    opened = {r[0] for r in read_log_files(spark, out, ["key7"])}
    assert len(opened) <= max(sum(p.parent.name == b for p in files) for b in buckets)
    assert rows(read_sentiment(spark, out, ["key1", "key9", "none"])) == [("key1", 0), ("key9", 1)]
    write_sentiment(made(spark, ("key1", -1)), out)
    assert rows(read_sentiment(spark, out, ["key1", "key9"])) == [("key1", -1), ("key9", 1)]
    assert read_sentiment(spark, out).count() == 4000


def read_log_files(spark, out, keys):
    """The files that hold the bucket of ``keys``: what the scan's partition filter leaves."""
    [folder] = [e["folder"] for e in Log(spark, out).live()[0]]
    wanted = [sink._bucket(F.lit(k)) for k in keys]
    frame = spark.read.schema(sink.SALTED).parquet(f"{out}/{folder}").filter(F.col("bucket").isin(*wanted))
    return frame.select("_metadata.file_path").distinct().collect()
