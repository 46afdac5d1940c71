"""The keyed result store: rowkey -> sentiment, the write that is published last wins.

A write adds one folder of rows and then publishes it as the next line of a
log. A line is a file named by its number, and it gets that name only if no
other has it, so every write has a number of its own, however many writers
there are, and numbers follow the order of publication. Readers take the log
first: they see a write whole or not at all, and no write touches what an
earlier one published. The newest number of a key gives its value.

Every so many lines the live ones are also written as one summary. Readers and
writers start from the newest summary and read the lines since, so what a write
costs does not grow with the writes before it. Compaction folds the live
folders into one, laid out by salt bucket, and publishes that in their place:
streams and readers just go on, and a read of few keys opens their buckets.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.rowkey import WIDTH, salt_key
from tidemark.schema import SENTIMENT

#: Rows of a folder. A compacted one holds rows of many writes and each row's own number.
LOGGED = T.StructType([*SENTIMENT.fields, T.StructField("seq", T.LongType())])
SALTED = T.StructType([*LOGGED.fields, T.StructField("bucket", T.StringType())])
#: Lines after which the live ones are summed up, and the summaries that stay.
SUMMARY_EVERY, SUMMARIES_KEPT = 32, 3


class Log:
    """The numbered lines of a store. They name folders, not rows, and are read by the driver.

    The file system has to move a file to a new name atomically and refuse a
    taken one, which a streaming checkpoint asks for as well.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path, self.files_read = spark._jvm, path, 0
        root = self._at("")
        self._files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _text(self, name: str) -> str | None:
        at = self._at(name)
        if not self._files.exists(at):
            return None
        self.files_read += 1
        stream = self._files.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """Whether ``name`` was free and now holds all of ``text``."""
        at, draft = self._at(name), self._at(f"drafts/{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        self._files.mkdirs(at.getParent())
        if self._files.getScheme() == "file":
            # A local rename replaces what is there; a hard link does not.
            try:
                os.link(draft.toUri().getPath(), at.toUri().getPath())
                return True
            except FileExistsError:
                return False
            finally:
                self._files.delete(draft, False)
        moved = not self._files.exists(at) and self._files.rename(draft, at)
        if not moved:
            self._files.delete(draft, False)
        return moved

    def _summaries(self) -> list[int]:
        at = self._at("summary")
        found = self._files.listStatus(at) if self._files.exists(at) else []
        return sorted(int(s.getPath().getName()) for s in found if s.getPath().getName().isdigit())

    def live(self) -> tuple[list[dict], int]:
        """The lines whose folders count, and the number of the last line.

        A writer that repeats a batch replaces its earlier line, and a
        compaction those that it folded.
        """
        last, lines = 0, []
        for number in reversed(self._summaries()):
            text = self._text(f"summary/{number}")
            if text is not None:
                last, lines = number, json.loads(text)
                break
        while (text := self._text(f"log/{last + 1}")) is not None:
            last, new = last + 1, json.loads(text)
            gone = set(new["replaces"])
            lines = [e for e in lines if e["folder"] not in gone and (e["writer"], e["batch_id"]) != (new["writer"], new["batch_id"])]
            lines.append(new | {"seq": last, "replaces": []})
        return lines, last

    def publish(self, line: dict) -> int:
        """Give ``line`` the next free number, and return that."""
        number = self.live()[1] + 1
        while not self._create(f"log/{number}", json.dumps(line)):
            number += 1
        if number % SUMMARY_EVERY == 0:
            self.summarise()
        return number

    def summarise(self) -> None:
        lines, last = self.live()
        self._create(f"summary/{last}", json.dumps(lines))
        for number in self._summaries()[:-SUMMARIES_KEPT]:
            self._files.delete(self._at(f"summary/{number}"), False)


def latest(logged: DataFrame, order: str = "seq") -> DataFrame:
    """One row per key, from its highest ``order``.

    The aggregate keeps one value per key on the map side, so a key written a
    billion times reaches its reducer once per task. Of two values with equal
    order the larger one is taken, on every run alike; ``seq`` has no such two
    for one key.
    """
    return logged.groupBy("rowkey").agg(
        F.max(F.struct(order, "sentiment"))["sentiment"].alias("sentiment")
    )


def _bucket(key: Column) -> Column:
    return F.substring(salt_key(key), 1, WIDTH)


def _publish(log: Log, rows: DataFrame, writer: str, batch_id: int, replaces: list[str], salted: bool) -> int:
    folder = f"data/{uuid.uuid4().hex}"
    if salted:
        # A large bucket becomes several files, small ones share a task.
        dealt = rows.withColumn("bucket", _bucket(F.col("rowkey"))).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{log.path}/{folder}")
    else:
        rows.write.parquet(f"{log.path}/{folder}")
    return log.publish({"writer": writer, "batch_id": batch_id, "folder": folder, "replaces": replaces, "salted": salted})


def write_sentiment(
    df: DataFrame,
    path: str,
    writer: str | None = None,
    batch_id: int | None = None,
    order: Column | None = None,
    salted: bool = False,
) -> int:
    """Upsert the rows of ``df``; keys that it does not hold stay as they are. Returns the write's number.

    A write with a ``writer`` and ``batch_id`` replaces the same writer's
    earlier try of that batch; a write without is a job of its own. ``order``
    tells which of two rows of a key in ``df`` came last; rows that it does not
    tell apart, and all rows without it, have no order, and the larger
    sentiment is taken. Of jobs that write at the same time the one that
    publishes later wins. ``salted`` lays the rows out by salt bucket, for
    large writes; small ones are laid out when they are compacted.
    """
    if (writer is None) != (batch_id is None):
        raise ValueError("give writer and batch_id together")
    rows = df.select(
        "rowkey", F.col("sentiment").cast("int"), (F.lit(0) if order is None else order).alias("place")
    )
    final = latest(rows, "place").withColumn("seq", F.lit(None).cast("long"))
    return _publish(Log(df.sparkSession, path), final, writer or uuid.uuid4().hex, batch_id or 0, [], salted)


def _rows(spark: SparkSession, path: str, lines: list[dict], keys: list[str] | None) -> DataFrame:
    """The rows of the folders that ``lines`` name, each with the number of its write."""
    out = spark.createDataFrame([], LOGGED)
    if not lines:
        return out
    numbers = spark.createDataFrame([(e["folder"], e["seq"]) for e in lines], "_folder string, _seq bigint")
    for salted in (False, True):
        folders = [f"{path}/{e['folder']}" for e in lines if e["salted"] == salted]
        if not folders:
            continue
        rows = spark.read.schema(SALTED if salted else LOGGED).parquet(*folders)
        if keys is not None:
            rows = rows.filter(F.col("rowkey").isin(*keys))
            if salted:
                rows = rows.filter(F.col("bucket").isin(*[_bucket(F.lit(k)) for k in keys]))
        folder = F.regexp_extract("_metadata.file_path", "/(data/[0-9a-f]{32})/", 1)
        numbered = rows.select(*LOGGED.names, folder.alias("_folder")).join(numbers, "_folder")
        out = out.union(numbered.select("rowkey", "sentiment", F.coalesce("seq", "_seq")))
    return out


def read_log(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """Every row of the live folders, with the ``seq`` of the write it came by."""
    return _rows(spark, path, Log(spark, path).live()[0], keys)


def read_sentiment(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """One row per key; of ``keys`` only, where they are given.

    Where ``keys`` are given, folders laid out by bucket are read in the
    buckets of those keys alone.
    """
    return latest(read_log(spark, path, keys))


def compact_sentiment(spark: SparkSession, path: str) -> None:
    """Fold all that is published now into one folder, in their place.

    Rows keep the ``seq`` of their write, so a write that is published
    meanwhile, or by a stream later on, still comes after them. The folders
    stay for readers that have already taken the log.
    """
    log = Log(spark, path)
    lines, _ = log.live()
    if len(lines) < 2 and all(e["salted"] for e in lines):
        return
    newest = _rows(spark, path, lines, None).groupBy("rowkey").agg(F.max(F.struct("seq", "sentiment")).alias("n"))
    rows = newest.select("rowkey", "n.sentiment", "n.seq")
    _publish(log, rows, f"compaction-{uuid.uuid4().hex}", 0, [e["folder"] for e in lines], True)
    log.summarise()
