"""Post sources, batch and streaming."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import POST


#: Formats whose rows may fail to parse, one by one.
PARSED = ("json", "csv")
_CORRUPT = "_corrupt_record"


def _schema(format: str) -> T.StructType:
    return T.StructType([*POST.fields, T.StructField(_CORRUPT, T.StringType())]) if format in PARSED else POST


def _with_corrupt(posts: DataFrame, format: str) -> DataFrame:
    """Posts of a parsed format: a row that does not parse is a post without key and language, its content the raw text."""
    if format not in PARSED:
        return posts
    broken = F.col(_CORRUPT).isNotNull()
    return posts.select(
        F.when(~broken, F.col("rowkey")).alias("rowkey"),
        F.when(broken, F.col(_CORRUPT)).otherwise(F.col("content")).alias("content"),
        F.when(~broken, F.col("language")).alias("language"),
    )


def read_posts(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """All posts under ``path``; the schema is given, never inferred.

    A row of a text format that does not parse is kept: it has no key and no
    language, and its content is the raw text, so it comes out with the posts
    that no pipeline takes. Spark cuts the files into splits of ``spark.sql.files.maxPartitionBytes``;
    that setting, not a shuffle, is what spreads the work.
    """
    found = spark.read.format(format).schema(_schema(format)).options(columnNameOfCorruptRecord=_CORRUPT, **options).load(path)
    return _with_corrupt(found, format)


def stream_posts(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    max_files: int = 1000,
    after: str | None = None,
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """Posts as they arrive, each file read once.

    ``after`` is what happens to a consumed file: ``archive`` (into the folder
    ``archive``) or ``delete``. The checkpoint, not the deletion, is what makes
    a file count once, so a failed batch is read again rather than lost. Rows
    that do not parse come as :func:`read_posts` tells.
    """
    reader = (
        spark.readStream.format(format)
        .schema(_schema(format))
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
    )
    if after is not None:
        reader = reader.option("cleanSource", after)
    if archive is not None:
        reader = reader.option("sourceArchiveDir", archive)
    return _with_corrupt(reader.load(path), format)


def write_unrouted(posts: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Posts that no pipeline took, in a folder of their own for each writer and batch.

    A batch that is repeated overwrites its folder, so it counts once.
    """
    name = f"{hashlib.sha256(writer.encode()).hexdigest()[:16]}-{batch_id}"
    posts.select(*POST.names).write.mode("overwrite").parquet(f"{path}/{name}")


def read_unrouted(spark: SparkSession, path: str) -> DataFrame:
    """All posts that :func:`write_unrouted` has put under ``path``."""
    try:
        return spark.read.schema(POST).parquet(f"{path}/*-*")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], POST)
