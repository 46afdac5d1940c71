"""Settings: where posts come from, where results go, how the session is set."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PREFIX = "spark.tidemark."


@dataclass(frozen=True)
class EngineConfig:
    """Input and output buffers plus the pipeline's options.

    ``after_read`` is what a stream does with a file that it has read:
    ``archive`` (into ``archive_path``), ``delete``, or nothing.
    ``unrouted_path`` is where posts in unsupported languages go; without it
    they are counted only.

    Each field may come from ``spark.tidemark.<field>`` in the session or from
    a ``key=value`` properties file.
    """

    input_path: str = ""
    input_format: str = "parquet"
    output_path: str = ""
    resources: str = ""
    language: str = "en"
    fixed: bool = False
    lookup: str = "in_row"
    max_files_per_trigger: int = 1000
    checkpoint_path: str = ""
    after_read: str = ""
    archive_path: str = ""
    unrouted_path: str = ""

    @classmethod
    def _typed(cls, raw: dict[str, str]) -> EngineConfig:
        convert = {"bool": lambda v: v.strip().lower() == "true", "int": int, "str": str}
        known = {f.name: convert[f.type] for f in fields(cls)}
        return cls(**{k: known[k](v) for k, v in raw.items() if k in known})

    @classmethod
    def from_session(cls, spark: SparkSession) -> EngineConfig:
        raw = {f.name: spark.conf.get(PREFIX + f.name, None) for f in fields(cls)}
        return cls._typed({k: v for k, v in raw.items() if v is not None})

    @classmethod
    def from_properties(cls, text: str) -> EngineConfig:
        lines = (line.strip() for line in text.splitlines())
        pairs = (line.split("=", 1) for line in lines if "=" in line and not line.startswith("#"))
        return cls._typed({k.strip(): v.strip() for k, v in pairs})


def package_zip(folder: str) -> str:
    """This package as a zip file in ``folder``, for the workers of a cluster."""
    root = Path(__file__).resolve().parent
    return shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, which run its functions by name.

    A session that was made elsewhere needs this once, unless the package is
    installed on every machine. Spark itself hands the file to the workers.
    """
    spark.sparkContext.addPyFile(package_zip(tempfile.mkdtemp()))


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the pipeline relies on; ``conf`` overrides.

    On a cluster the package is sent to the workers.
    """
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        # The stage expressions are large; tracing each Python call site doubles their cost.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share, for tables between jobs.

    It is the one the session names in ``spark.checkpoint.dir``. Where none is
    named, a local session uses its warehouse; any other has to name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir"))
    return context.getCheckpointDir()


#: Partitions for each core. The work of a post follows its length, so a core
#: takes several shares, and one with long posts does not hold up the others.
SHARES = 4


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt evenly to all cores, however its files are cut.

    Worth one shuffle of the raw rows ahead of the stages, which take far longer.
    """
    return df.repartition(SHARES * df.sparkSession.sparkContext.defaultParallelism)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once as a table of the shared folder, and read back.

    Later steps read the table, so a lost executor costs its own tasks only.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
