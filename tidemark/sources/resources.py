"""Loaders for the text resources: lookup tables, lexicon and models.

Each loader takes any path Spark reads and returns typed DataFrames; lines
that do not fit the format are kept apart, not guessed at. Where a key is
listed twice, the last line counts, in whatever splits the file is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "﻿"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, at)``: ``at`` orders lines by file, split and place in the split."""
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.text(path).select(
        F.trim(F.regexp_replace("value", f"^{BOM}", "")).alias("line"), at.alias("at")
    )


def _last(rows: DataFrame, *keys: str) -> DataFrame:
    """The last row of each key, by ``at``; lines are combined before the shuffle."""
    values = [c for c in rows.columns if c not in (*keys, "at")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "at").alias("v"))
    return last.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def _fields(line: Column, regex: str = "\\s+") -> Column:
    return F.split(line, regex, -1)


def load_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """``(abbr, expansion)`` for the lines that hold a dot."""
    parts = _fields(F.col("line"))
    rows = (
        _lines(spark, path)
        .filter(F.contains("line", F.lit(".")))
        .select(F.get(parts, F.lit(0)).alias("abbr"), F.get(parts, F.lit(1)).alias("expansion"), "at")
    )
    return _last(rows, "abbr")


def load_ambiguous(spark: SparkSession, path: str) -> DataFrame:
    """``(word)``: words that may be a name or a common word."""
    return _lines(spark, path).select(F.col("line").alias("word")).filter("word != ''").distinct()


# Tag patterns of the dictionary flags (fixed values).
STOP_TAG = "^(P|SP|R|D|I|C)"
PROPER_TAG = "^NP"


def with_flags(dictionary: DataFrame) -> DataFrame:
    """``(form, analyses)`` -> plus ``is_stop`` and ``is_noamb``."""
    tag = lambda a: F.coalesce(a["tag"].rlike(STOP_TAG), F.lit(False))
    return dictionary.select(
        "form",
        "analyses",
        F.exists("analyses", tag).alias("is_stop"),
        F.coalesce(F.get("analyses", F.lit(0))["tag"].rlike(PROPER_TAG), F.lit(False)).alias("is_noamb"),
    )


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``form lemma tag [lemma tag ...]`` -> ``(form, analyses, is_stop, is_noamb)``."""
    parts = _fields(F.col("line"))
    pairs = F.transform(
        F.sequence(F.lit(1), ((F.size(parts) - 1) / 2).cast("int")),
        lambda k: F.struct(
            F.get(parts, 2 * k - 1).alias("lemma"), F.get(parts, 2 * k).alias("tag")
        ),
    )
    rows = (
        _lines(spark, path)
        .filter(F.size(parts) >= 3)
        .select(F.get(parts, F.lit(0)).alias("form"), pairs.alias("analyses"), "at")
    )
    return with_flags(_last(rows, "form"))


def _load_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lines = _lines(spark, path)
    line = F.col("line")
    plain = lines.filter(~line.startswith("<") & (line != ""))
    parts = _fields(line)
    n_docs = lines.filter(line.startswith("<number_of_docs>")).select(
        F.regexp_extract(line, "<number_of_docs>([0-9]*)<", 1).cast("long").alias("n_docs")
    )
    head = F.split(F.regexp_extract(line, "<cat>([^<]*)", 1), "\\s+")
    prior = lines.filter(line.startswith("<cat>")).select(
        F.get(head, F.lit(0)).alias("cat"), F.get(head, F.lit(1)).cast("double").alias("p"), "at"
    )
    listed = F.split(F.regexp_extract(line, "<list>([^<]*)", 1), "\\s+")
    lists = lines.filter(line.startswith("<list>")).select(
        F.get(listed, F.lit(0)).alias("name"),
        F.explode(F.split(F.get(listed, F.lit(1)), "\\|")).alias("word"),
    )
    cond = plain.filter(F.size(parts) >= 4).select(
        F.get(parts, F.lit(0)).alias("feat"),
        F.get(parts, F.lit(1)).alias("cat"),
        F.get(parts, F.lit(2)).cast("double").alias("p"),
        F.get(parts, F.lit(3)).cast("int").alias("freq"),
        "at",
    )
    return n_docs, _last(prior, "cat"), _last(cond, "feat", "cat"), lists


class Model:
    """A Naive-Bayes model: scalar size, class priors, conditionals, lists."""

    def __init__(
        self, n_docs: DataFrame, prior: DataFrame, cond: DataFrame, lists: DataFrame | None = None
    ):
        self.n_docs, self.prior, self.cond, self.lists = n_docs, prior, cond, lists


def load_pos_model(spark: SparkSession, path: str) -> Model:
    n_docs, prior, cond, _ = _load_model(spark, path)
    return Model(n_docs, prior, cond)


def load_nb_model(spark: SparkSession, path: str) -> Model:
    return Model(*_load_model(spark, path))


def _lexicon_fields(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).withColumn("parts", F.split("line", "\t+"))


def load_polarity_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(word, cat)`` rows as listed, both fields trimmed."""
    return (
        _lexicon_fields(spark, path)
        .filter(F.size("parts") >= 2)
        .select(
            F.trim(F.get("parts", F.lit(0))).alias("word"),
            F.trim(F.get("parts", F.lit(1))).alias("cat"),
        )
    )


def lexicon_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon lines without a word and a category."""
    return _lexicon_fields(spark, path).filter((F.size("parts") < 2) & (F.col("line") != "")).select("line")


def model_lines(model: Model) -> DataFrame:
    """A model back in its text format, one ``line`` per row, header first."""
    n = model.n_docs.select(
        F.lit(0).alias("part"), F.concat(F.lit("<number_of_docs>"), "n_docs", F.lit("</number_of_docs>")).alias("line")
    )
    cats = model.prior.select(
        F.lit(1).alias("part"), F.concat(F.lit("<cat>"), "cat", F.lit(" "), F.col("p").cast("string"), F.lit("</cat>")).alias("line")
    )
    rows = model.cond.select(
        F.lit(3).alias("part"), F.concat_ws(" ", "feat", "cat", F.col("p").cast("string"), F.col("freq").cast("string")).alias("line")
    )
    out = n.union(cats)
    if model.lists is not None:
        words = model.lists.groupBy("name").agg(F.array_sort(F.collect_list("word")).alias("words"))
        out = out.union(
            words.select(
                F.lit(2),
                F.concat(F.lit("<list>"), "name", F.lit(" "), F.array_join("words", "|"), F.lit("</list>")),
            )
        )
    return out.union(rows)
