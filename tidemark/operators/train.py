"""Model estimation: the tables the taggers read, counted from labelled data.

Both are plain counts, pre-aggregated on the map side, so one frequent word or
one large class does not load a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import jvm
from tidemark.functions.text import rows_of
from tidemark.operators.tagger import VALUES
from tidemark.sources.resources import Model


# Stands in the feature column for the class itself; no token is empty.
CLASS = ""
_EXAMPLES = "array<struct<cat:string,feats:array<string>,border:boolean>>"


def _model(examples: DataFrame, lists: DataFrame | None = None) -> Model:
    """Model from rows ``(cat, feats)``, one per labelled thing.

    The examples sit behind the whole text pipeline, so one aggregate counts
    both the classes and the features; a thing without a class is no example. ``own`` marks the classes' own rows: as
    it is an aggregate, no filter on it moves below the exchange, and the plan
    reuses one exchange for all that is taken from the counts.
    """
    feats = F.concat(F.array(F.lit(CLASS)), F.col("feats"))
    counts = (
        rows_of(examples.filter("cat is not null"), feats, "i", "feat", "cat")
        .groupBy("feat", "cat")
        .agg(F.count("*").alias("n"), F.max(F.col("feat") == CLASS).alias("own"))
    )
    sizes = counts.filter("own").select("cat", F.col("n").alias("size"))
    n_docs = sizes.agg(F.sum("size").alias("n_docs"))
    prior = sizes.select("cat", (F.col("size") / n_docs.select("n_docs").scalar()).alias("p"))
    # At most one counted row per class stands behind each feature here.
    freq = F.sum("n").over(Window.partitionBy("feat")).cast("int")
    cond = (
        counts.filter(~F.col("own"))
        .withColumn("freq", freq)
        .join(sizes, "cat")
        .select("feat", "cat", (F.col("n") / F.col("size")).alias("p"), "freq")
    )
    return Model(n_docs, prior, cond, lists)


def fit_nb(docs: DataFrame, lists: DataFrame | None = None) -> Model:
    """Naive-Bayes model from ``(cat, tokens)``: document counts per class."""
    words = F.filter(F.array_distinct("tokens"), lambda t: t != CLASS)
    return _model(docs.select("cat", words.alias("feats")), lists)


def pos_examples(tagged: Column) -> Column:
    """Per tagged word: its class and the context features around it."""
    return jvm.function("Examples", _EXAMPLES, VALUES)(tagged)


def fit_pos(tagged: DataFrame) -> Model:
    """POS model from rows with a ``tagged`` array."""
    examples = rows_of(tagged, pos_examples(F.col("tagged")), "i", "x")
    return _model(examples.select("x.cat", "x.feats"))
