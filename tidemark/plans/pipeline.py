"""The whole annotation pipeline as one DataFrame.

With lookups in the row the plan is scan -> project: no exchange,
no key, so neither hot keys nor copies matter, and a lost task only repeats
its own split. The same plan works on a streaming DataFrame.
"""

from __future__ import annotations

from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.lookup import Lookup
from tidemark.operators.ner import recognise, word_lookup
from tidemark.operators.normalize import normalize
from tidemark.operators.routing import drop_null_posts, is_unrouted, is_usable, route_language
from tidemark.operators.sentences import split_sentences
from tidemark.operators.sentiment import PolarityTables, classify
from tidemark.operators.tagger import PosTables, tag
from tidemark.operators.tokens import tokenize
from tidemark.sources import resources as res

BUNDLED = str(Path(__file__).resolve().parent.parent / "resources")


class Resources:
    """The lookup tables of one language, each loaded and published once.

    ``folder`` holds the text resources; the bundled ones are a small invented
    sample, for trying the pipeline out. ``lookup`` is ``in_row`` (no shuffle;
    tables within a bound) or ``join`` (tables of any size).
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str = BUNDLED,
        names: dict[str, str] | None = None,
        lookup: str = "in_row",
        **bounds,
    ):
        self.spark, self.folder, self.names, self.lookup = spark, folder, names or {}, lookup
        self.bounds = {"by": lookup, **bounds}

    def path(self, name: str) -> str:
        return self.names.get(name, f"{self.folder}/{name}.txt")

    @cached_property
    def abbreviations(self) -> Lookup:
        table = res.load_abbreviations(self.spark, self.path("abbreviations"))
        return Lookup(table, "abbr", F.col("expansion"), **self.bounds)

    @cached_property
    def dictionary(self) -> DataFrame:
        return res.load_dictionary(self.spark, self.path("dictionary"))

    @cached_property
    def ambiguous(self) -> DataFrame:
        return res.load_ambiguous(self.spark, self.path("ambiguous"))

    @cached_property
    def words(self) -> Lookup:
        return word_lookup(self.dictionary, self.ambiguous, **self.bounds)

    @cached_property
    def pos_model(self) -> res.Model:
        return res.load_pos_model(self.spark, self.path("pos_model"))

    @cached_property
    def pos(self) -> PosTables:
        return PosTables(self.pos_model, **self.bounds)

    @cached_property
    def lexicon(self) -> DataFrame:
        return res.load_polarity_lexicon(self.spark, self.path("polarity"))

    @cached_property
    def nb_model(self) -> res.Model:
        return res.load_nb_model(self.spark, self.path("polarity_model"))

    @cached_property
    def polarity(self) -> PolarityTables:
        return PolarityTables(self.lexicon, self.nb_model, **self.bounds)

    def publish(self) -> None:
        """Publish the tables ahead of their first use; with joins there are none."""
        if self.lookup == "in_row":
            for table in (self.words, self.pos.cond, self.pos.prior, self.polarity.scores, self.abbreviations):
                table.publish()


def text_stages(posts: DataFrame, resources: Resources | None = None, fixed: bool = False) -> DataFrame:
    """Sentences, normalised sentences and tokens."""
    abbreviations = resources.abbreviations if fixed and resources else None
    return tokenize(normalize(split_sentences(posts, abbreviations, fixed), fixed), fixed)


def annotate(posts: DataFrame, resources: Resources, fixed: bool = False) -> DataFrame:
    """All annotation columns, up to ``tagged``."""
    tokens = text_stages(posts, resources, fixed)
    return tag(recognise(tokens, resources.words, fixed), resources.pos, fixed)


def build_pipeline(
    posts: DataFrame, resources: Resources, language: str = "en", fixed: bool = False
) -> DataFrame:
    """``(rowkey, sentiment)`` for the usable posts of one language."""
    usable = drop_null_posts(route_language(posts, language))
    return classify(annotate(usable, resources, fixed), resources.polarity, fixed)


def score_all(
    posts: DataFrame, resources: Resources, language: str, fixed: bool, supported: tuple[str, ...]
) -> DataFrame:
    """``(rowkey, usable, unrouted, sentiment)``, one row per post, in one pass.

    What :func:`build_pipeline` would score is ``usable``; other posts pass
    through the stages as empty ones. ``unrouted`` holds the whole post where
    its language is not supported, null elsewhere.
    """
    whole = F.struct("rowkey", "content", "language")
    marked = posts.select(
        "rowkey",
        F.when(is_usable(language), F.col("content")).otherwise("").alias("content"),
        is_usable(language).alias("usable"),
        F.when(is_unrouted(supported), whole).alias("unrouted"),
    )
    return classify(annotate(marked, resources, fixed), resources.polarity, fixed, ("usable", "unrouted"))
