"""Language routing and the filter for unusable posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPORTED = ("en",)


def drop_null_posts(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("rowkey").isNotNull() & F.col("content").isNotNull())


def count_null_posts(posts: DataFrame) -> DataFrame:
    """How many posts :func:`drop_null_posts` removes, by reason."""
    return posts.agg(
        F.count_if(F.col("rowkey").isNull()).alias("null_rowkey"),
        F.count_if(F.col("rowkey").isNotNull() & F.col("content").isNull()).alias("null_content"),
    )


def route_language(posts: DataFrame, language: str = "en") -> DataFrame:
    return posts.filter(F.col("language") == language)


def unrouted(posts: DataFrame, supported: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """Posts no pipeline takes, those without a language included."""
    return posts.filter(is_unrouted(supported))


def is_unrouted(supported: tuple[str, ...] = SUPPORTED) -> Column:
    return ~F.coalesce(F.col("language").isin(*supported), F.lit(False))


def is_usable(language: str = "en") -> Column:
    """Whether :func:`route_language` and :func:`drop_null_posts` both let a post pass."""
    routed = F.coalesce(F.col("language") == language, F.lit(False))
    return routed & F.col("rowkey").isNotNull() & F.col("content").isNotNull()


def counts(language: str = "en", supported: tuple[str, ...] = SUPPORTED) -> list[Column]:
    """What becomes of the posts of a job, to be observed as they pass.

    ``unrouted`` posts have a language that nobody supports or none; the null
    filter sees those of ``language``; ``other`` are of supported languages
    that the job does not read. The five add up to ``posts``.
    """
    routed = F.coalesce(F.col("language") == language, F.lit(False))
    named = F.col("rowkey").isNotNull()
    return [
        F.count(F.lit(1)).alias("posts"),
        F.count_if(is_unrouted(supported)).alias("unrouted"),
        F.count_if(~is_unrouted(supported) & ~routed).alias("other"),
        F.count_if(routed & ~named).alias("null_rowkey"),
        F.count_if(routed & named & F.col("content").isNull()).alias("null_content"),
        F.count_if(is_usable(language)).alias("scored"),
    ]
