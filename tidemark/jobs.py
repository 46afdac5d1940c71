"""The jobs as one call each, driven by a configuration."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import EngineConfig, spread
from tidemark.operators import routing
from tidemark.plans.pipeline import BUNDLED, Resources, build_pipeline
from tidemark.sources.posts import read_posts, stream_posts, write_unrouted
from tidemark.sources.sink import write_sentiment
from tidemark.streaming.stream import OBSERVED, run_stream


def _checked(config: EngineConfig) -> EngineConfig:
    for name in ("input_path", "output_path"):
        if not getattr(config, name):
            raise ValueError(f"the configuration names no {name}")
    return config


def _resources(spark: SparkSession, config: EngineConfig) -> Resources:
    return Resources(spark, config.resources or BUNDLED, lookup=config.lookup)


def _observed(seen: Observation, posts: DataFrame, counts: list[Column]) -> dict[str, int]:
    """What passed ``seen``; counted anew where nothing was left to score.

    Spark then drops the rest of the running plan as empty, and with it the
    observation, which gives an error in place of a row.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return posts.agg(*counts).first().asDict()


def run_batch(spark: SparkSession, config: EngineConfig) -> dict[str, int]:
    """Score every post of the input and upsert the results.

    Returns how many posts were read and what became of them, as
    :func:`tidemark.operators.routing.counts` names it. They are counted as
    they pass, in the run that scores them; work that is done again after an
    executor is lost may be counted again.
    """
    config = _checked(config)
    supported = tuple({*routing.SUPPORTED, config.language})
    posts = read_posts(spark, config.input_path, config.input_format)
    seen = Observation(OBSERVED)
    counts = routing.counts(config.language, supported)
    passed = posts.observe(seen, *counts)
    scored = build_pipeline(spread(passed), _resources(spark, config), config.language, config.fixed)
    write_sentiment(scored, config.output_path, salted=True)
    if config.unrouted_path:
        write_unrouted(posts.filter(routing.is_unrouted(supported)), config.unrouted_path, uuid.uuid4().hex, 0)
    return _observed(seen, posts, counts)


def run_stream_job(spark: SparkSession, config: EngineConfig, trigger: dict | None = None, **more) -> StreamingQuery:
    """Score posts as they arrive; by default what is there, and stop. ``more`` goes to ``run_stream``."""
    config = _checked(config)
    source = stream_posts(
        spark,
        config.input_path,
        config.input_format,
        config.max_files_per_trigger,
        config.after_read or None,
        config.archive_path or None,
    )
    return run_stream(
        source,
        config.output_path,
        _resources(spark, config),
        config.checkpoint_path or None,
        config.language,
        config.fixed,
        trigger,
        config.unrouted_path or None,
        **more,
    )
