"""The streaming job: posts in, sentiment upserted per micro-batch.

Every post stands alone, so the pipeline keeps no state and the streaming plan
is the batch plan. The sinks work per batch, to be safe to repeat: both outputs
of a batch are named by it, and a batch counts as done after the second.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import spread
from tidemark.operators import routing
from tidemark.plans.pipeline import Resources, build_pipeline, score_all
from tidemark.sources.posts import write_unrouted
from tidemark.sources.sink import write_sentiment

#: The name of the counts in a query's progress.
OBSERVED = "routing"


def run_stream(
    source: DataFrame,
    sink: str,
    resources: Resources,
    checkpoint: str | None = None,
    language: str = "en",
    fixed: bool = False,
    trigger: dict | None = None,
    unrouted: str | None = None,
    before_publish: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the job; by default it drains what is there and stops.

    The checkpoint lies beside the store's data unless another is given: two
    jobs with different stores never share one. It also names the writer, so a
    job that starts again goes on with its batches, and a repeated batch
    replaces itself. Posts in unsupported languages go to ``unrouted``, where
    it is given. How many posts were dropped and why is in each progress, under
    ``observedMetrics[OBSERVED]``. ``before_publish`` is called with the number
    of each batch before its sentiment is published.
    """
    checkpoint = checkpoint or f"{sink}/checkpoint-{language}-{'fixed' if fixed else 'compat'}"
    supported = tuple({*routing.SUPPORTED, language})
    # A batch of few files is few tasks, so its posts are dealt out to all cores.
    source = spread(source.observe(OBSERVED, *routing.counts(language, supported)))

    def publish(scored: DataFrame, rest: DataFrame | None, batch_id: int) -> None:
        if rest is not None:
            write_unrouted(rest, unrouted, checkpoint, batch_id)
        if before_publish is not None:
            before_publish(batch_id)
        write_sentiment(scored.select("rowkey", "sentiment"), sink, checkpoint, batch_id)

    if resources.lookup == "in_row" and unrouted is None:
        stream = build_pipeline(source, resources, language, fixed).select("rowkey", "sentiment")

        def store(batch: DataFrame, batch_id: int) -> None:
            publish(batch, None, batch_id)

    elif resources.lookup == "in_row":
        stream = score_all(source, resources, language, fixed, supported)

        def store(batch: DataFrame, batch_id: int) -> None:
            # Two outputs of one batch: it is read and scored once.
            held = batch.select("rowkey", "sentiment", "usable", "unrouted").persist()
            try:
                publish(held.filter("usable"), held.filter("unrouted is not null").select("unrouted.*"), batch_id)
            finally:
                held.unpersist()

    else:
        # The tables are joined with the batch itself, which is held because it is read for both outputs.
        stream = source

        def store(batch: DataFrame, batch_id: int) -> None:
            held = batch if unrouted is None else batch.persist()
            try:
                rest = None if unrouted is None else held.filter(routing.is_unrouted(supported))
                publish(build_pipeline(held, resources, language, fixed), rest, batch_id)
            finally:
                if unrouted is not None:
                    held.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
