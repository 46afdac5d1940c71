"""Headline queries at one scale; prints one JSON line.

Results go to Spark's no-op sink: all rows are computed and none pass through
the driver. The table is one file of one row group, so it is dealt to a number
of partitions that the bench names. What is done once per session (publishing
the lookup tables, building the stage expressions) is timed and in the total.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES, resources
from tidemark import session

HEADLINE = (
    "route_language",
    "sentence_split",
    "tokenize",
    "recognise_tokens",
    "sentiment_end_to_end",
    "polarity_vote",
    "fit_nb",
    "sentiment_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.tidemark.input_partitions": str(3 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    resources(spark).publish()
    QUERIES["sentiment_end_to_end"](spark, sf_dir).limit(0).count()
    setup = round(time.perf_counter() - start, 3)
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries and their set-up",
                "value": round(setup + sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "setup": setup,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
