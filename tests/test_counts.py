"""Counts of a batch job that leaves nothing to score."""

from tidemark import EngineConfig
from tidemark.jobs import run_batch


def test_a_job_without_a_post_to_score_still_counts(spark, posts, tmp_path):
    made = posts("uno", "dos", language="es").union(spark.createDataFrame([(None, "x", "en"), ("a", None, "en")], "rowkey string, content string, language string"))
    made.repartition(2).write.parquet(str(tmp_path / "in"))
    seen = run_batch(spark, EngineConfig(input_path=str(tmp_path / "in"), output_path=str(tmp_path / "out")))
    assert seen == {"posts": 4, "unrouted": 2, "other": 0, "null_rowkey": 1, "null_content": 1, "scored": 0}
