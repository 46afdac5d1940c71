"""Column helpers."""

import math

from checks.queries import QUERIES


def test_an_empty_text_has_an_infinite_share(spark, tmp_path):
    rows = [(1, "", "en", "web", 0), (2, "ab", "en", "web", 2), (3, None, "en", "web", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.single for r in QUERIES["text_helpers"](spark, str(tmp_path)).collect()}
    assert got == {1: math.inf, 2: 0.5, 3: None}
