"""The registered queries of the operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, chat, decontam, exact_dedup, html_main, language, merkle, packing, quality, repair, secrets, sharding, simhash, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: The file of ranks; a parameter of the operators.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The same vocabulary as a file of the tokenizers library.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_EXACT = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER w AS r
  FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, r = 1 AS kept, text_sha256 FROM g
"""


@query(_EXACT)
def op3_exact_dedup(spark, sf_dir):
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op5_quality(spark, sf_dir):
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        (F.col("fold") == quality.HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"),
    )


@query()
def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@query()
def op8_decontamination(spark, sf_dir):
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "doc_at", "item_at", "length", "agree")


@query()
def op1_sharding(spark, sf_dir):
    found = sharding.interleave(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


_CHAT = """
WITH RECURSIVE t AS (
  SELECT c.*, b.role AS before, c.role IN ('user', 'system') AS asks
  FROM conversations c LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1),
c AS (
  SELECT conv_id, turn, role, text, CASE WHEN before IN ('user', 'system') THEN turn - 1 WHEN before IS NOT NULL THEN turn - 2 END AS after
  FROM t WHERE asks),
l AS (
  SELECT c.conv_id, c.turn, 0 AS level FROM c LEFT JOIN c p ON p.conv_id = c.conv_id AND p.turn = c.after WHERE p.turn IS NULL
  UNION ALL SELECT c.conv_id, c.turn, l.level + 1 FROM c JOIN l ON l.conv_id = c.conv_id AND l.turn = c.after)
SELECT conv_id, 'call' AS kind, conv_id || ':' || turn AS call_id, turn, CAST(l.level AS BIGINT) AS level,
       CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       CASE WHEN c.after IS NOT NULL AND p.turn IS NULL THEN 'dangling' ELSE '' END AS errors,
       CASE WHEN c.role = 'user' THEN '{"arguments":{"prompt":' || to_json(c.text) || ',"turn":' || c.turn || '}'
            ELSE '{"arguments":{"instruction":' || to_json(c.text) || '}' END
         || ',"id":"' || conv_id || ':' || turn || '","name":"' || CASE WHEN c.role = 'user' THEN 'ask' ELSE 'configure' END || '","type":"call"}' AS json
FROM c JOIN l USING (conv_id, turn) LEFT JOIN (SELECT conv_id, turn - 1 AS turn FROM t WHERE NOT asks) r USING (conv_id, turn)
LEFT JOIN (SELECT conv_id, turn AS turn FROM c) p ON p.conv_id = c.conv_id AND p.turn = c.after
UNION ALL
SELECT t.conv_id, 'result', t.conv_id || ':' || (t.turn - 1), t.turn, CAST(l.level AS BIGINT),
       CASE WHEN l.turn IS NULL THEN 'orphan' ELSE 'linked' END, '',
       '{"content":' || to_json(t.text) || ',"id":"' || t.conv_id || ':' || (t.turn - 1) || '","type":"result"}'
FROM t LEFT JOIN l ON l.conv_id = t.conv_id AND l.turn = t.turn - 1 WHERE NOT asks
"""


@query(_CHAT)
def op4_tool_calls(spark, sf_dir):
    calls, results = chat.from_conversations(table(spark, sf_dir, "conversations"))
    return chat.link_calls(calls, results, chat.conversation_tools(spark))


@query()
def op9_html_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = html_main.extract(pages, html_main.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _listed(span) -> F.Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


@query()
def op10_secrets(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, _listed), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", _listed), ",").alias("spans"),
        F.array_join(F.transform(F.filter("costs", lambda c: c.isNotNull()), lambda c: F.format_number(c, 1)), " ").alias("guess_costs"),
    )


@query(sql.MANIFEST)
def op11_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    presented = F.when(tampered, merkle.leaf_digest(merkle.lowered()))
    found = merkle.proofs(merkle.manifest(table(spark, sf_dir, "documents"), presented))
    root = merkle.folded(F.coalesce("presented", "leaf"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query()
def op12_retrieval_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


@query(sql.REPAIR)
def op13_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(conversations), conversations)
