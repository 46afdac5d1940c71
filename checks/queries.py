"""The registered queries: each operator over the given tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame`` and ``ORACLE`` the
same name to SQL for an independent engine.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracle import NOISE, _coarse, _noisy, after
from checks.oracle_fixed import STAGES as FIXED
from tidemark.config import EngineConfig, settle, shared_folder, spread
from tidemark.functions import text
from tidemark.jobs import run_batch, run_stream_job
from tidemark.operators import normalize as norm
from tidemark.operators import routing, rowkey, sentiment, tagger, train
from tidemark.operators.ner import Token, recognise, token_info
from tidemark.plans.pipeline import Resources, annotate, build_pipeline, text_stages
from tidemark.sources import sink
from tidemark.sources.posts import read_posts, read_unrouted, stream_posts
from tidemark.streaming.stream import OBSERVED, run_stream

#: A file of one row group is one task, and files of a few make tasks of very
#: unequal work, so rows are dealt out. The caller may name a number of partitions.
PARTS = "spark.tidemark.input_partitions"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
_resources: dict[int, tuple[SparkSession, Resources]] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def resources(spark: SparkSession) -> Resources:
    """Lookup tables are published once per session."""
    if id(spark) not in _resources:
        _resources[id(spark)] = (spark, Resources(spark))
    return _resources[id(spark)][1]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def dealt(rows: DataFrame) -> DataFrame:
    parts = rows.sparkSession.conf.get(PARTS, None)
    return rows.repartition(int(parts)) if parts else spread(rows)


def _noise(column: Column) -> Column:
    """``column`` with each replacement of ``NOISE`` made, one after the other.

    Each one replaces a word between blanks and makes no word that a later one
    replaces, so all are made in one pass over the words. Where such a word
    stands twice in a row the two share a blank, and only the first is replaced;
    texts with such a place go through the replacements themselves.
    """
    made = {old.strip(" "): new.strip(" ") for old, new in NOISE}
    pairs = F.create_map(*[F.lit(x) for pair in made.items() for x in pair])
    twice = column.rlike(f" ({'|'.join(made)}) \\1 ")
    in_turn = reduce(lambda c, n: F.replace(c, F.lit(n[0]), F.lit(n[1])), NOISE, column)

    def passed(words: Column) -> Column:
        inner = lambda i: (i > 0) & (i < F.size(words) - 1)
        word = lambda w, i: F.when(w.isin(*made) & inner(i), F.element_at(pairs, w)).otherwise(w)
        return F.array_join(F.transform(words, word), " ")

    return F.when(twice, in_turn).otherwise(text.let(F.split(column, " ", -1), passed))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as posts, with common words turned into social text."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("rowkey"),
        _noise(F.col("text")).alias("content"),
        F.col("lang").alias("language"),
    )


def english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.drop_null_posts(routing.route_language(posts(spark, sf_dir)))


def tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_stages(english(spark, sf_dir))


def recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise(tokenised(spark, sf_dir), resources(spark).words)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagger.tag(recognised(spark, sf_dir), resources(spark).pos)


# --- routing, keys, helpers -------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS rowkey, length(text) AS n FROM documents WHERE lang = 'en'")
def route_language(spark, sf_dir):
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("rowkey"), F.col("text").alias("content"), F.col("lang").alias("language")
    )
    return routing.route_language(docs).select("rowkey", F.length("content").cast("bigint").alias("n"))


@query("SELECT lang AS language, count(*) AS posts FROM documents WHERE lang IS NULL OR lang <> 'en' GROUP BY lang")
def unrouted_languages(spark, sf_dir):
    return routing.unrouted(posts(spark, sf_dir)).groupBy("language").agg(F.count("*").alias("posts"))


@query(
    "SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS null_rowkey, "
    "count(*) FILTER (WHERE l.doc_id IS NOT NULL AND d.text IS NULL) AS null_content "
    "FROM labels l FULL JOIN (SELECT * FROM documents WHERE lang = 'en') d ON d.doc_id = l.doc_id"
)
def null_posts(spark, sf_dir):
    # Labels of texts in other languages have no content, texts without a label no key.
    english_docs = documents(spark, sf_dir).filter("lang = 'en'").select(F.col("doc_id").alias("d"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    rows = labels.join(english_docs, F.col("doc_id") == F.col("d"), "full").select(
        F.col("doc_id").cast("string").alias("rowkey"), F.col("text").alias("content")
    )
    return routing.count_null_posts(rows)


@query("SELECT doc_id, lpad(CAST(doc_id % 32 AS VARCHAR), 2, '0') || CAST(doc_id AS VARCHAR) AS salted FROM documents")
def salt_keys(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", rowkey.salt_key(F.col("doc_id").cast("string"), F.col("doc_id")).alias("salted")
    )


@query(
    "SELECT rowkey, lpad(CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) % 32 AS VARCHAR), 2, '0') || rowkey AS salted_key "
    "FROM (SELECT conv_id, turn, conv_id || '_' || turn AS rowkey FROM conversations) x"
)
def salt_round_robin(spark, sf_dir):
    keys = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", F.concat_ws("_", F.col("conv_id"), F.col("turn")).alias("rowkey")
    )
    return rowkey.salt_round_robin(keys, "rowkey", "conv_id", "turn").select("rowkey", "salted_key")


@query("SELECT conv_id || '_' || turn AS original, CAST(turn AS VARCHAR) AS source FROM conversations")
def key_roundtrip(spark, sf_dir):
    key = F.concat_ws("_", F.col("conv_id"), F.col("turn"))
    salted = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(rowkey.salt_key(key).alias("k"))
    original = rowkey.original_key(F.col("k"))
    return salted.select(original.alias("original"), rowkey.key_source(original).alias("source"))


@query(
    "WITH p AS (SELECT *, string_split_regex(text, '[a-z]+') AS p FROM documents), "
    "t AS (SELECT *, CASE WHEN len(p) = 1 OR p[-1] <> '' THEN p WHEN len(p) = 2 AND p[1] = '' THEN [] ELSE p[:-2] END AS kept FROM p) "
    "SELECT doc_id, array_to_string(kept, '|') AS parts, CAST(len(kept) AS INTEGER) AS n_parts, "
    "lower(text) AS folded, regexp_replace(text, '[aeiou]+', '<') AS first_only, "
    "regexp_replace(text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS chomped, "
    "coalesce(source NOT IN ('', '0'), false) AS truth, CAST(CAST(1.0 / n_chars AS FLOAT) AS DOUBLE) AS single FROM t"
)
def text_helpers(spark, sf_dir):
    t = F.col("text")
    parts = text.split_all(t, "[a-z]")
    return documents(spark, sf_dir).select(
        "doc_id",
        F.array_join(parts, "|").alias("parts"),
        F.size(parts).alias("n_parts"),
        text.fold_case(t).alias("folded"),
        text.replace_first(t, "[aeiou]+", "<$2").alias("first_only"),
        text.chomp(t).alias("chomped"),
        text.truthy(F.col("source")).alias("truth"),
        text.float32(text.ratio(F.lit(1.0), F.col("n_chars"))).alias("single"),
    )


# --- text stages ------------------------------------------------------------


@query(after("sentences", "SELECT rowkey, CAST(si AS INTEGER) AS i, sentence FROM sent"))
def sentence_split(spark, sf_dir):
    return text.rows_of(tokenised(spark, sf_dir), "sentences", "i", "sentence", "rowkey")


@query(after("sentences", "SELECT rowkey, count(s.si) AS n FROM en LEFT JOIN sent s USING (rowkey) GROUP BY rowkey"))
def sentence_count(spark, sf_dir):
    n = F.size("sentences").cast("bigint")
    return tokenised(spark, sf_dir).select("rowkey", n.alias("n"))


@query(after("normalized", "SELECT rowkey, CAST(si AS INTEGER) AS i, normalized FROM norm"))
def normalize_words(spark, sf_dir):
    return text.rows_of(tokenised(spark, sf_dir), "normalized", "i", "normalized", "rowkey")


@query(
    after(
        "tokens",
        "SELECT rowkey, count(*) FILTER (WHERE token = 'EMOT_POS') AS positive, "
        "count(*) FILTER (WHERE token = 'EMOT_NEG') AS negative FROM en LEFT JOIN tok USING (rowkey) GROUP BY rowkey",
    )
)
def emoticon_tags(spark, sf_dir):
    count = lambda mark: F.size(F.filter("tokens", lambda t: t == mark)).cast("bigint")
    return tokenised(spark, sf_dir).select(
        "rowkey", count(norm.POSITIVE).alias("positive"), count(norm.NEGATIVE).alias("negative")
    )


def _fixed_runs(column: str) -> str:
    for letter, run in norm.FIXED_RUNS:
        column = f"regexp_replace({column}, '{run}+', '{letter}', 'g')"
    return column


@query(
    after(
        "normalized",
        "SELECT o.w AS word, n.w AS collapsed, any_value(" + _fixed_runs("o.w") + ") AS collapsed_fixed, count(*) AS uses "
        "FROM word o JOIN w9 n USING (rowkey, si, wi) WHERE o.w <> n.w GROUP BY o.w, n.w",
    )
)
def letter_runs(spark, sf_dir):
    each = F.flatten(F.transform("sentences", lambda s: F.split(s, " ")))
    words = (
        text.rows_of(tokenised(spark, sf_dir), each, "i", "w")
        .groupBy(F.regexp_replace("w", "([^,.])[,.]$", "$1").alias("word"))
        .agg(F.count("*").alias("uses"))
    )
    out = words.select(
        "word",
        norm.collapse(F.col("word")).alias("collapsed"),
        norm.collapse(F.col("word"), True).alias("collapsed_fixed"),
        "uses",
    )
    return out.filter("word <> collapsed")


@query(after("tokens", "SELECT rowkey, CAST(pos AS INTEGER) AS i, token FROM tok"))
def tokenize(spark, sf_dir):
    return text.rows_of(tokenised(spark, sf_dir), "tokens", "i", "token", "rowkey")


@query(after("tokens", "SELECT token, count(*) AS uses, count(DISTINCT rowkey) AS posts FROM tok GROUP BY token"))
def clitics(spark, sf_dir):
    # Counted inside each post first: one row per post and token goes on.
    each = text.rows_of(tokenised(spark, sf_dir), "tokens", "i", "token", "rowkey")
    return (
        each.groupBy("rowkey", "token")
        .agg(F.count("*").alias("n"))
        .groupBy("token")
        .agg(F.sum("n").alias("uses"), F.count("*").alias("posts"))
    )


# --- recogniser -------------------------------------------------------------

_FLAGS = ("up", "caps", "known", "stop", "noamb", "prep", "art", "month")
_FLAG_COLUMNS = ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in _FLAGS)


@query(
    after(
        "recognised",
        f"SELECT rowkey, {_FLAG_COLUMNS}, count(*) FILTER (WHERE cap) AS word, count(*) FILTER (WHERE num) AS number, "
        "count(*) FILTER (WHERE amb) AS ambiguous FROM en LEFT JOIN f0 USING (rowkey) GROUP BY rowkey",
    )
)
def ner_flags(spark, sf_dir):
    df, probe = resources(spark).words.bind(tokenised(spark, sf_dir), F.transform("tokens", F.lower))
    info = df.select("rowkey", token_info(F.col("tokens"), probe).alias("info"))
    count = lambda name: F.size(F.filter("info", lambda r: getattr(Token(r), name))).cast("bigint")
    return info.select(
        "rowkey", *[count(n).alias(n) for n in (*_FLAGS, "word", "number", "ambiguous")]
    )


def _entries(spark, sf_dir) -> DataFrame:
    analyses = F.array_join(
        F.transform("e.analyses", lambda a: F.concat(a["lemma"], F.lit("/"), a["tag"])), " "
    )
    return text.rows_of(recognised(spark, sf_dir), "analyses", "i", "e", "rowkey").select(
        "rowkey", "i", "e.token", analyses.alias("analyses")
    )


_ENTRIES = (
    "SELECT rowkey, i, token, an AS analyses FROM (SELECT *, CAST(row_number() OVER (PARTITION BY rowkey ORDER BY pos) - 1 AS INTEGER) AS i FROM entry) x"
)


@query(after("recognised", _ENTRIES))
def recognise_tokens(spark, sf_dir):
    return _entries(spark, sf_dir)


@query(after("recognised", _ENTRIES + " WHERE regexp_matches(an, '/NNP$') AND contains(token, '_')"))
def ner_name_runs(spark, sf_dir):
    return _entries(spark, sf_dir).filter(F.col("analyses").endswith("/NNP") & F.contains("token", F.lit("_")))


@query(after("recognised", _ENTRIES + " WHERE regexp_matches(an, '/Z[um]?$')"))
def ner_quantities(spark, sf_dir):
    return _entries(spark, sf_dir).filter(F.col("analyses").rlike("/Z[um]?$"))


@query(after("recognised", _ENTRIES + " WHERE regexp_matches(an, '/W$')"))
def ner_dates(spark, sf_dir):
    return _entries(spark, sf_dir).filter(F.col("analyses").endswith("/W"))


@query(after("recognised", "SELECT token, regexp_extract(an, '/([^/]*)$', 1) AS tag, count(*) AS uses FROM entry WHERE regexp_matches(an, '/F[a-z]+$') GROUP BY ALL"))
def punct_tags(spark, sf_dir):
    tag = F.element_at(F.split("analyses", "/"), -1)
    return (
        _entries(spark, sf_dir)
        .filter(F.col("analyses").rlike("/F[a-z]+$"))
        .groupBy("token", tag.alias("tag"))
        .agg(F.count("*").alias("uses"))
    )


# --- tagger -----------------------------------------------------------------


@query(after("tagged", "SELECT v.c AS coarse, v.fine, count(*) AS uses FROM vis v JOIN closed l USING (rowkey, ln) GROUP BY ALL"))
def pos_coarse(spark, sf_dir):
    lines = tagger.line_info(F.col("analyses"))
    cands = F.flatten(F.transform(lines, lambda x: x["cands"]))
    return (
        text.rows_of(recognised(spark, sf_dir), cands, "i", "x")
        .groupBy(F.col("x.c").alias("coarse"), F.col("x.fine").alias("fine"))
        .agg(F.count("*").alias("uses"))
    )


@query(after("tagged", "SELECT feat, count(*) AS uses FROM (SELECT DISTINCT rowkey, ln, feat FROM feats) x GROUP BY feat"))
def pos_features(spark, sf_dir):
    names = tagger.context_features(tagger.line_info(F.col("analyses")))
    return text.rows_of(recognised(spark, sf_dir), names, "i", "feat").groupBy("feat").agg(F.count("*").alias("uses"))


@query(
    after(
        "tagged",
        "SELECT s.rowkey, CAST(s.ln - 1 AS INTEGER) AS i, s.lt AS before, s.c AS tag, "
        "CASE WHEN s.s > -1e8 THEN CAST(round(-s.s * 1000) AS BIGINT) ELSE -1 END AS cost FROM score s",
    )
)
def pos_scores(spark, sf_dir):
    df = recognised(spark, sf_dir)
    tables = resources(spark).pos
    lines = tagger.line_info(F.col("analyses"))
    df, cond, prior = tagger.bind_tables(df, tables)
    scored = text.rows_of(df, tagger.all_scores(lines, tables, cond, prior), "k", "x", "rowkey")
    lefts = text.rows_of(scored, "x.lefts", "l", "left", "rowkey", "x.i")
    ranks = text.rows_of(lefts, "left.ranks", "r", "rank", "rowkey", "i", "left.before")
    return ranks.select(
        "rowkey",
        "i",
        "before",
        F.col("rank.name").alias("tag"),
        F.when(F.col("rank.cost") < 1e8, F.round(F.col("rank.cost") * 1000).cast("bigint")).otherwise(-1).alias("cost"),
    )


@query(
    after(
        "tagged",
        "SELECT rowkey, CAST(row_number() OVER (PARTITION BY rowkey ORDER BY ln) - 1 AS INTEGER) AS i, token, lemma, tag FROM tagged",
    )
)
def pos_tags(spark, sf_dir):
    return text.rows_of(tagged(spark, sf_dir), "tagged", "i", "x", "rowkey").select(
        "rowkey", "i", "x.token", "x.lemma", "x.tag"
    )


# --- polarity ---------------------------------------------------------------


def _content(spark, sf_dir) -> DataFrame:
    tables = resources(spark).polarity
    df, probe = tables.scores.bind(tagged(spark, sf_dir), F.transform("tagged", lambda x: x["lemma"]))
    return df.select("rowkey", sentiment.content_words(F.col("tagged"), tables, probe).alias("words"))


@query(
    "WITH words AS (SELECT d.doc_id, l.quality, unnest(list_distinct(string_split(d.text, ' '))) AS word "
    "FROM documents d JOIN labels l USING (doc_id)) "
    "SELECT word, CAST(sign(sum(CASE WHEN quality = 1 THEN 1 ELSE -1 END)) AS INTEGER) AS polarity "
    "FROM words GROUP BY word HAVING sum(CASE WHEN quality = 1 THEN 1 ELSE -1 END) <> 0"
)
def polarity_vote(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    cat = F.when(F.col("quality") == 1, sentiment.POSITIVE).otherwise(sentiment.NEGATIVE)
    lexicon = (
        documents(spark, sf_dir)
        .select("doc_id", "text")
        .join(labels, "doc_id")
        .select(F.explode(F.array_distinct(F.split("text", " "))).alias("word"), cat.alias("cat"))
    )
    return sentiment.polarity_vote(lexicon)


@query(after("scored", "SELECT rowkey, CAST(i - 1 AS INTEGER) AS i, lemma FROM prev"))
def content_words(spark, sf_dir):
    return text.rows_of(_content(spark, sf_dir), "words.lemma", "i", "lemma", "rowkey")


@query(
    after(
        "scored",
        "SELECT word AS compound, count(*) AS uses FROM weighed WHERE kind IS NOT NULL AND cat = 'POSITIVE' GROUP BY word",
    )
)
def negation_compounds(spark, sf_dir):
    names = sentiment.compound_names(F.col("words"), resources(spark).polarity)
    return (
        text.rows_of(_content(spark, sf_dir), names, "i", "compound")
        .groupBy("compound")
        .agg(F.count("*").alias("uses"))
    )


def _scores(spark, sf_dir) -> DataFrame:
    return sentiment.with_scores(tagged(spark, sf_dir), resources(spark).polarity)


@query(
    after(
        "scored",
        "SELECT rowkey, CAST(hits AS INTEGER) AS hits, CAST(round(pos * 1000) AS BIGINT) AS pos, CAST(round(neg * 1000) AS BIGINT) AS neg FROM total",
    )
)
def nb_scores(spark, sf_dir):
    milli = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    return _scores(spark, sf_dir).select(
        "rowkey", "scores.hits", milli("scores.pos").alias("pos"), milli("scores.neg").alias("neg")
    )


@query(
    after(
        "scored",
        "SELECT CAST(sign(balance) AS INTEGER) AS emoticons, hits > 0 AS polar, sentiment, count(*) AS posts "
        "FROM total JOIN sentiment USING (rowkey) GROUP BY ALL",
    )
)
def sentiment_cascade(spark, sf_dir):
    s = F.col("scores")
    return (
        _scores(spark, sf_dir)
        .groupBy(
            F.signum("balance").cast("int").alias("emoticons"),
            (s["hits"] > 0).alias("polar"),
            sentiment.decide(F.col("balance"), s["hits"], s["pos"], s["neg"]).cast("int").alias("sentiment"),
        )
        .agg(F.count("*").alias("posts"))
    )


_TURNS = f"""
posts AS (SELECT conv_id || '_' || turn AS rowkey, {_noisy("text")} AS content, 'en' AS language FROM conversations),
en AS (SELECT rowkey, content FROM posts WHERE rowkey IS NOT NULL AND content IS NOT NULL)
"""


@query(
    after(
        "scored",
        "SELECT split_part(rowkey, '_', 1) AS rowkey, arg_max(sentiment, CAST(split_part(rowkey, '_', 2) AS BIGINT)) AS sentiment "
        "FROM sentiment GROUP BY 1",
        _TURNS,
    )
)
def sentiment_upsert(spark, sf_dir):
    # Every turn writes its conversation's key. Roles are separate writes, each of
    # which lacks keys of the others, and later turns come in later writes.
    turns = dealt(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(
        F.concat_ws("_", F.col("conv_id"), F.col("turn")).alias("rowkey"),
        _noise(F.col("text")).alias("content"),
        F.lit("en").alias("language"),
    )
    scored = settle(build_pipeline(turns, resources(spark)))
    folder = f"{shared_folder(spark)}/upsert-{uuid.uuid4().hex}"
    turn = F.split("rowkey", "_")[1].cast("bigint")
    keyed = scored.select(F.split("rowkey", "_")[0].alias("rowkey"), "sentiment", turn.alias("turn"))
    for rule in ("turn = 0", "turn = 1", "turn between 2 and 3", "turn > 3"):
        sink.write_sentiment(keyed.filter(rule), folder, order=F.col("turn"))
    sink.compact_sentiment(spark, folder)
    return sink.read_sentiment(spark, folder)


_SENTIMENT = after("scored", "SELECT rowkey, sentiment FROM sentiment")


@query(_SENTIMENT)
def sentiment_end_to_end(spark, sf_dir):
    return build_pipeline(posts(spark, sf_dir), resources(spark))


@query(_SENTIMENT)
def stream_sentiment(spark, sf_dir):
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    posts(spark, sf_dir).write.parquet(f"{folder}/posts")
    source = stream_posts(spark, f"{folder}/posts", max_files=4)
    run_stream(source, f"{folder}/out", resources(spark)).awaitTermination()
    return sink.read_sentiment(spark, f"{folder}/out")


@query(_SENTIMENT)
def job_batch(spark, sf_dir):
    # The whole job from a configuration: stored posts in, the store out.
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    posts(spark, sf_dir).write.json(f"{folder}/posts")
    run_batch(spark, EngineConfig(input_path=f"{folder}/posts", input_format="json", output_path=f"{folder}/out"))
    return sink.read_sentiment(spark, f"{folder}/out")


class Broken(RuntimeError):
    """What a job meets that is made to fail once."""


def _drained(spark: SparkSession, sf_dir: str, after_read: str) -> DataFrame:
    """The store after a drain whose second batch fails before it is published, and a restart.

    Files that a batch has consumed are archived or deleted; the checkpoint, not
    that, makes each count once, so the failed batch is read again.
    """
    folder = f"{shared_folder(spark)}/drain-{uuid.uuid4().hex}"
    posts(spark, sf_dir).repartition(6).write.parquet(f"{folder}/posts")
    config = EngineConfig(
        input_path=f"{folder}/posts", output_path=f"{folder}/out", max_files_per_trigger=2, after_read=after_read, archive_path=f"{folder}/done" if after_read == "archive" else ""
    )
    broken = []

    def once(batch_id: int) -> None:
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise Broken("this batch fails on purpose")

    try:
        run_stream_job(spark, config, before_publish=once).awaitTermination()
    except StreamingQueryException as error:
        if "this batch fails on purpose" not in str(error):
            raise
    run_stream_job(spark, config, before_publish=once).awaitTermination()
    if not broken:
        raise AssertionError("no batch failed")
    return sink.read_sentiment(spark, f"{folder}/out")


@query(_SENTIMENT)
def drain_archive(spark, sf_dir):
    return _drained(spark, sf_dir, "archive")


@query(_SENTIMENT)
def drain_delete(spark, sf_dir):
    return _drained(spark, sf_dir, "delete")


_MIXED = """
WITH p AS (SELECT l.doc_id AS rowkey, d.text AS content, d.lang AS language
           FROM labels l FULL JOIN documents d ON d.doc_id = l.doc_id)
SELECT count(*) AS posts, count(*) FILTER (WHERE language IS NULL OR language <> 'en') AS unrouted,
       CAST(0 AS BIGINT) AS other, count(*) FILTER (WHERE language = 'en' AND rowkey IS NULL) AS null_rowkey,
       count(*) FILTER (WHERE language = 'en' AND rowkey IS NOT NULL AND content IS NULL) AS null_content,
       count(*) FILTER (WHERE language = 'en' AND rowkey IS NOT NULL AND content IS NOT NULL) AS scored
FROM p
"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts keyed by their labels: a text without a label has no key."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("d"), "text", "lang")
    return labels.join(docs, F.col("doc_id") == F.col("d"), "full").select(
        F.col("doc_id").cast("string").alias("rowkey"), _noise(F.col("text")).alias("content"), F.col("lang").alias("language")
    )


@query(_MIXED)
def job_counts(spark, sf_dir):
    # What the batch job observed of its input while it scored it.
    folder = f"{shared_folder(spark)}/counts-{uuid.uuid4().hex}"
    _mixed(spark, sf_dir).write.parquet(f"{folder}/posts")
    seen = run_batch(spark, EngineConfig(input_path=f"{folder}/posts", output_path=f"{folder}/out"))
    return spark.createDataFrame([seen], ", ".join(f"{n} bigint" for n in seen))


@query(_MIXED)
def stream_counts(spark, sf_dir):
    # The same counts from the progress of all micro-batches.
    folder = f"{shared_folder(spark)}/counts-{uuid.uuid4().hex}"
    _mixed(spark, sf_dir).repartition(4).write.parquet(f"{folder}/posts")
    job = run_stream_job(spark, EngineConfig(input_path=f"{folder}/posts", output_path=f"{folder}/out", max_files_per_trigger=2))
    job.awaitTermination()
    seen = [p.observedMetrics[OBSERVED].asDict() for p in job.recentProgress if OBSERVED in p.observedMetrics]
    total = {n: sum(s[n] for s in seen) for n in seen[0]}
    return spark.createDataFrame([total], ", ".join(f"{n} bigint" for n in total))


@query("SELECT lang AS language, count(*) AS posts FROM documents WHERE lang IS NULL OR lang <> 'en' GROUP BY lang")
def stream_unrouted(spark, sf_dir):
    # The side output of a stream: one batch, two outputs.
    folder = f"{shared_folder(spark)}/unrouted-{uuid.uuid4().hex}"
    posts(spark, sf_dir).repartition(4).write.parquet(f"{folder}/posts")
    config = EngineConfig(input_path=f"{folder}/posts", output_path=f"{folder}/out", unrouted_path=f"{folder}/rest", max_files_per_trigger=2)
    run_stream_job(spark, config).awaitTermination()
    return read_unrouted(spark, f"{folder}/rest").groupBy("language").agg(F.count("*").alias("posts"))


@query(
    "SELECT CASE WHEN doc_id % 7 <> 0 THEN lang END AS language, doc_id % 7 = 0 AS corrupt, count(*) AS posts, "
    "count(DISTINCT doc_id) AS whole FROM documents GROUP BY 1, 2"
)
def corrupt_posts(spark, sf_dir):
    # Every seventh line is cut off: it comes out raw, with its number still in it.
    folder = f"{shared_folder(spark)}/corrupt-{uuid.uuid4().hex}"
    line = F.to_json(F.struct(F.col("rowkey"), F.col("content"), F.col("language")))
    cut = F.when(F.col("rowkey").cast("bigint") % 7 == 0, F.substring(line, 1, 24)).otherwise(line)
    posts(spark, sf_dir).select(cut.alias("value")).write.text(f"{folder}/posts")
    read = read_posts(spark, f"{folder}/posts", "json")
    corrupt = F.col("rowkey").isNull() & F.col("content").startswith('{"rowkey":"')
    number = F.coalesce("rowkey", F.regexp_extract("content", '^\\{"rowkey":"([0-9]+)"', 1))
    return read.groupBy("language", corrupt.alias("corrupt")).agg(F.count("*").alias("posts"), F.count_distinct(number).alias("whole"))


_FIRST_KEYS = "(SELECT DISTINCT split_part(rowkey, '_', 1) AS rowkey FROM posts ORDER BY 1 LIMIT 5)"


@query(
    after(
        "scored",
        "SELECT rowkey, sentiment FROM (SELECT split_part(rowkey, '_', 1) AS rowkey, arg_max(sentiment, CAST(split_part(rowkey, '_', 2) AS BIGINT)) AS sentiment "
        f"FROM sentiment GROUP BY 1) JOIN {_FIRST_KEYS} USING (rowkey)",
        _TURNS,
    )
)
def point_reads(spark, sf_dir):
    # Five keys of a compacted store: their buckets are opened, and a later write is seen.
    turns = dealt(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(
        F.concat_ws("_", F.col("conv_id"), F.col("turn")).alias("rowkey"), _noise(F.col("text")).alias("content"), F.lit("en").alias("language")
    )
    keyed = settle(
        build_pipeline(turns, resources(spark)).select(
            F.split("rowkey", "_")[0].alias("rowkey"), "sentiment", F.split("rowkey", "_")[1].cast("bigint").alias("turn")
        )
    )
    folder = f"{shared_folder(spark)}/points-{uuid.uuid4().hex}"
    sink.write_sentiment(keyed.filter("turn < 2"), folder, order=F.col("turn"), salted=True)
    sink.write_sentiment(keyed.filter("turn = 2"), folder)
    sink.compact_sentiment(spark, folder)
    sink.write_sentiment(keyed.filter("turn > 2"), folder, order=F.col("turn"))
    keys = [r.rowkey for r in keyed.select("rowkey").distinct().orderBy("rowkey").limit(5).collect()]
    return sink.read_sentiment(spark, folder, keys)


@query(
    after(
        "scored",
        "SELECT rowkey, sentiment, CASE WHEN hits > 0 THEN CAST(round(1e6 / (1 + exp(neg - pos))) AS BIGINT) ELSE -1 END AS p_positive "
        "FROM total JOIN sentiment USING (rowkey)",
        stages=FIXED,
    )
)
def sentiment_fixed(spark, sf_dir):
    done = build_pipeline(posts(spark, sf_dir), resources(spark), fixed=True)
    millionths = F.round(F.col("p_positive") * 1e6).cast("bigint")
    return done.select("rowkey", "sentiment", F.coalesce(millionths, F.lit(-1).cast("bigint")).alias("p_positive"))


@query(
    after(
        "tagged",
        "SELECT rowkey, CAST(row_number() OVER (PARTITION BY rowkey ORDER BY ln) - 1 AS INTEGER) AS i, token, lemma, tag FROM tagged",
        stages=FIXED,
    )
)
def pos_tags_fixed(spark, sf_dir):
    done = annotate(english(spark, sf_dir), resources(spark), fixed=True)
    return text.rows_of(done, "tagged", "i", "x", "rowkey").select(
        "rowkey", "i", "x.token", "x.lemma", "x.tag"
    )


# --- estimation -------------------------------------------------------------

_FIT_NB = """,
doc AS (SELECT t.rowkey, CASE WHEN l.quality = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS cat
        FROM en t JOIN labels l ON CAST(l.doc_id AS VARCHAR) = t.rowkey),
size AS (SELECT cat, count(*) AS n FROM doc GROUP BY cat),
cnt AS (SELECT token AS feat, cat, count(DISTINCT rowkey) AS n FROM tok JOIN doc USING (rowkey) GROUP BY ALL),
frq AS (SELECT feat, sum(n) AS freq FROM cnt GROUP BY feat)
"""


def _labelled(spark, sf_dir) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").cast("string").alias("rowkey"),
        F.when(F.col("quality") == 1, sentiment.POSITIVE).otherwise(sentiment.NEGATIVE).alias("cat"),
    )
    return text_stages(english(spark, sf_dir).join(labels, "rowkey")).select("cat", "tokens")


@query(
    after("tokens", "SELECT 1").removesuffix("SELECT 1").rstrip()
    + _FIT_NB
    + "SELECT feat, cat, CAST(round(cnt.n / size.n * 1e9) AS BIGINT) AS p, CAST(freq AS INTEGER) AS freq FROM cnt JOIN size USING (cat) JOIN frq USING (feat)"
)
def fit_nb(spark, sf_dir):
    cond = train.fit_nb(_labelled(spark, sf_dir)).cond
    return cond.select("feat", "cat", F.round(F.col("p") * 1e9).cast("bigint").alias("p"), "freq")


@query(
    after("tokens", "SELECT 1").removesuffix("SELECT 1").rstrip()
    + _FIT_NB
    + "SELECT cat, CAST(round(n / sum(n) OVER () * 1e9) AS BIGINT) AS p FROM size"
)
def fit_nb_priors(spark, sf_dir):
    prior = train.fit_nb(_labelled(spark, sf_dir)).prior
    return prior.select("cat", F.round(F.col("p") * 1e9).cast("bigint").alias("p"))


@query(
    after("tagged", "SELECT 1").removesuffix("SELECT 1").rstrip()
    + f""",
g0 AS (SELECT rowkey, ln, token, tag, tag IN ('Fp', '<blank>') AS border, {_coarse("tag")} AS c FROM tagged),
g1 AS (SELECT *, lag(c) OVER w AS pc, coalesce(lag(border) OVER w, true) AS starts, lead(c) OVER w AS nc, coalesce(lead(border) OVER w, true) AS ends
       FROM g0 WINDOW w AS (PARTITION BY rowkey ORDER BY ln)),
g2 AS (SELECT *, CASE WHEN starts THEN lower(token) ELSE token END AS word FROM g1 WHERE NOT border),
ex AS (
  SELECT rowkey, ln, c, 'L_BEGIN' AS feat FROM g2 WHERE starts
  UNION ALL SELECT rowkey, ln, c, unnest(['L_' || pc, 'L_' || pc || '_' || word]) FROM g2 WHERE NOT starts
  UNION ALL SELECT rowkey, ln, c, unnest(['R_' || nc, 'R_' || nc || '_' || word]) FROM g2 WHERE NOT ends),
size AS (SELECT c, count(*) AS n FROM g2 GROUP BY c),
cnt AS (SELECT feat, c, count(*) AS n FROM ex GROUP BY ALL),
frq AS (SELECT feat, sum(n) AS freq FROM cnt GROUP BY feat)
SELECT feat, c AS cat, CAST(round(cnt.n / size.n * 1e9) AS BIGINT) AS p, CAST(freq AS INTEGER) AS freq FROM cnt JOIN size USING (c) JOIN frq USING (feat)
"""
)
def fit_pos(spark, sf_dir):
    cond = train.fit_pos(tagged(spark, sf_dir)).cond
    return cond.select("feat", "cat", F.round(F.col("p") * 1e9).cast("bigint").alias("p"), "freq")
