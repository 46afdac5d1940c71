"""Polarity: ``tagged`` -> ``(rowkey, sentiment)``.

Content lemmas are scored by a Naive-Bayes model whose probabilities a polarity
lexicon overrides; a quantifier or negation right before a polar word makes a
compound. Emoticons decide first, and a post without polar words is neutral.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jvm
from tidemark.functions.lookup import Lookup, Probe, drop_bound
from tidemark.functions.text import build_once, few, float32, scan
from tidemark.operators.normalize import NEGATIVE as NEGATIVE_MARK
from tidemark.operators.normalize import POSITIVE as POSITIVE_MARK
from tidemark.sources.resources import Model

POSITIVE, NEGATIVE = "POSITIVE", "NEGATIVE"
LEXICON_P = 0.1  # probability of a listed (word, class) pair (fixed value)
CONTENT_TAG = "^(?:V|N|AQ|R|JJ)"
RESET_TAG = "^[FI]"
TIE = 1e-9
LISTS = ("light_words", "quant_adj", "neg_noun", "neg_verb")


def polarity_vote(lexicon: DataFrame) -> DataFrame:
    """``(word, polarity)``: +1 or -1 by majority; tied words drop out."""
    vote = F.when(F.col("cat") == POSITIVE, 1).when(F.col("cat") == NEGATIVE, -1).otherwise(0)
    return (
        lexicon.groupBy("word")
        .agg(F.signum(F.sum(vote)).cast("int").alias("polarity"))
        .filter("polarity != 0")
    )


def word_scores(lexicon: DataFrame, model: Model) -> DataFrame:
    """Per word: polarity, whether the model knows it, and p(word | class).

    A listed pair has the lexicon probability, tied words included; then the
    trained value counts; null means the smoothing constant.
    """
    listed = lexicon.groupBy("word").agg(
        *[
            F.max(F.when(F.col("cat") == c, F.lit(LEXICON_P))).alias(f"listed_{n}")
            for n, c in (("pos", POSITIVE), ("neg", NEGATIVE))
        ]
    )
    trained = model.cond.groupBy(F.col("feat").alias("word")).agg(
        F.max(F.coalesce("freq", F.lit(0)) != 0).alias("trained"),
        *[
            F.max(F.when((F.col("cat") == c) & (F.col("p") != 0), F.col("p"))).alias(f"trained_{n}")
            for n, c in (("pos", POSITIVE), ("neg", NEGATIVE))
        ],
    )
    return (
        listed.join(trained, "word", "full")
        .join(polarity_vote(lexicon), "word", "left")
        .select(
            "word",
            F.coalesce("polarity", F.lit(0)).alias("polarity"),
            F.coalesce("trained", F.lit(False)).alias("trained"),
            F.coalesce("listed_pos", "trained_pos").alias("p_pos"),
            F.coalesce("listed_neg", "trained_neg").alias("p_neg"),
        )
    )


class PolarityTables:
    """Lexicon and model prepared for in-row scoring.

    The word lists go into the expressions, up to 10,000 words, unless the
    lookup is by joins: then lists of any size are joined as well, by the
    lemmas of a post. A compound is not looked up in lists that are joined.
    """

    def __init__(self, lexicon: DataFrame, model: Model, **bounds):
        self.n_docs = model.n_docs.select("n_docs").first()[0]
        prior = {r["cat"]: r["p"] for r in few(model.prior.filter(F.col("cat").isin(POSITIVE, NEGATIVE)), "priors")}
        self.prior = {c: prior[c] for c in (POSITIVE, NEGATIVE)}
        rows = model.lists.filter(F.col("name").isin(*LISTS)).distinct()
        self.joined_lists: Lookup | None = None
        if bounds.get("by") == "join":
            flags = rows.groupBy("word").agg(*[F.max(F.col("name") == n).alias(n) for n in LISTS])
            self.joined_lists = Lookup(flags, "word", F.struct(*LISTS), **bounds)
        else:
            listed = few(rows, "listed words for lookups in the row; use lookup='join'")
            self.lists = {n: sorted(r["word"] for r in listed if r["name"] == n) for n in {r["name"] for r in listed}}
        self.smooth = F.ln(float32(F.lit(1.0) / F.lit(float(self.n_docs))))
        self.scores = Lookup(
            word_scores(lexicon, model),
            "word",
            F.struct(
                "polarity",
                "trained",
                F.coalesce(F.ln("p_pos"), self.smooth).alias("pos"),
                F.coalesce(F.ln("p_neg"), self.smooth).alias("neg"),
            ),
            **bounds,
        )

    def compiled(self, name: str, kind: str, fixed: bool):
        """A compiled stage that reads these tables."""
        smooth = self.scores.table.sparkSession.range(1).select(self.smooth).first()[0]
        values = {n: self.lists.get(n, []) for n in LISTS} | {
            "lexical": LEXICON_P,
            "smooth": smooth,
            "prior_pos": self.prior[POSITIVE],
            "prior_neg": self.prior[NEGATIVE],
            "positive": POSITIVE_MARK,
            "negative": NEGATIVE_MARK,
        }
        return jvm.function(name, kind, self.scores.shared(), fixed, values)

    def listed(self, word: Column, name: str) -> Column:
        if self.joined_lists is not None:
            return F.coalesce(self.joined_lists.probe(word)[name], F.lit(False))
        return word.isin(*self.lists.get(name, [])) if self.lists.get(name) else F.lit(False)

    def opens(self, word: Column) -> Column:
        """Whether a compound may begin with this content word."""
        any_of = self.listed(word, LISTS[1])
        for name in LISTS[2:]:
            any_of = any_of | self.listed(word, name)
        return any_of & ~self.listed(word, LISTS[0])

    def bind(self, df: DataFrame) -> tuple[DataFrame, Probe]:
        """Make lists and scores reachable over ``df``, which has ``tagged``."""
        if self.joined_lists is not None:
            df, _ = self.joined_lists.bind(df, _lemmas())
        return self.scores.bind(df, build_once(_score_keys, self))


def _gate(tagged: Column, fixed: bool) -> Column:
    """Lines the polarity stage reads: three fields, a word before a blank."""
    ends = lambda c: c.rlike("[A-Za-z0-9_]$")
    full = lambda x: (x["lemma"] != "") & (x["tag"] != "")
    if fixed:
        return F.filter(tagged, full)
    return F.filter(tagged, lambda x: full(x) & (ends(x["token"]) | ends(x["lemma"])))


def content_words(tagged: Column, tables: PolarityTables, probe: Probe, fixed: bool = False) -> Column:
    """Content lemmas in order, with an empty lemma where context resets."""
    if tables.scores.by == "in_row":
        return tables.compiled("Content", _WORDS, fixed)(tagged)
    reset = lambda x: x["tag"].rlike(RESET_TAG)
    content = lambda x: x["tag"].rlike(CONTENT_TAG) & ~tables.listed(x["lemma"], "light_words")
    kept = F.filter(_gate(tagged, fixed), lambda x: reset(x) | content(x))
    return F.transform(
        kept,
        lambda x: F.when(
            reset(x),
            F.struct(F.lit("").alias("lemma"), F.lit("").alias("tag"), F.lit(None).cast(SCORE).alias("s")),
        ).otherwise(F.struct(x["lemma"].alias("lemma"), x["tag"].alias("tag"), probe(x["lemma"]).alias("s"))),
    )


SCORE = "struct<polarity:int,trained:boolean,pos:double,neg:double>"
_WORDS = f"array<struct<lemma:string,tag:string,s:{SCORE}>>"
_TOTALS = "struct<hits:int,pos:double,neg:double,balance:int>"


def compound_kind(lemma_score: Column, tag: Column, previous: Column, tables: PolarityTables) -> Column:
    """'quant', 'negation' or null for a polar word after ``previous``."""
    polar = F.coalesce(lemma_score["polarity"], F.lit(0)) != 0
    adjective, noun, verb = tag.rlike("^(?:AQ|JJ)"), tag.startswith("N"), tag.startswith("V")
    negated = ((adjective | noun) & tables.listed(previous, "neg_noun")) | (
        verb & tables.listed(previous, "neg_verb")
    )
    return F.when(
        polar,
        F.when(adjective & tables.listed(previous, "quant_adj"), "quant").when(negated, "negation"),
    )


def compound_names(words: Column, tables: PolarityTables) -> Column:
    """The compounds of a post, in order."""
    if tables.scores.by == "in_row":
        return tables.compiled("Compounds", "array<string>", False)(words)

    def step(previous: Column, w: Column) -> Column:
        kind = compound_kind(w["s"], w["tag"], previous, tables)
        joined = kind.isNotNull() & (w["lemma"] != "")
        name = F.concat(previous, F.lit("_"), w["lemma"])
        return F.struct(
            F.when(joined, name).otherwise(w["lemma"]).alias("state"),
            F.when(joined, name).alias("out"),
        )

    return F.filter(scan(words, F.lit(""), step, "string"), lambda n: n.isNotNull())


def score_content(words: Column, tables: PolarityTables, probe: Probe, fixed: bool = False) -> Column:
    """Fold the content words into ``(hits, pos, neg)`` log sums."""
    weight = 1 if fixed else 2  # the class prior counts twice in compat
    lexical = F.ln(F.lit(LEXICON_P))
    start = F.struct(
        F.lit("").alias("previous"),
        F.lit("").alias("earlier"),
        F.lit(0).alias("hits"),
        (F.ln(F.lit(tables.prior[POSITIVE])) * weight).alias("pos"),
        (F.ln(F.lit(tables.prior[NEGATIVE])) * weight).alias("neg"),
    )

    def moved(acc: Column, previous: Column, hits: Column, pos: Column, neg: Column) -> Column:
        return F.struct(
            previous.alias("previous"),
            acc["previous"].alias("earlier"),
            (acc["hits"] + hits).alias("hits"),
            (acc["pos"] + pos).alias("pos"),
            (acc["neg"] + neg).alias("neg"),
        )

    def step(acc: Column, w: Column) -> Column:
        s = w["s"]
        positive = s["polarity"] > 0
        polar = F.coalesce(s["polarity"], F.lit(0)) != 0
        name = F.concat(acc["previous"], F.lit("_"), w["lemma"])
        kind = compound_kind(s, w["tag"], acc["previous"], tables)
        if fixed:
            doubled = (kind == "quant") & tables.listed(acc["earlier"], "neg_noun")
            kind = F.when(doubled, "negation").otherwise(kind)
        other = probe(name)
        # The own class of a quantified word keeps its probability, a negated
        # word hands it to the other class.
        quantified = moved(
            acc,
            name,
            F.lit(1),
            F.when(positive, lexical).otherwise(F.coalesce(other["pos"], tables.smooth)),
            F.when(positive, F.coalesce(other["neg"], tables.smooth)).otherwise(lexical),
        )
        negated = moved(
            acc,
            name,
            F.lit(1),
            F.when(positive, tables.smooth).otherwise(lexical),
            F.when(positive, lexical).otherwise(tables.smooth),
        )
        counts = polar | F.coalesce(s["trained"], F.lit(False))
        plain = moved(
            acc,
            w["lemma"],
            F.when(polar, 1).otherwise(0),
            F.when(counts, s["pos"]).otherwise(F.lit(0.0)),
            F.when(counts, s["neg"]).otherwise(F.lit(0.0)),
        )
        forgotten = F.struct(
            F.lit("").alias("previous"),
            acc["earlier"].alias("earlier"),
            acc["hits"].alias("hits"),
            acc["pos"].alias("pos"),
            acc["neg"].alias("neg"),
        )
        return (
            F.when(w["lemma"] == "", forgotten)
            .when(kind == "quant", quantified)
            .when(kind == "negation", negated)
            .otherwise(plain)
        )

    return F.aggregate(words, start, step)


def emoticon_balance(tagged: Column, fixed: bool = False) -> Column:
    value = lambda t: F.when(t == POSITIVE_MARK, 1).when(t == NEGATIVE_MARK, -1).otherwise(0)
    marks = F.filter(tagged, lambda x: x["token"].isin(POSITIVE_MARK, NEGATIVE_MARK))
    return F.aggregate(_gate(marks, fixed), F.lit(0), lambda a, x: a + value(x["token"]))


def decide(balance: Column, hits: Column, pos: Column, neg: Column) -> Column:
    """Emoticons, then no polar word, then the better class; a tie is neutral."""
    return (
        F.when(balance > 0, 1)
        .when(balance < 0, -1)
        .when(hits == 0, 0)
        .when(F.abs(pos - neg) < TIE, 0)
        .when(pos > neg, 1)
        .otherwise(-1)
    )


def _lemmas() -> Column:
    return F.transform("tagged", lambda x: x["lemma"])


def _score_keys(tables: PolarityTables) -> Column:
    """The lemmas, and each joined to the nearest operator among content lines before it.

    A compound joins a word to the content lemma right before it, so if that
    one is an operator, it is the nearest. Lines that are no content do not
    count, as they do not part a compound.
    """

    def step(last: Column, x: Column) -> Column:
        opens = x["tag"].rlike(CONTENT_TAG) & tables.opens(x["lemma"])
        return F.struct(
            F.when(opens, x["lemma"]).otherwise(last).alias("state"),
            F.when(last != "", F.concat(last, F.lit("_"), x["lemma"])).alias("out"),
        )

    joined = F.filter(scan(F.col("tagged"), F.lit(""), step, "string"), lambda n: n.isNotNull())
    return F.concat(_lemmas(), joined)


def _scores(tables: PolarityTables, probe: Probe, fixed: bool) -> Column:
    words = content_words(F.col("tagged"), tables, probe, fixed)
    return score_content(words, tables, probe, fixed)


def _compiled(tables: PolarityTables, fixed: bool) -> Column:
    return tables.compiled("Score", _TOTALS, fixed)(F.col("tagged"))


def with_scores(df: DataFrame, tables: PolarityTables, fixed: bool = False) -> DataFrame:
    """Add ``balance`` and ``scores`` (``hits``, ``pos``, ``neg``)."""
    if tables.scores.by == "in_row":
        scored = df.withColumn("scores", build_once(_compiled, tables, fixed))
        return scored.withColumn("balance", F.col("scores.balance"))
    df, probe = tables.bind(df)
    balance = emoticon_balance(F.col("tagged"), fixed)
    scored = df.withColumn("scores", build_once(_scores, tables, probe, fixed))
    return drop_bound(scored.withColumn("balance", balance))


def classify(df: DataFrame, tables: PolarityTables, fixed: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(rowkey, sentiment)`` and ``keep``, one row per post; ``fixed`` adds ``p_positive``."""
    s = F.col("scores")
    out = [
        F.col("rowkey"),
        *keep,
        decide(F.col("balance"), s["hits"], s["pos"], s["neg"]).cast("int").alias("sentiment"),
    ]
    if fixed:
        odds = F.lit(1.0) / (F.lit(1.0) + F.exp(s["neg"] - s["pos"]))
        out.append(F.when(s["hits"] > 0, odds).alias("p_positive"))
    return with_scores(df, tables, fixed).select(*out)
