"""Part-of-speech tagging: ``analyses`` -> ``tagged``.

A Naive-Bayes choice per ambiguous word from its right neighbour's possible
tags and its left neighbour's chosen tag. All that needs no choice is computed
for every position at once; the left-to-right pass only carries one tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jvm
from tidemark.functions.lookup import Lookup, Probe, drop_bound
from tidemark.functions.text import build_once, few, float32, let, scan
from tidemark.operators.ner import PUNCT_TAGS
from tidemark.schema import TAGGED
from tidemark.sources.resources import Model

# Classes an unknown word may take, border tags, context vetoes (fixed values).
OPEN_CLASSES = ("NN", "NNP", "VB", "RB", "JJ")
BORDER_TAGS = ("Fp", "<blank>")
VETOES = (("PRP", ("L_VB_that", "L_VBd_that")), ("DT", ("R_END", "R_IN", "R_CC")))

ZERO = -1e9  # stands for the logarithm of zero; far below any real sum
BEGIN = "BEGIN"
END = "END"


#: Frequent tags that are their own leading part: word classes, numbers, dates and marks.
PLAIN_TAGS = ("NN", "NNP", "JJ", "RB", "IN", "DT", "VB", "VBZ", "Z", "Zu", "Zm", "W") + tuple(
    sorted({t for t in PUNCT_TAGS.values() if len(t) == 2})
)


def coarse_tag(tag: Column) -> Column:
    """Leading part of a tag that the model distinguishes; '' if there is none."""
    return (
        F.when(tag.isin(*PLAIN_TAGS), tag)
        .when(tag == "UNK", "UN")
        .when(
            tag.rlike("^(?:V|NNP|PRP)"),
            F.regexp_extract(tag, "([A-Z][A-Z][A-Z]?[A-Za-z$]?)", 1),
        )
        .otherwise(F.regexp_extract(tag, "([A-Z][A-Za-z$0-9]?)", 1))
    )


class PosTables:
    """A POS model prepared for in-row scoring."""

    def __init__(self, model: Model, **bounds):
        n = model.n_docs.select("n_docs").first()[0]
        self.smooth = F.ln(float32(F.lit(1.0) / F.lit(float(n))))
        veto = F.lit(None).cast("string")
        for cat, feats in VETOES:
            veto = F.when(F.col("feat").isin(*feats), cat).otherwise(veto)
        # Features with no count do not take part.
        by_feat = (
            model.cond.filter(F.coalesce("freq", F.lit(0)) != 0)
            .groupBy("feat")
            .agg(
                F.map_from_entries(
                    F.collect_list(F.when(F.col("p") > 0, F.struct("cat", F.ln("p").alias("lp"))))
                ).alias("lp")
            )
        )
        self.cond = Lookup(
            by_feat, "feat", F.struct(F.col("lp"), veto.alias("veto")), **bounds
        )
        self.prior = Lookup(model.prior, "cat", F.col("p"), **bounds)
        known = few(model.prior.filter(F.col("cat").isin(*OPEN_CLASSES)), "open classes", len(OPEN_CLASSES))
        self.open_prior = {c: 0.0 for c in OPEN_CLASSES} | {r["cat"]: r["p"] for r in known}
        self._shortcuts: dict[bool, Probe | None] = {}

    def compiled(self, name: str, kind: str, *fixed: bool):
        """A compiled stage that weighs with this model."""
        spark = self.cond.table.sparkSession
        smooth = spark.range(1).select(self.smooth).first()[0]
        values = {**VALUES, "open": OPEN_CLASSES, "open_prior": [float(self.open_prior[c]) for c in OPEN_CLASSES]}
        return jvm.function(name, kind, self.cond.shared(), self.prior.shared(), *fixed, smooth, values)

    def shortcut(self, fixed: bool) -> Probe | None:
        """Classes of unknown words by their neighbours alone; null where a lookup is by joins.

        Few words stand in a feature, and between the same tags all others get
        the same class. ``_between(own, left, right)`` gives it for the usual tags,
        and ``_in_feature(word)`` is there for each word that may stand in a
        feature. Words that end in -ly or -ing are such words with tags of their own
        (``GUESSED``). What is not listed is for the caller to work out.
        """
        if fixed not in self._shortcuts:
            self._shortcuts[fixed] = self._publish_shortcut(fixed) if self.cond.by == "in_row" else None
        return self._shortcuts[fixed]

    def _publish_shortcut(self, fixed: bool) -> Probe | None:
        cond = self.cond.publish()
        tags = lambda *more: F.explode(F.array(*[F.lit(t) for t in sorted({*COMMON_TAGS, *more})]))
        pairs = (
            self.cond.table.sparkSession.range(1)
            .select(tags("", BEGIN).alias("left"))
            .select("left", tags(END, *GUESSED).alias("right"))
        )
        at_end = F.array(F.lit("R_" + END)) if fixed else F.expr("cast(array() as array<string>)")
        names = F.transform(F.split("right", " "), lambda c: F.concat(F.lit("R_"), c))
        right = F.when(F.col("right") == END, at_end).otherwise(names)
        left = F.when(F.col("left") != "", F.array(F.concat(F.lit("L_"), "left"))).otherwise(F.slice(right, 1, 0))
        known = pairs.select("left", "right", _known(cond, F.concat(right, left)).alias("evidence"))
        evidence = F.col("evidence")

        def listed(own: str, chosen: Column) -> DataFrame:
            return known.select(_between(F.lit(own), F.col("left"), F.col("right")).alias("key"), chosen.alias("value"))

        def guessed(own: str) -> Column:
            cands = [F.struct(F.lit(c).alias("c"), F.lit("").alias("fine"), F.lit("").alias("lemma")) for c in own.split(" ")]
            return _best(with_priors(F.array(*cands), self.prior.publish()), evidence, self, fixed)["c"]

        chosen = listed("UN", _open_class(evidence, self, fixed))
        for own in GUESSED:
            chosen = chosen.union(listed(own, guessed(own)))
        parts = F.split(F.expr("substr(key, 3)"), "_")
        tails = F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "_"))
        words = (
            self.cond.table.filter("key like 'L\\\\_%' or key like 'R\\\\_%'")
            .select(F.explode(F.slice(tails, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("word"))
            .distinct()
            .select(_in_feature(F.col("word")).alias("key"), F.lit("").alias("value"))
        )
        table = Lookup(
            chosen.union(words), "key", F.col("value"), max_rows=self.cond.max_rows, max_bytes=self.cond.max_bytes
        )
        # The words of a model near the bound may be over it; all words are worked out then.
        return table.publish() if table.fits() else None


#: The tags of unknown words that end in -ly and -ing.
GUESSED = ("UN RB", "UN VB")
#: Coarse tags between which the classes of unknown words are listed.
COMMON_TAGS = ("UN", "VBD", "VBG", "VBN", "VBP", "PRP", "PRP$", "CC", "TO", "MD", "CD", "EX", "Fa", "Fi", "Fl", "Fr", *PLAIN_TAGS)


def _between(own: Column, left: Column, right: Column) -> Column:
    return F.concat(own, F.lit("<"), left, F.lit(">"), right)


def _in_feature(word: Column) -> Column:
    return F.concat(F.lit("_"), word)


#: The fixed values that the compiled stages read.
VALUES = {"plain_tags": PLAIN_TAGS, "border_tags": BORDER_TAGS}
_CAND = "struct<c:string,fine:string,lemma:string>"
LINES = f"array<struct<token:string,kind:int,lemma:string,tag:string,cands:array<{_CAND}>>>"


def line_info(analyses: Column, fixed: bool = False) -> Column:
    """Tagger lines of a post up to its last border.

    ``kind``: 0 one known analysis, 1 several, 2 unknown word, 3 border.
    ``cands`` holds one candidate per coarse tag, the last analysis winning.
    A mark without a tag makes no line.
    """
    return jvm.function("LineInfo", LINES, fixed, VALUES)(analyses)


def _starts_sentence(lines: Column, i: Column) -> Column:
    return (i == 0) | (F.get(lines, i - 1)["kind"] == 3)


def _word(x: Column, starts: Column) -> Column:
    """The word inside features: folded only at a sentence start."""
    return F.when(starts, F.lower(x["token"])).otherwise(x["token"])


def _right_features(lines: Column, x: Column, i: Column, word: Column, fixed: bool) -> Column:
    after = F.get(lines, i + 1)
    names = F.flatten(
        F.transform(
            after["cands"],
            lambda c: F.array(
                F.concat(F.lit("R_"), c["c"]), F.concat(F.lit("R_"), c["c"], F.lit("_"), word)
            ),
        )
    )
    at_end = F.array(F.lit("R_END")) if fixed else F.expr("cast(array() as array<string>)")
    return F.when(after["kind"] != 3, names).otherwise(at_end)


def _left_features(tag: Column, word: Column) -> Column:
    plain = F.concat(F.lit("L_"), tag)
    return F.when(tag == BEGIN, F.array(plain)).otherwise(
        F.array(plain, F.concat(plain, F.lit("_"), word))
    )


def context_features(lines: Column, fixed: bool = False) -> Column:
    """Every feature a post may look up, whatever tags get chosen."""
    return jvm.function("Features", "array<string>", fixed)(lines)


def _known(cond: Probe, names: Column) -> Column:
    return F.filter(F.transform(names, cond), lambda v: v.isNotNull())


def rank_candidates(cands: Column, evidence: Column, tables: PosTables, fixed: bool = False) -> Column:
    """Candidates (``c``, prior ``p``, ...) with the cost of the evidence.

    The least one wins: equal costs go to the higher prior, then to the tag
    that sorts first. ``cost`` is a negated log score, or ``-ZERO`` for none.
    """
    weight = 1 if fixed else 2  # the class prior counts twice in compat

    def ranked(c: Column) -> Column:
        given = lambda v: F.when(
            v["veto"].isNotNull() & c["c"].startswith(v["veto"]), F.lit(ZERO)
        ).otherwise(F.coalesce(F.element_at(v["lp"], c["c"]), tables.smooth))
        first = F.when(c["p"] > 0, F.ln(c["p"]) * weight).otherwise(F.lit(ZERO))
        total = F.aggregate(evidence, first, lambda a, v: a + given(v))
        cost = let(
            total, lambda t: F.when(t > ZERO / 10, -F.round(t, 9)).otherwise(F.lit(-ZERO))
        )
        return F.struct(
            F.when(F.size(evidence) > 0, cost).otherwise(F.lit(-ZERO)).alias("cost"),
            (-c["p"]).alias("rarity"),
            c["c"].alias("name"),
            c.alias("cand"),
        )

    return F.transform(cands, ranked)


def _best(cands: Column, evidence: Column, tables: PosTables, fixed: bool) -> Column:
    return F.array_min(rank_candidates(cands, evidence, tables, fixed))["cand"]


def _open_class(evidence: Column, tables: PosTables, fixed: bool) -> Column:
    """The class of an unknown word; without evidence every class scores nothing and the prior decides."""
    likeliest = min(OPEN_CLASSES, key=lambda c: (-tables.open_prior[c], c))
    cands = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(tables.open_prior[c]).alias("p")) for c in OPEN_CLASSES])
    best = _best(cands, evidence, tables, fixed)
    return F.when(F.size(evidence) > 0, best["c"]).otherwise(F.lit(likeliest))


def with_priors(cands: Column, prior: Probe) -> Column:
    return F.transform(
        cands,
        lambda c: F.struct(
            c["c"], F.coalesce(prior(c["c"]), F.lit(0.0)).alias("p"), c["fine"], c["lemma"]
        ),
    )


_RANK = "struct<cost:double,rarity:double,name:string,cand:struct<c:string,p:double,fine:string,lemma:string>>"
_SCORES = f"array<struct<i:int,lefts:array<struct<before:string,ranks:array<{_RANK}>>>>>"


def all_scores(lines: Column, tables: PosTables, cond: Probe, prior: Probe) -> Column:
    """Ranked candidates of each open word under every tag that may stand before it.

    ``(i, lefts)`` with ``lefts`` of ``(before, ranks)``: ``before`` is BEGIN at
    a sentence start and '' after an unknown word. Without evidence there are
    no ranks, as the prior alone decides then.
    """

    if tables.cond.by == "in_row":
        return tables.compiled("Scores", _SCORES)(lines)

    def of(xs: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            starts = _starts_sentence(xs, i)

            def scored(word: Column) -> Column:
                right = _known(cond, _right_features(xs, x, i, word, False))
                before = F.get(xs, i - 1)
                tags = (
                    F.when(starts, F.array(F.lit(BEGIN)))
                    .when(before["kind"] == 2, F.array(F.lit("")))
                    .otherwise(F.transform(before["cands"], lambda c: c["c"]))
                )
                open_ = F.transform(
                    F.array(*[F.lit(c) for c in OPEN_CLASSES]),
                    lambda c: F.struct(c.alias("c"), F.lit("").alias("fine"), F.lit("").alias("lemma")),
                )
                cands = with_priors(F.when(x["kind"] == 2, open_).otherwise(x["cands"]), prior)

                def under(tag: Column) -> Column:
                    left = F.when(tag != "", _known(cond, _left_features(tag, word)))
                    evidence = F.concat(right, F.coalesce(left, F.slice(right, 1, 0)))
                    ranks = let(
                        evidence, lambda e: F.when(F.size(e) > 0, rank_candidates(cands, e, tables))
                    )
                    return F.struct(tag.alias("before"), ranks.alias("ranks"))

                return F.transform(tags, under)

            choice = x["kind"].isin(1, 2)
            return F.struct(i.alias("i"), F.when(choice, let(_word(x, starts), scored)).alias("lefts"))

        return F.filter(F.transform(xs, one), lambda r: r["lefts"].isNotNull())

    return let(lines, of)


def tag_lines(
    lines: Column, tables: PosTables, cond: Probe, prior: Probe, fixed: bool = False
) -> Column:
    """One tagged line for each line.

    Only a word with several tags hands on what is not known ahead. So the
    left-to-right pass goes over those words and the unknown ones right behind
    them; all other lines are worked out where they stand.
    """
    listed = tables.shortcut(fixed)
    no_names = F.expr("cast(array() as array<string>)")

    def out(token: Column, lemma: Column, tag: Column) -> Column:
        return F.struct(token.alias("token"), lemma.alias("lemma"), tag.alias("tag"))

    def chosen(x: Column, i: Column, before: Column) -> Column:
        """Struct ``(c, lemma, tag)`` of a word that has a choice, after the tag ``before``."""
        word = _word(x, _starts_sentence(lines, i))

        def unknown(c: Column) -> Column:
            return F.struct(F.lit("").alias("c"), x["token"].alias("lemma"), c.alias("tag"))

        def one_of(b: Column) -> Column:
            return F.struct(b["c"].alias("c"), b["lemma"].alias("lemma"), b["fine"].alias("tag"))

        def weigh(evidence: Column) -> Column:
            best = _best(with_priors(x["cands"], prior), evidence, tables, fixed)
            return F.when(x["kind"] == 2, unknown(_open_class(evidence, tables, fixed))).otherwise(let(best, one_of))

        right = _known(cond, F.coalesce(_right_features(lines, x, i, word, fixed), no_names))
        left = F.when(before != "", _known(cond, _left_features(before, word)))
        weighed = let(F.concat(right, F.coalesce(left, F.slice(right, 1, 0))), weigh)
        if listed is None:
            return weighed
        tags = lambda cands: F.array_join(F.transform(cands, lambda c: c["c"]), " ")
        own = F.when(x["kind"] == 2, "UN").when(F.get(x["cands"], F.lit(0))["c"] == "UN", tags(x["cands"]))
        after = F.get(lines, i + 1)
        beside = (
            F.when(after["kind"] == 3, END)
            .when(F.size(after["cands"]) == 1, F.get(after["cands"], F.lit(0))["c"])
            .otherwise(tags(after["cands"]))
        )
        usual = F.when(listed(_in_feature(word)).isNull(), listed(_between(own, before, beside)))
        named = lambda c: F.get(F.filter(x["cands"], lambda k: k["c"] == c), F.lit(0))
        return let(
            usual,
            lambda c: F.when(c.isNull(), weighed).when(x["kind"] == 2, unknown(c)).otherwise(let(named(c), one_of)),
        )

    # A line with one tag hands on that tag, an unknown word none.
    handed = lambda i: F.when(F.get(lines, i - 1)["kind"] == 0, F.coalesce(F.get(F.get(lines, i - 1)["cands"], F.lit(0))["c"], F.lit(""))).otherwise("")

    def left_tag(i: Column, passed: Column | None) -> Column:
        first = F.when(_starts_sentence(lines, i), BEGIN)
        if passed is not None:
            first = first.when(F.get(lines, i - 1)["kind"] == 1, passed)
        return first.otherwise(handed(i))

    def depends(x: Column, i: Column) -> Column:
        return (x["kind"] == 1) | ((x["kind"] == 2) & (i > 0) & (F.get(lines, i - 1)["kind"] == 1))

    # The pass goes over places, not lines: a list of prepared lines would copy them all.
    def step(passed: Column, i: Column) -> Column:
        x = F.get(lines, i)
        return let(
            let(left_tag(i, passed), lambda before: chosen(x, i, before)),
            lambda b: F.struct(
                b["c"].alias("state"), F.struct(i.alias("at"), out(x["token"], b["lemma"], b["tag"]).alias("line")).alias("out")
            ),
        )

    places = F.filter(F.transform(lines, lambda x, i: F.when(depends(x, i), i)), lambda i: i.isNotNull())
    passed = scan(places, F.lit(""), step, f"struct<at:int,line:{TAGGED[len('array<') : -1]}>")

    def merged(done: Column) -> Column:
        # For each line up to the last of these its number among them, or -1.
        numbers = F.flatten(
            F.transform(
                done,
                lambda d, k: F.concat(
                    F.array_repeat(F.lit(-1), d["at"] - F.when(k > 0, F.get(done, k - 1)["at"]).otherwise(-1) - 1), F.array(k)
                ),
            )
        )

        def placed(numbers: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                alone = let(
                    let(left_tag(i, None), lambda before: chosen(x, i, before)),
                    lambda b: out(x["token"], b["lemma"], b["tag"]),
                )
                return (
                    F.when(F.get(numbers, i) >= 0, F.get(done, F.get(numbers, i))["line"])
                    .when(x["kind"] == 2, alone)
                    .otherwise(out(x["token"], x["lemma"], x["tag"]))
                )

            return F.transform(lines, one)

        return let(numbers, placed)

    return let(passed, merged)


def _lines(fixed: bool) -> Column:
    return line_info(F.col("analyses"), fixed)


def _feature_keys(fixed: bool) -> Column:
    return let(build_once(_lines, fixed), lambda xs: context_features(xs, fixed))


def _candidate_tags() -> Column:
    own = F.flatten(
        F.transform(build_once(_lines, False), lambda x: F.transform(x["cands"], lambda c: c["c"]))
    )
    return F.array_union(own, F.array(*[F.lit(c) for c in OPEN_CLASSES]))


def _tagged(tables: PosTables, cond: Probe, prior: Probe, fixed: bool) -> Column:
    return let(build_once(_lines, fixed), lambda xs: tag_lines(xs, tables, cond, prior, fixed))


def bind_tables(df: DataFrame, tables: PosTables, fixed: bool = False):
    """Make both model tables reachable over ``df``: ``(df, cond, prior)``."""
    df, cond = tables.cond.bind(df, build_once(_feature_keys, fixed))
    df, prior = tables.prior.bind(df, build_once(_candidate_tags))
    return df, cond, prior


def _compiled(tables: PosTables, fixed: bool) -> Column:
    return tables.compiled("Tag", TAGGED, fixed)(F.col("analyses"))


def tag(df: DataFrame, tables: PosTables, fixed: bool = False) -> DataFrame:
    """Add ``tagged``: one analysis per line, sentence borders included.

    With lookups in the row the compiled stage does it, with joins :func:`tag_lines`.
    """
    if tables.cond.by == "in_row":
        return df.withColumn("tagged", build_once(_compiled, tables, fixed))
    df, cond, prior = bind_tables(df, tables, fixed)
    return drop_bound(df.withColumn("tagged", build_once(_tagged, tables, cond, prior, fixed)))
