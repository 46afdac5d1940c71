"""Names, quantities, money, dates and dictionary analyses: ``tokens`` -> ``analyses``.

Every position first gets its own outcome from the tokens around it, all
positions at once. A position may claim a span of following tokens; the only
sequential part is choosing, left to right, which claims stand, and it runs
over the claims alone, which are few.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jvm
from tidemark.functions.lookup import Lookup, Probe, drop_bound
from tidemark.functions.text import LOWER, UPPER, build_once, fold_case, let, scan, truthy
from tidemark.operators.tokens import PUNCT, PUNCT_URL
from tidemark.schema import ANALYSES, RECOGNISED

# Word lists and limits (fixed values).
MAX_NAME = 10
PREPOSITIONS = ("de", "del", "of")
ARTICLES = ("el", "la", "los", "las", "the")
CURRENCY = ("euro", "euros", "peseta", "pesetas", "€", "dollar", "dollars", "pound", "pounds")
MEASURE = (
    "kg", "kilogram", "gram", "g", "centimeter", "cm", "hour", "second", "minute",
    "ton", "tn", "meter", "km", "kilometer", "%",
)
QUANTITY = (
    "hundred", "hundreds", "thousand", "thousands", "million", "millions",
    "bilion", "billions", "trillion", "trillions",
)
NUMBER_WORDS = (
    "two", "three", "four", "five", "six", "eight", "nine", "ten", "eleven", "twelve",
    "thirteen", "fourteen", "fifteen", "sixteen", "eighteen", "nineteen", "twenty",
    "hundred", "thousand",
)
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
)
BOUNDARY = ("#SENT#", "<blank>", '"', "“", "«", ".", "-", "?", "!", ":", "``")
CAPS_END = ("#SENT#", "<blank>", '"', "»", "”", ".", "-", "?", "!", ":")
QUOTE_OPEN = ('"', "“", "«", "'")
QUOTE_CLOSE = "[\"»”']"

# Punctuation tags (fixed values); marks not listed get an empty tag.
PUNCT_TAGS = {
    ".": "Fp", ",": "Fc", ":": "Fd", ";": "Fx", "-": "Fg", "--": "Fg",
    "'": "Fe", '"': "Fe", "``": "Fe", "''": "Fe", "...": "Fs",
    "<<": "Fra", "«": "Fra", "“": "Fra", ">>": "Frc", "»": "Frc", "”": "Frc",
    "/": "Fh", "\\": "Fh", "(": "Fpa", ")": "Fpt", "¿": "Fia", "?": "Fit",
    "¡": "Faa", "!": "Fat", "[": "Fca", "]": "Fct", "{": "Fla", "}": "Flt", "…": "Fz",
}
UNTAGGED = ("&", "$", "#", "=", "<", ">", "|", "^", "*", "€", "·", "¬", "~")

_either = "|".join
_PREP_END = f"_(?:{_either(PREPOSITIONS)})$"
_PREP_ART_END = f"_(?:{_either(PREPOSITIONS)})_(?:{_either(ARTICLES)})$"


def punct_tag(token: Column) -> Column:
    """Tag of a punctuation token; null for any other token."""
    by_tag: dict[str, list[str]] = {"": list(UNTAGGED)}
    for mark, tag in PUNCT_TAGS.items():
        by_tag.setdefault(tag, []).append(mark)
    chain = reduce(
        lambda c, item: c.when(token.isin(*item[1]), item[0]), by_tag.items(), F
    )
    return F.when(token.isin(*PUNCT_TAGS, *UNTAGGED), chain)


def _closed_classes() -> dict[str, dict[str, object]]:
    """Folded word -> the closed classes it belongs to."""
    classes: dict[str, dict[str, object]] = {}

    def put(words, **values):
        for w in words:
            classes.setdefault(w, {}).update(values)

    put([m + s for m in MEASURE for s in ("", "s", ".")], unit="meas")
    put(QUANTITY, unit="quant")
    put(CURRENCY, unit="curr")
    put(["$"], unit="$")
    put(PREPOSITIONS, prep=True)
    put(ARTICLES, art=True)
    put(MONTHS, month=True)
    put(NUMBER_WORDS, number=True)
    for mark in UNTAGGED:
        put([mark], mark="")
    for mark, tag in PUNCT_TAGS.items():
        put([mark], mark=tag)
    return classes


_CLOSED = (
    "array<struct<word:string,unit:string,mark:string,prep:boolean,art:boolean,"
    "month:boolean,number:boolean>>"
)


def word_table(dictionary: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """One row per folded word: all the recogniser needs to know of it.

    ``noamb`` lists the spellings that are always a proper noun, since that
    test is the one made on the token as written.
    """
    exact = F.col("form") == F.col("word")
    own = F.struct(F.lit(1).alias("hit"), F.col("analyses"), F.col("is_stop"))
    forms = (
        dictionary.withColumn("word", fold_case(F.col("form")))
        .groupBy("word")
        .agg(
            F.max(F.when(exact, own)).alias("own"),
            F.array_sort(F.collect_set(F.when(F.col("is_noamb"), F.col("form")))).alias("noamb"),
        )
    )
    names = ambiguous.select("word").distinct().withColumn("ambiguous", F.lit(True))
    rows = json.dumps([{"word": w, **c} for w, c in _closed_classes().items()])
    closed = dictionary.sparkSession.range(1).select(F.inline(F.from_json(F.lit(rows), _CLOSED)))
    no = F.lit(False)
    flag = lambda name: F.coalesce(name, no).alias(name)
    return (
        forms.join(names, "word", "full")
        .join(closed, "word", "full")
        .select(
            "word",
            F.struct(
                F.col("own.analyses").alias("analyses"),
                F.coalesce("own.is_stop", no).alias("stop"),
                flag("ambiguous"),
                F.coalesce("noamb", F.expr("cast(array() as array<string>)")).alias("noamb"),
                F.coalesce(
                    F.get("own.analyses", F.lit(0))["lemma"].startswith("Z"), no
                ).alias("z_lemma"),
                "unit",
                "mark",
                (
                    F.coalesce("month", no)
                    | F.coalesce("number", no)
                    | F.coalesce(F.get("own.analyses", F.lit(0))["lemma"].startswith("Z"), no)
                ).alias("special"),
                *[flag(n) for n in ("prep", "art", "month", "number")],
            ).alias("entry"),
        )
    )


def word_lookup(dictionary: DataFrame, ambiguous: DataFrame, **bounds) -> Lookup:
    return Lookup(word_table(dictionary, ambiguous), "word", F.col("entry"), **bounds)


# Shape bits of a token as written.
UP, WORD, CAPS, BOUND, DIGIT, MARK = (1 << k for k in range(6))
TEXT_BOUNDS = ("#SENT#", "<blank>", "")


class Token:
    """Reads one element of :func:`token_info`; every test is null past the ends."""

    def __init__(self, row: Column):
        self.row = row
        self.t, self.lo = row["t"], row["lo"]
        self.analyses = row["d"]["analyses"]
        self.exists = row.isNotNull()

    def _has(self, bit: int) -> Column:
        return self.row["shape"].bitwiseAND(bit) != 0

    def _flag(self, name: str) -> Column:
        return F.coalesce(self.row["d"][name], F.lit(False))

    up = property(lambda self: self._has(UP))
    word = property(lambda self: self._has(WORD))
    caps = property(lambda self: self._has(CAPS))
    bound = property(lambda self: self._has(BOUND))
    number = property(
        lambda self: self._has(DIGIT) | (self._flag("number") & (self.t == self.lo))
    )
    mark = property(lambda self: self.row["d"]["mark"])
    known = property(lambda self: self.analyses.isNotNull())
    noamb = property(
        lambda self: F.coalesce(F.array_contains(self.row["d"]["noamb"], self.t), F.lit(False))
    )

    def __getattr__(self, name: str) -> Column:
        if name in ("stop", "ambiguous", "prep", "art", "month", "z_lemma", "special"):
            return self._flag(name)
        raise AttributeError(name)

    def unit(self, kind: str) -> Column:
        return self.row["d"]["unit"] == kind

    def year(self) -> Column:
        return self.t.rlike("^[0-9]{4,}$")


def token_info(tokens: Column, probe: Probe) -> Column:
    """Per token: text, folded text, table entry and shape bits.

    A token of plain lower-case letters, the usual case, has no shape bits, so
    only other tokens are tested for them.
    """

    def shape(t: Column) -> Column:
        tests = (
            (UP, t.rlike(f"^{UPPER}")),
            (WORD, t.rlike(f"^{UPPER}{LOWER}")),
            (CAPS, t.rlike(f"^{UPPER}+$")),
            (BOUND, t.isin(*TEXT_BOUNDS)),
            (DIGIT, t.rlike("[0-9]")),
        )
        bits = reduce(lambda a, b: a + b, [F.when(c, b).otherwise(0) for b, c in tests])
        of_mark = F.when(t.isin(*BOUNDARY), MARK | BOUND).otherwise(MARK)
        return F.when(t.rlike("^[a-z]+$"), 0).when(t.isin(*PUNCT_TAGS, *UNTAGGED), of_mark).otherwise(bits)

    return F.transform(
        tokens,
        lambda t: F.struct(
            t.alias("t"), F.lower(t).alias("lo"), probe(F.lower(t)).alias("d"), shape(t).alias("shape")
        ),
    )


def _number_span(at, z: Column, month: Column, fixed: bool) -> Column:
    """How many following tokens a number or month takes, and the tag."""
    n1, n2, n3, n4 = (at(k) for k in range(1, 5))
    year_in = lambda x: x.t.rlike("[0-9]{4}")
    of, de = n1.lo == "of", n1.lo == "de"
    after_number = (
        (n1.unit("meas"), 1, "Zu"),
        (n1.unit("quant") & n2.unit("meas"), 2, "Zu"),
        (n1.unit("curr") | n1.unit("$"), 1, "Zm"),
        (n1.unit("quant") & (n2.lo == "de") & n3.unit("curr"), 3, "Zm"),
        (n1.unit("quant") & n2.unit("curr"), 2, "Zm"),
        (de & n2.unit("curr"), 2, "Zm"),
        (n1.unit("quant"), 1, "Z"),
        (of & n2.month & (n3.t == ",") & year_in(n4), 4, "W"),
        (of & n2.month & year_in(n3), 3, "W"),
        (n1.month & n2.year(), 2, "W"),
        (of & n2.month, 2, "W"),
        (n1.month, 1, "W"),
    )
    after_month = [(of & n2.year(), 2, "W")]
    if fixed:
        after_month += [(c, n, "W") for c, n, _ in _month_first(at)]

    def chain(rules) -> Column:
        return reduce(
            lambda c, r: c.when(r[0], F.struct(F.lit(r[1]).alias("len"), F.lit(r[2]).alias("tag"))),
            rules,
            F,
        )

    none = F.struct(F.lit(0).alias("len"), F.lit("").alias("tag"))
    return F.coalesce(F.when(z, chain(after_number)).when(month, chain(after_month)), none)


def _month_first(at):
    """Month-first dates: condition, tokens taken, and the day's token."""
    n1, n2, n3, n4 = (at(k) for k in range(1, 5))
    the = n1.lo == "the"
    return (
        (the & n2.number & (n3.t == ",") & n4.year(), 4, n2.t),
        (the & n2.number & n3.year(), 3, n2.t),
        (n1.number & n2.year(), 2, n1.t),
    )


def _quoted_length(info: Column, i: Column) -> Column:
    """Tokens of a quoted title that starts here (2 to 6), else 0."""
    at = lambda k: Token(F.get(info, i + k))
    closes = lambda k: at(k).t.rlike(QUOTE_CLOSE)
    capitals = at(1).up
    chain = F.when(capitals & closes(2), 2)
    for n in (3, 4, 5):
        capitals = capitals & at(n - 1).up
        chain = chain.when(capitals & closes(n), n)
    chain = chain.when(capitals & truthy(at(5).t) & closes(6), 6)
    opens = F.left(at(-1).t, F.lit(1)).isin(*QUOTE_OPEN)
    return F.coalesce(F.when(at(0).up & opens, chain), F.lit(0))


def _run_length(info: Column, i: Column, base: Column) -> Column:
    """Tokens in the run of capitalised words, prepositions and articles that
    starts at ``base``; anything over the limit counts as one too many."""
    after = Token(F.get(info, base + 1))
    has_mark = lambda x: x["t"].rlike(PUNCT)
    start = F.struct(
        F.lit(1).alias("count"),
        F.lit(True).alias("open"),
        F.exists(F.slice(info, i + 1, base - i + 1), has_mark).alias("marked"),
        ((base == i) & Token(F.get(info, i)).prep).alias("after_prep"),
    )

    def step(acc: Column, row: Column) -> Column:
        x = Token(row)
        joins = (~x.art | acc["after_prep"]) & ((x.word & ~acc["marked"]) | x.prep | x.art)
        goes_on = acc["open"] & joins
        return F.when(
            goes_on,
            F.struct(
                (acc["count"] + 1).alias("count"),
                goes_on.alias("open"),
                (acc["marked"] | has_mark(row)).alias("marked"),
                x.prep.alias("after_prep"),
            ),
        ).otherwise(
            F.struct(
                acc["count"].alias("count"),
                F.lit(False).alias("open"),
                acc["marked"].alias("marked"),
                acc["after_prep"].alias("after_prep"),
            )
        )

    walk = F.aggregate(F.slice(info, base + 2, MAX_NAME), start, step, lambda a: a["count"])
    return F.when(after.word | after.prep | after.art, walk).otherwise(1)


def _joined(info: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.transform(F.slice(info, start + 1, length), lambda x: x["t"]), "_")


def _name(info: Column, row: Column, i: Column, quoted: Column, runs: Column) -> Column:
    """Struct ``(end, text)`` after the quoted-title and name-run merges."""
    base = i + F.greatest(quoted - 1, F.lit(0))
    alone = F.struct(
        base.cast("int").alias("end"),
        F.when(quoted > 0, _joined(info, i, quoted)).otherwise(row["t"]).alias("text"),
    )

    def merged(count: Column) -> Column:
        def shaped(text: Column) -> Column:
            unusual = text.rlike(f"{PUNCT}_") & text.rlike(f"{PUNCT_URL}_")
            cut = lambda drop, shown: F.struct(
                (base + count - 1 - drop).cast("int").alias("end"), shown.alias("text")
            )
            return (
                F.when(unusual, alone)
                .when(~text.rlike(_PREP_END) & ~text.rlike(_PREP_ART_END), cut(0, text))
                .when(text.rlike("(?i)" + _PREP_END), cut(1, F.regexp_replace(text, _PREP_END, "")))
                .otherwise(cut(2, F.regexp_replace(text, "(?i)" + _PREP_ART_END, "")))
            )

        whole = _joined(info, i, base - i + count)
        return F.when((count > 1) & (count <= MAX_NAME), let(whole, shaped)).otherwise(alone)

    return F.when(runs, let(_run_length(info, i, base), merged)).otherwise(alone)


def _one(lemma: Column, tag: Column) -> Column:
    return F.array(F.struct(lemma.alias("lemma"), tag.alias("tag")))


def _outcome(info: Column, row: Column, i: Column, fixed: bool) -> Column:
    """What position ``i`` yields if the pass reaches it.

    ``entry`` is the token or merged span; ``claim`` says how far it reaches.
    Null for a word that stands alone (:func:`_alone`), as most do.
    """
    x = Token(row)
    before, after = Token(F.get(info, i - 1)), Token(F.get(info, i + 1))
    pair = x.caps & x.known
    caps_run = pair & (
        (after.caps & after.known) | (before.caps & before.known & after.t.isin(*CAPS_END))
    )
    caps_run = F.coalesce(caps_run, F.lit(False))
    free_capital = x.up & ~x.stop
    at_start = F.coalesce(before.bound, F.lit(False))
    first_tag = (
        F.when(x.t == "I", "UNK")
        .when(caps_run, "UNK")
        .when(x.up & x.noamb, "NNP")
        .when(free_capital & before.exists & ~at_start & (before.t != "..."), "NNP")
        .when(((free_capital & at_start) | (i == 0)) & (~x.known | x.ambiguous), "NNP")
        .otherwise("")
    )
    runs = x.word & ~(at_start & x.known & ~x.ambiguous)

    def finish(p: Column) -> Column:
        end, text = p["name"]["end"], p["name"]["text"]
        merged = end > i
        at = lambda k: Token(F.get(info, end + k))
        tag = (
            F.when(text.rlike("\\S_\\S"), "NNP").when(p["tag"] == "", "UNK").otherwise(p["tag"])
        )
        listed = (tag == "UNK") & ~merged & x.known
        number = F.when(merged, text.rlike("[0-9]")).otherwise(x.number)
        z = number | (listed & x.z_lemma)
        month = x.month & ~merged
        plain = (
            F.when(~merged & x.mark.isNotNull(), _one(text, x.mark))
            .when(number, _one(text, F.lit("Z")))
            .when(listed, x.analyses)
            .otherwise(_one(F.lower(text), tag))
        )

        def spanned(span: Column) -> Column:
            long = F.concat(text, F.lit("_"), _joined(info, end + 1, span["len"]))
            taken = span["len"] > 0
            late = F.lit(None).cast(_LATE) if fixed else _late_date(at, text, month)
            return F.struct(
                F.struct(
                    F.when(taken, long).otherwise(text).alias("token"),
                    F.when(taken, _one(F.lower(long), span["tag"])).otherwise(plain).alias("analyses"),
                ).alias("entry"),
                F.struct(
                    i.alias("start"),
                    end.alias("name_end"),
                    (end + span["len"]).alias("end"),
                    z.alias("number"),
                    text.alias("text"),
                    late.alias("late"),
                ).alias("claim"),
            )

        return let(_number_span(at, z, month, fixed), spanned)

    quoted = F.when(caps_run, 0).otherwise(_quoted_length(info, i))
    named = let(
        quoted,
        lambda q: F.struct(
            F.when(q > 0, "").otherwise(first_tag).alias("tag"),
            _name(info, row, i, q, runs).alias("name"),
        ),
    )
    lone_word = (row["shape"].bitwiseAND(UP | DIGIT) == 0) & (i > 0) & ~x.special
    return F.when(~lone_word, let(named, finish))


def _alone(row: Column) -> Column:
    """The entry of a word that stands alone."""
    x = Token(row)
    unknown = lambda: F.coalesce(x.analyses, _one(x.lo, F.lit("UNK")))
    return F.struct(
        x.t.alias("token"),
        F.when(row["shape"] == 0, unknown())
        .when(x.mark.isNotNull(), _one(x.t, x.mark))
        .when(x.t.rlike("\\S_\\S"), _one(x.lo, F.lit("NNP")))
        .otherwise(unknown())
        .alias("analyses"),
    )


_ENTRY = f"struct<token:string,analyses:{ANALYSES}>"
_LATE = f"struct<day:string,reach:int,entry:{_ENTRY}>"
_CLAIM = f"struct<start:int,name_end:int,end:int,number:boolean,text:string,late:{_LATE}>"


def _late_date(at, text: Column, month: Column) -> Column:
    """A month-first date that stands only if its day was already part of an
    earlier number in the same post."""

    def found(reach: int, day: Column) -> Column:
        parts = [text] + [at(k).t for k in range(1, reach + 1)]
        whole = F.concat_ws("_", *parts)
        return F.struct(
            day.alias("day"),
            F.lit(reach).alias("reach"),
            F.struct(
                whole.alias("token"), _one(F.lower(whole), F.lit("W")).alias("analyses")
            ).alias("entry"),
        )

    return F.when(month, reduce(lambda c, r: c.when(r[0], found(r[1], r[2])), _month_first(at), F))


_KEPT = "struct<lead:int,start:int,at:int,late:boolean>"


def _choose(outcomes: Column) -> Column:
    """Walk the claims left to right and keep those that start on free ground.

    The pass carries three places and emits three for each claim kept; entries
    are put together outside it. The numbers read so far matter only where a
    late date asks for one, so only those that some date asks for are carried.
    """

    def matters(o: Column) -> Column:
        c = o["claim"]
        return o["claim"].isNotNull() & ((c["end"] > c["start"]) | c["number"] | c["late"].isNotNull())

    no_days = F.expr("cast(array() as array<string>)")
    start = F.struct(
        F.lit(0).alias("free"), F.lit(-1).alias("name_end"), no_days.alias("days")
    )

    def walk(claims: Column) -> Column:
        asked = F.array_distinct(
            F.filter(F.transform(claims, lambda c: c["late"]["day"]), lambda d: d.isNotNull())
        )

        def step(asked: Column) -> Column:
            def one(state: Column, c: Column) -> Column:
                late = F.coalesce(F.array_contains(state["days"], c["late"]["day"]), F.lit(False))
                end = F.when(late, c["start"] + c["late"]["reach"]).otherwise(c["end"])
                grown = c["number"] & (c["end"] > c["name_end"])
                others = F.array_remove(state["days"], c["text"])
                days = F.when(
                    F.array_contains(asked, c["text"]),
                    F.when(grown, F.concat(others, F.array(c["text"]))).otherwise(others),
                ).otherwise(state["days"])
                taken = F.struct(
                    F.struct(
                        (end + 1).cast("int").alias("free"), c["name_end"].alias("name_end"), days.alias("days")
                    ).alias("state"),
                    F.struct(
                        state["free"].alias("lead"), c["start"].alias("start"), c["at"].alias("at"), late.alias("late")
                    ).alias("out"),
                )
                passed = F.struct(state.alias("state"), F.lit(None).cast(_KEPT).alias("out"))
                return F.when(c["start"] >= state["free"], taken).otherwise(passed)

            steps = scan(claims, start, one, _KEPT)
            return F.filter(steps, lambda k: k.isNotNull())

        def finish(kept: Column) -> Column:
            # What the pass ends with follows from the last claim kept.
            last = F.get(kept, F.size(kept) - 1)
            claim = lambda k: F.get(outcomes, k["at"])["claim"]
            end = F.when(last["late"], last["start"] + claim(last)["late"]["reach"]).otherwise(claim(last)["end"])
            return F.struct(
                F.when(F.size(kept) > 0, (end + 1).cast("int")).otherwise(0).alias("free"),
                F.when(F.size(kept) > 0, claim(last)["name_end"]).otherwise(-1).alias("name_end"),
                kept.alias("kept"),
            )

        return let(let(asked, step), finish)

    def small(o: Column, at: Column) -> Column:
        """A claim without its entries, and where it stands."""
        c = o["claim"]
        late = F.when(
            c["late"].isNotNull(), F.struct(c["late"]["day"].alias("day"), c["late"]["reach"].alias("reach"))
        )
        named = F.struct(
            *[c[f].alias(f) for f in ("start", "name_end", "end", "number", "text")], late.alias("late"), at.alias("at")
        )
        return F.when(matters(o), named)

    claims = F.filter(F.transform(outcomes, small), lambda c: c.isNotNull())
    return let(claims, walk)


def recognise_tokens(tokens: Column, probe: Probe, fixed: bool = False) -> Column:
    """Recogniser output for one token list."""

    def pieces(info: Column, outcomes: Column, chosen: Column) -> Column:
        size = F.size(info)
        # Places first, then one entry for each: lists of entries would copy them at each joint.
        place = lambda i, late: F.struct(i.cast("int").alias("i"), late.alias("late"))
        none = F.expr("cast(array() as array<struct<i:int,late:boolean>>)")
        upto = lambda lo, hi: F.when(
            hi > lo, F.transform(F.sequence(lo, hi - 1), lambda i: place(i, F.lit(False)))
        ).otherwise(none)
        held = F.flatten(
            F.transform(
                chosen["kept"],
                lambda c: F.concat(upto(c["lead"], c["start"]), F.array(place(c["at"], c["late"]))),
            )
        )
        rest = upto(chosen["free"], size)

        def entry(p: Column) -> Column:
            o = F.get(outcomes, p["i"])
            return (
                F.when(o.isNull(), _alone(F.get(info, p["i"])))
                .when(p["late"], o["claim"]["late"]["entry"])
                .otherwise(o["entry"])
            )

        last = F.element_at(info, -1)["t"]
        # A post ending inside a number gets no closing mark in compat.
        closes = (last != ".") & (last != "")
        if not fixed:
            closes = closes & ((chosen["free"] < size) | (chosen["name_end"] == size - 1))
        blank = F.array(
            F.struct(
                F.lit("<blank>").alias("token"), _one(F.lit("<blank>"), F.lit("Fp")).alias("analyses")
            )
        )
        nothing = F.expr(f"cast(array() as {RECOGNISED})")
        body = F.filter(F.transform(F.concat(held, rest), entry), lambda e: e["token"] != "")
        return F.concat(body, F.when(closes, blank).otherwise(nothing))

    def run(info: Column) -> Column:
        outcomes = F.transform(info, lambda x, i: _outcome(info, x, i, fixed))
        return let(outcomes, lambda o: let(_choose(o), lambda c: pieces(info, o, c)))

    nothing = F.expr(f"cast(array() as {RECOGNISED})")
    return F.when(F.size(tokens) > 0, let(token_info(tokens, probe), run)).otherwise(nothing)


def _found(probe: Probe, fixed: bool) -> Column:
    if not fixed:
        return recognise_tokens(F.col("tokens"), probe)
    return F.flatten(F.transform("sentence_tokens", lambda s: recognise_tokens(s, probe, True)))


#: The fixed values that the compiled recogniser reads.
_VALUES = {
    "max_name": MAX_NAME,
    "upper": UPPER,
    "lower": LOWER,
    "punct": PUNCT,
    "punct_url": PUNCT_URL,
    "prep_end": _PREP_END,
    "prep_art_end": _PREP_ART_END,
    "quote_close": QUOTE_CLOSE,
    "marks": [*PUNCT_TAGS, *UNTAGGED],
    "boundary": BOUNDARY,
    "text_bounds": TEXT_BOUNDS,
    "caps_end": CAPS_END,
    "quote_open": QUOTE_OPEN,
}


def _compiled(words: Lookup, fixed: bool) -> Column:
    found = jvm.function("Recognise", RECOGNISED, words.shared(), fixed, _VALUES)
    return found(F.col("sentence_tokens" if fixed else "tokens"))


def recognise(df: DataFrame, words: Lookup, fixed: bool = False) -> DataFrame:
    """Add ``analyses``: one entry per token or merged span.

    ``words`` comes from :func:`word_lookup`. With ``fixed`` each sentence is
    read on its own (from ``sentence_tokens``) and always closes. With lookups
    in the row the compiled stage does it, with joins the expressions above.
    """
    if words.by == "in_row":
        return df.withColumn("analyses", build_once(_compiled, words, fixed))
    df, probe = words.bind(df, F.transform("tokens", F.lower))
    return drop_bound(df.withColumn("analyses", build_once(_found, probe, fixed)))
