"""Tokenisation: ``normalized`` -> ``tokens``.

Substitutions over a whole sentence set off punctuation and mark clitics, the
marks are resolved token by token where there are any, and one split of the
whole post at white space follows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import build_once, chomp, let, split_all

# Character classes and word lists (fixed values).
PUNCT = "[,;«»“”'\"&\\$#=\\(\\)<>!¡\\?¿\\\\\\[\\]\\{\\}\\|\\^\\*\\-€·¬…]"
PUNCT_URL = "[:/~]"
S_HOSTS = "[Hh]e|[Hh]ere|[Hh]ow|[Ii]t|[Ss]he|[Tt]hat|[Tt]here|[Ww]hat|[Ww]hen|[Ww]here|[Ww]ho|[Ww]hy"

# Stand-ins for text that must survive the punctuation rules (fixed values).
CLITIC = "APOTEMP"
GENITIVE = "GENs"
STAND_INS = (
    ("3SUSP012", "..."),
    ("2DOBR111", "<<"),
    ("2DOBR222", ">>"),
    ("2DOBR333", "''"),
    ("2DOBR444", "``"),
    ("44DOTQUANT77", "."),
    ("44COMMQUANT77", ","),
    ("44QUOTQUANT77", "'"),
    (GENITIVE, "'s"),
)

# Ordered sentence substitutions (fixed values). The hyphen is in PUNCT, so the
# word-edge hyphens are set off by the same rule as any other mark.
SUBSTITUTIONS = (
    ("\\.\\.\\.", " 3SUSP012 "),
    ("<<", " 2DOBR111 "),
    (">>", " 2DOBR222 "),
    ("''", " 2DOBR333 "),
    ("``", " 2DOBR444 "),
    (f"(^| )({S_HOSTS})'s", f"$1$2{CLITIC}s"),
    ("(^| )([A-Z][a-z]+)'s", f"$1$2 {GENITIVE}"),
    ("([Ia-z])'(ve|ll|s|re|m|d|t)", f"$1{CLITIC}$2"),
    ("([0-9]+)\\.([0-9]+)", "$144DOTQUANT77$2 "),
    ("([0-9]+),([0-9]+)", "$144COMMQUANT77$2 "),
    ("([0-9]+)'([0-9]+)", "$144QUOTQUANT77$2 "),
    (f"({PUNCT})", " $1 "),
    (f"({PUNCT_URL})(?:\\s|$)", " $1 "),
    ("\\.$", " . "),
)

# Contracted words (fixed values): what the first letter is continued with.
CONTRACTIONS = (
    (("wanna", "Wanna"), "ant\nto"),
    (("cannot", "Cannot"), "an\nnot"),
    (("gonna", "Gonna"), "oing\nto"),
    (("gotta", "Gotta"), "ot\nto"),
    (("hafta", "Hafta"), "ave\nto"),
)
HAVE_CONTRACTIONS = ("coulda", "Coulda", "shoulda", "Shoulda", "woulda", "Woulda", "musta", "Musta")


# Sentences without any of these only need the punctuation rules.
NEEDS_ALL_RULES = "['0-9<>`\\x00-\\x08\\x0E-\\x1F]"
NEEDS_ALL_TEXTS = ("...", CLITIC, GENITIVE)

# The same substitutions as they are run. Those of a fixed text need no pattern,
# those of clitics and of numbers are tried where the sentence has such a place.
LITERAL_RULES = tuple((pattern.replace("\\", ""), mark) for pattern, mark in SUBSTITUTIONS[:5])
CLITIC_RULES = SUBSTITUTIONS[5:8]
NUMBER_RULES = SUBSTITUTIONS[8:11]
NUMBER = "[0-9][.,'][0-9]"
# The last three in one pass: each only sets a mark off, and one of PUNCT_URL
# has a blank behind it after the first of them where a mark of PUNCT follows.
PUNCT_RULE = (
    f"[{PUNCT[1:-1]}:/~.](?:(?<={PUNCT})|(?<={PUNCT_URL})(?=\\s|$|{PUNCT})|(?<=\\.)$)",
    " $0 ",
)

# Texts with a token that may be a contraction, or that holds a control character.
SINGLE_TOKENS = "[\\x00-\\x08\\x0E-\\x1F]|[at](?!\\S)(?<=nna|tta|fta|lda|sta|annot)"
# Tokens of one character, or of small letters behind any first letter, hold no mark.
PLAIN_TOKEN = "^(?:[A-Za-z]?[a-z]*+|[^\\x00-\\x20])$"


def _where(found: Callable[[Column], Column], rules, value: Column) -> Column:
    """``value`` with ``rules`` applied where ``found`` holds of it."""
    every = lambda s: reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, s)
    return let(value, lambda s: F.when(found(s), every(s)).otherwise(s))


def sentence_tokens(sentence: Column) -> Column:
    """Tokens of one sentence as a text with white space between them, clitics still marked."""
    marked = reduce(lambda c, rule: F.replace(c, F.lit(rule[0]), F.lit(rule[1])), LITERAL_RULES, chomp(sentence))
    marked = _where(lambda s: s.contains("'"), CLITIC_RULES, marked)
    marked = _where(lambda s: s.rlike(NUMBER), NUMBER_RULES, marked)
    return F.regexp_replace(marked, *PUNCT_RULE)


def restore(tokens: Column) -> Column:
    """In each token of a text the first of each stand-in back as what it stands for; a second one stays."""
    first = lambda t, pair: _where(lambda s: s.contains(pair[0]), [(f"(?<!\\S)(\\S*?){pair[0]}", f"$1{pair[1]}")], t)
    return reduce(first, STAND_INS, tokens)


def expand_clitics(token: Column, fixed: bool = False) -> Column:
    """Resolve a marked clitic or a contraction; parts are newline-separated.

    Compat keeps two slips: the clitics `'s` and `'d` lose their letter, and
    `wanna` begins with a digit.
    """

    def ends(suffix: str) -> Column:
        return token.endswith(CLITIC + suffix)

    if fixed:
        other = F.regexp_replace(token, f"([A-Za-z]){CLITIC}([a-z])", "$1\n'$2")
    else:
        other = F.regexp_replace(token, f"([a-z]){CLITIC}([a-z])", "$1\n'2")
    negated = (
        F.when(
            token.rlike(f"^(?:[Cc]a|[Ww]o)n{CLITIC}"),
            F.regexp_replace(
                F.regexp_replace(token, f"^(.)an{CLITIC}t", "$1an\nnot"),
                f"^(.)on{CLITIC}t",
                "$1ill\nnot",
            ),
        )
        .when(
            token.contains(f"n{CLITIC}"),
            F.regexp_replace(token, f"^(.*?)n{CLITIC}t(.*)$", "$1\nnot$2"),
        )
        .otherwise(F.regexp_replace(token, f"([a-z]){CLITIC}([a-z])", "$1\nnot"))
    )
    marked = (
        F.when(ends("t"), negated)
        .when(ends("ve"), F.replace(token, F.lit(CLITIC + "ve"), F.lit("\nhave")))
        .when(ends("re"), F.replace(token, F.lit(CLITIC + "re"), F.lit("\nare")))
        .when(ends("ll"), F.replace(token, F.lit(CLITIC + "ll"), F.lit("\nwill")))
        .when(ends("m"), F.regexp_replace(token, f"^(.*?){CLITIC}m(.*)$", "$1\nam$2"))
        .otherwise(other)
    )
    return F.when(token.contains(CLITIC), marked).otherwise(expand_contractions(token, fixed))


def expand_contractions(token: Column, fixed: bool = False) -> Column:
    have = F.regexp_replace(token, "a$", "\nhave")
    chain = F.when(token.isin(*HAVE_CONTRACTIONS), have)
    for words, rest in CONTRACTIONS:
        head = F.lit("1") if words[0] == "wanna" and not fixed else F.left(token, F.lit(1))
        chain = chain.when(token.isin(*words), F.concat(head, F.lit(rest)))
    every = [w for words, _ in CONTRACTIONS for w in words] + list(HAVE_CONTRACTIONS)
    return F.when(token.isin(*every), chain).otherwise(token)


def word_tokens(sentence: Column, fixed: bool = False) -> Column:
    """Final tokens of one sentence as a text with white space between them.

    Tokens are looked at one by one only where one of them may be a clitic or a
    contraction, or may lose a control character.
    """

    def resolved(t: Column) -> Column:
        return F.when(t.rlike(PLAIN_TOKEN), expand_contractions(t, fixed)).otherwise(chomp(expand_clitics(t, fixed)))

    def each(text: Column) -> Column:
        one_by_one = F.array_join(F.transform(split_all(text, "\\s"), resolved), "\n")
        return F.when(text.contains(CLITIC) | text.rlike(SINGLE_TOKENS), one_by_one).otherwise(text)

    needs_all = reduce(lambda c, held: c | sentence.contains(held), NEEDS_ALL_TEXTS, sentence.rlike(NEEDS_ALL_RULES))
    plain = F.regexp_replace(F.trim(sentence), *PUNCT_RULE)
    return let(F.when(needs_all, restore(sentence_tokens(sentence))).otherwise(plain), each)


def flatten_tokens(sentences: Column) -> Column:
    """All tokens of a post; each sentence that has a token, if an empty one, ends in a newline beforehand.

    Joining and cutting at white space separates clitic parts and removes empty
    tokens; only an empty one at the very start of a post stays.
    """
    ended = lambda text: F.when((text == "") | text.rlike("\\S"), F.concat(text, F.lit("\n"))).otherwise("")
    marked = F.transform(sentences, lambda s: let(word_tokens(s), ended))
    return split_all(F.array_join(marked, "\n"), "\\s")


def _tokens() -> Column:
    return flatten_tokens(F.col("normalized"))


def _tokens_by_sentence() -> Column:
    parts = F.transform(
        "normalized",
        lambda s: F.filter(F.split(word_tokens(s, True), "\\s+", -1), lambda t: t != ""),
    )
    return let(parts, lambda p: F.struct(p.alias("by"), F.flatten(p).alias("every")))


def tokenize(df: DataFrame, fixed: bool = False) -> DataFrame:
    """Add ``tokens``; ``fixed`` also adds ``sentence_tokens``.

    Compat forgets sentence ends here, so ``tokens`` is one list per post.
    """
    if not fixed:
        return df.withColumn("tokens", build_once(_tokens))
    return df.withColumn("_t", build_once(_tokens_by_sentence)).select(
        *df.columns, F.col("_t.every").alias("tokens"), F.col("_t.by").alias("sentence_tokens")
    )
