"""Normalisation of noisy social text: ``sentences`` -> ``normalized``.

Each word loses stretched letters, then is recognised as an emoticon, laughter,
markup, a link or a mention. The rules are one regular expression each, so a
word passes them as one chain of built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import build_once, let

POSITIVE = "EMOT_POS"
NEGATIVE = "EMOT_NEG"

# Stretched letters (fixed values): the run that triggers the rule, per letter.
# `i` only counts after a `u`, and what it collapses is a run of two or more.
TRIGGERS = (
    ("a", "aa"),
    ("A", "AA"),
    ("e", "eee"),
    ("E", "EEE"),
    ("i", "ui"),
    ("I", "UI"),
    ("o", "ooo"),
    ("O", "OOO"),
    ("u", "uu"),
    ("U", "UU"),
)
VOWEL = "[aeiouAEIOU]"
FIXED_RUNS = tuple((x, x * (3 if x in "eEoO" else 2)) for x, _ in TRIGGERS)

# Whole-word patterns (fixed values), first match wins, with what replaces them.
WORD_RULES = (
    ("^[Xx:;][Oo-]?[Dd\\])]+$", POSITIVE),
    ("^[Xx:;][Oo-]?[\\[(]+$", NEGATIVE),
    ("^[Dd][Oo-]?[Xx:;]$", NEGATIVE),
    ("^[AJaj]{4,}$", POSITIVE),
    ("^[EJej]{4,}$", POSITIVE),
    ("^[IJij]{4,}$", POSITIVE),
    ("^[AHah]{4,}$", POSITIVE),
    ("^[EHeh]{4,}$", POSITIVE),
    ("^[IHih]{4,}$", POSITIVE),
    ('^"$', ""),
    ("^\\]\\]$", ""),
    ("^!\\[CDATA\\[$", ""),
    ("^[\\s\\W]?(?:news|http|https|ftp|ftps)://\\S*$", " "),
    ('^[\\s"“]?[@#]\\S*$', " "),
)
TAIL = "[^,.][,.]$"


def collapse(word: Column, fixed: bool = False) -> Column:
    """Shorten stretched vowels.

    Compat handles the first run of a letter only, and loses what stands before
    the last earlier occurrence of that letter.
    """
    if fixed:
        return reduce(lambda w, r: F.regexp_replace(w, f"{r[1]}+", r[0]), FIXED_RUNS, word)
    return reduce(
        lambda w, r: F.regexp_replace(
            w, f"^(?=.*{r[1]}).*?([^{r[0]}]*){r[0]}{r[0]}+(.*)$", f"$1{r[0]}$2"
        ),
        TRIGGERS,
        word,
    )


def rewrite(word: Column, fixed: bool = False) -> Column:
    """Emoticon, laughter, markup, link and mention rules for one word."""
    chain = F.when(word.rlike(WORD_RULES[0][0]), WORD_RULES[0][1])
    for pattern, result in WORD_RULES[1:]:
        chain = chain.when(word.rlike(pattern), "" if fixed and result == " " else result)
    trimmed = F.regexp_replace(word, "^\\s*(.*\\S)\\s*$", "$1")
    if fixed:
        trimmed = F.regexp_replace(trimmed, "^([A-Z])\\.([A-Z])$", "$1$2")
    return chain.otherwise(trimmed)


def _touched(fixed: bool) -> tuple[str, str]:
    """Patterns of the words the two rule groups can change at all.

    Nearly every word matches neither, so these two checks stand in for the
    two dozen patterns behind them.
    """
    runs = "|".join(run for _, run in (FIXED_RUNS if fixed else TRIGGERS))
    special = [pattern.removeprefix("^") for pattern, _ in WORD_RULES] + ["\\s"]
    if fixed:
        special.append("[A-Z]\\.[A-Z]$")
    # Every run begins with two vowels, and every rule at the start of the word but one.
    return f"(?={VOWEL}{VOWEL})(?:{runs})", f"^(?:{'|'.join(special)})|\\s$"


def normalize_word(word: Column, fixed: bool = False) -> Column:
    """The rewritten word, and its detached stop behind a blank; empty where the word goes."""
    stretched, special = _touched(fixed)
    small, plain = _plain(fixed)
    no_tail = F.lit(None).cast("string").alias("tail")
    last, rest = F.right(word, F.lit(1)), F.substr(word, F.lit(1), F.length(word) - 1)
    has_tail = word.endswith(".") | word.endswith(",")
    parts = F.when(has_tail & word.rlike(TAIL), F.struct(rest.alias("word"), last.alias("tail"))).otherwise(
        F.struct(word.alias("word"), no_tail)
    )

    def finish(p: Column) -> Column:
        shortened = F.when(p["word"].rlike(stretched), collapse(p["word"], fixed)).otherwise(p["word"])
        rewritten = let(shortened, lambda w: F.when(w.rlike(special), rewrite(w, fixed)).otherwise(w))
        tail = F.coalesce(F.concat(F.lit(" "), p["tail"]), F.lit(""))
        return let(rewritten, lambda w: F.when(w == "", "").otherwise(F.concat(w, tail)))

    # Plain words, most by far, are known by one look, and so are those with a stop behind them.
    return (
        F.when(word.rlike(f"{small}$|{plain}\\z"), word)
        .when(word.rlike(f"{plain}[,.]\\z"), F.concat(rest, F.lit(" "), last))
        .otherwise(let(parts, finish))
    )


def _plain(fixed: bool) -> tuple[str, str]:
    """Patterns of words that no rule changes: none stretched, no laughter, no letter eyes.

    The first is of small letters only, the second of letters, digits, hyphens and apostrophes.
    """
    runs = "|".join(sorted(run for _, run in (FIXED_RUNS if fixed else TRIGGERS)))
    # Other letters than vowels are listed, and so found in one table without a look ahead.
    small = f"^(?![xd]|[aehij]{{4}})(?:[bcdfghjklmnpqrstvwxyz]++|(?!{runs})[aeiou])++"
    eyes = "[Xx][Oo-]?[Dd]|[Dd][Oo-]?[Xx]"
    other = "[bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ0123456789'-]"
    return small, f"^(?!{eyes}|[AEHIJaehij]{{4}})(?:{other}++|(?!{runs}){VOWEL})++"


# A sentence without any of these has no word the rules could touch.
SUSPECT = (
    '["\\]!@#“:;\\t\\x0B\\f\\r]|[A-Z]\\.[A-Z]|(?:^| )(?:[Xx][Oo\\-Dd\\])\\[(]|[Dd][Oo\\-]?[Xx]|[AEHIJaehij]{4})'
)


def normalize_sentence(sentence: Column, fixed: bool = False) -> Column:
    suspect = f"{_touched(fixed)[0]}|{SUSPECT}"
    return F.when(sentence.rlike(suspect), _rewrite_words(sentence, fixed)).otherwise(
        _detach_tails(sentence, fixed)
    )


def _detach_tails(sentence: Column, fixed: bool) -> Column:
    """Blank-squeeze a sentence and set off the stop that ends a word."""
    apart = F.regexp_replace(sentence, "(?<=[^ ,.])[,.](?= |$)", " $0")
    squeezed = F.ltrim(F.regexp_replace(F.concat(apart, F.lit(" ")), " {2,}", " "))
    return F.rtrim(squeezed) if fixed else squeezed


def _rewrite_words(sentence: Column, fixed: bool) -> Column:
    words = F.filter(F.transform(split_spaces(sentence), lambda w: normalize_word(w, fixed)), lambda w: w != "")
    if fixed:
        return F.array_join(words, " ")
    return let(words, lambda ws: F.when(F.size(ws) > 0, F.concat(F.array_join(ws, " "), F.lit(" "))).otherwise(""))


def split_spaces(sentence: Column) -> Column:
    return F.split(sentence, " +", -1)


def _normalized(fixed: bool) -> Column:
    return F.transform("sentences", lambda s: normalize_sentence(s, fixed))


def normalize(df: DataFrame, fixed: bool = False) -> DataFrame:
    """Add ``normalized``; each kept word is followed by one blank in compat."""
    return df.withColumn("normalized", build_once(_normalized, fixed))
