"""Sentence splitting: ``content`` -> ``sentences``.

Only a full stop ends a sentence (and a newline already in the text). Dots in
numbers, acronyms and ellipses are hidden behind a mark while the split runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lookup import Lookup, drop_bound
from tidemark.functions.text import LOWER, UPPER, build_once, let, split_all

# Marks (fixed values).
DOT = "<SIGLA-TMP>"
ABBREVIATION_DOT = "<ABR-TMP>"

# Ordered substitutions (fixed values): hide inner dots, then cut after a dot.
SUBSTITUTIONS = (
    (f"({LOWER})\\.({LOWER})", f"$1{DOT}$2"),
    ("\\.\\.\\.", DOT * 3),
    ("([0-9]+)\\.([0-9]+)", f"$1{DOT}$2"),
    (f"({UPPER})\\.({UPPER})", f"$1{DOT}$2"),
    (f"({DOT}{UPPER})\\.({UPPER})", f"$1{DOT}$2"),
    (f"({DOT}{UPPER})\\.(\\s+)({LOWER})", f"$1{DOT}$2$3"),
    ("\\.([^\"'])", ".\n$1"),
)

# The same substitutions as they are run: patterns that begin with the dot pass
# quickly over all else. A dot right behind a match has no letter or digit of its
# own before it, and so stays. The first, third and fourth meet no dot twice and
# are one pass; the fifth and sixth need a dot that those have hidden.
INNER_DOT = (f"\\.(?<!\\G.)((?<={LOWER}\\.){LOWER}|(?<={UPPER}\\.){UPPER}|(?<=[0-9]\\.)[0-9]+)", f"{DOT}$1")
ELLIPSIS = ("...", DOT * 3)
BEHIND_HIDDEN = (
    (f"\\.(?<={DOT}{UPPER}\\.)({UPPER})", f"{DOT}$1"),
    (f"\\.(?<={DOT}{UPPER}\\.)(?=\\s+{LOWER})", DOT),
)


def sentence_array(text: Column) -> Column:
    hidden = F.replace(F.regexp_replace(text, *INNER_DOT), *map(F.lit, ELLIPSIS))
    behind = lambda t: reduce(lambda c, rule: F.regexp_replace(c, *rule), BEHIND_HIDDEN, t)
    hidden = let(hidden, lambda t: F.when(t.contains(DOT), behind(t)).otherwise(t))
    cut = F.regexp_replace(hidden, *SUBSTITUTIONS[-1])
    cut = F.regexp_replace(F.concat(cut, F.lit("\n")), "\n\\s+", "\n")
    for mark in (ABBREVIATION_DOT, DOT):
        cut = F.replace(cut, F.lit(mark), F.lit("."))
    return split_all(cut, "\n")


def _sentences() -> Column:
    return sentence_array(F.col("content"))


def split_sentences(
    posts: DataFrame, abbreviations: Lookup | None = None, fixed: bool = False
) -> DataFrame:
    """Add ``sentences``.

    Compat never protects an abbreviation: its table keys carry an escaped dot
    and so match no word. ``fixed`` hides the last dot of each listed word.
    """
    text = F.col("content")
    if not (fixed and abbreviations is not None):
        return posts.withColumn("sentences", build_once(_sentences))
    words = F.split(text, " ", -1)
    posts, known = abbreviations.bind(posts, words)
    protected = F.array_join(
        F.transform(
            words,
            lambda w: F.when(
                known(w).isNotNull(), F.regexp_replace(w, "\\.$", ABBREVIATION_DOT)
            ).otherwise(w),
        ),
        " ",
    )
    return drop_bound(posts.withColumn("sentences", sentence_array(protected)))
