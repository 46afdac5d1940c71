"""Column helpers for the text semantics the stages rely on.

Everything here is built-in Spark expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented classes used by the sentence and name rules (fixed values).
UPPER = "[A-ZÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÑÇÜ]"
LOWER = "[a-záéíóúàèìòùâêîôûñçü]"


_built: dict = {}
#: Expressions kept; beyond it the one built first is let go.
_MOST_BUILT = 64


def build_once(build: Callable[..., Column], *args) -> Column:
    """``build(*args)``, kept while the Spark application uses it.

    An expression names columns, not frames, so one serves every frame. The
    stage expressions hold thousands of nodes, each a call into the JVM, and
    are worth keeping; arguments are compared by identity where they must be.
    """
    context = SparkContext._active_spark_context
    key = (context and context.applicationId, build, args)
    if key not in _built:
        while len(_built) >= _MOST_BUILT:
            del _built[next(iter(_built))]
        _built[key] = build(*args)
    return _built[key]


def few(rows: DataFrame, what: str, most: int = 10_000) -> list:
    """The rows of a table that goes into an expression; over ``most`` is an error."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"over {most} {what}")
    return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A plain Column reused n times is evaluated n times inside a lambda, and the
    optimizer may inline a projected column back into one. A lambda variable is
    never inlined, so this is the one safe way to share a value in a row. A fold
    over nothing is used because, unlike ``transform``, it copies no result.
    """
    nothing = F.expr("cast(array() as array<int>)")
    return F.aggregate(nothing, value, lambda bound, _: bound, body)


def rows_of(df: DataFrame, items: Column | str, index: str, item: str, *keep: Column | str) -> DataFrame:
    """One row per array element, with its position.

    The outer form with a filter behind it: for a plain explode the optimizer
    infers a filter on the array and pushes it under the stages, which computes
    the whole chain again for every part of that filter.
    """
    array = F.col(items) if isinstance(items, str) else items
    out = df.select(*keep, F.posexplode_outer(array).alias(index, item))
    return out.filter(F.col(index).isNotNull())


def split_all(value: Column, regex: str) -> Column:
    """Split on runs of ``regex``: a leading empty part stays, trailing ones go.

    A text without any separator comes back whole, even when it is empty.
    """

    def trim_tail(parts: Column) -> Column:
        only_empty = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) == "")
        return (
            F.when((F.size(parts) == 1) | (F.element_at(parts, -1) != ""), parts)
            .when(only_empty, F.slice(parts, 1, 0))
            .otherwise(F.slice(parts, 1, F.size(parts) - 1))
        )

    return let(F.split(value, f"(?:{regex})+", -1), trim_tail)


def chomp(value: Column) -> Column:
    """Drop blanks and control characters (up to U+0020) from both ends."""
    return F.regexp_replace(value, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def fold_case(value: Column) -> Column:
    """Lower-case, including the accented capitals of the source languages."""
    return F.translate(F.lower(value), "ÁÉÍÓÚÇÑ", "áéíóúçñ")


def truthy(value: Column) -> Column:
    """Script-style truth of a string: null, '' and '0' are false."""
    return F.coalesce(~value.isin("", "0"), F.lit(False))


def replace_first(value: Column, regex: str, replacement: str) -> Column:
    """Substitute the first match only; ``replacement`` uses groups from $2."""
    return F.regexp_replace(value, f"(?s)^(.*?)(?:{regex})(.*)$", f"$1{replacement}")


def float32(value: Column) -> Column:
    """Round a double through single precision, as the smoothing constant is."""
    return value.cast("float").cast("double")


def ratio(above: Column, below: Column) -> Column:
    """IEEE quotient: over zero it is infinite, or no number, where a plain division is an error."""
    a, b = above.cast("double"), below.cast("double")
    infinite = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).when(a.isNotNull(), float("nan"))
    return F.when(b == 0, infinite).otherwise(a / b)


def scan(
    items: Column,
    state: Column,
    step: Callable[[Column, Column], Column],
    out_type: str,
) -> Column:
    """Left-to-right pass emitting one value per item.

    ``step(state, item)`` gives a struct ``(state, out)``. Appending to one long
    array would copy it at each step, so the items are cut into blocks and only
    the blocks' outputs are appended to the outer list. A block has about the
    square root of the items, so no step copies more than that.
    """
    none = F.expr(f"cast(null as {out_type})")
    empty = F.expr(f"cast(array() as array<{out_type}>)")
    empty_blocks = F.expr(f"cast(array() as array<array<{out_type}>>)")

    def pair(last: Column, outs: Column) -> Column:
        return F.struct(last.alias("last"), outs.alias("outs"))

    def appended(acc: Column) -> Column:
        return F.concat(acc["outs"], F.array(acc["last"]["out"]))

    def start(state: Column, out: Column, outs: Column) -> Column:
        return pair(F.struct(state.alias("state"), out.alias("out")), outs)

    # Each step appends what the step before it emitted, so nothing is bound twice.
    def run_block(state: Column, items_in_block: Column, size: Column) -> Column:
        return F.aggregate(
            items_in_block,
            start(state, none, empty),
            lambda acc, item: pair(step(acc["last"]["state"], item), appended(acc)),
            lambda acc: F.struct(
                acc["last"]["state"].alias("state"),
                F.slice(appended(acc), F.lit(2), size).alias("out"),
            ),
        )

    # Blocks are cut where they are read: a list of blocks would copy every item.
    def blocks(xs: Column) -> Column:
        def over(block: Column) -> Column:
            last = F.floor((F.size(xs) - 1) / block).cast("int")
            return F.aggregate(
                F.sequence(F.lit(0), last),
                start(state, empty, empty_blocks),
                lambda acc, b: pair(
                    run_block(
                        acc["last"]["state"],
                        F.slice(xs, b * block + 1, block),
                        F.least(block, F.size(xs) - b * block),
                    ),
                    appended(acc),
                ),
                lambda acc: F.flatten(appended(acc)),
            )

        every = let(F.ceil(F.sqrt(F.size(xs))).cast("int"), over)
        return F.when(F.size(xs) > 0, every).otherwise(empty)

    return let(items, blocks)
