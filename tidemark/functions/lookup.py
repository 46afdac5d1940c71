"""Word lookups inside a row, without a shuffle.

The annotation stages work on token arrays, one row per post. Joining a word
table against them the usual way means one row per token, a shuffle back per
post, and a sort of everything. Instead a table of checked size is published
once as a SQL session variable (an array of hash buckets, each a small map),
so a lookup is two array accesses in the expression that needs it, and a plan
over posts stays scan -> project with no exchange. This is the way unless the
caller asks for the other; a table over the bound is an error, which names it.

``by="join"`` is for larger tables: the distinct keys of each post are joined
to the table, and only the hits come back to the post. Nothing chooses between
the two but the caller. Both ways give the stage the same ``probe``.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import settle
from tidemark.functions import jvm


@dataclass(frozen=True)
class Probe:
    """Looks a key up in the bucketed table that column ``name`` holds."""

    name: str
    buckets: int

    def __call__(self, key: Column) -> Column:
        return F.element_at(F.get(F.col(self.name), _bucket(key, self.buckets)), key)


#: What a published table may measure: rows, and bytes as JSON text. As maps on
#: the heap it takes a few times that, once for each executor.
MAX_ROWS = 1_000_000
MAX_BYTES = 64 << 20
JOIN_BUCKETS = 64
WAYS = ("in_row", "join")

_names = itertools.count()


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Lookup:
    """A ``key -> value`` table with unique, non-null string keys."""

    def __init__(
        self,
        table: DataFrame,
        key: str,
        value: Column,
        by: str = "in_row",
        max_rows: int = MAX_ROWS,
        max_bytes: int = MAX_BYTES,
    ):
        if by not in WAYS:
            raise ValueError(f"a lookup is one of {WAYS}")
        self.by = by
        self.table = table.select(F.col(key).alias("key"), value.alias("value"))
        self.max_rows = max_rows
        self.max_bytes = max_bytes
        self._variable: Probe | None = None
        self._shared = None
        self._hits = f"_hits_{next(_names)}"

    def _size(self) -> tuple[int, int]:
        """Rows of the table, and their bytes as JSON text."""
        size = F.octet_length(F.to_json(F.struct("key", "value")))
        rows, total = self.table.agg(F.count("*"), F.sum(size)).first()
        return rows, total or 0

    def fits(self) -> bool:
        """Whether the table is within the bound for lookups in the row."""
        rows, total = self._size()
        return rows <= self.max_rows and total <= self.max_bytes

    def _measured(self) -> int:
        """Rows of the table, once it has been found to stay within the bound."""
        rows, total = self._size()
        if rows > self.max_rows or total > self.max_bytes:
            raise ValueError(
                f"a lookup table of {rows} rows and {total} bytes is over the bound of {self.max_rows} rows "
                f"and {self.max_bytes} bytes for lookups in the row; use lookup='join'"
            )
        return rows

    def publish(self) -> Probe:
        """Measure the table and hand it to the session; once only."""
        if self._variable is None:
            spark = self.table.sparkSession
            rows, buckets = self._measured(), 1
            while buckets < rows:
                buckets *= 2
            maps = (
                self.table.groupBy(_bucket(F.col("key"), buckets).alias("slot"))
                .agg(F.collect_list(F.struct("key", "value")).alias("entries"))
                .select("slot", F.map_from_entries("entries").alias("entries"))
            )
            slots = spark.range(buckets).select(F.col("id").cast("int").alias("slot"))
            dense = slots.join(maps, "slot", "left").agg(
                F.array_sort(
                    F.collect_list(F.struct("slot", "entries")),
                    lambda a, b: a["slot"] - b["slot"],
                ).alias("pairs")
            )
            name = f"tidemark_lookup_{next(_names)}"
            kind = self.table.schema["value"].dataType.simpleString()
            view = f"{name}_view"
            dense.select(F.col("pairs.entries").alias("slots")).createOrReplaceTempView(view)
            spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<MAP<STRING, {kind}>>")
            spark.sql(f"SET VAR {name} = (SELECT slots FROM {view})")
            spark.catalog.dropTempView(view)
            self._variable = Probe(name, buckets)
        return self._variable

    def shared(self):
        """Measure the table and hand it to the compiled stages; once only."""
        if self._shared is None:
            self._measured()
            self._shared = jvm.shared(self.table)
        return self._shared

    @property
    def probe(self) -> Probe:
        """What :meth:`bind` hands out, for expressions that are built ahead of it."""
        return self.publish() if self.by == "in_row" else Probe(self._hits, JOIN_BUCKETS)

    def bind(self, df: DataFrame, keys: Column) -> tuple[DataFrame, Probe]:
        """Make the table reachable from expressions over ``df``.

        ``keys`` lists every key a row may probe; only the join path reads it.
        """
        if self.by == "in_row":
            return df, self.publish()
        return self._bind_by_join(df, keys)

    def _bind_by_join(self, df: DataFrame, keys: Column) -> tuple[DataFrame, Probe]:
        # Posts with the same key set share one 128-bit name, so copies are
        # looked up once and the names survive a recomputed task.
        # The frame is read twice from here on, so it is settled first: a chain of
        # binds would otherwise double the work of all stages before each of them.
        named = settle(
            df.withColumn("_keys", F.array_sort(F.array_distinct(keys)))
            .withColumn("_k1", F.xxhash64("_keys"))
            .withColumn("_k2", F.xxhash64(F.lit("second"), F.col("_keys")))
        )
        asked = (
            named.groupBy("_k1", "_k2")
            .agg(F.any_value("_keys").alias("_keys"))
            .select("_k1", "_k2", F.explode("_keys").alias("key"))
        )
        # The table has one row for a word, so a word that most key sets ask for is
        # a skewed key of this side only, which the runtime divides as it needs.
        found = (
            asked.join(self.table, "key")
            .groupBy("_k1", "_k2", _bucket(F.col("key"), JOIN_BUCKETS).alias("slot"))
            .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("entries"))
            .groupBy("_k1", "_k2")
            .agg(F.map_from_entries(F.collect_list(F.struct("slot", "entries"))).alias("_found"))
        )
        slots = F.transform(
            F.sequence(F.lit(0), F.lit(JOIN_BUCKETS - 1)),
            lambda s: F.element_at(F.col("_found"), s),
        )
        found = found.select("_k1", "_k2", slots.alias(self._hits))
        # Many copies of one key set make one hot name here; the hits side has a
        # single row for it, so the runtime skew split divides the posts side.
        bound = named.drop("_keys").join(found, ["_k1", "_k2"], "left").drop("_k1", "_k2")
        return bound, self.probe


def drop_bound(df: DataFrame) -> DataFrame:
    """Remove the per-row hit columns a join-path bind left behind."""
    return df.drop(*[c for c in df.columns if c.startswith("_hits_")])
