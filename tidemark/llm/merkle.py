"""Merkle manifest of a dataset, with nested-interval labels.

The leaves of a tree (one for each source) are ranked, and every node is
labelled with the interval [lo, hi) of leaf ranks that it covers. A node's
ancestors are the nodes whose intervals contain its own; at a given level that
is the one in bucket ``lo div 16**level``, so each level is one equi-join on
(tree, bucket) that checks containment. Within a parent, what is left of its
interval without the node's own are the siblings. The subroots of the sources
are the leaves of one more tree, built and labelled alike.

Texts are hashed where they are read and do not move. A level has a sixteenth
of the rows of the one below, and its keys are even, whatever the sources are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain, settled

FANOUT = 16
_PROOFS = "doc_id bigint, leaf string, presented string, subroot string, root string, path array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | str = "text") -> Column:
    """The leaf of a row of ``documents``, or of that row with another ``text``."""
    text = F.col(text) if isinstance(text, str) else text
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def lowered(text: str = "text") -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(text), capitals, capitals.lower())


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of (tree, copies, ...) with ``lo``, the copies before them in their tree, and ``n``, all its copies.

    Rows are dealt to ranges of (tree, order), so a large tree spans many
    ranges; each numbers its own rows and the ranges before it are added. The
    ranges are settled, since another reading could cut them elsewhere.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = settled(rows.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "ranged")
    sizes = settled(ranged.groupBy("tree", "range").agg(F.sum("copies").alias("size")), "sizes")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("tree").alias("_tree"),
        F.col("range").alias("_range"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_start"),
        F.sum("size").over(tree).alias("n"),
    )
    starts = settled(starts, "starts")
    own = Window.partitionBy("tree", "range").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(starts, _same(F.col("tree"), F.col("_tree")) & (F.col("range") == F.col("_range")))
    lo = F.col("_start") + F.coalesce(F.sum("copies").over(own), F.lit(0))
    return placed.withColumn("lo", lo).drop("_tree", "_range", "_start", "range")


def _runs(nodes: DataFrame, level: int, *carried: str) -> DataFrame:
    """The nodes of ``level`` over ``nodes``, the level below: each with its kids in order."""
    kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash", *carried)))
    runs = nodes.groupBy("tree", F.expr(f"lo div {FANOUT**level}").alias("bucket")).agg(F.first("n").alias("n"), kids.alias("kids"))
    return runs.select(
        "tree",
        "n",
        "bucket",
        F.element_at("kids", 1)["lo"].alias("lo"),
        F.element_at("kids", -1)["hi"].alias("hi"),
        F.sha2(F.array_join(F.transform("kids", lambda k: k["hash"]), ""), 256).alias("hash"),
        "kids",
    )


def _levels(leaves: DataFrame, name: str, *carried: str) -> list[DataFrame]:
    """The runs of levels 1, 2, ... until every tree has one node left."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    nodes = leaves
    while FANOUT ** len(levels) < most:
        level = len(levels) + 1
        open_trees = nodes.filter(F.col("n") > FANOUT ** (level - 1))
        levels.append(settled(_runs(open_trees, level, *(carried if level == 1 else ())), f"{name}{level}"))
        nodes = levels[-1]
    return levels


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The last node of each tree: (tree, hash)."""
    tops = leaves.filter("n = 1").select("tree", "hash")
    for i, runs in enumerate(levels):
        tops = tops.union(runs.filter(F.col("n") <= FANOUT ** (i + 1)).select("tree", "hash"))
    return tops


def _siblings(kid: Column) -> Column:
    """What the parent's interval holds before and after the kid's, as joined digests."""

    def joined(rule) -> Column:
        return F.array_join(F.transform(F.filter("kids", rule), lambda k: k["hash"]), "")

    return F.struct(joined(lambda k: k["hi"] <= kid["lo"]).alias("left"), joined(lambda k: k["lo"] >= kid["hi"]).alias("right"))


def _descend(levels: list[DataFrame], tops: DataFrame, *carried: str) -> DataFrame:
    """One row per kid of level 1, with its siblings level by level up to its tree's top and on.

    ``tops`` (tree, n, path, ...) tells the path above each tree; its other
    columns come along.
    """
    along = [c for c in tops.columns if c not in ("tree", "n", "path")]
    below: DataFrame | None = None
    for level in range(len(levels), 0, -1):
        width = FANOUT**level
        last = (F.col("n") <= width) & (F.col("n") > width // FANOUT)
        above = tops.filter(last).select("tree", F.lit(0).cast("bigint").alias("lo"), F.col("n").alias("hi"), "path", *along)
        if below is not None:
            above = above.union(below)
        above = above.select(F.col("tree").alias("_tree"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *along)
        above = settled(above.withColumn("_bucket", F.expr(f"_lo div {width}")), "above")
        inside = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
        met = levels[level - 1].join(above, _same(F.col("tree"), F.col("_tree")) & (F.col("bucket") == F.col("_bucket")) & inside)
        kept = carried if level == 1 else ()
        kids = F.transform(
            "kids",
            lambda k: F.struct(
                k["lo"].alias("lo"),
                k["hi"].alias("hi"),
                F.concat(F.array(_siblings(k)), F.col("path")).alias("path"),
                *[k[c].alias(c) for c in kept],
            ),
        )
        out = met.select("tree", *along, F.explode(kids).alias("k"))
        below = out.select("tree", "k.lo", "k.hi", "k.path", *along, *[f"k.{c}" for c in kept])
    return below


@dataclass(frozen=True)
class Manifest:
    """Leaves and levels of the trees of all sources, and of the tree over their subroots."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    over: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """(scope, tree, level, lo, hi, hash): every node; scope ``top`` has the subroots as leaves."""
        parts = []
        for scope, leaves, levels in (("source", self.leaves, self.levels), ("top", self.sources, self.over)):
            for level, table in enumerate([leaves, *levels]):
                parts.append(table.select(F.lit(scope).alias("scope"), F.col("tree").cast("string").alias("tree"), F.lit(level).alias("level"), "lo", "hi", "hash"))
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
        return out


def manifest(docs: DataFrame, presented: Column | None = None) -> Manifest:
    """The labelled trees of ``docs`` (doc_id, source, lang, n_chars, text).

    ``presented`` is the leaf of a row as someone hands it in for a check, null
    for the row as it is; it does not enter the trees. Null fields are hashed
    as such, a null source is a tree of its own and comes first, rows of a
    source without doc_id come first, and rows with the same doc_id come by
    their leaves. Rows that agree in all of that are combined before they are
    shuffled and are one leaf each all the same. Very long texts are hashed in
    place. Extra columns are ignored; an empty table has no nodes and no root.
    """
    rows = plain(docs, "doc_id", "source", "lang", "n_chars", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").alias("tree"),
        leaf_digest().alias("hash"),
        (F.lit(None).cast("string") if presented is None else presented).alias("presented"),
    )
    distinct = rows.groupBy("doc_id", "tree", "hash", "presented").agg(F.count("*").alias("copies"))
    first = _ranked(distinct, ["doc_id", "hash", "presented"])
    each = F.explode(F.sequence("lo", F.col("lo") + F.col("copies") - 1)).alias("lo")
    leaves = first.select("tree", "n", each, "hash", "doc_id", "presented").withColumn("hi", F.col("lo") + 1)
    leaves = settled(leaves, "leaves")
    levels = _levels(leaves, "level", "doc_id", "presented")
    tops = _tops(leaves, levels).select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "hash", F.lit(1).alias("copies"))
    sources = settled(_ranked(tops, ["source"]).withColumn("hi", F.col("lo") + 1), "sources")
    over = _levels(sources, "over", "source")
    top = _tops(sources, over).first()
    return Manifest(leaves, levels, sources, over, top["hash"] if top else None)


def proofs(of: Manifest) -> DataFrame:
    """(doc_id, leaf, presented, subroot, root, path), one row per leaf.

    ``path`` holds the siblings before and after the leaf and each ancestor of
    it, from the leaf up; a node alone in its run has empty ones.
    """
    spark = of.leaves.sparkSession
    if of.root is None:
        return spark.createDataFrame([], _PROOFS)
    nothing = F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("path")
    start = of.sources.select("tree", "n").distinct().withColumn("path", nothing)
    if of.over:
        paths = _descend(of.over, start, "source", "hash")
    else:
        paths = of.sources.select("source", "hash").withColumn("path", nothing)
    sizes = of.leaves.filter("lo = 0").select(F.col("tree").alias("_tree"), "n")
    tops = paths.select("source", F.col("hash").alias("subroot"), "path").join(sizes, _same(F.col("source"), F.col("_tree")))
    tops = settled(tops.select(F.col("source").alias("tree"), "n", "path", "subroot"), "tops")
    alone = of.leaves.filter("n = 1").select(F.col("tree").alias("_tree"), "doc_id", "hash", "presented")
    found = tops.filter("n = 1").join(alone, _same(F.col("tree"), F.col("_tree")))
    found = found.select("doc_id", F.col("hash").alias("leaf"), "presented", "subroot", "path")
    if of.levels:
        below = _descend(of.levels, tops, "hash", "doc_id", "presented")
        found = found.union(below.select("doc_id", F.col("hash").alias("leaf"), "presented", "subroot", "path"))
    return found.select("doc_id", "leaf", "presented", "subroot", F.lit(of.root).alias("root"), "path")


def folded(leaf: Column, path: Column | str = "path") -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def proof_digest(path: Column | str = "path") -> Column:
    """One digest of all siblings of a path, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)
