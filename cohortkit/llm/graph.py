"""Connected components of a link table, and links inside buckets.

``components`` alternates large-star and small-star steps (each a grouped
aggregation and an equi-join) until nothing changes; every step's links are
written to the shared folder.  Nothing but a count reaches the driver.

``bucket_links`` proposes linearly many pairs: the members of a bucket are
paired with the bucket's least member, through sub-buckets, so that no member
is paired with more than about ``fan`` others in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written

__all__ = ["components", "hub_pairs", "mixed_buckets", "cross_pairs"]

#: Salts over which a node's links are dealt, so that a hub's links aren't one task's.
_SALTS = 32


def _least(links: DataFrame) -> DataFrame:
    """Least neighbour by node (and the node itself): partial sums first, so a
    hub costs no more than its share."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``links`` (undirected, two columns of one comparable type) to (``node``,
    ``root``): each linked node with the least node of its component.  Null ends
    and self-links are left out; an empty table gives no rows."""
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        # large star: every neighbour above a node is linked with the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, "large-star")
        # small star: a node and its smaller neighbours are linked with the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = written(small, "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def hub_pairs(members: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """Distinct pairs (a < b) that tie each bucket (rows with equal ``keys``)
    together: a member with the least of its salted part, that one with the
    least of the bucket.  Linear in the rows; least values are partial
    aggregates, so a huge bucket isn't gathered anywhere."""
    parts = members.withColumn("__salt", F.pmod(F.xxhash64(node), F.lit(_SALTS))).groupBy(*keys, "__salt").agg(F.min(node).alias("__hub"))
    tops = parts.groupBy(*keys).agg(F.min("__hub").alias("__top"))
    salted = members.withColumn("__salt", F.pmod(F.xxhash64(node), F.lit(_SALTS))).join(parts, [*keys, "__salt"])
    low = salted.select(F.col("__hub").alias("a"), F.col(node).alias("b"))
    high = parts.join(tops, keys).select(F.col("__top").alias("a"), F.col("__hub").alias("b"))
    return low.unionByName(high).where("a < b").distinct()


def mixed_buckets(members: DataFrame, keys: list[str], root: str) -> DataFrame:
    """``members`` in buckets that hold more than one component (column
    ``root``), with the bucket's largest component as ``main``.  Buckets that lie
    in one component are gone, so groups of copies that are tied together
    already cost nothing more."""
    sizes = members.groupBy(*keys, root).agg(F.count(F.lit(1)).alias("__n"))
    mixed = sizes.groupBy(*keys).agg(F.max_by(root, F.struct("__n", root)).alias("main"), F.count(F.lit(1)).alias("__roots")).where("__roots > 1").drop("__roots")
    return members.join(mixed, keys)


def cross_pairs(members: DataFrame, keys: list[str], root: str, node: str = "node") -> DataFrame:
    """Distinct pairs (a < b) that share a bucket, but not a component (column
    ``root``): members outside the bucket's largest component with all members
    of other components."""
    rows = written(mixed_buckets(members.select(*keys, F.col(node).alias("__node"), F.col(root).alias("__root")), keys, "__root"), "mixed-buckets")
    minor = rows.where("__root != main").select(*keys, F.col("__node").alias("a"), F.col("__root").alias("__of"))
    pairs = minor.join(rows, keys).where("__root != __of")
    return pairs.select(F.least("a", "__node").alias("a"), F.greatest("a", "__node").alias("b")).distinct()
