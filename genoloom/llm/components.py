"""Groups of records linked directly or through others: alternating large-star and small-star.

Edges point from the larger node to the smaller. Large-star links all larger neighbours of a node to its
smallest neighbour, small-star does so for its smaller ones; both are joins of the edge table with the
minimum per node. The minima are a written table of one row per node, so both sides of each join are
shuffled for it alone and nothing behind it needs its partitioning: adaptive execution can split the tasks
of a hub, which no plan with an aggregate right below the join allows. When a round changes nothing, every
record points to its component's minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import Scratch


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("s").agg(F.min("d").alias("m"))


def large_star(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """Each edge (s, d) leads to d's smallest neighbour. Only smaller neighbours count for that, d itself if it has none.

    minima: (s, m), the smallest d of each s, as a written table.
    """
    return edges.join(minima.select(F.col("s").alias("d"), "m"), "d", "left").select("s", F.coalesce("m", "d").alias("d"))


def small_star(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """The smaller neighbours of s, and s, lead to the smallest of them; a pair may be there more than once."""
    others = edges.join(minima, "s").where("d <> m").select(F.col("d").alias("s"), F.col("m").alias("d"))
    return others.unionByName(minima.withColumnRenamed("m", "d"))


def star_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(s, d): each node of the edges (s > d, longs, no loops), but for the minima, with its component's minimum."""
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("s", "d"))).first())
    now, now_at = scratch.put(edges.distinct())
    before = sign(now)
    while True:
        least, least_at = scratch.put(_minimum(now))
        large, large_at = scratch.put(large_star(now, least))
        scratch.drop(now_at, least_at)
        least, least_at = scratch.put(_minimum(large))
        now, now_at = scratch.put(small_star(large, least).distinct())
        scratch.drop(large_at, least_at)
        after = sign(now)
        if after == before:
            return now
        before = after


def link_groups(df: DataFrame, left: str | Column, right: str | Column) -> DataFrame:
    """(member, group_id): each record of a complete pair with its group, named by its smallest member by bytes.

    Pairs with a null or empty side take no part; a record paired only with itself is its own group;
    repeated pairs, pairs seen from both sides, and any order give the same result. Other columns are
    ignored, an empty table gives no rows. Records work under 64-bit hashes; should two records share one,
    another seed is taken, so that the result is exact.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    scratch = Scratch(df.sparkSession)
    pairs = df.select(as_column(left).cast("string").alias("a"), as_column(right).cast("string").alias("b")).where("a <> '' and b <> ''")
    seed = 0
    while True:
        key = lambda c, seed=seed: F.xxhash64(c) if not seed else F.xxhash64(F.lit(seed), c)
        ends = pairs.select(F.explode(F.array("a", "b")).alias("member")).groupBy(key(F.col("member")).alias("id")).agg(F.min("member").alias("member"), F.max("member").alias("other"))
        nodes, nodes_at = scratch.put(ends.withColumn("shared", F.col("member") != F.col("other")).drop("other"))
        if nodes.where("shared").isEmpty():
            break
        scratch.drop(nodes_at)
        seed += 1
    nodes = nodes.drop("shared")
    a, b = key(F.col("a")), key(F.col("b"))
    edges = pairs.select(F.greatest(a, b).alias("s"), F.least(a, b).alias("d")).where("s <> d")
    stars = star_components(edges, scratch)
    placed, _ = scratch.put(nodes.join(stars.select(F.col("s").alias("id"), "d"), "id", "left").select("member", F.coalesce("d", "id").alias("root")))
    names, _ = scratch.put(placed.groupBy("root").agg(F.min("member").alias("group_id")))
    return placed.join(names, "root").select("member", "group_id")
