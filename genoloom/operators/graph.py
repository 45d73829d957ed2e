"""Graphs as edge tables: simple edges, degrees, neighbourhoods, components, rank and core iterations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.parse import pair_key
from ..session import Scratch
from .ranking import first_per_group


#: Rounds of an iteration planned as one job.
TOGETHER = 4


def simple_edges(df: DataFrame, a: str, b: str, score: Column | None = None) -> DataFrame:
    """(a, b[, score]) with a < b: loops dropped, repeated and reversed edges merged, keeping the highest score."""
    low, high = pair_key(a, b)
    pairs = df.select(low.alias("a"), high.alias("b"), *([score.alias("score")] if score is not None else [])).where("a < b")
    return pairs.groupBy("a", "b").agg(F.max("score").alias("score")) if score is not None else pairs.distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """(node, other, the other columns): each edge from both ends."""
    rest = [c for c in edges.columns if c not in ("a", "b")]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("other"), *rest).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"), *rest))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree, strength): neighbours and, with scores, their sum."""
    sums = [F.sum("score").alias("strength")] if "score" in edges.columns else []
    return both_ways(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"), *sums)


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes`` (a column ``node``)."""
    return edges.join(nodes.select(F.col("node").alias("a")), "a", "left_semi").join(nodes.select(F.col("node").alias("b")), "b", "left_semi").select(*edges.columns)


def neighbourhood(edges: DataFrame, seeds: DataFrame, per_seed: int = 10) -> DataFrame:
    """(node, is_seed): the seeds and the ``per_seed`` best neighbours of each by score, then by name."""
    near = both_ways(edges).join(seeds.select("node"), "node", "left_semi")
    best = first_per_group(near, ["node"], [F.desc("score"), F.asc("other")], per_seed)
    new = best.select(F.col("other").alias("node")).distinct().join(seeds.select("node"), "node", "left_anti")
    return seeds.select("node").distinct().withColumn("is_seed", F.lit(True)).unionByName(new.withColumn("is_seed", F.lit(False)))


def hashed(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(nodes (id, node), the edges between ids): 64-bit hashes, which rounds shuffle and sort faster than texts.

    Should two nodes share a hash another seed is taken, so that results are exact. The nodes are a written table.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    seed = 0
    while True:
        key = lambda c, seed=seed: F.xxhash64(c) if not seed else F.xxhash64(F.lit(seed), c)
        nodes, nodes_at = scratch.put(ends.select(key(F.col("node")).alias("id"), "node"))
        if nodes.groupBy("id").count().where("count > 1").isEmpty():
            return nodes, edges.withColumns({"a": key(F.col("a")), "b": key(F.col("b"))})
        scratch.drop(nodes_at)
        seed += 1


def named(nodes: DataFrame, figures: DataFrame) -> DataFrame:
    """``figures`` (node, ...) of hashed nodes under their names."""
    return figures.withColumnRenamed("node", "id").join(nodes, "id").select("node", *(c for c in figures.columns if c != "node"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each.

    In each round a node takes the least label among its neighbours and then that label's own. Labels are
    written once a round.
    """
    scratch = Scratch(edges.sparkSession)
    nodes, links = hashed(edges.select("a", "b"), scratch)
    links, _ = scratch.put(both_ways(links))
    labels, at = scratch.put(links.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        seen = links.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other").groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        now, now_at = scratch.put(step.join(jump, "near").select("node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("changed")))
        done = now.where("changed").isEmpty()
        scratch.drop(at)
        labels, at = now.drop("changed"), now_at
        if done:
            break
    placed = named(nodes, labels)
    return placed.join(placed.groupBy("label").agg(F.min("node").alias("component")), "label").select("node", "component")


def page_rank(edges: DataFrame, rounds: int | None = None, damping: float = 0.85, tolerance: float = 1e-10) -> DataFrame:
    """(node, rank) of an undirected graph weighted by scores of at least 0, starting from equal ranks.

    Rounds end when one changes the ranks by at most ``tolerance`` in sum, at the latest after ``rounds``;
    a few of them are one job, whose result is written. The walk's eigenvalues are real, so each round is
    weighted against the last but one (Chebyshev), which takes about a third of the plain rounds.
    """
    scratch = Scratch(edges.sparkSession)
    names, links = hashed(edges, scratch)
    links = both_ways(links)
    out = links.groupBy("node").agg(F.sum("score").alias("all"))
    shares = links.join(out, "node").select("node", "other", (F.col("score") / F.col("all")).alias("share"))
    # A node's own figures come to it by a link of its own, so that a round reads the last one once.
    links, _ = scratch.put(shares.unionByName(out.select("node", F.col("node").alias("other"), F.lit(None).cast("double").alias("share"))))
    nodes, _ = scratch.put(out.select("node"))
    n = max(nodes.count(), 1)
    ranks, at = scratch.put(nodes.select("node", F.lit(1.0 / n).alias("rank"), F.lit(1.0 / n).alias("before")))
    own = F.col("share").isNull()
    weight, k = 1.0, 0
    while rounds is None or k < rounds:
        step = ranks.drop("change")
        for _ in range(min(TOGETHER, rounds - k if rounds is not None else TOGETHER)):
            given = links.join(step.select("node", "rank", "before"), "node").groupBy(F.col("other").alias("node")).agg(
                F.sum(F.col("rank") * F.col("share")).alias("got"), F.max(F.when(own, F.col("rank"))).alias("rank"), F.max(F.when(own, F.col("before"))).alias("before")
            )
            fresh = (1 - damping) / n + damping * F.coalesce("got", F.lit(0.0))
            step = given.select("node", (F.col("before") + weight * (fresh - F.col("before"))).alias("rank"), F.col("rank").alias("before"), F.abs(fresh - F.col("rank")).alias("change"))
            weight, k = 1 / (1 - damping**2 * (weight / 4 if k else 1 / 2)), k + 1
        now, now_at = scratch.put(step)
        change = now.agg(F.sum("change")).first()[0] or 0.0
        scratch.drop(at)
        ranks, at = now, now_at
        if not change > tolerance:
            break
    return named(names, ranks.select("node", "rank"))


def eigenvector(edges: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """(node, centrality): the leading eigenvector of the scores (at least 0), the largest value being 1.

    Lanczos steps from ones: power iteration would oscillate for ever where the leading component is
    bipartite. Spark keeps a vector per step; the driver has two figures of each. Steps end when the
    error, by the residual and the distance to the next eigenvalue, is at most ``tolerance``.
    """
    scratch = Scratch(edges.sparkSession)
    links, _ = scratch.put(both_ways(edges))
    now, _ = scratch.put(links.select("node").distinct())
    n = now.count()
    now = now.select("node", F.lit(max(n, 1) ** -0.5).alias("v"), F.lit(0.0).alias("u"))
    kept, diagonal, beside = [], [], []
    weights = np.ones(1)
    while n:
        got = links.join(now.select(F.col("node").alias("other"), "v"), "other").groupBy("node").agg(F.sum(F.col("score") * F.col("v")).alias("got"))
        step, at = scratch.put(now.join(got, "node").select("node", "v", (F.col("got") - (beside[-1] if beside else 0.0) * F.col("u")).alias("w"), F.lit(len(kept)).alias("k")))
        kept.append(at)
        diagonal.append(step.agg(F.sum(F.col("w") * F.col("v"))).first()[0])
        rest = F.col("w") - diagonal[-1] * F.col("v")
        size = math.sqrt(step.agg(F.sum(rest * rest)).first()[0])
        values, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
        weights, most = vectors[:, -1], values[-1]
        gap = most - values[-2] if len(values) > 1 else most
        if not size * abs(weights[-1]) > max(tolerance * gap, 1e-13 * most):
            break
        beside.append(size)
        now = step.select("node", (rest / size).alias("v"), F.col("v").alias("u"))
    if not n:
        return now.select("node", F.col("v").alias("centrality"))
    parts = edges.sparkSession.read.schema(step.schema).parquet(*kept)
    weight = F.get(F.array(*(F.lit(float(x)) for x in weights * np.sign(weights[0]))), F.col("k"))
    total, _ = scratch.put(parts.groupBy("node").agg(F.greatest(F.sum(F.col("v") * weight), F.lit(0.0)).alias("x")))
    most = total.agg(F.max("x")).first()[0] or 1.0
    return total.select("node", (F.col("x") / most).alias("centrality"))


def core(edges: DataFrame, k: int) -> DataFrame:
    """Edges of the k-core: nodes of fewer than k neighbours left are peeled off until all have as many; a few rounds are one job."""
    scratch = Scratch(edges.sparkSession)
    names, links = hashed(edges.select("a", "b").distinct(), scratch)
    links, _ = scratch.put(both_ways(links))
    left, at = scratch.put(links.select("node").distinct())
    before = left.count()
    while True:
        step = left
        for _ in range(TOGETHER):
            step = links.join(step.select(F.col("node").alias("other")), "other").groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("node")
        now, now_at = scratch.put(step)
        scratch.drop(at)
        left, at, after = now, now_at, now.count()
        if after == before:
            return induced(edges, named(names, left))
        before = after


#: Edges that one task finishes by itself: some 260 MB in numpy.
IN_ONE_TASK = 2_000_000


def _peeled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, their cores) of a simple graph's edges, by peeling: each node and each end of an edge is looked at once."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    to = np.concatenate([ends[len(a) :], ends[: len(a)]])[np.argsort(ends, kind="stable")]
    left = degree = np.bincount(ends, minlength=len(nodes))
    start, left = np.cumsum(degree) - degree, left.copy()
    cores, held, rest, k = np.zeros(len(nodes), np.int64), np.ones(len(nodes), bool), np.arange(len(nodes)), 0
    while len(rest):
        k = max(k, int(left[rest].min()))
        front = rest[left[rest] <= k]
        while len(front):
            cores[front], held[front] = k, False
            size = degree[front]
            near = to[np.repeat(start[front] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            near, times = np.unique(near[held[near]], return_counts=True)
            left[near] -= times
            front = near[left[near] <= k]
        rest = rest[held[rest]]
    return nodes, cores


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) in, (node, core) out."""
    parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
    if parts:
        nodes, cores = _peeled(*(np.concatenate(x) for x in zip(*parts)))
        yield from pa.table({"node": nodes, "core": cores}).to_batches(65_536)


def coreness(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(node, core): the largest k whose k-core holds the node.

    Every node begins with its degree and then, round by round, takes the largest h such that at least h
    neighbours have a value of h or more; values only fall, and once their sum stays they are the cores.
    Neighbours count by (node, value), so that a hub's neighbours never meet in one row; a few rounds are
    one job. After each, nodes whose value is no more than the least core still possible are done and
    leave with their edges; once ``in_one_task`` edges or fewer are left, one task peels them to the end,
    since chains of matches would take a round for each of their nodes.
    """
    scratch = Scratch(edges.sparkSession)
    names, links = hashed(edges.select("a", "b").distinct(), scratch)
    links, links_at = scratch.put(links)
    now, at, done, lower = None, None, [], 1
    while True:
        # Nodes that left have cores of at most ``lower``, so that those that stay have the cores of what is left, or ``lower``.
        if links.count() <= in_one_task:
            last = links.coalesce(1).mapInArrow(_in_one_task, "node long, core long")
            if now is not None:
                last = now.select("node").join(last, "node", "left").select("node", F.greatest("core", F.lit(lower)).alias("core"))
            done.append(scratch.put(last)[0])
            break
        both = both_ways(links)
        degree = both.groupBy("node").agg(F.count(F.lit(1)).alias("core"))
        if now is None:
            now, at = scratch.put(degree)
        before = now.agg(F.sum("core")).first()[0]
        step = now
        for _ in range(TOGETHER):
            values = both.join(step.select(F.col("node").alias("other"), F.col("core").alias("v")), "other").groupBy("node", "v").agg(F.count(F.lit(1)).alias("n"))
            upto = F.sum("n").over(W.partitionBy("node").orderBy(F.desc("v")).rowsBetween(W.unboundedPreceding, 0))
            step = values.withColumn("h", F.least("v", upto)).groupBy("node").agg(F.greatest(F.max("h"), F.lit(lower)).alias("core"))
        # Nodes without an edge left have the least core.
        step, _ = scratch.put(now.select("node").join(step, "node", "left").select("node", F.coalesce("core", F.lit(lower)).alias("core")))
        scratch.drop(at)
        after = step.agg(F.sum("core")).first()[0]
        if after == before:
            done.append(step)
            break
        done.append(step.where(F.col("core") <= lower))
        now, at = scratch.put(step.where(F.col("core") > lower))
        fewer, fewer_at = scratch.put(induced(links, now))
        scratch.drop(links_at)
        links, links_at = fewer, fewer_at
        # What is left has at least the least degree in it as its cores, if all its nodes still have an edge.
        degrees_left = both_ways(links).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        least, n = degrees_left.agg(F.min("n"), F.count(F.lit(1))).first()
        if n and n == now.count():
            lower = max(lower, least)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return named(names, out)


def larger_cliques(edges: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(nodes array): the cliques of one node more than those of ``found`` (of ``size`` nodes in order), each once, grown along edges to larger nodes."""
    step = edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
    grown = found.withColumn("x", F.element_at("nodes", size)).join(step, "x").select("nodes", "y")
    for i in range(size - 1):
        grown = grown.withColumn("x", F.get("nodes", F.lit(i))).join(step, ["x", "y"], "left_semi").drop("x")
    return grown.select(F.concat("nodes", F.array("y")).alias("nodes"))


def clique_scores(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, mcc): the sum of (size - 1)! over all cliques of two nodes or more that hold the node.

    Cliques grow by a node a round until a round finds none. ``nodes`` (a column ``node``) adds nodes
    without edges, with 0; if there is no edge at all the score is degree times closeness, which is 0 too.
    """
    scratch = Scratch(edges.sparkSession)
    found, _ = scratch.put(edges.select(F.array("a", "b").alias("nodes")))
    total, size = None, 2
    while total is None or not found.isEmpty():
        one = found.select(F.explode("nodes").alias("node"), F.lit(float(math.factorial(size - 1))).alias("w"))
        total = one if total is None else total.unionByName(one)
        found, _ = scratch.put(larger_cliques(edges, found, size))
        size += 1
    out = total.groupBy("node").agg(F.sum("w").alias("mcc"))
    if nodes is not None:
        out = nodes.select("node").distinct().join(out, "node", "left").select("node", F.coalesce("mcc", F.lit(0.0)).alias("mcc"))
    return out


#: Two sums of the same scores in another order may differ by this part.
NEARLY = 1e-9


def shortest_paths(edges: DataFrame) -> DataFrame:
    """(a, b, d, paths): distance of all connected ordered pairs of nodes of a bounded graph and how many shortest paths there are.

    An edge is as long as its score (of more than 0), or 1 where there is none. Distances are relaxed from
    all nodes at once until a round shortens none; then paths are counted along the edges that lie on
    shortest ones. For neighbourhoods of chosen seeds: the result has a row per pair of nodes.
    """
    scratch = Scratch(edges.sparkSession)
    weight = F.col("score").cast("double") if "score" in edges.columns else F.lit(1.0)
    links, _ = scratch.put(both_ways(edges.select("a", "b", weight.alias("w"))))
    steps = links.select(F.col("node").alias("b"), F.col("other").alias("c"), "w")
    nodes = links.select("node").distinct()
    start = nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0.0).alias("d"))
    best, at = scratch.put(start.withColumn("fresh", F.lit(True)))
    while not best.where("fresh").isEmpty():
        tried = best.where("fresh").join(steps, "b").select("a", F.col("c").alias("b"), (F.col("d") + F.col("w")).alias("d"))
        all_ = tried.groupBy("a", "b").agg(F.min("d").alias("e")).join(best.select("a", "b", "d"), ["a", "b"], "full")
        shorter = F.col("d").isNull() | (F.col("e") < F.col("d") * (1 - NEARLY))
        now, now_at = scratch.put(all_.select("a", "b", F.when(F.coalesce(shorter, F.lit(False)), F.col("e")).otherwise(F.col("d")).alias("d"), F.coalesce(shorter, F.lit(False)).alias("fresh")))
        scratch.drop(at)
        best, at = now, now_at
    best = best.select("a", "b", "d")
    # Edges (b, c) on a shortest path from a.
    on = best.join(steps, "b").join(best.select("a", F.col("b").alias("c"), F.col("d").alias("dc")), ["a", "c"]).where(F.abs(F.col("d") + F.col("w") - F.col("dc")) <= NEARLY * F.col("dc")).select("a", "b", "c")
    on, _ = scratch.put(on)
    front, _ = scratch.put(start.select("a", "b", F.lit(1).cast("double").alias("paths")))
    counts = front
    while not front.isEmpty():
        front, _ = scratch.put(front.join(on, ["a", "b"]).groupBy("a", F.col("c").alias("b")).agg(F.sum("paths").alias("paths")))
        counts = counts.unionByName(front)
    return best.join(counts.groupBy("a", "b").agg(F.sum("paths").alias("paths")), ["a", "b"]).select("a", "b", "d", "paths")


def centralities(edges: DataFrame, normalized: bool = False) -> DataFrame:
    """(node, closeness, betweenness) of a bounded graph, by the lengths of its edges: one over the sum of the distances to
    all nodes that can be reached (over their mean, if normalized), and the share of shortest paths between pairs of others
    that pass through the node."""
    paths, _ = Scratch(edges.sparkSession).put(shortest_paths(edges))
    ends = paths.where("a <> b")
    near = ends.groupBy(F.col("a").alias("node")).agg(((F.count(F.lit(1)) if normalized else F.lit(1)) / F.sum("d")).alias("closeness"))
    first = ends.select("a", F.col("b").alias("node"), F.col("d").alias("d1"), F.col("paths").alias("n1"))
    second = ends.select(F.col("a").alias("node"), "b", F.col("d").alias("d2"), F.col("paths").alias("n2"))
    through = first.join(second, "node").where("a < b").join(ends, ["a", "b"]).where(F.abs(F.col("d1") + F.col("d2") - F.col("d")) <= NEARLY * F.col("d"))
    between = through.groupBy("node").agg(F.sum(F.col("n1") * F.col("n2") / F.col("paths")).alias("betweenness"))
    return near.join(between, "node", "left").select("node", "closeness", F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"))


def merged(parts: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes (node, part, degree), edges (a, b, score, part)) of the graphs of several gene lists put together.

    parts: (part, node). Each part has the edges among its own nodes; a node belongs to the first part
    that lists it, nodes without an edge stay as isolated ones, edges found in several parts are kept once a part.
    """
    parts = parts.where("part is not null and node is not null").distinct()
    inside = edges.join(parts.withColumnRenamed("node", "a"), "a").join(parts.withColumnRenamed("node", "b"), ["part", "b"]).select("a", "b", "score", "part")
    degree = both_ways(inside.select("a", "b").distinct()).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    nodes = parts.groupBy("node").agg(F.min("part").alias("part")).join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return nodes, inside
