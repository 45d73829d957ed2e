"""Micro fixtures for the reference's operators: ties, missing values, edge cases."""

import heapq
import itertools
import math
import random

import numpy as np
import pytest
from genoloom.functions import parse, stats
from genoloom.operators import enrich, expression, graph, integrate, ranking, sets
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: parse.strip_version(F.lit("GCF_1.10")), "GCF_1"),
        (lambda: parse.version(F.lit("GCF_1.10")), 10),
        (lambda: parse.version(F.lit("GCF_1")), 0),
        (lambda: parse.gene_contig(F.lit("NZ_CP073017.1_768_971726_826726")), "NZ_CP073017.1"),
        (lambda: parse.gene_contig(F.lit("odd")), None),
        (lambda: parse.pipe_field(F.lit("a|b|c"), 5), None),
        (lambda: parse.pipe_field_or_all(F.lit("a|b|c"), 2), "b"),
        (lambda: parse.pipe_field_or_all(F.lit("a"), 2), "a"),
        (lambda: parse.numbered(F.lit(1234), "Conserved_", 3), "Conserved_1234"),
        (lambda: parse.truncated(F.lit("x" * 40), 35), "x" * 32 + "..."),
        (lambda: parse.bucket(F.lit(50.0), [0, 50, 100]), "(0,50]"),
        (lambda: parse.lineage_rank(F.lit("a;b;c"), F.lit("genus;family;genus"), "genus"), "c"),
        (lambda: parse.lineage_rank(F.lit("a;b"), F.lit("x;y"), "genus"), None),
        (lambda: parse.reverse_complement(F.lit("AACg")), "cGTT"),
        (lambda: parse.sample_prefix(F.lit("GTEX-1-2-3-4")), "GTEX-1-2"),
        (lambda: parse.items(F.lit("a | b |  | c")), ["a", "b", "c"]),
        (lambda: parse.stars(F.lit(0.001)), "**"),
        (lambda: parse.evidence_sum(F.lit(None).cast("int"), F.lit(1), F.lit(2)), 3),
        (lambda: parse.first_filled(F.lit(""), F.lit(None).cast("string"), F.lit("z")), "z"),
        (lambda: stats.t_statistic(F.lit(1.0), F.lit(10)), None),
    ],
)
def test_scalar(spark, column, want):
    assert one(spark, column()) == want


def test_cds_header(spark):
    r = one(spark, parse.cds_header(F.lit(">cds-WP_158299063.1::NZ_CP073017.1:826971-826726(-)")))
    assert tuple(r) == ("NZ_CP073017.1", 826971, 826726, "-")
    assert one(spark, parse.cds_header(F.lit(">x::c:1-9"))).strand == "+"


def test_best_hits_ties_and_zero(spark):
    data = [("c", "g", 2, "s2", 10, 0.0, 90.0), ("c", "g", 1, "s1", 10, 0.0, 90.0), ("c", "g", 3, "s3", 5, 1e-5, 99.0), ("c", "h", 4, "s4", 5, 1.0, 99.0), ("c", "i", 5, "s5", 5, float("nan"), 99.0)]
    df = spark.createDataFrame(data, "cid string, gene string, hit_id long, subject string, length int, evalue double, identity double")
    got = {r.gene: r for r in ranking.best_hits(df, ["cid", "gene"]).collect()}
    assert set(got) == {"g", "h"}
    assert (got["g"].subject_by_length, got["g"].subject_by_evalue, got["g"].subject_by_identity, got["g"].all_same) == ("s1", "s1", "s3", False)
    assert got["h"].comprehensive_score is None and got["h"].subject_by_comprehensive == "s4"


def test_dense_ids_and_batches(spark):
    df = spark.createDataFrame([(x,) for x in "hgfedcba"], "x string").repartition(4)
    assert [(r.x, r.id) for r in ranking.dense_ids(df, [F.asc("x")], "id").orderBy("x").collect()] == [(c, k + 1) for k, c in enumerate("abcdefgh")]
    assert sorted(r["count"] for r in ranking.even_batches(df, [F.asc("x")], 3).groupBy("batch").count().collect()) == [2, 3, 3]
    assert ranking.dense_ids(df.limit(0), [F.asc("x")], "id").count() == 0


def test_maximal_and_closed_sets(spark):
    data = [("s1", "1", "abc"), ("s2", "2", "abc"), ("s1", "3", "ab"), ("s3", "4", "ab"), ("s3", "5", "bd"), ("s2", "6", "bd"), ("s4", "7", "a")]
    rows = [(s, k, g) for s, k, genes in data for g in genes]
    sigs = sets.signatures(spark.createDataFrame(rows, "s string, k string, g string"), "s", "k", "g")
    assert sorted("".join(r.genes) for r in sets.maximal(sets.recurring(sigs)).collect()) == ["abc", "bd"]
    got = {"".join(r.genes): (r.n_clusters, r.n_species) for r in sets.closed(sigs).collect()}
    assert got == {"abc": (2, 2), "ab": (4, 3), "bd": (2, 2)}


def test_graph(spark):
    rows = [("b", "a", 1.0), ("a", "b", 3.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "d", 2.0), ("x", "y", 1.0), ("z", "z", 9.0)]
    edges = graph.simple_edges(spark.createDataFrame(rows, "p string, q string, s double"), "p", "q", F.col("s"))
    assert {(r.a, r.b, r.score) for r in edges.collect()} == {("a", "b", 3.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "d", 2.0), ("x", "y", 1.0)}
    assert {r.node: r.component for r in graph.components(edges).collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    assert {r.node: r.mcc for r in graph.clique_scores(edges).collect()} == {"a": 4, "b": 4, "c": 5, "d": 1, "x": 1, "y": 1}
    assert {(r.a, r.b) for r in graph.core(edges, 2).collect()} == {("a", "b"), ("b", "c"), ("a", "c")}
    near = graph.neighbourhood(edges, spark.createDataFrame([("d",), ("q",)], "node string"), 1)
    assert {(r.node, r.is_seed) for r in near.collect()} == {("d", True), ("q", True), ("c", False)}
    ranks = {r.node: r["rank"] for r in graph.page_rank(edges, 30).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-9


def test_provenance(spark):
    a = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, a int")
    b = spark.createDataFrame([("k2", 3), ("k3", 4)], "k string, b int")
    got = {r.k: r.sources for r in integrate.combine({"n": a, "p": b}, ["k"]).collect()}
    assert got == {"k1": "n", "k2": "n+p", "k3": "p"}
    newest = integrate.newest_versions(spark.createDataFrame([("A.9",), ("A.10",), ("B",), (None,)], "acc string"), "acc")
    assert {tuple(r) for r in newest.collect()} == {("A", "A.10"), ("B", "B")}


def test_benjamini_hochberg(spark):
    p = [0.01, 0.02, 0.02, 0.5, 1.0, None]
    df = spark.createDataFrame([("g", x) for x in p], "g string, p double")
    got = {r.v: r.adjusted for r in stats.benjamini_hochberg(df, ["g"], "p").collect()}
    assert got == pytest.approx({0.01: 0.02 / 3 * 5, 0.02: 0.02 / 3 * 5, 0.5: 0.625, 1.0: 1.0})


def test_tails(spark):
    got = spark.createDataFrame([(2.0, 10), (0.0, 5), (-1.0, 1), (None, 3)], "t double, d int").select(stats.t_two_sided(F.col("t"), F.col("d")).alias("p")).collect()
    assert [r.p for r in got][:3] == pytest.approx([0.07338803, 1.0, 0.5], abs=1e-7) and got[3].p is None
    tail = spark.createDataFrame([(3, 5, 4, 20)], "x int, m int, k int, n int").select(stats.hypergeometric_tail(*(F.col(c) for c in "xmkn"))).first()[0]
    want = sum(math.comb(5, i) * math.comb(15, 4 - i) for i in (3, 4)) / math.comb(20, 4)
    assert tail == pytest.approx(want)


def test_spearman(spark):
    rows = [(k, g, v) for k in range(6) for g, v in (("up", float(k)), ("down", float(-k)), ("tied", float(k // 2)), ("flat", 1.0))]
    df = spark.createDataFrame(rows, "sample int, gene string, value double")
    got = {(r.gene1, r.gene2): r.spearman_rho for r in expression.spearman(df, expression.pairs_of(df), []).collect()}
    assert got["down", "up"] == pytest.approx(-1) and got["tied", "up"] == pytest.approx(0.9561828874675149) and got["flat", "up"] is None


def test_random_sets_take_no_item_twice(spark):
    pool = spark.createDataFrame([(f"g{k}",) for k in range(7)], "gene string")
    got = expression.random_sets(pool, "gene", spark.createDataFrame([("a", 3), ("b", 7), ("c", 20), ("d", 0)], "s string, k int"), "s", "k", "1").collect()
    by = {}
    for r in got:
        by.setdefault(r.s, []).append(r.gene)
    assert {k: len(set(v)) for k, v in by.items()} == {"a": 3, "b": 7, "c": 7} and len(got) == 17


def test_fallback_and_coverage(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.9)], "term string, p double")
    assert enrich.strict_or_all(df, F.col("p") < 0.6).count() == 1
    assert enrich.strict_or_all(df, F.col("p") < 0.1).count() == 2
    rows = spark.createDataFrame([("c", "t", "g1"), ("c", "t", "g1"), ("c", "u", "g2"), ("d", "t", "g3")], "c string, t string, g string")
    got = {(r.c, r.t): (r.n, r.of_group, r.of_term) for r in enrich.coverage(rows, "c", "t", "g").collect()}
    assert got == {("c", "t"): (1, 0.5, 0.5), ("c", "u"): (1, 0.5, 1.0), ("d", "t"): (1, 1.0, 0.5)}


def test_centralities(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "e"), ("d", "e"), ("x", "y")], "a string, b string")
    got = {r.node: (round(r.closeness, 6), r.betweenness) for r in graph.centralities(edges, normalized=True).collect()}
    assert got["a"] == (round(4 / 6, 6), 1.0) and got["x"] == (1.0, 0.0)
    square = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "d")], "a string, b string")
    assert {r.betweenness for r in graph.centralities(square).collect()} == {0.5}


def test_random_sets_are_independent(spark):
    """Every pair of items is about equally often together, which runs of one circular order wouldn't give."""
    pool = spark.createDataFrame([(f"g{k}",) for k in range(8)] + [("g1",), (None,)], "gene string")
    got = expression.random_sets(pool, "gene", spark.range(2000).selectExpr("cast(id as string) s", "3 k"), "s", "k", "5").collect()
    sets_ = {}
    for r in got:
        sets_.setdefault(r.s, set()).add(r.gene)
    assert {len(v) for v in sets_.values()} == {3} and len(sets_) == 2000
    together = {}
    for v in sets_.values():
        for pair in itertools.combinations(sorted(v), 2):
            together[pair] = together.get(pair, 0) + 1
    mean = 2000 * 3 / 28
    assert len(together) == 28 and all(abs(n - mean) < 5 * mean**0.5 for n in together.values())
    assert expression.random_sets(pool.limit(0), "gene", spark.createDataFrame([("a", 2)], "s string, k int"), "s", "k", "5").isEmpty()


def test_cliques_of_all_sizes(spark):
    six = list(itertools.combinations("abcdef", 2)) + [("f", "g"), ("x", "y")]
    edges = spark.createDataFrame(six, "a string, b string")
    found = {k: [c for c in itertools.combinations("abcdefgxy", k) if all(p in six for p in itertools.combinations(c, 2))] for k in range(2, 8)}
    want = {n: sum(math.factorial(k - 1) for k, cs in found.items() for c in cs if n in c) for n in "abcdefgxy"}
    nodes = spark.createDataFrame([(n,) for n in "abcdefgxyq"], "node string")
    assert found[6] and not found[7]
    assert {r.node: r.mcc for r in graph.clique_scores(edges, nodes).collect()} == {**want, "q": 0}
    assert {r.mcc for r in graph.clique_scores(edges.limit(0), nodes).collect()} == {0}


def test_weighted_paths_and_cores(spark):
    r = random.Random(3)
    names = [f"n{k:02}" for k in range(14)]
    weights = {p: float(r.randrange(1, 5)) for p in itertools.combinations(names, 2) if r.random() < 0.25}
    weights |= {(f"p{k:03}", f"p{k + 1:03}"): 1.0 for k in range(66)}  # longer than 64 steps
    edges = spark.createDataFrame([(a, b, w) for (a, b), w in weights.items()], "a string, b string, score double")
    near = {}
    for (a, b), w in weights.items():
        near.setdefault(a, {})[b] = w
        near.setdefault(b, {})[a] = w
    dist = {}
    for s in near:
        d, todo = {s: 0.0}, [(0.0, s)]
        while todo:
            x, v = heapq.heappop(todo)
            for o, w in near[v].items():
                if x + w < d.get(o, math.inf):
                    d[o] = x + w
                    heapq.heappush(todo, (x + w, o))
        dist[s] = d
    count = {}
    for s in near:
        n = {s: 1}
        for v in sorted(dist[s], key=dist[s].get)[1:]:
            n[v] = sum(n[o] for o, w in near[v].items() if dist[s][o] + w == dist[s][v])
        count[s] = n
    between = {v: sum(count[a][v] * count[v][b] / count[a][b] for a in near for b in dist[a] if a < b and v not in (a, b) and v in dist[a] and dist[a][v] + dist[v][b] == dist[a][b]) for v in near}
    got = {x.node: (x.closeness, x.betweenness) for x in graph.centralities(edges).collect()}
    assert set(got) == set(near) and all(got[v] == pytest.approx((1 / sum(dist[v].values()), between[v])) for v in near)
    cores, left, k = {}, {v: set(o) for v, o in near.items() if v[0] == "n"}, 0
    while left:
        k += 1
        while weak := [v for v in left if len(left[v]) < k]:
            for v in weak:
                cores[v] = k - 1
                for o in left.pop(v):
                    if o in left:
                        left[o].discard(v)
    assert {x.node: x.core for x in graph.coreness(edges.where("a like 'n%'")).collect()} == cores
    assert graph.coreness(edges.limit(0)).isEmpty()


def test_merged_graph_keeps_isolated_nodes(spark):
    parts = spark.createDataFrame([("c2", "b"), ("c1", "a"), ("c1", "b"), ("c2", "c"), ("c2", "lone"), (None, "a")], "part string, node string")
    edges = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0), ("b", "c", 2.0)], "a string, b string, score double")
    nodes, inside = graph.merged(parts, edges)
    assert {tuple(r) for r in nodes.select("node", "part", "degree").collect()} == {("a", "c1", 1), ("b", "c1", 2), ("c", "c2", 1), ("lone", "c2", 0)}
    assert {(r.a, r.b, r.part) for r in inside.collect()} == {("a", "b", "c1"), ("b", "c", "c2")}


def test_hot_group_meets_its_figures_in_place(spark):
    """Half of the hits under one key: they aren't shuffled to meet the key's bests."""
    hits = spark.range(4000).selectExpr("id hit_id", "case when id % 2 = 0 then 'hot' else concat('k', id) end k", "concat('s', id % 7) subject", "cast(id % 90 as int) length", "pow(10d, -(id % 50)) evalue", "cast(id % 100 as double) identity")
    best = ranking.best_hits(hits, ["k"])
    rows = {r.k: r for r in best.collect()}
    assert len(rows) == 2001
    hot = [(i % 90 / 88 + (i % 50) / 48 + (i % 100) / 98, -i, i) for i in range(0, 4000, 2) if i % 90]
    assert rows["hot"].comprehensive_score == pytest.approx(max(hot)[0] / 3) and rows["hot"].length_by_length == 88
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_slim_counts_over_the_closure(spark):
    links = spark.createDataFrame([("a", "r"), ("b", "r"), ("a1", "a"), ("a2", "a"), ("x", "a1"), ("x", "b")], "child string, parent string")
    rows = spark.createDataFrame([("a1", "g1"), ("x", "g1"), ("x", "g2"), ("b", "g3"), ("q", "g9")], "term string, gene string")
    level = spark.createDataFrame([("a",), ("b",)], "term string")
    assert {tuple(r) for r in enrich.slim(rows, links, level).collect()} == {("a", 2), ("b", 3)}


def test_log_gamma():
    x = np.concatenate([np.arange(1, 400) / 8, [1e3, 1e6, 1e9]])
    assert stats._lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def test_short_ids_and_positions(spark):
    df = spark.createDataFrame([("a_b_7_9_3",), ("a_b_3",), ("a_b_x_y",), (None,)], "g string").select("g", parse.short_gene_interval("g").alias("i"), parse.first_tokens("g").alias("t")).orderBy("g")
    got = {r.g: ((r.i.contig, r.i.start, r.i.end), r.t) for r in df.collect()}
    assert got == {"a_b_7_9_3": (("a_b", 3, 9), "a_b"), "a_b_3": ((None, None, None), "a_b"), "a_b_x_y": (("a_b", None, None), "a_b"), None: ((None, None, None), None)}
    left, right = (spark.createDataFrame([(x,) for x in v], f"{c} string") for c, v in (("p", "cab"), ("q", "z")))
    assert {tuple(r) for r in integrate.zipped(left, [F.asc("p")], right, [F.asc("q")]).collect()} == {(1, "a", "z"), (2, "b", None), (3, "c", None)}
    assert integrate.existing(left, ["x", "p"]).columns == ["p"]
    one_ = spark.createDataFrame([("K;P;F", "k;p;f", "x.fna")], "n string, r string, f string")
    row = one_.select(parse.lineage_rank("n", "r", "p").alias("p"), *parse.lineage_levels("n", list("abcd")), parse.strip_suffix("f", [".fna"]).alias("f"), parse.aliased("f", {"x.fna": "X"}).alias("g")).first()
    assert tuple(row) == ("P", "K", "P", "F", "", "x", "X")
