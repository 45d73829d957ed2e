"""Queries that do more than their SQL says: the whole job on the smallest tables and on micro fixtures."""

import __spark_entry__ as e
import compare
import numpy as np
import pytest
from genoloom.operators import enrich, graph
from genoloom.plans import statistics

BASE = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"


def sql_rows(name):
    cur = compare.connect(BASE).execute(e.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    return [dict(zip(columns, r)) for r in cur.fetchall()]


def test_random_sets_are_as_large_as_their_clusters(spark):
    got = e.queries()["o11_random_sets"](spark, BASE).collect()
    want = {r.conserved_id: r.gene_count for r in spark.read.parquet(f"{BASE}/conserved_cluster.parquet").where("gene_count > 0").collect()}
    sizes = {}
    for r in got:
        sizes.setdefault(r.set_id, set()).add(r.gene)
    assert max(want.values()) > 10 and {k: len(v) for k, v in sizes.items()} == want and len(got) == sum(want.values())
    assert {(r["set_id"], r["gene"]) for r in sql_rows("o11_random_sets")} <= {(r.set_id, r.gene) for r in got}


def test_network_holds_every_gene_of_the_best_terms(spark):
    terms, hits = ({tuple(r) for r in f(spark, LARGER).collect()} for f in (statistics.annotation, statistics.drawn))
    tested = enrich.over_representation(statistics.annotation(spark, LARGER), statistics.drawn(spark, LARGER)).collect()
    best = {r.term for r in sorted(tested, key=lambda r: (r.adjusted, r.p, r.term))[:10]}
    genes = {}
    for term, gene in terms:
        if term in best and (gene,) in hits:
            genes.setdefault(gene, set()).add(term)
    want = {(a, b, len(genes[a] & genes[b])) for a in genes for b in genes if a < b and genes[a] & genes[b]}
    got = e.queries()["g15_network"](spark, LARGER).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert len({g for r in got for g in (r.a, r.b)}) > 20


def test_centralities_are_converged(spark):
    """A bipartite leading component (a path) beside a smaller one, against dense linear algebra."""
    rows = [(f"n{k:02}", f"n{k + 1:02}", 5.0 + k % 3) for k in range(11)] + [("x", "y", 2.0), ("y", "z", 1.0), ("x", "z", 1.0)]
    names = sorted({n for r in rows for n in r[:2]})
    m = np.zeros((len(names), len(names)))
    for a, b, w in rows:
        m[names.index(a), names.index(b)] = m[names.index(b), names.index(a)] = w
    edges = spark.createDataFrame(rows, "a string, b string, score double")
    rank = np.linalg.solve(np.eye(len(m)) - 0.85 * m / m.sum(0), np.full(len(m), 0.15 / len(m)))
    leading = np.abs(np.linalg.eigh(m)[1][:, -1])
    ranks = {r.node: r["rank"] for r in graph.page_rank(edges).collect()}
    values = {r.node: r.centrality for r in graph.eigenvector(edges).collect()}
    assert [ranks[n] for n in names] == pytest.approx(rank, abs=1e-9)
    assert [values[n] for n in names] == pytest.approx(leading / leading.max(), abs=1e-6)
    assert graph.eigenvector(edges.limit(0)).isEmpty() and graph.page_rank(edges.limit(0)).isEmpty()


def test_cores_need_no_round_for_each_node_of_a_chain(spark):
    chain = spark.createDataFrame([(f"n{k:04}", f"n{k + 1:04}") for k in range(300)], "a string, b string")
    spark.sparkContext.setJobGroup("chain", "cores of a chain")
    got = graph.coreness(chain).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setJobGroup("", "")
    assert len(got) == 301 and {r.core for r in got} == {1} and len(jobs) < 40


@pytest.mark.parametrize("in_one_task", [0, 25, 2_000_000])
def test_cores_do_not_depend_on_what_one_task_finishes(spark, in_one_task):
    """Dense parts with chains and trees hanging on them, between them and by themselves."""
    r = np.random.default_rng(5)
    rows = {(f"d{i:02}", f"d{j:02}") for i in range(14) for j in range(i + 1, 14) if r.random() < 0.6} | {(f"e{i}", f"e{j}") for i in range(5) for j in range(i + 1, 5)}
    rows |= {(f"t{k // 2:02}", f"t{k:02}") for k in range(1, 12)} | {("d00", "t00"), ("e0", "x0"), ("d01", "x5")} | {(f"x{k}", f"x{k + 1}") for k in range(5)} | {(f"y{k:02}", f"y{k + 1:02}") for k in range(20)}
    near = {}
    for a, b in rows:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    cores, left, k = {}, {v: set(o) for v, o in near.items()}, 0
    while left:
        k += 1
        while weak := [v for v in left if len(left[v]) < k]:
            for v in weak:
                cores[v] = k - 1
                for o in left.pop(v):
                    if o in left:
                        left[o].discard(v)
    assert max(cores.values()) > 4 and min(cores.values()) == 1
    got = graph.coreness(spark.createDataFrame(sorted(rows), "a string, b string"), in_one_task).collect()
    assert {x.node: x.core for x in got} == cores and len(got) == len(cores)
