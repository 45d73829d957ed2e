"""The relational forms of both set filters against greedy loops, on random clusters."""

import random
from itertools import combinations

import __spark_entry__ as e
import pytest
from genoloom.operators import sets
from genoloom.session import Scratch


def clusters(seed):
    r = random.Random(seed)
    return {(f"s{r.randrange(5)}", k): frozenset(r.sample("abcdefg", r.randrange(1, 5))) for k in range(r.randrange(10, 40))}


def greedy_maximal(found):
    species = {}
    for (s, _), genes in found.items():
        if len(genes) >= 2:
            species.setdefault(genes, set()).add(s)
    few = len({s for (s, _), g in found.items() if len(g) >= 2}) < 3
    kept = []
    for genes in sorted((g for g, s in species.items() if few or len(s) >= 2), key=lambda g: (-len(g), sorted(g))):
        if not any(genes < k for k in kept):
            kept.append(genes)
    return set(kept)


def greedy_closed(found):
    many = {k: g for k, g in found.items() if len(g) >= 2}
    common = {a & b for a, b in combinations(many.values(), 2) if len(a & b) >= 2}
    holding = {g: [k for k, x in many.items() if g <= x] for g in common}
    kept = {}
    for genes in sorted(common, key=lambda g: (-len(g), sorted(g))):
        species = {s for s, _ in holding[genes]}
        if not any(genes < k and species <= s for k, (s, _) in kept.items()):
            kept[genes] = (species, len(holding[genes]))
    return {g: (n, len(s)) for g, (s, n) in kept.items()}


@pytest.mark.parametrize("seed", range(4))
def test_against_greedy_loops(spark, seed):
    found = clusters(seed)
    rows = [(s, k, g) for (s, k), genes in found.items() for g in genes]
    sigs = sets.signatures(spark.createDataFrame(rows, "s string, k int, g string"), "s", "k", "g")
    assert {frozenset(r.genes) for r in sets.maximal(sets.recurring(sigs)).collect()} == greedy_maximal(found)
    assert {frozenset(r.genes): (r.n_clusters, r.n_species) for r in sets.closed(sigs).collect()} == greedy_closed(found)


def joins(df, kind):
    """The planned joins of that kind."""
    return [x.strip() for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if f", {kind}" in x]


def test_index_of_pairs_is_never_broadcast(spark):
    """A written table of sets is small beside its pairs of genes, which must not go through the driver."""
    found, _ = Scratch(spark).put(spark.createDataFrame([(sorted(g),) for g in {frozenset(x) for x in combinations("abcdefgh", 4)}], "genes array<string>"))
    anti = joins(sets.maximal(found), "LeftAnti")
    assert anti and all("SortMergeJoin" in x for x in anti)
    pairs = [x for x in joins(sets.supersets(found, found), "Inner") if "pair" in x]
    assert pairs and all("SortMergeJoin" in x for x in pairs)


def test_kept_sets_are_never_broadcast(spark):
    semi = joins(e.queries()["a8_set_members"](spark, "/root/testdata/sf0.001"), "LeftSemi")
    assert len(semi) == 2 and "SortMergeJoin" in semi[0]  # that of the members comes before that within the sets
