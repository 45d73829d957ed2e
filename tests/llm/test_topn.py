import random

import pytest
from genoloom.llm import topn

DDL = "g string, tie double, score double, id long, band int, salt string, rank int"


def brute(data, n):
    best = {}
    for g, tie, score, i, *_ in data:
        if None in (g, tie, score, i) or any(x != x or abs(x) == float("inf") for x in (tie, score)):
            continue
        best.setdefault(g, set()).add((-score, tie, i))
    return {(g, k + 1, i) for g, s in best.items() for k, (_, _, i) in enumerate(sorted(s)[:n])}


def rows():
    r = random.Random(5)
    out = []
    for k in range(4000):
        g = r.choice(["hot"] * 20 + [f"g{x}" for x in range(200)] + [None, "", "é" * 3000])
        out.append((g, r.choice([0.0, -0.0, 1.0, None, float("nan")]), r.choice([1.0, 2.0, 2.0, -3.0, 0.0, -0.0, float("inf"), float("nan"), None, r.random() * 100]), k if r.random() < 0.99 else None, 1, "x", 9))
    return out + out[:500]


@pytest.mark.parametrize(("n", "bands", "salts"), [(3, 4, 16), (1, 1, 1), (5, 9, 3)])
def test_brute_force(spark, n, bands, salts):
    data = rows()
    df = spark.createDataFrame(data, DDL).repartition(5)
    got = topn.top_n(df, "g", "score", "tie", "id", n, bands, salts)
    assert got.columns == ["g", "score", "tie", "id", "rank"]
    assert {(r.g, r["rank"], r.id) for r in got.collect()} == brute(data, n)
    assert got.count() == len(brute(data, n))


def test_all_equal_scores(spark):
    df = spark.createDataFrame([("g", 1.0, 2.0, k, 0, "", 0) for k in range(1000)], DDL)
    assert [r.id for r in topn.top_n(df, "g", "score", "tie", "id").orderBy("rank").collect()] == [0, 1, 2]


def test_nothing_and_swapped_names(spark):
    df = spark.createDataFrame([], DDL)
    assert topn.top_n(df, "g", "score", "tie", "id").count() == 0
    df = spark.createDataFrame([("a", 1.0, 2.0, 7, 0, "", 0)], "score string, id double, g double, tie long, band int, salt string, rank int")
    assert tuple(topn.top_n(df, "score", "g", "id", "tie").first()) == ("a", 2.0, 1.0, 7, 1)
