import random

import pytest
from genoloom.llm import components
from pyspark.sql import functions as F

DDL = "a string, b string, s long, d long, id long"


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a and b:
            x, y = sorted((find(a), find(b)), key=str.encode)
            up[y] = x
    return {x: find(x) for x in up}


def result(spark, edges, parts=3):
    df = spark.createDataFrame([(a, b, 1, 2, 3) for a, b in edges], DDL).repartition(parts)
    return {r.member: r.group_id for r in components.link_groups(df, "a", "b").collect()}


def test_shapes(spark):
    chain = [(f"c{k:03}", f"c{k + 1:03}") for k in range(150)]
    star = [("hub", f"leaf{k}") for k in range(300)]
    other = [("x", "x"), ("y", None), (None, "z"), ("", "w"), ("é", "zz"), ("zz", "é"), ("B", "a"), ("k" * 9000, "k")]
    edges = chain[::-1] + star + other + star[:20]
    assert result(spark, edges) == brute(edges)


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randrange(400)}", f"n{r.randrange(400)}") for _ in range(330)]
    assert result(spark, edges) == brute(edges)


def test_nothing(spark):
    assert components.link_groups(spark.createDataFrame([], DDL), "a", "b").count() == 0
    assert components.link_groups(spark.createDataFrame([(None, "x", 1, 1, 1)], DDL), "a", F.col("b")).count() == 0


def test_shared_hashes_take_another_seed(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(components.F, "xxhash64", lambda *c: real(*c) if len(c) > 1 else real(F.substring(c[0], 1, 1)))
    edges = [("a1", "a2"), ("a3", "b1"), ("b2", "b3")]
    assert result(spark, edges) == brute(edges)


def test_hub_is_split(spark):
    """Half of the edges on one node: both joins read it by skewed partitions, split over tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    had = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        other = "case when id % 2 = 0 then {hub} else pmod(xxhash64(id), 1000000) + 10 end"
        scratch = components.Scratch(spark)
        for step, hub_is in ((components.large_star, "d"), (components.small_star, "s")):
            far = "id + 2000000" if hub_is == "d" else "-id - 10"
            s, d = (far, other.format(hub=5)) if hub_is == "d" else (other.format(hub=5), far)
            edges, _ = scratch.put(spark.range(200_000).selectExpr(f"cast({s} as long) s", f"cast({d} as long) d").repartition(8))
            least, _ = scratch.put(components._minimum(edges))
            out = step(edges, least)
            plan = out._jdf.queryExecution().executedPlan()
            out.collect()
            assert "skew=true" in plan.toString(), (step.__name__, plan.toString())
    finally:
        for k, v in had.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
