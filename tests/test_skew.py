import random
import statistics
from collections import Counter, defaultdict

from genoloom.operators import skew
from pyspark.sql import functions as F

DDL = "key string, value string, x double, n long, node int"


def rows(n=3000, seed=1):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        key = r.choice(["hot"] * 10 + ["b", "c", "d", None, "", "é"])
        x = r.choice([None, float("nan"), 0.0, -0.0, -1.5, 1e-300, 1e300, float("inf"), r.random(), r.random() * 1e-9, float(r.randrange(5))])
        out.append((key, r.choice([None, "", "v"] + [f"v{k}" for k in range(50)]), x, 7, 8))
    return out


def brute(data):
    count, values, figures = Counter(), defaultdict(set), defaultdict(list)
    for key, value, x, *_ in data:
        if key is None:
            continue
        count[key] += 1
        if value is not None:
            values[key].add(value)
        if x is not None and x == x:
            figures[key].append(x)
    return {k: (n, len(values[k]), statistics.median(figures[k]) if figures[k] else None) for k, n in count.items()}


def test_profile_in_deep_trees(spark):
    data = rows()
    df = spark.createDataFrame(data, DDL).repartition(5)
    for chunk, fan in ((1 << 15, 8), (16, 2), (50, 3)):
        got = {r[0]: (r.n_rows, r.n_distinct, r["median"]) for r in skew.key_profile(df, "key", "value", "x", chunk_rows=chunk, fan_in=fan).collect()}
        assert got == brute(data)


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], DDL)
    assert skew.key_profile(df, "key", "value", "x").count() == 0
    df = spark.createDataFrame([(None, "a", 1.0, 1, 1)], DDL)
    assert skew.key_profile(df, "key", "value", "x").count() == 0
    df = spark.createDataFrame([("a", None, None, 1, 1)], DDL)
    assert [tuple(r) for r in skew.key_profile(df, "key", "value", "x").collect()] == [("a", 1, 0, None)]


def test_frequent_values(spark):
    data = [("a", "x" * 100_000, 1.0, 1, 1)] * 3 + [(None, None, 1.0, 1, 1)] * 96 + [("b", "y", None, 1, 1)]
    df = spark.createDataFrame(data, DDL)
    got = {(r.field, r.key_value, r.n_rows) for r in skew.frequent_values(df, {"key": F.col("key"), "value": F.col("value")}, chunk_rows=7, fan_in=2).collect()}
    assert got == {("key", "a", 3), ("value", "x" * 100_000, 3)}
    assert skew.frequent_values(df.limit(0), {"key": F.col("key")}).count() == 0


def test_no_chunk_state_is_merged_by_one_task(spark):
    df = spark.range(100_000).select((F.col("id") % 3).cast("string").alias("key"))
    plan = skew.key_counts(df, "key", chunk_rows=1000, fan_in=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4  # the logarithm of 100 chunks to the base of 4


def test_scratch_tables_are_released(spark):
    import os

    from genoloom.session import Scratch, checkpoint, release

    df, at = Scratch(spark).put(spark.range(5))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir() in at
    release(spark)
    assert not os.path.exists(at.removeprefix("file:"))
    assert checkpoint(spark.range(3)).count() == 3
