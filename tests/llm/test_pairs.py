import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from genoloom.llm import pairs
from pyspark.sql import functions as F

DDL = "basket string, item string, n long, i int, block int"


def brute(data, least=1):
    baskets = {}
    for b, i, *_ in data:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    one = Counter(i for s in baskets.values() for i in s)
    two = Counter(p for s in baskets.values() for p in combinations(sorted(s, key=str.encode), 2))
    n = len(baskets)
    return {(a, b): (c, one[a], one[b], n, pytest.approx(c * n / (one[a] * one[b]))) for (a, b), c in two.items() if c >= least}


def result(df, **kw):
    return {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n, r.lift) for r in pairs.item_pairs(df, "basket", "item", **kw).collect()}


def rows():
    r = random.Random(3)
    items = ["", "é", "z" * 5000, "hot"] + [f"i{k}" for k in range(40)]
    out = [("big", i) for i in items] + [(f"b{k}", "hot") for k in range(60)]
    out += [(r.choice([None, ""] + [f"b{k}" for k in range(60)]), r.choice([None, *items])) for _ in range(600)]
    return [(b, i, 1, 2, 3) for b, i in out + out[:50]]


@pytest.mark.parametrize(("item_block", "cell_rows"), [(512, 500_000), (7, 50), (1, 20)])
def test_all_pairs(spark, item_block, cell_rows):
    data = rows()
    df = spark.createDataFrame(data, DDL).repartition(3)
    assert result(df, item_block=item_block, cell_rows=cell_rows) == brute(data)
    assert result(df, item_block=item_block, cell_rows=cell_rows, min_count=4) == brute(data, 4)


def test_nothing(spark):
    df = spark.createDataFrame([], DDL)
    assert result(df) == {}
    assert result(spark.createDataFrame([(None, "a", 1, 1, 1), ("b", None, 1, 1, 1), ("c", "x", 1, 1, 1)], DDL)) == {}


def test_gram_in_slabs(monkeypatch):
    monkeypatch.setattr(pairs, "SLAB", 5)
    rng = np.random.default_rng(0)
    x = rng.random((30, 9)) < 0.4
    b, i = np.nonzero(x)
    got = pairs.gram(b, i, i, 9, 9)
    assert (got == x.astype(int).T @ x.astype(int)).all()


def test_rows_go_to_the_blocks_of_their_basket_only(spark):
    """2,000 items in 200 blocks, baskets of ten: a row is sent some ten times, not 200."""
    df = spark.range(20_000).selectExpr("cast(id div 10 as string) basket", "cast(pmod(xxhash64(id), 2000) as string) item").distinct()
    kept = df.selectExpr("*", "cast(pmod(xxhash64(item), 200) as int) block", "0 r")
    n, per = kept.count(), kept.groupBy("basket").agg(F.count("*").alias("n"), F.count_distinct("block").alias("m")).selectExpr("sum(n * m)").first()[0]
    met = pairs.met_blocks(kept, 200)
    assert met.count() == per <= 10 * n and met.where("i > j").isEmpty()
    data = [(r.basket, r.item, 1, 2, 3) for r in df.collect()]
    assert result(df, item_block=10) == brute(data)
