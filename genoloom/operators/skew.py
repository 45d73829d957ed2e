"""Per-key results where a few keys hold most rows.

States are merged in a tree: rows of fixed-size input chunks are combined first, then ``fan_in`` nodes
at a time until one is left. Chunks are dealt to the first nodes by hash, ``fan_in`` to each on average;
every later node takes the states of exactly ``fan_in`` nodes, whatever share of the rows a key holds. What isn't of bounded size for one key (the set of its distinct values, the
histogram of a figure) is kept as rows of (key, value), never as one row's array, so that it spreads too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.stats import value_bucket


def tree_aggregate(
    df: DataFrame,
    keys: list[str],
    init: dict[str, Column],
    merge: dict[str, Column],
    chunk_rows: int = 1 << 15,
    fan_in: int = 8,
    rows: int | None = None,
) -> DataFrame:
    """One row per combination of ``keys`` with the merged states.

    init: name -> aggregate over raw rows; merge: the same names -> aggregate over states of that name.
    The number of rounds is the logarithm (base ``fan_in``) of the number of chunks. Keys that are null
    group as one key; an empty input gives no rows. ``rows`` saves the count, if it is known.
    """
    chunks = max(math.ceil((rows if rows is not None else df.count()) / chunk_rows), 1)
    width = fan_in ** max(0, math.ceil(math.log(max(chunks, 1), fan_in)) - 1)
    node = "__node"
    row = F.monotonically_increasing_id()
    # The upper bits of the row number are the input partition: a chunk never spans two of them.
    chunk = F.floor(row / chunk_rows) if chunk_rows > 1 else row
    states = df.withColumn(node, F.pmod(F.xxhash64(chunk), F.lit(width)))
    states = states.groupBy(*keys, node).agg(*(c.alias(n) for n, c in init.items()))
    while width > 1:
        width //= fan_in
        states = states.withColumn(node, F.col(node) % width).groupBy(*keys, node).agg(*(c.alias(n) for n, c in merge.items()))
    return states.drop(node) if width == 1 else states


def key_counts(df: DataFrame, key: str, out: str = "n_rows", **tree) -> DataFrame:
    """Rows per ``key``; repeated rows count, rows without a key are left out."""
    return tree_aggregate(df.where(F.col(key).isNotNull()).select(key), [key], {out: F.count(F.lit(1))}, {out: F.sum(out)}, **tree)


def key_profile(df: DataFrame, key: str, distinct_of: str | None = None, median_of: str | None = None, **tree) -> DataFrame:
    """(key, n_rows[, n_distinct][, median]) for each ``key``, exactly.

    Rows whose key is null are left out; repeated rows count; null values aren't counted among the
    distinct ones, null and NaN figures don't enter the median (null where a key has no figure).
    Other columns, whatever their names, are ignored; an empty table gives an empty result.
    """
    rows = tree.pop("rows", None)
    rows = df.count() if rows is None else rows
    picked = {"__key": key, "__value": distinct_of, "__figure": median_of}
    df = df.select(*(F.col(c).alias(a) for a, c in picked.items() if c)).where("__key is not null")
    out = tree_aggregate(df, ["__key"], {"n_rows": F.count(F.lit(1))}, {"n_rows": F.sum("n_rows")}, rows=rows, **tree)
    if distinct_of:
        pairs = tree_aggregate(df.where("__value is not null"), ["__key", "__value"], {"n": F.lit(1)}, {"n": F.lit(1)}, rows=rows, **tree)
        distinct = tree_aggregate(pairs, ["__key"], {"n_distinct": F.count(F.lit(1))}, {"n_distinct": F.sum("n_distinct")}, rows=rows, **tree)
        out = out.join(distinct, "__key", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    if median_of:
        figure = F.col("__figure").cast("double")
        histogram = tree_aggregate(
            df.select("__key", figure.alias("v")).where("v is not null and not isnan(v)"),
            ["__key", "v"], {"n": F.count(F.lit(1))}, {"n": F.sum("n")}, rows=rows, **tree,
        )
        out = out.join(median_of_histogram(histogram, "__key"), "__key", "left")
    return out.withColumnRenamed("__key", key)


def median_of_histogram(histogram: DataFrame, key: str) -> DataFrame:
    """(key, median) of rows (key, v double, n long), v being distinct per key.

    A coarse histogram over buckets that rise with v tells where the middle lies; only the one or two
    buckets holding it are sorted, so that even a key with billions of distinct figures sorts few.
    """
    h = histogram.withColumn("b", value_bucket())
    per = h.groupBy(key, "b").agg(F.sum("n").alias("m"))
    w = W.partitionBy(key)
    per = (
        per.withColumn("upto", F.sum("m").over(w.orderBy("b").rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("total", F.sum("m").over(w))
        .withColumn("lo", F.floor((F.col("total") + 1) / 2))
        .withColumn("hi", F.floor((F.col("total") + 2) / 2))
        .where("(upto >= lo and upto - m < lo) or (upto >= hi and upto - m < hi)")
        .select(key, "b", (F.col("upto") - F.col("m")).alias("before"), "lo", "hi")
    )
    near = h.join(per, [key, "b"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(W.partitionBy(key, "b").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    )
    holds = lambda at: F.max(F.when((F.col("upto") >= F.col(at)) & (F.col("upto") - F.col("n") < F.col(at)), F.col("v")))
    return near.groupBy(key).agg(((holds("lo") + holds("hi")) / 2).alias("median"))


def frequent_values(df: DataFrame, fields: dict[str, Column], share: tuple[int, int] = (2, 100), **tree) -> DataFrame:
    """(field, key_value, n_rows): values holding at least the given share (a fraction) of all rows.

    fields: name -> column. Rows with a null value count in the total only; repeated rows count. All
    fields are counted in one tree. An empty table gives no rows.
    """
    rows = df.count()
    long = df.select(F.explode(F.array(*(F.struct(F.lit(n).alias("field"), c.cast("string").alias("key_value")) for n, c in fields.items()))).alias("x")).select("x.*")
    counts = tree_aggregate(
        long.where("key_value is not null"), ["field", "key_value"], {"n_rows": F.count(F.lit(1))}, {"n_rows": F.sum("n_rows")}, rows=rows * len(fields), **tree
    )
    return counts.where(F.col("n_rows") * share[1] >= F.lit(rows) * share[0])


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``per_key`` (a written table of one row per key, ``n`` counting the key's rows) but ``n``.

    Keys that hold at least one in ``share`` of all rows, at most ``share`` keys, are broadcast: their rows
    stay in the tasks that read them. In the join of the others no key holds more than that part. Rows
    with a null key, or without a row in ``per_key``, are left out.
    """
    total = per_key.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * share >= F.lit(total)
    hot = per_key.where(is_hot).drop(n)
    near = rows.join(F.broadcast(hot), keys)  # at most ``share`` rows
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(per_key.where(~is_hot).drop(n), keys)
    return near.unionByName(far)
