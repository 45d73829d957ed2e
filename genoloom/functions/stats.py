"""Statistics: composite scores, ranks, corrected p-values, tails of distributions.

Whatever needs an order within a group works on the group's histogram in two steps: totals of coarse
buckets of values, then the values of one bucket. No task sorts a whole group, however large.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Buckets per power of two.
STEPS = 64


def value_bucket(v: str = "v") -> Column:
    """A bucket that rises with the (finite) value."""
    size = F.least(F.log2(F.abs(F.col(v))) + 1100, F.lit(3000.0)) * STEPS
    return F.when(F.col(v) == 0, F.lit(0)).otherwise(F.floor(F.signum(v) * size)).cast("long")


def positions(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, v, n) with ``before``: how many of the key's values are smaller, ``total``: how many there are."""
    h = histogram.withColumn("bucket", value_bucket())
    w = W.partitionBy(*keys)
    per = h.groupBy(*keys, "bucket").agg(F.sum("n").alias("m"))
    per = per.withColumn("lower", F.sum("m").over(w.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("m")).withColumn("total", F.sum("m").over(w)).drop("m")
    inner = W.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    return h.join(per, [*keys, "bucket"]).withColumn("before", F.col("lower") + F.sum("n").over(inner) - F.col("n")).drop("lower", "bucket")


def _histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("v")).where("v is not null and not isnan(v)")
    return rows.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))


def average_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, v, n, rank): rank of each distinct value among its key's values, ties averaged; nulls and NaN left out."""
    return positions(_histogram(df, keys, value), keys).withColumn("rank", F.col("before") + (F.col("n") + 1) / 2).drop("before", "total")


def benjamini_hochberg(df: DataFrame, keys: list[str], p: str) -> DataFrame:
    """(keys, v, adjusted): the corrected value of each distinct p-value of a key; null ones don't count."""
    at = positions(_histogram(df, keys, p), keys).withColumn("raw", F.col("v") * F.col("total") / (F.col("before") + F.col("n"))).withColumn("bucket", value_bucket())
    later = at.groupBy(*keys, "bucket").agg(F.min("raw").alias("least"))
    later = later.withColumn("beyond", F.min("least").over(W.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1))).drop("least")
    inner = F.min("raw").over(W.partitionBy(*keys, "bucket").orderBy(F.desc("v")).rowsBetween(W.unboundedPreceding, 0))
    return at.join(later, [*keys, "bucket"]).withColumn("adjusted", F.least(F.lit(1.0), inner, F.col("beyond"))).select(*keys, "v", "adjusted")


def composite_score(length: Column, evalue: Column, identity: Column, most_length: Column, least_evalue: Column, most_identity: Column, weights: tuple[float, float, float] = (1, 1, 1)) -> Column:
    """Weighted mean of length, -log10 of e-value and identity, each relative to the best of its group."""
    guard = lambda c: F.when(c <= 0, 1.0).otherwise(c)
    log = lambda e: -F.log10(e + F.lit(1e-300))
    least = F.when(least_evalue <= 0, F.lit(1e-300)).otherwise(least_evalue)
    wl, we, wi = weights
    return (wl * length / guard(most_length) + we * F.try_divide(log(evalue), log(least)) + wi * identity / guard(most_identity)) / sum(weights)


def t_statistic(r: Column, n: Column) -> Column:
    """t of a correlation; null where it is 1 or -1 or n is below 3."""
    return r * F.sqrt(F.when(n > 2, F.try_divide(n - 2, 1 - r * r)))


def _beta_fraction(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


#: Stirling's series of the logarithm of the gamma function: 1/12, -1/360, 1/1260, ... over odd powers.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def _lgamma(x: np.ndarray | float) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers; small ones are raised to ten and more first."""
    x = np.asarray(x, float)
    up = np.ceil(np.maximum(10 - x, 0))
    below = np.zeros_like(x)
    for k in range(10):
        below += np.where(k < up, np.log(np.where(k < up, x + k, 1.0)), 0.0)
    y = x + up
    series = sum(c / y ** (2 * k + 1) for k, c in enumerate(_STIRLING))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - below


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function."""
    a, b, x = (np.asarray(v, float) for v in np.broadcast_arrays(a, b, x))
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(np.clip(x, 1e-300, 1)) + b * np.log(np.clip(1 - x, 1e-300, 1)))
    low = x < (a + 1) / (a + b + 2)
    one = front * _beta_fraction(np.where(low, a, b), np.where(low, b, a), np.where(low, x, 1 - x)) / np.where(low, a, b)
    out = np.where(low, one, 1 - one)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t, null where t or df is."""

    @F.pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        good = t.notna() & df.notna() & (df > 0)
        out = pd.Series(np.nan, t.index)
        d, x = df[good].to_numpy(float), t[good].to_numpy(float)
        out[good] = incomplete_beta(d / 2, 0.5, d / (d + x * x))
        return out.astype(object).where(good, None)

    return p(t.cast("double"), df.cast("double"))


def hypergeometric_tail(x: Column, m: Column, k: Column, n: Column) -> Column:
    """P(at least x of the k drawn are among the m marked of n)."""

    @F.pandas_udf("double")
    def tail(x: pd.Series, m: pd.Series, k: pd.Series, n: pd.Series) -> pd.Series:
        x, m, k, n = (v.to_numpy(float) for v in (x, m, k, n))
        choose = lambda a, b: _lgamma(a + 1) - _lgamma(b + 1) - _lgamma(a - b + 1)
        low, high = np.maximum(x, k - (n - m)), np.minimum(k, m)
        terms = np.maximum(high - low + 1, 0).astype(np.int64)  # all terms of all rows side by side
        row = np.repeat(np.arange(len(x)), terms)
        i = np.arange(len(row)) - np.repeat(np.cumsum(terms) - terms, terms) + low[row]
        p = np.exp(choose(m[row], i) + choose((n - m)[row], k[row] - i) - choose(n, k)[row])
        return pd.Series(np.minimum(np.bincount(row, weights=p, minlength=len(x)), 1.0))

    return tail(x.cast("long"), m.cast("long"), k.cast("long"), n.cast("long"))


def empirical_p(null: Column, observed: Column) -> Column:
    """(share of null values at least as large as the observed one, both counted once more), as an aggregate."""
    return (F.count_if(null >= observed) + 1) / (F.count(null) + 1)
