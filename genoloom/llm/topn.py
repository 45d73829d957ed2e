"""The best N rows of each of very many groups, by descending score bands.

Rows are range-partitioned into bands of score and the bands are processed from the top. Groups that
already have N rows take no part in lower bands (an anti-join); what a band adds is ranked exactly, ties
included. Within a band each (group, salt) is first cut to its N best inside the map tasks, so a group
holding a third of all rows reaches no task as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import Scratch


def top_n(df: DataFrame, group: str, score: str, tie: str, row_id: str, n: int = 3, bands: int = 4, salts: int = 16) -> DataFrame:
    """(group, score, tie, row_id, rank) of the n best rows of each group: highest score, lowest tie, lowest row_id.

    Rows with a null group or id, or whose score or tie is null or not finite, take no part. Rows equal in
    all four columns are one row. Groups with fewer rows keep all they have. Other columns are ignored,
    an empty table gives no rows. The result doesn't depend on bands or salts.
    """
    finite = lambda c: f"{c} is not null and not isnan({c}) and abs({c}) <= 1.7976931348623157e308"
    rows = df.select(F.col(group).cast("string").alias("g"), F.col(score).cast("double").alias("score"), F.col(tie).cast("double").alias("tie"), F.col(row_id).cast("long").alias("id"))
    rows = rows.where(f"g is not null and id is not null and {finite('score')} and {finite('tie')}")
    # -0.0 and 0.0 are the same score.
    rows = rows.withColumns({c: F.col(c) + F.lit(0.0) for c in ("score", "tie")})
    cuts = sorted(set(rows.approxQuantile("score", [k / bands for k in range(1, bands)], 0.01)), reverse=True) if bands > 1 else []
    band = F.lit(len(cuts))
    for k in reversed(range(len(cuts))):
        band = F.when(F.col("score") >= cuts[k], k).otherwise(band)
    scratch = Scratch(df.sparkSession)
    banded, banded_at = scratch.put(rows.withColumn("band", band), ["band"])

    order = [F.desc("score"), F.asc("tie"), F.asc("id")]
    best = lambda x, *keys: x.withColumn("rank", F.dense_rank().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
    full: DataFrame | None = None  # rows of the groups that have n
    rest: DataFrame | None = None  # rows of the others
    rest_at = None
    for k in range(len(cuts) + 1):
        found = banded.where(F.col("band") == k).drop("band").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
        # Equal rows share a salt: with it among the keys they are found where they lie, without a shuffle.
        found = best(found, "g", "salt").drop("rank").dropDuplicates().drop("salt")
        if full is not None:
            found = found.join(full.where("rank = 1").select("g"), "g", "left_anti").unionByName(rest)
        ranked = best(found, "g").withColumn("filled", F.max("rank").over(W.partitionBy("g")) >= n)
        state, state_at = scratch.put(ranked, ["filled"])
        new = state.where("filled").drop("filled")
        full = new if full is None else full.unionByName(new)
        if rest_at:
            scratch.drop(f"{rest_at}/filled=false")
        rest, rest_at = state.where("not filled").drop("filled", "rank"), state_at
        last = state.where("not filled").drop("filled")
    scratch.drop(banded_at)
    return full.unionByName(last).select(F.col("g").alias(group), F.col("score").alias(score), F.col("tie").alias(tie), F.col("id").alias(row_id), "rank")
