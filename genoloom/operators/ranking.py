"""Best rows per group, top rows, identifiers by order, and deterministic samples.

Best rows are found by aggregates of structs (``max_by``) or by ranks with a limit, both of which Spark
reduces inside the map tasks before any shuffle, so groups of any size are handled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.stats import composite_score


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; ties beyond ``order`` must be broken by it."""
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def counts_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_share(counts: DataFrame, n: str, share: str = "share") -> DataFrame:
    """Each row's part of the sum of ``n``."""
    total = counts.agg(F.sum(n).alias("__total"))
    return counts.crossJoin(F.broadcast(total)).withColumn(share, F.try_divide(n, "__total")).drop("__total")  # the right side is one row


def dense_ids(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive ids in the order given, without bringing the rows into one task.

    Rows are range-partitioned and sorted; only the number of rows per partition is numbered centrally.
    """
    from ..session import Scratch

    scratch = Scratch(df.sparkSession)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__dense_at", F.monotonically_increasing_id())
    placed, _ = scratch.put(placed)
    part = F.shiftright("__dense_at", 33)
    sizes = placed.groupBy(part.alias("__dense_part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(W.orderBy("__dense_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).drop("__n")  # a row per partition
    return placed.withColumn("__dense_part", part).join(before, "__dense_part").withColumn(name, F.col("__before") + F.col("__dense_at").bitwiseAND(F.lit((1 << 33) - 1)) + start).drop("__dense_part", "__dense_at", "__before")


def sample_per_group(df: DataFrame, keys: list[str], item: str, n: int | Column, seed: str) -> DataFrame:
    """n rows of each group, drawn by the order of md5(seed, group, item): the same rows every time."""
    draw = F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in keys), F.col(item).cast("string")))
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(draw, item))
    if isinstance(n, int):
        return df.withColumn("__rn", rn).where(F.col("__rn") <= n).drop("__rn")
    return df.withColumn("__rn", rn).where(F.col("__rn") <= n).drop("__rn")


def best_hits(hits: DataFrame, keys: list[str], min_length: int = 1, max_evalue: float = 9999, min_identity: float = 0, weights: tuple[float, float, float] = (1, 1, 1)) -> DataFrame:
    """One row per group with its best hit by length, e-value, identity and composite score.

    hits: keys (groups with a null one are left out), hit_id, subject, length, evalue, identity. Ties go to
    the lowest hit_id. Columns: subject_by_X, length_by_X, identity_by_X, evalue_by_X for X of length,
    evalue, identity, comprehensive; comprehensive_score; all_same. Hits without finite figures take no part.
    The three plain bests are one aggregate, written; hits meet them for the composite score by
    ``join_per_key``, so that a group of a third of all hits reaches no task as a whole.
    """
    from ..session import Scratch
    from .skew import join_per_key

    ok = f"length >= {min_length} and evalue <= {max_evalue} and identity >= {min_identity} and not isnan(evalue) and not isnan(identity) and abs(evalue) < double('infinity') and abs(identity) < double('infinity')"
    for k in keys:
        ok += f" and `{k}` is not null"
    hits = hits.where(ok)
    pick = F.struct("subject", "length", "identity", "evalue")
    best = hits.groupBy(*keys).agg(
        F.max_by(pick, F.struct("length", -F.col("hit_id"))).alias("length_best"),
        F.min_by(pick, F.struct("evalue", "hit_id")).alias("evalue_best"),
        F.max_by(pick, F.struct("identity", -F.col("hit_id"))).alias("identity_best"),
        F.count(F.lit(1)).alias("__n"),
    )
    best, _ = Scratch(hits.sparkSession).put(best)
    limits = best.select(*keys, "__n", F.col("length_best.length").alias("__length"), F.col("evalue_best.evalue").alias("__evalue"), F.col("identity_best.identity").alias("__identity"))
    score = composite_score(F.col("length"), F.col("evalue"), F.col("identity"), F.col("__length"), F.col("__evalue"), F.col("__identity"), weights)
    scored = join_per_key(hits, limits, keys, "__n").withColumn("score", score)
    order = F.struct(F.col("score").isNotNull(), "score", -F.col("hit_id"))
    composed = scored.groupBy(*keys).agg(F.max_by(pick, order).alias("comprehensive_best"), F.max_by("score", order).alias("comprehensive_score"))
    out = best.join(composed, keys)
    criteria = ("length", "evalue", "identity", "comprehensive")
    columns = [F.col(f"{x}_best.{c}").alias(f"{c}_by_{x}") for x in criteria for c in ("subject", "length", "identity", "evalue")]
    same = [F.col("length_best.subject").eqNullSafe(F.col(f"{x}_best.subject")) for x in criteria[1:]]
    return out.select(*keys, *columns, "comprehensive_score", (same[0] & same[1] & same[2]).alias("all_same"))


def label_top(df: DataFrame, name: str, by: list[Column], n: int, out: str = "label") -> DataFrame:
    """``name`` for the first n rows in the order given, null for the others."""
    first = top_rows(df, by, n).select(F.col(name).alias("__name"))
    return df.join(first, df[name] == first["__name"], "left").withColumn(out, F.col("__name")).drop("__name")


def even_batches(df: DataFrame, order: list[Column], batches: int, name: str = "batch") -> DataFrame:
    """Rows in order, dealt into at most ``batches`` batches of ceil(total / batches) rows."""
    total = df.count()
    size = max(1, -(-total // batches))
    return dense_ids(df, order, "__id", 0).withColumn(name, F.floor(F.col("__id") / size) + 1).drop("__id")
