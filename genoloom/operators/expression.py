"""Expression in long form (sample, gene, value[, tissue]): rank correlation, medians, permutation controls."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import stats
from ..session import Scratch


def to_long(df: DataFrame, ids: list[str], genes: list[str]) -> DataFrame:
    """(ids, gene, value) of a wide table."""
    return df.unpivot(ids, [F.col(f"`{g}`").cast("double").alias(g) for g in genes], "gene", "value")


def to_wide(cells: DataFrame, ids: list[str], missing: float = 0.0) -> tuple[DataFrame, list[str]]:
    """(a row of ids per sample with a column per gene, the genes); cells that are absent become ``missing``."""
    wide = cells.groupBy(*ids).pivot("gene").agg(F.first("value"))
    genes = [c for c in wide.columns if c not in ids]
    return wide.fillna(missing, genes), genes


def pairs_of(genes: DataFrame) -> DataFrame:
    """(gene1, gene2), gene1 < gene2, of a chosen list (a column ``gene``); the result of a correlation has a row for each."""
    one = genes.select("gene").distinct()
    return one.select(F.col("gene").alias("gene1")).join(one.select(F.col("gene").alias("gene2")), F.col("gene1") < F.col("gene2"))


def spearman(long: DataFrame, pairs: DataFrame, by: list[str], min_samples: int = 3) -> DataFrame:
    """(by, gene1, gene2, spearman_rho, n_samples, t, pvalue) of each of the ``pairs`` (gene1, gene2) asked for.

    Only the genes of the pairs are ranked, and a pair meets its two genes' values by joins, so the work is
    pairs x samples and no sample ever brings together all of its genes. by: strata, ranked and correlated
    apart; strata of fewer than min_samples samples are left out. Ranks are taken per gene over its values;
    undefined correlations (a constant gene) are null.
    """
    pairs = pairs.select("gene1", "gene2").distinct()
    genes = pairs.select(F.explode(F.array("gene1", "gene2")).alias("gene")).distinct()
    long = long.join(genes, "gene", "left_semi").where("value is not null and not isnan(value)").withColumn("value", F.col("value") + F.lit(0.0))
    ranks = stats.average_ranks(long, [*by, "gene"], "value").withColumnRenamed("v", "value").drop("n")
    ranked, _ = Scratch(long.sparkSession).put(long.join(ranks, [*by, "gene", "value"]).select(*by, "sample", "gene", "rank"))
    a = ranked.withColumnsRenamed({"gene": "gene1", "rank": "r1"})
    b = ranked.withColumnsRenamed({"gene": "gene2", "rank": "r2"})
    met = pairs.join(a, "gene1").join(b, [*by, "gene2", "sample"])
    out = met.groupBy(*by, "gene1", "gene2").agg(F.try_divide(F.covar_pop("r1", "r2"), F.stddev_pop("r1") * F.stddev_pop("r2")).alias("rho"), F.count(F.lit(1)).alias("n_samples")).where(F.col("n_samples") >= min_samples)
    out = out.withColumn("spearman_rho", F.when(F.col("rho").isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("rho"))))).drop("rho")
    out = out.withColumn("t", stats.t_statistic(F.col("spearman_rho"), F.col("n_samples")))
    return out.withColumn("pvalue", stats.t_two_sided(F.col("t"), F.col("n_samples") - 2))


def pair_metrics(pairs: DataFrame, correlations: DataFrame, level: float = 0.05) -> DataFrame:
    """(set_id, mean_rho, mean_abs_rho, max_abs_rho, prop_sig, n_pairs) of each set of pairs (set_id, gene1, gene2).

    correlations: (gene1, gene2, spearman_rho, pvalue). p-values are corrected within each set; pairs
    without a correlation count in n_pairs only.
    """
    from .enrich import adjusted

    rows, _ = Scratch(pairs.sparkSession).put(pairs.join(correlations.select("gene1", "gene2", "spearman_rho", "pvalue"), ["gene1", "gene2"], "left"))
    size, rho = F.abs("spearman_rho"), F.col("spearman_rho")
    return adjusted(rows, ["set_id"], "pvalue").groupBy("set_id").agg(
        F.avg(rho).alias("mean_rho"), F.avg(size).alias("mean_abs_rho"), F.max(size).alias("max_abs_rho"), F.avg((F.col("adjusted") < level).cast("double")).alias("prop_sig"), F.count(F.lit(1)).alias("n_pairs")
    )


def against_null(metrics: DataFrame, observed_id: str, names: list[str]) -> DataFrame:
    """(metric, observed, null_mean, null_sd, empirical_p, z_score, fold) of one set against all others."""
    long = metrics.unpivot(["set_id"], names, "metric", "value")
    observed = long.where(F.col("set_id") == observed_id).select("metric", F.col("value").alias("observed"))
    null = long.where(F.col("set_id") != observed_id).join(F.broadcast(observed), "metric")  # a row per metric
    out = null.groupBy("metric", "observed").agg(F.avg("value").alias("null_mean"), F.stddev_samp("value").alias("null_sd"), stats.empirical_p(F.col("value"), F.col("observed")).alias("empirical_p"))
    return out.withColumn("z_score", F.try_divide(F.col("observed") - F.col("null_mean"), F.col("null_sd"))).withColumn("fold", F.try_divide("observed", "null_mean"))


def random_sets(pool: DataFrame, item: str, sets: DataFrame, set_id: str, size: str, seed: str) -> DataFrame:
    """(set_id, item): for each set a uniform sample of ``size`` items (all, if there are fewer) without repetition, drawn on its own.

    Items are numbered once; a set draws numbers by Floyd's method: for each of the last ``size`` numbers j
    one up to j by md5(seed, set_id, j), or j itself where that is drawn already. Nothing of size
    sets x pool arises.
    """
    from .ranking import dense_ids

    ordered = dense_ids(pool.select(item).where(F.col(item).isNotNull()).distinct(), [F.asc(item)], "__at", 0).select(item, "__at")
    ordered, _ = Scratch(pool.sparkSession).put(ordered)
    n = ordered.count()
    k = F.least(F.col(size).cast("long"), F.lit(n).cast("long"))
    draw = lambda j: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(set_id).cast("string"), j.cast("string"))), 1, 8), 16, 10).cast("long") % (j + 1)
    taken = F.aggregate(F.sequence(n - k, F.lit(n - 1).cast("long")), F.array().cast("array<bigint>"), lambda got, j: F.array_append(got, F.when(F.array_contains(got, draw(j)), j).otherwise(draw(j))))
    draws = sets.where((F.col(size) > 0) & F.lit(n > 0)).select(set_id, F.explode(taken).alias("__at"))
    return draws.join(ordered, "__at").select(set_id, item)
