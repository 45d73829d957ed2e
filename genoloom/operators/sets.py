"""Conserved gene sets: signatures, maximal sets, sets closed under their species.

A set of two genes or more contains another only if it contains the other's two rarest genes: containment
joins probe an inverted index of (pair of genes, set) with that one pair, so neither all pairs of sets nor
all pairs sharing some frequent gene arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def signatures(rows: DataFrame, species: str, cluster: str, gene: str, min_genes: int = 2) -> DataFrame:
    """(species, cluster, genes): the sorted distinct genes of each cluster of a species."""
    return rows.groupBy(F.col(species).alias("species"), F.col(cluster).alias("cluster")).agg(F.array_sort(F.collect_set(gene)).alias("genes")).where(F.size("genes") >= min_genes)


def recurring(sigs: DataFrame, min_species: int = 2) -> DataFrame:
    """(genes, n_species, n_clusters) of each distinct set; found in ``min_species`` species only if there are at least three in all.

    ``sigs`` is read twice and should be a written table.
    """
    sets = sigs.groupBy("genes").agg(F.count_distinct("species").alias("n_species"), F.count(F.lit(1)).alias("n_clusters"))
    some = sigs.select("species").distinct().limit(3).count()
    return sets.where(F.col("n_species") >= min_species) if some >= 3 else sets


def _pairs(genes: str) -> Column:
    """All pairs of genes of a sorted set, as a column of structs."""
    tail = lambda x, i: F.transform(F.slice(F.col(genes), i + 2, F.size(genes)), lambda y: F.struct(x.alias("p"), y.alias("q")))
    return F.explode(F.flatten(F.transform(F.col(genes), tail)))


def _probes(sets: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each set of ``sets`` (two genes or more) with its two rarest genes, and the rows of ``others`` under each of their pairs; both with a 64-bit signature.

    The index has a row per pair of a set, while Spark judges it by the size of the file it is exploded from
    and would broadcast it: the hint has it shuffled at any size.
    """
    signature = F.expr("aggregate(genes, 0L, (a, x) -> a | shiftleft(1L, cast(pmod(xxhash64(x), 64) as int)))")
    use = others.select(F.explode("genes").alias("gene")).groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    one = sets.select("genes").distinct()
    ranked = one.withColumn("gene", F.explode("genes")).join(use, "gene", "left").groupBy("genes").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)), "gene"))).alias("by_use"))
    two = [F.get("by_use", F.lit(k))["gene"] for k in (0, 1)]
    rare = ranked.select("genes", F.struct(F.least(*two).alias("p"), F.greatest(*two).alias("q")).alias("pair"))
    index = others.withColumn("wider_bits", signature).withColumnRenamed("genes", "superset").withColumn("pair", _pairs("superset")).hint("merge")
    return rare.withColumn("bits", signature), index


#: Properly contained: the cheap tests on sizes and signatures come before the one on the genes themselves.
_CONTAINED = "size(superset) > size(genes) and (bits & wider_bits) = bits and size(array_except(genes, superset)) = 0"


def supersets(sets: DataFrame, others: DataFrame) -> DataFrame:
    """(genes, superset, the other columns of ``others``): the rows of ``others`` whose genes properly contain each set of two genes or more."""
    rare, index = _probes(sets, others)
    return rare.join(index, "pair").where(_CONTAINED).drop("pair", "bits", "wider_bits")


def maximal(sets: DataFrame) -> DataFrame:
    """The sets (of two genes or more) that no other set properly contains; the search for a set ends with the first that does."""
    rare, index = _probes(sets, sets.select("genes"))
    kept = rare.join(index.withColumnRenamed("pair", "held"), (F.col("pair") == F.col("held")) & F.expr(_CONTAINED), "left_anti")
    return sets.join(kept.select("genes"), "genes", "left_semi")


def common_sets(sigs: DataFrame) -> DataFrame:
    """(genes): the distinct sets of two genes or more that two clusters have in common.

    Pairs are formed between distinct sets only, and only between sets that share a pair of genes: two
    sets meet under each pair they share and are kept where that is the first one.
    """
    sets = sigs.groupBy("genes").agg(F.count(F.lit(1)).alias("n"))
    twice = sets.where("n >= 2").select("genes")
    index = sets.select("genes", _pairs("genes").alias("pair"))
    met = index.alias("x").join(index.alias("y"), "pair").where("x.genes < y.genes").select("pair", F.array_sort(F.array_intersect("x.genes", "y.genes")).alias("genes"))
    first = F.struct(F.get("genes", F.lit(0)).alias("p"), F.get("genes", F.lit(1)).alias("q"))
    return twice.unionByName(met.where(F.col("pair") == first).select("genes")).distinct()


def closed(sigs: DataFrame) -> DataFrame:
    """(genes, n_clusters, n_species): common sets that no larger one with the same species contains.

    The species of a larger set are among those of the sets it contains, so equal numbers of species mean
    the same species: species are counted as rows, never gathered. ``sigs`` is read several times and
    should be a written table.
    """
    from ..session import Scratch

    scratch = Scratch(sigs.sparkSession)
    common, _ = scratch.put(common_sets(sigs))
    clusters = sigs.groupBy("genes", "species").agg(F.count(F.lit(1)).alias("n"))
    distinct = sigs.select("genes").distinct()
    holders = supersets(common, distinct).select("genes", "superset").unionByName(common.join(distinct, "genes", "left_semi").select("genes", F.col("genes").alias("superset")))
    met = holders.join(clusters.withColumnRenamed("genes", "superset"), "superset").groupBy("genes", "species").agg(F.sum("n").alias("n"))
    held, _ = scratch.put(met.groupBy("genes").agg(F.sum("n").alias("n_clusters"), F.count(F.lit(1)).alias("n_species")))
    wider = supersets(held, held.select("genes", F.col("n_species").alias("wider_species"))).join(held, "genes")
    covered = wider.where("n_species = wider_species").select("genes").distinct()
    return held.join(covered, "genes", "left_anti").select("genes", "n_clusters", "n_species")
