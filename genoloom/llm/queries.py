"""The queries of the training-data operators and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import table
from . import bpe, components, packing, pairs, topn, truncation

def gene() -> Column:
    """Human genes without blanks at the ends, in upper case."""
    return F.upper(F.trim("human_gene"))


def gene_pairs(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "homology_summary")
    genes = df.where(~gene().isin("NO HIT", "UNKNOWN"))
    return pairs.item_pairs(genes, "conserved_id", gene(), min_count=5, min_share=(1, 500))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    chance = "cast(n_ab as decimal(38, 0)) * n >= 4 * cast(n_a as decimal(19, 0)) * n_b"
    return gene_pairs(spark, base).where(chance).select(F.col("item_a").alias("gene_a"), F.col("item_b").alias("gene_b"))


def p3_lift(spark: SparkSession, base: str) -> DataFrame:
    return gene_pairs(spark, base).select(F.col("item_a").alias("gene_a"), F.col("item_b").alias("gene_b"), "n_ab", "n_a", "n_b", F.round("lift", 6).alias("lift"))


def best_hits(spark: SparkSession, base: str) -> DataFrame:
    return topn.top_n(table(spark, base, "blast_hit"), "cluster_gene", "bit_score", "evalue", "hit_id", n=3)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return best_hits(spark, base).select("hit_id")


def p4_ranked(spark: SparkSession, base: str) -> DataFrame:
    return best_hits(spark, base).select("cluster_gene", "hit_id", F.col("rank").cast("int").alias("rank"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    own = lambda c: F.trim(F.substring_index(c, "|", -1))
    out = components.link_groups(table(spark, base, "gene_match"), own("query_id"), own("subject_id"))
    return out.withColumnRenamed("member", "gene_id")


def p6_ids(spark: SparkSession, base: str) -> DataFrame:
    return bpe.encode(table(spark, base, "documents"), "doc_id", "text")


def p7_packed(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(table(spark, base, "documents"), "doc_id", "text", 2048)


def p7_use(spark: SparkSession, base: str) -> DataFrame:
    packed = p7_packed(spark, base).groupBy("container").agg(F.sum("tokens").alias("tokens"))
    total = packed.agg(F.count(F.lit(1)).alias("n_containers"), F.sum("tokens").alias("n_tokens"), F.max("tokens").alias("most"))
    return total.withColumn("unused_share", F.round(1 - F.try_divide(F.col("n_tokens"), F.col("n_containers") * 2048), 6))


def cut_texts(spark: SparkSession, base: str) -> DataFrame:
    return truncation.truncated(table(spark, base, "documents"), "doc_id", "text", "lang", "source")


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return cut_texts(spark, base).where("p > 0.5").select("doc_id")


def p8_sources(spark: SparkSession, base: str) -> DataFrame:
    by_source = cut_texts(spark, base).groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(F.col("p") > 0.5).alias("n_cut"))
    return by_source.withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_texts"), 6))


_PAIRS = """
with cell as (select distinct conserved_id b, upper(trim(human_gene, ' ')) g from homology_summary
    where conserved_id is not null and human_gene is not null and upper(trim(human_gene, ' ')) not in ('NO HIT', 'UNKNOWN')),
n as (select count(distinct b) n from cell),
one as (select g, count(*) c from cell group by g),
two as (select x.g gene_a, y.g gene_b, count(*) n_ab from cell x join cell y on x.b = y.b and x.g < y.g group by all),
pair as (select gene_a, gene_b, n_ab, a.c n_a, b.c n_b, n from two join one a on a.g = gene_a join one b on b.g = gene_b, n
    where n_ab >= 5 and n_ab * 500 >= n)
"""
_BEST = """
with hit as (select distinct hit_id, cluster_gene, bit_score, evalue from blast_hit
    where cluster_gene is not null and isfinite(bit_score) and isfinite(evalue)),
best as (select cluster_gene, hit_id, cast(row_number() over (partition by cluster_gene order by bit_score desc, evalue, hit_id) as int) rank
    from hit qualify rank <= 3)
"""
_GROUPS = """
with recursive pair as (select trim(split_part(query_id, '|', -1), ' ') a, trim(split_part(subject_id, '|', -1), ' ') b from gene_match),
link as (select distinct a, b from pair where a <> '' and b <> ''),
both_ways as (select a, b from link union select b, a from link),
reach(gene_id, seen) using key (gene_id) as (
    select a, min(least(a, b)) from both_ways group by a
    union
    select l.b, min(r.seen) from reach r join both_ways l on l.a = r.gene_id join recurring.reach o on o.gene_id = l.b
    where r.seen < o.seen group by l.b)
select gene_id, seen group_id from reach
"""

QUERIES = {"p3_found": p3_found, "p3_lift": p3_lift, "p4_found": p4_found, "p4_ranked": p4_ranked, "p5_found": p5_found, "p6_ids": p6_ids, "p7_packed": p7_packed, "p7_use": p7_use, "p8_found": p8_found, "p8_sources": p8_sources}
SQL = {
    "p3_found": _PAIRS + "select gene_a, gene_b from pair where n_ab * n >= 4 * n_a * n_b",
    "p3_lift": _PAIRS + "select gene_a, gene_b, n_ab, n_a, n_b, round(n_ab / (n_a * n_b / n), 6) lift from pair",
    "p4_found": _BEST + "select hit_id from best",
    "p4_ranked": _BEST + "select * from best",
    "p5_found": _GROUPS,
}
