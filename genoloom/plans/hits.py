"""Queries over alignment hits: best hits, agreement, summaries per criterion, run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse
from ..operators import ranking
from ..session import Scratch, table

CRITERIA = ("length", "evalue", "identity", "comprehensive")


def delivered(spark: SparkSession, base: str) -> DataFrame:
    """Alignment hits as delivered, some more than once, with the subject's gene."""
    return table(spark, base, "blast_hit").select(
        "hit_id", "conserved_id", "cluster_gene", parse.first_filled(parse.pipe_field("subject_id", 5), F.lit("Unknown")).alias("subject"),
        F.col("alignment_length").alias("length"), "evalue", F.col("perc_identity").alias("identity"), "bit_score", "query_id",
    )


def hits(spark: SparkSession, base: str) -> DataFrame:
    """Alignment hits once each."""
    return delivered(spark, base).dropDuplicates(["hit_id"])


def best(spark: SparkSession, base: str) -> DataFrame:
    """Copies of a hit tie with it in everything, so they needn't be removed first."""
    return ranking.best_hits(delivered(spark, base).where("conserved_id is not null and cluster_gene is not null"), ["conserved_id", "cluster_gene"])


def c8_best_hits(spark: SparkSession, base: str) -> DataFrame:
    return best(spark, base).withColumn("comprehensive_score", F.round("comprehensive_score", 6))


def r8_long(spark: SparkSession, base: str) -> DataFrame:
    """The wide summary as one row per criterion."""
    rows = [F.struct(F.lit(x).alias("criterion"), *(F.col(f"{c}_by_{x}").alias(c) for c in ("subject", "length", "identity", "evalue"))) for x in CRITERIA]
    return best(spark, base).select("conserved_id", "cluster_gene", F.explode(F.array(*rows)).alias("r")).select("conserved_id", "cluster_gene", "r.*")


def a13_criterion_summary(spark: SparkSession, base: str) -> DataFrame:
    long, _ = Scratch(spark).put(r8_long(spark, base))
    out = long.groupBy("criterion").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("subject") != "Unknown").alias("n_known"), F.avg("length").alias("mean_length"), F.avg("identity").alias("mean_identity"))
    from ..operators.skew import key_profile

    middle = key_profile(long, "criterion", median_of="length").select("criterion", F.col("median").alias("median_length"))
    return out.join(middle, "criterion").withColumns({"mean_length": F.round("mean_length", 6), "mean_identity": F.round("mean_identity", 6)})


def a14_agreement(spark: SparkSession, base: str) -> DataFrame:
    return best(spark, base).agg(F.count_if("all_same").alias("n_same"), F.count(F.lit(1)).alias("n")).withColumn("share", F.round(F.try_divide("n_same", "n"), 6))


def w5_placeholders(spark: SparkSession, base: str) -> DataFrame:
    """Clusters without a hit that passes strict limits get a placeholder row."""
    good = hits(spark, base).where("length >= 150 and evalue <= 1e-20 and identity >= 90").where("conserved_id is not null")
    found = good.groupBy("conserved_id").agg(F.max_by("subject", F.struct("bit_score", -F.col("hit_id"))).alias("subject"), F.count(F.lit(1)).alias("n_hits"))
    missing = table(spark, base, "conserved_cluster").select("conserved_id").join(found, "conserved_id", "left_anti")
    return found.unionByName(missing.select("conserved_id", F.concat(F.lit("No_hit_in_"), "conserved_id").alias("subject"), F.lit(0).cast("long").alias("n_hits")))


def a15_queries(spark: SparkSession, base: str) -> DataFrame:
    """Matches and distinct queries per cluster, and the run's best hit by e-value."""
    df = hits(spark, base).where("conserved_id is not null")
    pairs = df.groupBy("conserved_id", "query_id").agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.groupBy("conserved_id").agg(F.sum("n").alias("n_matches"), F.count("query_id").alias("n_queries"))
    ok = df.where("evalue is not null and not isnan(evalue) and abs(evalue) < double('infinity')")
    top = ok.groupBy("conserved_id").agg(F.min_by("query_id", F.struct("evalue", "hit_id")).alias("best_query"), F.min("evalue").alias("best_evalue"))
    return counts.join(top, "conserved_id", "left").select("conserved_id", "n_matches", "n_queries", F.coalesce("best_query", F.lit("-")).alias("best_query"), F.coalesce("best_evalue", F.lit(0.0)).alias("best_evalue"))


def w6_first_per_query(spark: SparkSession, base: str) -> DataFrame:
    ok = delivered(spark, base).where("query_id is not null and evalue is not null and not isnan(evalue)")
    return ok.groupBy("query_id").agg(F.min_by("hit_id", F.struct("evalue", "hit_id")).alias("hit_id"))


def j16_hit_genes(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the summary whose gene is hit by any query."""
    hit = delivered(spark, base).select(F.col("subject").alias("human_gene")).distinct()
    return table(spark, base, "homology_summary").join(hit, "human_gene", "left_semi").groupBy("human_gene").agg(F.count(F.lit(1)).alias("n"))


def a37_top_subjects(spark: SparkSession, base: str) -> DataFrame:
    counts = hits(spark, base).groupBy("subject").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_rows(counts, [F.desc("n"), F.asc("subject")], 10)


def f28_identity_buckets(spark: SparkSession, base: str) -> DataFrame:
    label = parse.bucket("identity", [0, 50, 70, 80, 90, 95, 100])
    return hits(spark, base).groupBy(F.coalesce(label, F.lit("none")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("bit_score"), 6).alias("mean_score"))


_HIT = """hit as (select distinct on (hit_id) hit_id, query_id, conserved_id, cluster_gene, bit_score,
    coalesce(nullif(string_split(subject_id, '|')[6], ''), 'Unknown') subject, alignment_length length, evalue, perc_identity identity from blast_hit)"""
_BEST = f"""with {_HIT},
ok as (select * from hit where conserved_id is not null and cluster_gene is not null and length >= 1 and evalue <= 9999 and identity >= 0
    and isfinite(evalue) and isfinite(identity)),
lim as (select *, max(length) over w ml, min(evalue) over w me, max(identity) over w mi from ok window w as (partition by conserved_id, cluster_gene)),
scored as (select *, (length / (case when ml <= 0 then 1.0 else ml end)
    + (-log10(evalue + 1e-300)) / nullif(-log10((case when me <= 0 then 1e-300 else me end) + 1e-300), 0)
    + identity / (case when mi <= 0 then 1.0 else mi end)) / 3 score from lim),
place as (select *, row_number() over (partition by conserved_id, cluster_gene order by length desc, hit_id) rl,
    row_number() over (partition by conserved_id, cluster_gene order by evalue, hit_id) re,
    row_number() over (partition by conserved_id, cluster_gene order by identity desc, hit_id) ri,
    row_number() over (partition by conserved_id, cluster_gene order by score desc nulls last, hit_id) rc from scored),
best as (select conserved_id, cluster_gene, """ + ", ".join(f"max({c}) filter (r{x[0]} = 1) {c}_by_{x}" for x in CRITERIA for c in ("subject", "length", "identity", "evalue")) + """,
    max(score) filter (rc = 1) comprehensive_score from place group by 1, 2),
long as (""" + " union all ".join(f"select conserved_id, cluster_gene, '{x}' criterion, subject_by_{x} subject, length_by_{x} length, identity_by_{x} identity, evalue_by_{x} evalue from best" for x in CRITERIA) + ")"  # fmt: skip
_SAME = "coalesce(subject_by_length = subject_by_evalue and subject_by_length = subject_by_identity and subject_by_length = subject_by_comprehensive, false)"

QUERIES = {f.__name__: f for f in (c8_best_hits, r8_long, a13_criterion_summary, a14_agreement, w5_placeholders, a15_queries, w6_first_per_query, j16_hit_genes, a37_top_subjects, f28_identity_buckets)}
SQL = {
    "c8_best_hits": _BEST + f" select * exclude (comprehensive_score), round(comprehensive_score, 6) comprehensive_score, {_SAME} all_same from best",
    "r8_long": _BEST + " select * from long",
    "a13_criterion_summary": _BEST + " select criterion, count(*) n_rows, count(*) filter (subject <> 'Unknown') n_known, round(avg(length), 6) mean_length, round(avg(identity), 6) mean_identity, median(length) median_length from long group by 1",
    "a14_agreement": _BEST + f" select count(*) filter ({_SAME}) n_same, count(*) n, round(count(*) filter ({_SAME}) / count(*), 6) share from best",
    "w5_placeholders": f"""with {_HIT}, good as (select * from hit where length >= 150 and evalue <= 1e-20 and identity >= 90 and conserved_id is not null),
        found as (select conserved_id, first(subject order by bit_score desc, hit_id) subject, count(*) n_hits from good where bit_score is not null group by 1)
        select conserved_id, subject, (select count(*) from good g where g.conserved_id = f.conserved_id) n_hits from found f union all
        select conserved_id, 'No_hit_in_' || conserved_id, 0 from conserved_cluster where conserved_id not in (select conserved_id from good)""",
    "a15_queries": f"""with {_HIT}, own as (select * from hit where conserved_id is not null),
        top as (select conserved_id, first(query_id order by evalue, hit_id) best_query, min(evalue) best_evalue from own where isfinite(evalue) group by 1)
        select conserved_id, count(*) n_matches, count(distinct query_id) n_queries, coalesce(any_value(best_query), '-') best_query, coalesce(any_value(best_evalue), 0) best_evalue
        from own left join top using (conserved_id) group by 1""",
    "w6_first_per_query": f"with {_HIT} select query_id, first(hit_id order by evalue, hit_id) hit_id from hit where query_id is not null and evalue is not null and not isnan(evalue) group by 1",
    "j16_hit_genes": f"with {_HIT} select human_gene, count(*) n from homology_summary where human_gene in (select subject from hit) group by 1",
    "a37_top_subjects": f"with {_HIT} select subject, count(*) n from hit group by 1 order by n desc, subject limit 10",
    "f28_identity_buckets": f"""with {_HIT} select case """ + " ".join(f"when identity > {a} and identity <= {b} then '({a},{b}]'" for a, b in zip([0, 50, 70, 80, 90, 95], [50, 70, 80, 90, 95, 100])) + """ else 'none' end bucket,
        count(*) n, round(avg(bit_score), 6) mean_score from hit group by 1""",
}
