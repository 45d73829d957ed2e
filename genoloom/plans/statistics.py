"""Queries of statistics: co-expression, corrected p-values, over-representation, permutation controls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse, stats
from ..operators import enrich, expression, ranking
from ..operators.skew import key_profile
from ..session import Scratch, table
from .annotation import placed
from .general import gene

GENES = ["p_size", "p_retailprice", "quantity", "lines", "discount"]


def samples(spark: SparkSession, base: str) -> DataFrame:
    """Expression in wide form: parts as samples, five measures as genes, the type as tissue."""
    lines = table(spark, base, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"), F.round(F.avg("l_discount"), 6).alias("discount"))
    part = table(spark, base, "part").select(F.col("p_partkey").alias("sample"), F.col("p_type").alias("tissue"), "p_size", "p_retailprice")
    return part.join(lines, F.col("sample") == F.col("l_partkey")).drop("l_partkey")


def long(spark: SparkSession, base: str) -> DataFrame:
    return expression.to_long(samples(spark, base), ["sample", "tissue"], GENES)


def measures(spark: SparkSession) -> DataFrame:
    """Pairs of the five measures."""
    return expression.pairs_of(spark.createDataFrame([(g,) for g in GENES], "gene string"))


def a28_spearman(spark: SparkSession, base: str) -> DataFrame:
    out = expression.spearman(long(spark, base), measures(spark), [])
    return out.select("gene1", "gene2", F.round("spearman_rho", 6).alias("spearman_rho"), F.round("t", 4).alias("t"), "n_samples")


def matrix(spark: SparkSession, base: str) -> DataFrame:
    """(sample, tissue, gene, value) of a whole expression matrix, written: quantities of each brand and type ("gene")
    by month and priority ("sample"), priority being the tissue; what wasn't sold is 0."""
    orders = table(spark, base, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("tissue"))
    part = table(spark, base, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("gene"))
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("decimal(12, 2)").alias("quantity"))
    cells = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("month", "tissue", "gene").agg(F.sum("quantity").cast("double").alias("value"))
    wide, genes = expression.to_wide(cells.withColumn("sample", F.concat_ws("/", "month", "tissue")).drop("month"), ["sample", "tissue"])
    return Scratch(spark).put(expression.to_long(wide, ["sample", "tissue"], genes))[0]


def target(rows: DataFrame) -> DataFrame:
    """The gene list under study: the ten genes of the highest totals."""
    return ranking.top_rows(rows.groupBy("gene").agg(F.sum("value").alias("total")), [F.desc("total"), F.asc("gene")], 10).select("gene")


def c13_coexpression(spark: SparkSession, base: str) -> DataFrame:
    """Per tissue of at least 20 samples, with p-values (from Student's t) corrected within the tissue."""
    rows = matrix(spark, base)
    out, _ = Scratch(spark).put(expression.spearman(rows, expression.pairs_of(target(rows)), ["tissue"], 20))
    out = enrich.adjusted(out, ["tissue"], "pvalue")
    return out.select("tissue", "gene1", "gene2", F.round("spearman_rho", 6).alias("spearman_rho"), F.round("pvalue", 8).alias("pvalue"), "n_samples", F.round("adjusted", 8).alias("adj_pvalue"), parse.stars("adjusted").alias("stars"))


def a26_medians(spark: SparkSession, base: str) -> DataFrame:
    rows = long(spark, base).withColumn("at", F.concat_ws("/", "tissue", "gene"))
    out = key_profile(rows, "at", median_of="value")
    return out.select(F.substring_index("at", "/", 1).alias("tissue"), F.substring_index("at", "/", -1).alias("gene"), "n_rows", "median")


def a35_matrix(spark: SparkSession, base: str) -> DataFrame:
    """The symmetric matrix of correlations, one row per gene."""
    pairs = expression.spearman(long(spark, base), measures(spark), []).select("gene1", "gene2", F.round("spearman_rho", 6).alias("rho"))
    mirrored = pairs.unionByName(pairs.select(F.col("gene2").alias("gene1"), F.col("gene1").alias("gene2"), "rho"))
    diagonal = pairs.select(F.explode(F.array("gene1", "gene2")).alias("gene1")).distinct().select("gene1", F.col("gene1").alias("gene2"), F.lit(1.0).alias("rho"))
    return mirrored.unionByName(diagonal).groupBy(F.col("gene1").alias("gene")).pivot("gene2", sorted(GENES)).agg(F.first("rho"))


def w8_ranks(spark: SparkSession, base: str) -> DataFrame:
    """Average ranks of the identities of each cluster's hits, as a summary per cluster."""
    rows = table(spark, base, "homology_summary").where("conserved_id is not null").select("conserved_id", "identity_pct")
    ranks = stats.average_ranks(rows, ["conserved_id"], "identity_pct")
    return ranks.select("conserved_id", F.col("v").alias("identity_pct"), "n", "rank")


def w10_adjusted(spark: SparkSession, base: str) -> DataFrame:
    """E-values of at most 1 as p-values, corrected within each cluster."""
    rows = table(spark, base, "homology_summary").where("conserved_id is not null and e_value <= 1 and not isnan(e_value)").select("conserved_id", F.col("e_value").alias("p"))
    return stats.benjamini_hochberg(rows, ["conserved_id"], "p").select("conserved_id", F.col("v").alias("p"), "adjusted")


def w9_adjusted_all(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "homology_summary").where("e_value <= 1 and not isnan(e_value)").select(F.lit("all").alias("family"), F.col("e_value").alias("p"))
    return stats.benjamini_hochberg(rows, ["family"], "p").select(F.col("v").alias("p"), "adjusted")


def annotation(spark: SparkSession, base: str) -> DataFrame:
    """(term, gene): genera and the human genes met in them."""
    return placed(spark, base).select(F.col("genus").alias("term"), gene().alias("gene")).where("term is not null and gene is not null and gene not in ('NO HIT', 'UNKNOWN')").distinct()


def drawn(spark: SparkSession, base: str) -> DataFrame:
    """The gene list under study: genes met at high identity."""
    return table(spark, base, "homology_summary").where("identity_pct >= 97").select(gene().alias("gene")).distinct()


def a33_enriched(spark: SparkSession, base: str) -> DataFrame:
    out = enrich.over_representation(annotation(spark, base), drawn(spark, base))
    return out.select("term", "n_term", "n_hit", "n_drawn", "n_all", F.round("p", 8).alias("p"), F.round("adjusted", 8).alias("adjusted"))


def p25_fallback(spark: SparkSession, base: str) -> DataFrame:
    """Terms with a corrected value below a threshold, or all tested terms if there is none."""
    return enrich.strict_or_all(a33_enriched(spark, base), F.col("adjusted") < 1e-9).select("term", "adjusted")


def best_terms(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The ten best enriched terms with their place (rank) and the genes under study under them."""
    terms, _ = Scratch(spark).put(annotation(spark, base))
    hits, _ = Scratch(spark).put(drawn(spark, base))
    order = [F.asc("adjusted"), F.asc("p"), F.asc("term")]
    best, _ = Scratch(spark).put(ranking.dense_ids(ranking.top_rows(enrich.over_representation(terms, hits), order, 10), order, "rank").select("term", "rank", "adjusted"))
    return best, terms.join(best.select("term", "rank"), "term").join(hits, "gene", "left_semi").select("term", "rank", "gene")


def g15_network(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of all genes under study that share one of the ten best enriched terms, with how many of them they share."""
    own, _ = Scratch(spark).put(best_terms(spark, base)[1])
    return enrich.shared_terms(own, own, 1)


def w12_main_terms(spark: SparkSession, base: str) -> DataFrame:
    """The main term of each gene of that network: the one of the best place, and how many of the ten it has."""
    own = best_terms(spark, base)[1]
    return own.groupBy("gene").agg(F.min_by("term", "rank").alias("main_term"), F.min("rank").alias("rank"), F.count(F.lit(1)).alias("n_terms"))


def j34_shared_significant(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of the twelve genes of most terms that stand together in terms significant at 5 %."""
    terms, _ = Scratch(spark).put(annotation(spark, base))
    found = enrich.over_representation(terms, drawn(spark, base)).where("adjusted < 0.05").select("term")
    top = ranking.top_rows(terms.groupBy("gene").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("gene")], 12)
    return enrich.shared_terms(terms.join(found, "term", "left_semi"), top, 1)


def a34_slim(spark: SparkSession, base: str) -> DataFrame:
    """Distinct genes under each term of the second level (phyla), by the closure of the terms' hierarchy."""
    taxa = table(spark, base, "taxonomy")
    ranks = ["kingdom", "phylum", "tax_class", "tax_order", "family", "genus"]
    named = [F.concat_ws(":", F.lit(r), r) for r in ranks]
    steps = F.explode(F.array(*(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(y.alias("child"), x.alias("parent"))) for a, b, x, y in zip(ranks, ranks[1:], named, named[1:])))).alias("s")
    links = taxa.select(steps).where("s is not null").select("s.*").distinct()
    own = annotation(spark, base).select(F.concat_ws(":", F.lit("genus"), "term").alias("term"), "gene")
    level = taxa.where("phylum is not null").select(named[1].alias("term")).distinct()
    return enrich.slim(own, links, level)


def identities(spark: SparkSession, base: str) -> DataFrame:
    """Mean identity of each human gene."""
    rows = table(spark, base, "homology_summary").where("identity_pct is not null and not isnan(identity_pct)").select(gene().alias("gene"), F.col("identity_pct").cast("decimal(12, 4)").alias("x"))
    return rows.where("gene is not null").groupBy("gene").agg((F.sum("x").cast("double") / F.count(F.lit(1))).alias("mean_identity"))


def random_sets(spark: SparkSession, base: str, sets: DataFrame) -> DataFrame:
    return expression.random_sets(identities(spark, base), "gene", sets, "set_id", "size", "7")


def o11_random_sets(spark: SparkSession, base: str) -> DataFrame:
    """For each cluster a random set of as many genes as it lists."""
    sets = table(spark, base, "conserved_cluster").where("gene_count is not null").select(F.col("conserved_id").alias("set_id"), F.col("gene_count").alias("size"))
    return random_sets(spark, base, sets)


def a30_pair_metrics(spark: SparkSession, base: str) -> DataFrame:
    """Metrics of the correlations among the genes under study and among 1,000 random sets of as many genes."""
    rows = matrix(spark, base)
    chosen, _ = Scratch(spark).put(target(rows))
    k = chosen.count()
    draws = expression.random_sets(rows, "gene", spark.range(1000).select(F.col("id").cast("string").alias("set_id"), F.lit(k).alias("size")), "set_id", "size", "123")
    genes, _ = Scratch(spark).put(draws.unionByName(chosen.select(F.lit("target").alias("set_id"), "gene")))
    pairs = genes.select("set_id", F.col("gene").alias("gene1")).join(genes.select("set_id", F.col("gene").alias("gene2")), "set_id").where("gene1 < gene2")  # of ten genes a set
    pairs, _ = Scratch(spark).put(pairs)
    return expression.pair_metrics(pairs, expression.spearman(rows, pairs, []))


def c16_permutation(spark: SparkSession, base: str) -> DataFrame:
    """Each metric of the genes under study against the random sets."""
    metrics, _ = Scratch(spark).put(a30_pair_metrics(spark, base))
    out = expression.against_null(metrics, "target", ["mean_rho", "mean_abs_rho", "max_abs_rho", "prop_sig"])
    return out.select("metric", *(F.round(c, 6).alias(c) for c in ("observed", "null_mean", "null_sd", "empirical_p")), F.round("z_score", 4).alias("z_score"), F.round("fold", 4).alias("fold"))


def o10_identity_permutation(spark: SparkSession, base: str) -> DataFrame:
    """Mean identity of the ten most frequent genes against 1,000 random sets of ten."""
    values, _ = Scratch(spark).put(identities(spark, base))
    null = random_sets(spark, base, spark.range(1000).select(F.col("id").cast("string").alias("set_id"), F.lit(10).alias("size")))
    null = null.join(values, "gene").groupBy("set_id").agg(F.round(F.avg("mean_identity"), 6).alias("x"))
    counts = table(spark, base, "homology_summary").select(gene().alias("gene")).where("gene is not null").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    top = ranking.top_rows(counts.join(values, "gene", "left_semi"), [F.desc("n"), F.asc("gene")], 10)
    observed = top.join(values, "gene").agg(F.round(F.avg("mean_identity"), 6).alias("observed"))
    out = null.crossJoin(F.broadcast(observed)).groupBy("observed").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"), stats.empirical_p(F.col("x"), F.col("observed")).alias("p"))  # one row
    return out.select("observed", F.round("m", 5).alias("null_mean"), F.round("s", 5).alias("null_sd"), F.round("p", 6).alias("empirical_p"), F.round(F.try_divide(F.col("observed") - F.col("m"), F.col("s")), 3).alias("z_score"))


def c17_random_terms(spark: SparkSession, base: str) -> DataFrame:
    """Terms met by the random set of each cluster: the most frequent one."""
    rows = o11_random_sets(spark, base).join(annotation(spark, base), "gene").groupBy("set_id", "term").agg(F.count(F.lit(1)).alias("n"))
    return ranking.first_per_group(rows, ["set_id"], [F.desc("n"), F.asc("term")])


def a36_scale(spark: SparkSession, base: str) -> DataFrame:
    """The factor that brings cluster sizes to the scale of row counts."""
    rows = table(spark, base, "homology_summary").where("conserved_id is not null").groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n"))
    most = rows.agg(F.max("n").alias("most_rows")).crossJoin(table(spark, base, "conserved_cluster").agg(F.max("gene_count").alias("most_genes")))  # one row each
    return most.withColumn("scale", F.round(F.try_divide("most_rows", "most_genes"), 6))


_LONG = """line as (select l_partkey, sum(l_quantity) quantity, count(*) lines, round(avg(l_discount), 6) discount from lineitem group by 1),
wide as (select p_partkey sample, p_type tissue, p_size::double p_size, p_retailprice::double p_retailprice, quantity::double quantity, lines::double lines, discount::double discount from part join line on p_partkey = l_partkey),
long as (unpivot wide on p_size, p_retailprice, quantity, lines, discount into name gene value value)"""
_COR = """ranked as (select *, rank() over (partition by {by}gene order by value) + (count(*) over (partition by {by}gene, value) - 1) / 2.0 r from long),
cor as (select {x}x.gene gene1, y.gene gene2, corr(x.r, y.r) rho, count(*) n from ranked x join ranked y on x.sample = y.sample and x.gene < y.gene group by all)"""
_ANN = r"""(select distinct genus term, upper(trim(human_gene, ' ')) gene from (select *, nullif(regexp_extract(cluster_gene, '^(.*)_[^_]+_\d+_\d+$', 1), '') contig from homology_summary) join taxonomy using (contig)
    where genus is not null and human_gene is not null and upper(trim(human_gene, ' ')) not in ('NO HIT', 'UNKNOWN'))"""
_ENR = f"""ann as {_ANN}, dr as (select distinct gene from ann where gene in (select upper(trim(human_gene, ' ')) from homology_summary where identity_pct >= 97 and human_gene is not null)),
s as (select term, count(*) n_term, count(*) filter (gene in (select gene from dr)) n_hit, (select count(*) from dr) n_drawn, (select count(distinct gene) from ann) n_all from ann group by 1),
e as (select * from s where n_term between 10 and 500 and n_hit > 0),
tl as (select *, least(1, list_sum(list_transform(range(greatest(n_hit, n_drawn - (n_all - n_term)), least(n_drawn, n_term) + 1), lambda i:
    exp(lgamma(n_term + 1) - lgamma(i + 1) - lgamma(n_term - i + 1) + lgamma(n_all - n_term + 1) - lgamma(n_drawn - i + 1) - lgamma(n_all - n_term - n_drawn + i + 1)
    - lgamma(n_all + 1) + lgamma(n_drawn + 1) + lgamma(n_all - n_drawn + 1))))) p from e),
aj as (select *, least(1, min(raw) over (order by p desc range between unbounded preceding and current row)) adjusted from (select *, p * count(*) over () / count(*) over (order by p range between unbounded preceding and current row) raw from tl))"""
_BH = """select {k}p, least(1, min(raw) over ({w} order by p desc rows between unbounded preceding and current row)) adjusted from
    (select {k}p, p * sum(n) over ({w}) / sum(n) over ({w} order by p rows between unbounded preceding and current row) raw from
        (select {k}e_value p, count(*) n from homology_summary where {c}e_value <= 1 and not isnan(e_value) group by all))"""
_IDN = "idn as (select upper(trim(human_gene, ' ')) gene, sum(identity_pct::decimal(12, 4))::double / count(*) mean_identity from homology_summary where identity_pct is not null and not isnan(identity_pct) and human_gene is not null group by 1)"
# Floyd's draws, as in expression.random_sets.
_FLOYD = """floyd as (select set_id, unnest(list_reduce(range(n - kk, n), lambda got, j: case when list_contains(got, draw(set_id, j)) then list_append(got, j) else list_append(got, draw(set_id, j)) end, []::bigint[])) k
    from (select set_id, least(size, (select count(*) from pool)) kk, (select count(*) from pool) n from sets where size > 0)),
rnd as (select set_id, gene from floyd join pool using (k))"""


def _floyd(seed: str) -> str:
    return _FLOYD.replace("draw(set_id, j)", f"(('0x' || substr(md5('{seed}|' || set_id || '|' || j), 1, 8))::bigint % (j + 1))")


_RND = f"{_IDN}, pool as (select gene, row_number() over (order by gene) - 1 k from idn), {_floyd('7')}"
_SETS = "sets as (select conserved_id set_id, gene_count size from conserved_cluster where gene_count is not null)"
_MATRIX = """cells as (select strftime(o_orderdate, '%Y-%m') || '/' || o_orderpriority sample, o_orderpriority tissue, p_brand || '/' || p_type gene, sum(l_quantity::decimal(12, 2))::double value from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by all),
full_grid as (select sample, tissue, gene from (select distinct sample, tissue from cells), (select distinct gene from cells)),
long as (select sample, tissue, gene, coalesce(value, 0) value from full_grid left join cells using (sample, tissue, gene)),
chosen as (select gene from long group by 1 order by sum(value) desc, gene limit 10)"""
# Two-sided tail of Student's t as the finite series in the angle atan(t / sqrt(f)), f being the degrees of freedom.
_TAIL = """case when r is null or abs(r) >= 1 or n < 3 then null else greatest(0, 1 - case when f % 2 = 0
        then sin(th) * list_sum(list_transform(range(0, f // 2), lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1) + 2 * j * ln(cos(th)))))
        when f = 1 then 2 / pi() * th
        else 2 / pi() * (th + sin(th) * cos(th) * list_sum(list_transform(range(0, (f - 1) // 2), lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5) + 2 * j * ln(cos(th)))))) end) end"""

_TESTED = f"""angled as (select *, n - 2 f, atan(abs(r) * sqrt((n - 2) / greatest(1 - r * r, 1e-300)) / sqrt(greatest(n - 2, 1))) th from cor),
tested as (select *, {_TAIL} p from angled)"""
_BHW = "least(1, min(raw) over ({w} order by p desc rows between unbounded preceding and current row))"
_PAIRED = f"""with {_MATRIX}, pool as (select gene, row_number() over (order by gene) - 1 k from (select distinct gene from long)), sets as (select range::varchar set_id, (select count(*) from chosen) size from range(1000)), {_floyd('123')},
own as (select set_id, gene from rnd union all select 'target', gene from chosen), pairs as (select x.set_id, x.gene g1, y.gene g2 from own x join own y on x.set_id = y.set_id and x.gene < y.gene),
ranked as (select *, rank() over (partition by gene order by value) + (count(*) over (partition by gene, value) - 1) / 2.0 k from long),
cor as (select x.gene g1, y.gene g2, case when stddev_pop(x.k) > 0 and stddev_pop(y.k) > 0 then corr(x.k, y.k) end r, count(*) n from ranked x join ranked y on x.sample = y.sample and x.gene < y.gene where (x.gene, y.gene) in (select g1, g2 from pairs) group by 1, 2 having count(*) >= 3),
{_TESTED}, rows_ as (select set_id, g1, g2, r, p from pairs left join tested using (g1, g2)),
aj as (select *, case when p is not null then {_BHW.format(w='partition by set_id, p is null')} end adj from (select *, p * count(p) over (partition by set_id) / count(p) over (partition by set_id order by p range between unbounded preceding and current row) raw from rows_)),
met as (select set_id, avg(r) mean_rho, avg(abs(r)) mean_abs_rho, max(abs(r)) max_abs_rho, avg((adj < 0.05)::double) prop_sig, count(*) n_pairs from aj group by 1)"""

QUERIES = {
    f.__name__: f
    for f in (
        a30_pair_metrics, o10_identity_permutation, w12_main_terms, j34_shared_significant, a34_slim, a28_spearman, c13_coexpression, a26_medians, a35_matrix, w8_ranks, w10_adjusted, w9_adjusted_all, a33_enriched, p25_fallback, g15_network, o11_random_sets,
        c16_permutation, c17_random_terms, a36_scale,
    )
}
QUERIES["q25_fallback"] = QUERIES.pop("p25_fallback")
SQL = {
    "a28_spearman": f"with {_LONG}, {_COR.format(by='', x='')} select gene1, gene2, round(rho, 6) spearman_rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 4) t, n n_samples from cor",
    "a26_medians": f"with {_LONG} select tissue, gene, count(*) n_rows, median(value) median from long group by 1, 2",
    "a35_matrix": f"with {_LONG}, {_COR.format(by='', x='')}, m as (select gene1 gene, gene2 o, round(rho, 6) rho from cor union all select gene2, gene1, round(rho, 6) from cor union all select distinct gene, gene, 1.0 from long) pivot m on o in ('discount', 'lines', 'p_retailprice', 'p_size', 'quantity') using first(rho) group by gene",
    "w8_ranks": "with r as (select conserved_id, identity_pct, rank() over w + (count(*) over (partition by conserved_id, identity_pct) - 1) / 2.0 rank from homology_summary where conserved_id is not null and identity_pct is not null and not isnan(identity_pct) window w as (partition by conserved_id order by identity_pct)) select conserved_id, identity_pct, count(*) n, any_value(rank)::double rank from r group by 1, 2",
    "w10_adjusted": _BH.format(k="conserved_id, ", w="partition by conserved_id", c="conserved_id is not null and "),
    "w9_adjusted_all": _BH.format(k="", w="", c=""),
    "a33_enriched": f"with {_ENR} select term, n_term, n_hit, n_drawn, n_all, round(p, 8) p, round(adjusted, 8) adjusted from aj",
    "q25_fallback": f"with {_ENR}, r as (select term, round(adjusted, 8) adjusted from aj) select * from r where adjusted < 1e-9 or not exists (select 1 from r where adjusted < 1e-9)",
    "g15_network": f"with {_ENR}, best as (select term from aj order by adjusted, p, term limit 10), own as (select * from ann where term in (select term from best) and gene in (select gene from dr)) select x.gene a, y.gene b, count(*) shared from own x join own y on x.term = y.term and x.gene < y.gene group by 1, 2",
    "w12_main_terms": f"with {_ENR}, best as (select term, row_number() over (order by adjusted, p, term) rank from aj order by rank limit 10), own as (select term, rank, gene from ann join best using (term) where gene in (select gene from dr)) select gene, arg_min(term, rank) main_term, min(rank) rank, count(*) n_terms from own group by 1",
    "j34_shared_significant": f"with {_ENR}, top as (select gene from ann group by 1 order by count(*) desc, gene limit 12), own as (select * from ann where gene in (select gene from top) and term in (select term from aj where adjusted < 0.05)) select x.gene a, y.gene b, count(*) shared from own x join own y on x.term = y.term and x.gene < y.gene group by 1, 2",
    "a34_slim": f"""with recursive ann as {_ANN}, rk as (select *, 'kingdom:' || kingdom k0, 'phylum:' || phylum k1, 'tax_class:' || tax_class k2, 'tax_order:' || tax_order k3, 'family:' || family k4, 'genus:' || genus k5 from taxonomy),
        link as (select distinct * from (select k1 child, k0 parent from rk union all select k2, k1 from rk union all select k3, k2 from rk union all select k4, k3 from rk union all select k5, k4 from rk) where child is not null and parent is not null),
        clo(term, up) as (select 'genus:' || term, 'genus:' || term from (select distinct term from ann) union select clo.term, parent from clo join link on child = up)
        select up term, count(distinct gene) n_genes from (select 'genus:' || term term, gene from ann) join clo using (term) where starts_with(up, 'phylum:') group by 1""",
    "o11_random_sets": f"with {_SETS}, {_RND} select * from rnd",
    "a30_pair_metrics": _PAIRED + " select set_id, mean_rho, mean_abs_rho, max_abs_rho, prop_sig, n_pairs from met",
    "c16_permutation": _PAIRED + """, lg as (unpivot (select set_id, mean_rho, mean_abs_rho, max_abs_rho, prop_sig from met) on mean_rho, mean_abs_rho, max_abs_rho, prop_sig into name metric value v),
        ob as (select metric, v observed from lg where set_id = 'target'), nu as (select metric, observed, avg(v) m, stddev_samp(v) s, (count(*) filter (v >= observed) + 1) / (count(v) + 1) p from lg join ob using (metric) where set_id <> 'target' group by 1, 2)
        select metric, round(observed, 6) observed, round(m, 6) null_mean, round(s, 6) null_sd, round(p, 6) empirical_p, round((observed - m) / s, 4) z_score, round(observed / m, 4) fold from nu""",
    "c13_coexpression": f"""with {_MATRIX}, ranked as (select *, rank() over (partition by tissue, gene order by value) + (count(*) over (partition by tissue, gene, value) - 1) / 2.0 k from long where gene in (select gene from chosen)),
        cor as (select x.tissue, x.gene g1, y.gene g2, case when stddev_pop(x.k) > 0 and stddev_pop(y.k) > 0 then corr(x.k, y.k) end r, count(*) n from ranked x join ranked y on x.sample = y.sample and x.gene < y.gene group by 1, 2, 3 having count(*) >= 20),
        {_TESTED}, aj as (select *, case when p is not null then {_BHW.format(w='partition by tissue, p is null')} end adj from (select *, p * count(p) over (partition by tissue) / count(p) over (partition by tissue order by p range between unbounded preceding and current row) raw from tested))
        select tissue, g1 gene1, g2 gene2, round(r, 6) spearman_rho, round(p, 8) pvalue, n n_samples, round(adj, 8) adj_pvalue, case when adj < 0.001 then '***' when adj < 0.01 then '**' when adj < 0.05 then '*' when adj is not null then 'ns' end stars from aj""",
    "o10_identity_permutation": f"""with sets as (select range::varchar set_id, 10 size from range(1000)), {_RND}, nul as (select set_id, round(avg(mean_identity), 6) x from rnd join idn using (gene) group by 1),
        top as (select gene from (select upper(trim(human_gene, ' ')) gene, count(*) n from homology_summary where human_gene is not null group by 1) where gene in (select gene from idn) order by n desc, gene limit 10),
        ob as (select round(avg(mean_identity), 6) observed from idn where gene in (select gene from top))
        select observed, round(avg(x), 5) null_mean, round(stddev_samp(x), 5) null_sd, round((count(*) filter (x >= observed) + 1) / (count(*) + 1), 6) empirical_p, round((observed - avg(x)) / stddev_samp(x), 3) z_score from nul, ob group by observed""",
    "c17_random_terms": f"with {_SETS}, {_RND}, ann as {_ANN}, r as (select set_id, term, count(*) n from rnd join ann using (gene) group by 1, 2) select * from r qualify row_number() over (partition by set_id order by n desc, term) = 1",
    "a36_scale": "with r as (select count(*) n from homology_summary where conserved_id is not null group by conserved_id) select max(n) most_rows, (select max(gene_count) from conserved_cluster) most_genes, round(max(n) / (select max(gene_count) from conserved_cluster), 6) scale from r",
}
