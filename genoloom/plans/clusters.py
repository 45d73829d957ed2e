"""Queries over gene clusters: occurrence, conserved sets, families, components and graph measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse
from ..operators import graph, ranking, sets
from ..session import Scratch, table


def members(spark: SparkSession, base: str) -> DataFrame:
    """(conserved_id, gene): one row per listed gene."""
    return table(spark, base, "conserved_cluster").select("conserved_id", F.explode(parse.items("gene_list")).alias("gene"))


def occurrences(spark: SparkSession, base: str) -> DataFrame:
    """(conserved_id, query, target, block): one row per comparison in which the cluster was met."""
    rows = table(spark, base, "conserved_cluster").select("conserved_id", F.explode(parse.items("species_cluster_map")).alias("at"))
    return rows.select("conserved_id", parse.comparison("at").alias("c")).select("conserved_id", "c.*")


def c4_gene_occurrence(spark: SparkSession, base: str) -> DataFrame:
    """Clusters of each gene, raw lines and distinct ones, most frequent first."""
    rows = members(spark, base)
    return rows.groupBy("gene").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("conserved_id").alias("n_clusters"), F.concat_ws(" | ", F.array_sort(F.collect_set("conserved_id"))).alias("clusters"))


def a4_gene_folders(spark: SparkSession, base: str) -> DataFrame:
    """Distinct comparisons (folders) and distinct blocks in which each gene's clusters were met."""
    met = occurrences(spark, base).select("conserved_id", F.concat_ws("_with_", "query", "target").alias("folder"), "block").distinct()
    rows = members(spark, base).distinct().join(met, "conserved_id").select("gene", "folder", "block").distinct()
    return rows.groupBy("gene").agg(F.count(F.lit(1)).alias("n_blocks"), F.count_distinct("folder").alias("n_folders"))


def r6_comparisons(spark: SparkSession, base: str) -> DataFrame:
    return occurrences(spark, base).groupBy("query").agg(F.count(F.lit(1)).alias("n_blocks"), F.count_distinct("target").alias("n_targets"), F.count_distinct("conserved_id").alias("n_clusters"))


def f10_intervals(spark: SparkSession, base: str) -> DataFrame:
    rows = members(spark, base).select("conserved_id", "gene", parse.gene_interval("gene").alias("i"))
    return rows.select("conserved_id", "gene", "i.contig", F.col("i.start").alias("start_pos"), F.col("i.end").alias("end_pos"), "i.strand").distinct()


def layout(spark: SparkSession, base: str) -> DataFrame:
    """(conserved_id, relation, gene, homologous_id): listed genes, numbered in their order, and the genes of other genomes matched with them.

    A match names its two genes as query and target; where the listed gene is the target, the sides are
    swapped. Listed genes come before matched ones, these in the order of their matches.
    """
    rows = table(spark, base, "conserved_cluster").select("conserved_id", F.posexplode(parse.items("gene_list")).alias("at", "gene"))
    listed = rows.groupBy("conserved_id", "gene").agg(F.min("at").alias("at"))  # a gene listed twice has its first number
    listed = listed.withColumn("homologous_id", parse.numbered((F.col("at") + 1).cast("int"), "Gene_", 2))
    own = lambda c: F.trim(F.substring_index(c, "|", -1))
    pairs = table(spark, base, "gene_match").select("match_id", own("query_id").alias("query"), own("subject_id").alias("target")).where("query <> target")
    known = listed.select(F.col("gene").alias("reference")).distinct()
    as_target = pairs.join(known.withColumnRenamed("reference", "target"), "target", "left_semi").select("match_id", F.col("target").alias("reference"), F.col("query").alias("other"))
    as_query = pairs.join(known.withColumnRenamed("reference", "query"), "query", "left_semi").join(known.withColumnRenamed("reference", "target"), "target", "left_anti").select("match_id", F.col("query").alias("reference"), F.col("target").alias("other"))
    found = as_target.unionByName(as_query).join(listed.withColumnRenamed("gene", "reference"), "reference")
    return listed.select("conserved_id", F.lit(0).cast("long").alias("relation"), "gene", "homologous_id").unionByName(found.select("conserved_id", F.col("match_id").alias("relation"), F.col("other").alias("gene"), "homologous_id"))


def c12_layout(spark: SparkSession, base: str) -> DataFrame:
    """Places of the genes of each cluster, in the listed order and in other genomes: the first of each (genome, homologous name)."""
    rows = layout(spark, base).withColumn("i", parse.gene_interval("gene")).where("i.contig is not null").withColumn("molecule", F.col("i.contig"))
    pick = F.min_by(F.struct("gene", "i"), F.struct("relation", "gene")).alias("x")
    kept = rows.groupBy("conserved_id", "molecule", "homologous_id").agg(pick)
    return kept.select("conserved_id", "molecule", F.col("x.gene").alias("gene"), F.col("x.i.start").alias("start_pos"), F.col("x.i.end").alias("end_pos"), "x.i.strand", "homologous_id")


def p8_threshold(spark: SparkSession, base: str) -> DataFrame:
    """Clusters at or above half of the most species, the tiers being derived from the data."""
    df = table(spark, base, "conserved_cluster").select("conserved_id", "species_count", "gene_count")
    tiers = df.agg(F.max("species_count").alias("most"))
    out = df.crossJoin(F.broadcast(tiers))  # one row
    share = F.col("species_count") / F.col("most")
    tier = F.when(share >= 0.95, "95").when(share >= 0.7, "70").when(share >= 0.5, "50").otherwise("below")
    return out.withColumn("tier", tier).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("gene_count").alias("n_genes"))


def c11_high_conservation(spark: SparkSession, base: str) -> DataFrame:
    """Per query genome: highly conserved clusters, their ids, and the taxonomy of the genome's contig."""
    high = table(spark, base, "conserved_cluster").where("species_count >= 5").select("conserved_id")
    rows = occurrences(spark, base).join(high, "conserved_id", "left_semi").select("query", "conserved_id").distinct()
    out = rows.groupBy("query").agg(F.count(F.lit(1)).alias("n_clusters"), F.concat_ws(";", F.array_sort(F.collect_list("conserved_id"))).alias("ids"))
    taxa = table(spark, base, "taxonomy").select(F.col("contig").alias("query"), "family", "genus", "species")
    return out.join(taxa, "query", "left")


def star_genes(spark: SparkSession, base: str) -> DataFrame:
    """(species, cluster, gene) of the order tables: nation of the customer, order, brand."""
    orders = table(spark, base, "orders").join(table(spark, base, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("species"))
    lines = table(spark, base, "lineitem").join(table(spark, base, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("cluster"), F.col("p_brand").alias("gene"))
    return lines.join(orders, F.col("cluster") == F.col("o_orderkey")).select("species", "cluster", "gene")


def star_sets(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Signatures of the order tables and the sets kept of them, both written."""
    scratch = Scratch(spark)
    sigs, _ = scratch.put(sets.signatures(star_genes(spark, base), "species", "cluster", "gene"))
    found, _ = scratch.put(sets.recurring(sigs))
    return sigs, sets.maximal(found)


def c5_conserved_sets(spark: SparkSession, base: str) -> DataFrame:
    kept = star_sets(spark, base)[1].select(F.concat_ws("|", "genes").alias("genes"), F.size("genes").alias("gene_count"), "n_species", "n_clusters")
    ids = ranking.dense_ids(kept, [F.desc("gene_count"), F.desc("n_species"), F.asc("genes")], "id")
    return ids.select(parse.numbered("id", "Conserved_", 3).alias("conserved_id"), "genes", "gene_count", "n_species", "n_clusters")


def a8_set_members(spark: SparkSession, base: str) -> DataFrame:
    """The species and clusters in which each kept set was met, one row each.

    Spark would judge the kept sets by their file, which is far smaller than their lists of genes in memory, and broadcast them.
    """
    sigs, kept = star_sets(spark, base)
    return sigs.join(kept.select("genes").hint("merge"), "genes", "left_semi").select(F.concat_ws("|", "genes").alias("genes"), "species", "cluster")


def c6_closed_sets(spark: SparkSession, base: str) -> DataFrame:
    """Gene lists in common: species are the genomes in which a cluster was met as the query."""
    met = occurrences(spark, base).where("query <> ''").select("conserved_id", F.col("query").alias("species")).distinct()
    sigs, _ = Scratch(spark).put(sets.signatures(members(spark, base).join(met, "conserved_id"), "species", "conserved_id", "gene"))
    return sets.closed(sigs).select(F.concat_ws("|", "genes").alias("genes"), F.size("genes").alias("gene_count"), "n_clusters", "n_species")


def matches(spark: SparkSession, base: str) -> DataFrame:
    """Matches between two genes, with plain gene names."""
    own = lambda c: F.trim(F.substring_index(c, "|", -1))
    df = table(spark, base, "gene_match").select(own("query_id").alias("x"), own("subject_id").alias("y"), "perc_identity", "bit_score", "evalue")
    return df.where("x <> '' and y <> ''")


def simple(spark: SparkSession, base: str) -> DataFrame:
    ok = matches(spark, base).where("bit_score is not null and not isnan(bit_score)")
    return graph.simple_edges(ok, "x", "y", F.col("bit_score"))


def g3_simple_edges(spark: SparkSession, base: str) -> DataFrame:
    return simple(spark, base)


def g4_degrees(spark: SparkSession, base: str) -> DataFrame:
    return graph.degrees(simple(spark, base)).withColumn("strength", F.round("strength", 4))


def close_edges(spark: SparkSession, base: str) -> DataFrame:
    """Edges at a distance of at most 0.25, the distance being 1 - identity; missing pairs are no edges."""
    near = matches(spark, base).where("not isnan(perc_identity) and 1 - perc_identity / 100 <= 0.25")
    return graph.simple_edges(near, "x", "y")


def g2_components(spark: SparkSession, base: str) -> DataFrame:
    return graph.components(close_edges(spark, base))


def c2_dereplicated(spark: SparkSession, base: str) -> DataFrame:
    """Single-linkage clusters: id by smallest member, the longest member as representative (then the smallest), size."""
    labels = graph.components(close_edges(spark, base))
    i = parse.gene_interval("node")
    sized = labels.withColumn("length", F.coalesce(i["end"] - i["start"], F.lit(0)))
    groups = sized.groupBy("component").agg(F.min_by("node", F.struct(-F.col("length"), "node")).alias("representative"), F.max("length").alias("representative_size"), F.count(F.lit(1)).alias("size"))
    return ranking.dense_ids(groups, [F.asc("component")], "cluster_id", 0).drop("component")


def a11_cluster_sizes(spark: SparkSession, base: str) -> DataFrame:
    sizes = c2_dereplicated(spark, base)
    return sizes.agg(F.count(F.lit(1)).alias("n_clusters"), F.max("size").alias("most"), F.round(F.avg("size"), 6).alias("mean"), F.round(1 - F.try_divide(F.count(F.lit(1)), F.sum("size")), 6).alias("compression"))


def seeds(spark: SparkSession, base: str) -> DataFrame:
    """Candidate genes: those of the five clusters of most species."""
    top = ranking.top_rows(table(spark, base, "conserved_cluster").where("gene_list is not null"), [F.desc("species_count"), F.asc("conserved_id")], 5)
    return top.select(F.explode(parse.items("gene_list")).alias("node")).distinct()


def expanded(spark: SparkSession, base: str) -> DataFrame:
    edges = simple(spark, base)
    return Scratch(spark).put(graph.induced(edges, graph.neighbourhood(edges, seeds(spark, base))))[0]


def j36_expanded(spark: SparkSession, base: str) -> DataFrame:
    return expanded(spark, base)


def g13_nodes(spark: SparkSession, base: str) -> DataFrame:
    return graph.neighbourhood(simple(spark, base), seeds(spark, base))


def g11_clique_scores(spark: SparkSession, base: str) -> DataFrame:
    return graph.clique_scores(expanded(spark, base), g13_nodes(spark, base))


def g12_hubs(spark: SparkSession, base: str) -> DataFrame:
    """Candidates among the ten best by clique score, else the two best candidates."""
    scores, _ = Scratch(spark).put(g11_clique_scores(spark, base))
    order = [F.desc("mcc"), F.asc("node")]
    own = ranking.top_rows(scores.join(seeds(spark, base), "node", "left_semi"), order, 10)
    hubs = own.join(ranking.top_rows(scores, order, 10), "node", "left_semi").withColumn("strict", F.lit(True))
    both = hubs.unionByName(ranking.top_rows(own, order, 2).withColumn("strict", F.lit(False)))
    any_strict = both.agg(F.max("strict").alias("any"))
    return both.crossJoin(F.broadcast(any_strict)).where("strict = any").select("node", "mcc")  # one row


def g8_eigenvector(spark: SparkSession, base: str) -> DataFrame:
    return graph.eigenvector(expanded(spark, base)).withColumn("centrality", F.round("centrality", 6))


def g6_centralities(spark: SparkSession, base: str) -> DataFrame:
    out = graph.centralities(expanded(spark, base))
    return out.select("node", F.round("closeness", 9).alias("closeness"), F.round("betweenness", 6).alias("betweenness"))


def g10_page_rank(spark: SparkSession, base: str) -> DataFrame:
    return graph.page_rank(simple(spark, base)).withColumn("rank", F.round("rank", 9))


def g9_core(spark: SparkSession, base: str) -> DataFrame:
    return graph.core(simple(spark, base).select("a", "b"), 2)


def g9_coreness(spark: SparkSession, base: str) -> DataFrame:
    return graph.coreness(simple(spark, base))


def g14_merged(spark: SparkSession, base: str) -> DataFrame:
    """Nodes of the merged match graphs of all clusters, each under its first cluster, with isolated ones."""
    parts, _ = Scratch(spark).put(members(spark, base).select(F.col("conserved_id").alias("part"), F.col("gene").alias("node")))
    return graph.merged(parts, simple(spark, base))[0].withColumnRenamed("part", "conserved_id")


def c10_families(spark: SparkSession, base: str) -> DataFrame:
    """Each gene with its family's representative and size; families come from close matches."""
    labels = graph.components(close_edges(spark, base))
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("family_size"))
    return labels.join(sizes, "component").select(F.col("node").alias("gene_id"), F.col("component").alias("cluster_representative"), "family_size")


def a16_family_summary(spark: SparkSession, base: str) -> DataFrame:
    """Families of clustered genes: members, distinct contigs."""
    rows = c10_families(spark, base).withColumn("contig", parse.gene_contig("gene_id"))
    return rows.groupBy("cluster_representative").agg(F.count(F.lit(1)).alias("n_members"), F.count_distinct("contig").alias("n_contigs"), F.min("gene_id").alias("first_member"))


def j39_family_clusters(spark: SparkSession, base: str) -> DataFrame:
    """Conserved clusters that share a family with another one, by family."""
    rows = members(spark, base).join(c10_families(spark, base), F.col("gene") == F.col("gene_id")).select("conserved_id", "cluster_representative").distinct()
    return rows.groupBy("cluster_representative").agg(F.count(F.lit(1)).alias("n_clusters")).where("n_clusters >= 2")


_MEMBER = "member as (select conserved_id, unnest(list_filter(list_transform(string_split(gene_list, ' | '), lambda x: trim(x, ' ')), lambda x: x <> '')) gene from conserved_cluster)"
_AT = """place as (select conserved_id, unnest(list_filter(list_transform(string_split(species_cluster_map, ' | '), lambda x: trim(x, ' ')), lambda x: x <> '')) x from conserved_cluster),
occ as (select conserved_id, split_part(regexp_replace(x, ':#[^:#]*$', ''), '_with_', 1) query, nullif(regexp_replace(regexp_replace(x, ':#[^:#]*$', ''), '^.*?_with_', ''), regexp_replace(x, ':#[^:#]*$', '')) target from place)"""
_I = r"""nullif(regexp_extract({0}, '^(.*)_[^_]+_\d+_\d+$', 1), '') contig, try_cast(nullif(regexp_extract({0}, '^.*_[^_]+_(\d+)_(\d+)$', 1), '') as bigint) p, try_cast(nullif(regexp_extract({0}, '^.*_[^_]+_(\d+)_(\d+)$', 2), '') as bigint) q"""
_SIG = """sig as (select c_nationkey s, l_orderkey k, list_sort(list(distinct p_brand)) g from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey group by 1, 2 having count(distinct p_brand) >= 2),
rec as (select g, count(distinct s) n_species, count(*) n_clusters from sig group by g having count(distinct s) >= 2)"""
_MATCH = """raw as (select trim(split_part(query_id, '|', -1), ' ') x, trim(split_part(subject_id, '|', -1), ' ') y, * from gene_match),
ok as (select least(x, y) a, greatest(x, y) b, * from raw where x <> '' and y <> '' and x <> y),
edge as (select a, b, max(bit_score) score from ok where bit_score is not null and not isnan(bit_score) group by 1, 2),
both_ways as (select a node, b other, score from edge union all select b, a, score from edge)"""
_NEAR = """with recursive raw as (select trim(split_part(query_id, '|', -1), ' ') x, trim(split_part(subject_id, '|', -1), ' ') y, perc_identity p from gene_match),
near as (select distinct least(x, y) a, greatest(x, y) b from raw where x <> '' and y <> '' and x <> y and not isnan(p) and 1 - p / 100 <= 0.25),
two as (select a, b from near union select b, a from near),
reach(node, seen) using key (node) as (
    select a, min(least(a, b)) from two group by a
    union
    select l.b, min(r.seen) from reach r join two l on l.a = r.node join recurring.reach o on o.node = l.b where r.seen < o.seen group by l.b),
lab as (select node, seen component from reach)"""
_SEED = f"{_MEMBER}, seed as (select distinct gene node from member where conserved_id in (select conserved_id from conserved_cluster where gene_list is not null order by species_count desc nulls last, conserved_id limit 5))"
_EXP = f"""with {_MATCH}, {_SEED},
best as (select other from (select node, other, row_number() over (partition by node order by score desc, other) rn from both_ways where node in (select node from seed)) where rn <= 10),
nodes as (select node, true is_seed from seed union all select distinct other, false from best where other not in (select node from seed)),
ex as (select * from edge where a in (select node from nodes) and b in (select node from nodes))"""
_MCC = _EXP.replace("with raw", "with recursive raw", 1) + """, smaller as (select b, list(a) others from ex group by b),
cl(nodes, tip, size) as (select [a, b], b, 2 from ex union all select list_append(nodes, e.b), e.b, size + 1 from cl join ex e on e.a = cl.tip join smaller s on s.b = e.b where list_has_all(s.others, cl.nodes)),
part as (select unnest(nodes) node, factorial(size - 1)::double w from cl),
mcc as (select node, coalesce(sum(w), 0)::double mcc from (select distinct node from nodes) left join part using (node) group by 1)"""
_SIZED = _NEAR + ", sized as (select *, coalesce(abs(p - q), 0) len from (select *, " + _I.format("node") + " from lab)), grp as (select component, first(node order by len desc, node) representative, max(len) representative_size, count(*) size from sized group by 1)"
# Both iterate as long as it takes: 160 rounds of a walk that loses 15 % a round, 3,000 steps shifted by the greatest strength.
_RANK = f"with recursive {_MATCH}, deg as (select node, sum(score) al from both_ways group by 1), l as (select node, other, score / al s from both_ways join deg using (node)), n as (select count(*) n from deg), it(node, r, k) as (select node, 1.0::double / n, 0 from deg, n union all select l.other, 0.15 / (select n from n) + 0.85 * sum(it.r * l.s), it.k + 1 from it join l on l.node = it.node where it.k < 160 group by l.other, it.k)"
_EIG = _EXP.replace("with raw", "with recursive raw", 1) + """, t as (select a node, b other, score from ex union all select b, a, score from ex), m as (select max(s) m from (select sum(score) s from t group by node)),
loops as (select * from t union all select distinct node, node, m from t, m),
it(node, v, k) using key (node) as (select distinct node, 1.0::double, 0 from t union select l.node, sum(l.score * it.v) / max(sum(l.score * it.v)) over (), it.k + 1 from it join loops l on l.other = it.node where it.k < 3000 group by l.node, it.k)"""
_CORE = f"""with recursive {_MATCH}, it(node, c, k) as (select node, count(*), 0 from both_ways group by 1
    union all select node, max(least(c, rn)), k + 1 from (select t.node, it.c, it.k, row_number() over (partition by t.node order by it.c desc) rn from it join both_ways t on t.other = it.node where it.k < 200) group by node, k),
core as (select node, c from it where k = 200)"""

QUERIES = {
    f.__name__: f
    for f in (
        c4_gene_occurrence, a4_gene_folders, a8_set_members, g9_coreness, g14_merged, r6_comparisons, f10_intervals, c12_layout, p8_threshold, c11_high_conservation, c5_conserved_sets, c6_closed_sets, g3_simple_edges, g4_degrees, g2_components,
        c2_dereplicated, a11_cluster_sizes, j36_expanded, g13_nodes, g11_clique_scores, g12_hubs, g6_centralities, g8_eigenvector, g10_page_rank, g9_core, c10_families, a16_family_summary, j39_family_clusters,
    )
}
QUERIES["q8_threshold"] = QUERIES.pop("p8_threshold")
SQL = {
    "c4_gene_occurrence": f"with {_MEMBER} select gene, count(*) n_lines, count(distinct conserved_id) n_clusters, array_to_string(list_sort(list(distinct conserved_id)), ' | ') clusters from member group by 1",
    "r6_comparisons": f"with {_AT} select query, count(*) n_blocks, count(distinct target) n_targets, count(distinct conserved_id) n_clusters from occ group by 1",
    "f10_intervals": f"with {_MEMBER}, i as (select *, {_I.format('gene')} from member) select distinct conserved_id, gene, contig, least(p, q) start_pos, greatest(p, q) end_pos, case when p > q then '-' when p <= q then '+' end strand from i",
    "a4_gene_folders": f"with {_AT}, spot as (select distinct conserved_id, query || coalesce('_with_' || target, '') folder, block from (select conserved_id, split_part(regexp_replace(x, ':#[^:#]*$', ''), '_with_', 1) query, case when contains(regexp_replace(x, ':#[^:#]*$', ''), '_with_') then regexp_replace(regexp_replace(x, ':#[^:#]*$', ''), '^.*?_with_', '') end target, nullif(regexp_extract(x, ':#([^:#]*)$', 1), '') block from place)), {_MEMBER}, r as (select distinct gene, folder, block from member join spot using (conserved_id)) select gene, count(*) n_blocks, count(distinct folder) n_folders from r group by 1",
    "a8_set_members": f"with {_SIG}, kept as (select * from rec r where not exists (select 1 from rec o where len(o.g) > len(r.g) and list_has_all(o.g, r.g))) select array_to_string(g, '|') genes, s species, k as cluster from sig where g in (select g from kept)",
    "c12_layout": f"""with m as (select conserved_id, list_filter(list_transform(string_split(gene_list, ' | '), lambda x: trim(x, ' ')), lambda x: x <> '') l from conserved_cluster), e as (select conserved_id, unnest(l) gene, unnest(range(1, len(l) + 1)) k from m),
        li as (select conserved_id, gene, min(k) k from e group by 1, 2), g as (select match_id, trim(split_part(query_id, '|', -1), ' ') q, trim(split_part(subject_id, '|', -1), ' ') t from gene_match),
        sided as (select match_id, case when t in (select gene from li) then t else q end own, case when t in (select gene from li) then q else t end other from g where q <> t),
        al as (select conserved_id, 0 relation, gene, k from li union all select conserved_id, match_id, other, k from sided join li on li.gene = own),
        i as (select *, """ + _I.format("gene") + """ from al)
        select conserved_id, contig molecule, gene, least(p, q) start_pos, greatest(p, q) end_pos, case when p > q then '-' when p <= q then '+' end strand, format('Gene_{:02d}', k) homologous_id from i where contig is not null
        qualify row_number() over (partition by conserved_id, contig, k order by relation, gene) = 1""",
    "q8_threshold": "with t as (select *, species_count / (select max(species_count) from conserved_cluster) s from conserved_cluster) select case when s >= 0.95 then '95' when s >= 0.7 then '70' when s >= 0.5 then '50' else 'below' end tier, count(*) n, sum(gene_count) n_genes from t group by 1",
    "c11_high_conservation": f"with {_AT}, u as (select distinct query, conserved_id from occ where conserved_id in (select conserved_id from conserved_cluster where species_count >= 5)), g as (select query, count(*) n_clusters, array_to_string(list_sort(list(conserved_id)), ';') ids from u group by 1) select g.*, family, genus, species from g left join taxonomy on contig = query",
    "c5_conserved_sets": f"with {_SIG}, kept as (select * from rec r where not exists (select 1 from rec o where len(o.g) > len(r.g) and list_has_all(o.g, r.g))), o as (select array_to_string(g, '|') genes, len(g) gene_count, n_species, n_clusters from kept) select format('Conserved_{{:03d}}', row_number() over (order by gene_count desc, n_species desc, genes)) conserved_id, * from o",
    "c6_closed_sets": f"""with {_AT}, {_MEMBER}, met as (select distinct conserved_id k, query s from occ where query <> ''),
        one as (select conserved_id k, list_sort(list(distinct gene)) g from member group by 1 having count(distinct gene) >= 2), sig as (select s, k, g from one join met using (k)),
        d as (select g, count(*) n from sig group by 1),
        com as (select g from d where n >= 2 union select list_sort(list_intersect(x.g, y.g)) from d x join d y on x.g < y.g where len(list_intersect(x.g, y.g)) >= 2),
        held as (select c.g, count(*) n_clusters, list_sort(list(distinct s)) sp from com c join sig on list_has_all(sig.g, c.g) group by 1)
        select array_to_string(g, '|') genes, len(g) gene_count, n_clusters, len(sp) n_species from held h where not exists (select 1 from held o where len(o.g) > len(h.g) and list_has_all(o.g, h.g) and o.sp = h.sp)""",
    "g3_simple_edges": f"with {_MATCH} select * from edge",
    "g4_degrees": f"with {_MATCH} select node, count(*) degree, round(sum(score), 4) strength from both_ways group by 1",
    "g2_components": _NEAR + " select * from lab",
    "c2_dereplicated": _SIZED + " select row_number() over (order by component) - 1 cluster_id, representative, representative_size, size from grp",
    "a11_cluster_sizes": _SIZED + " select count(*) n_clusters, max(size) most, round(avg(size), 6) mean, round(1 - count(*) / sum(size), 6) compression from grp",
    "j36_expanded": _EXP + " select * from ex",
    "g13_nodes": _EXP + " select * from nodes",
    "g11_clique_scores": _MCC + " select * from mcc",
    "g12_hubs": _MCC + """, own as (select * from mcc where node in (select node from seed) order by mcc desc, node limit 10), top as (select * from mcc order by mcc desc, node limit 10),
        s as (select own.* from own semi join top using (node)) select * from s union all select * from (select * from own order by mcc desc, node limit 2) where not exists (select 1 from s)""",
    "g6_centralities": _EXP.replace("with raw", "with recursive raw", 1) + """, t as (select a x, b y, score w from ex union all select b, a, score from ex),
        dist(s, v, d) using key (s, v) as (select distinct x, x, 0.0::double from t union
            select r.s, t.y, min(r.d + t.w) from dist r join t on r.v = t.x left join recurring.dist o on o.s = r.s and o.v = t.y where o.d is null or r.d + t.w < o.d * (1 - 1e-9) group by 1, 2),
        tight as (select p.s, p.v, q.v z from dist p join t on t.x = p.v join dist q on q.s = p.s and q.v = t.y where abs(p.d + t.w - q.d) <= 1e-9 * q.d),
        p(s, v, k, n) as (select distinct s, s, 0, 1::double from dist union all select p.s, e.z, p.k + 1, sum(n) from p join tight e on e.s = p.s and e.v = p.v group by 1, 2, 3),
        e as (select s, v, d, n from (select s, v, sum(n) n from p group by 1, 2) join dist using (s, v) where s <> v),
        c as (select s node, 1 / sum(d) closeness from e group by 1),
        b as (select x.v node, sum(x.n * y.n / z.n) betweenness from e x join e y on y.s = x.v and x.s < y.v join e z on z.s = x.s and z.v = y.v and abs(x.d + y.d - z.d) <= 1e-9 * z.d group by 1)
        select node, round(closeness, 9) closeness, round(coalesce(betweenness, 0), 6) betweenness from c left join b using (node)""",
    "g8_eigenvector": _EIG + " select node, round(v / max(v) over (), 6) centrality from it",
    "g10_page_rank": _RANK + " select node, round(r, 9) rank from it where k = 160",
    "g9_coreness": _CORE + " select node, c core from core",
    "g9_core": _CORE + " select a, b from edge where a in (select node from core where c >= 2) and b in (select node from core where c >= 2)",
    "g14_merged": f"with {_MATCH}, {_MEMBER}, part as (select distinct conserved_id part, gene node from member), ie as (select distinct a, b from edge join part x on x.node = a join part y on y.node = b and y.part = x.part), deg as (select node, count(*) degree from (select a node from ie union all select b from ie) group by 1) select part.node, min(part) conserved_id, coalesce(any_value(degree), 0) degree from part left join deg using (node) group by 1",
    "c10_families": _NEAR + " select node gene_id, component cluster_representative, count(*) over (partition by component) family_size from lab",
    "a16_family_summary": _NEAR + ", s as (select *, " + _I.format("node") + " from lab) select component cluster_representative, count(*) n_members, count(distinct contig) n_contigs, min(node) first_member from s group by 1",
    "j39_family_clusters": _NEAR.replace("with recursive ", f"with recursive {_MEMBER}, ") + ", r as (select distinct conserved_id, component from member join lab on gene = node) select component cluster_representative, count(*) n_clusters from r group by 1 having count(*) >= 2",
}
