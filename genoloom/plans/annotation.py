"""Queries that integrate, annotate and rank: sources, taxonomy, panels, coverage, evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse
from ..operators import enrich, graph, integrate, ranking
from ..session import Scratch, table
from ..sources import rejects
from .clusters import close_edges, members, seeds, simple
from .general import gene
from .hits import best

KEYS = ["conserved_id", "cluster_gene"]


def summary(spark: SparkSession, base: str) -> DataFrame:
    """The homology summary, one row per key: of repeated ones that with the best score."""
    df = table(spark, base, "homology_summary").select(*KEYS, "human_gene", "length_bp", "identity_pct", "e_value", "comprehensive_score")
    return integrate.one_per_key(df, KEYS, [F.coalesce("comprehensive_score", F.lit(-1.0)), F.coalesce("human_gene", F.lit("")), F.coalesce("length_bp", F.lit(-1)), F.coalesce("identity_pct", F.lit(-1.0)), F.coalesce("e_value", F.lit(-1.0))])


def lines_of(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """The good lines of one kind; others aren't parsed."""
    return rejects.load_lines(table(spark, base, "raw_record").where(F.col("file_kind") == kind)).where("status = 'ok'")


def eggnog(spark: SparkSession, base: str) -> DataFrame:
    rows = lines_of(spark, base, "eggnog_summary").select(F.get("fields", F.lit(0)).alias("conserved_id"), F.col("query_id").alias("cluster_gene"), F.col("hit").alias("egg_hit"), F.col("evalue").alias("egg_evalue"), "record_id")
    return integrate.one_per_key(rows, KEYS, [-F.col("egg_evalue"), -F.col("record_id")]).drop("record_id")


#: Annotations looked up by a gene's key, and their fields in a seed line.
LOOKED_UP = {"seed_hit": 1, "seed_evalue": 2, "seed_score": 3, "seed_identity": 8, "seed_coverage": 9}


def seed_annotations(spark: SparkSession, base: str) -> DataFrame:
    """(query_id, five texts) of seed lines; of repeated queries the last line counts."""
    rows = lines_of(spark, base, "seed_orthologs").select("query_id", *(F.get("fields", F.lit(k)).alias(c) for c, k in LOOKED_UP.items()), "record_id")
    return integrate.one_per_key(rows, ["query_id"], [F.col("record_id")]).drop("record_id")


def integrated(spark: SparkSession, base: str) -> DataFrame:
    nucleotide = summary(spark, base).where("human_gene is null or not contains(lower(human_gene), 'no hit')")
    protein = best(spark, base).select(*KEYS, F.col("subject_by_comprehensive").alias("prot_gene"), F.col("evalue_by_comprehensive").alias("prot_evalue"))
    return integrate.combine({"nucl": nucleotide, "prot": protein, "egg": eggnog(spark, base)}, KEYS)


def source_of():
    has = lambda x: F.contains("sources", F.lit(x))
    return integrate.provenance(has("nucl"), has("prot"), has("egg"))


def c9_integrated(spark: SparkSession, base: str) -> DataFrame:
    """All evidence of each gene in one row, with its cluster's figures and five looked-up annotations, ``NA`` where there is none."""
    clusters = table(spark, base, "conserved_cluster").select("conserved_id", "gene_count", "species_count")
    out = integrated(spark, base).withColumn("source", source_of()).join(clusters, "conserved_id", "left").withColumn("query_id", F.concat_ws("|", *KEYS))
    out = out.join(seed_annotations(spark, base), "query_id", "left").withColumns({c: F.coalesce(c, F.lit("NA")) for c in LOOKED_UP})
    out = out.withColumn("any_gene", parse.first_filled("human_gene", "prot_gene", "egg_hit", F.lit("NA")))
    return integrate.existing(out, [*KEYS, "human_gene", "e_value", "prot_gene", "prot_evalue", "egg_hit", "egg_evalue", "egg_score", "source", *LOOKED_UP, "gene_count", "species_count", "any_gene"])


def j17_annotated_seeds(spark: SparkSession, base: str) -> DataFrame:
    """Queries of seed lines with the first summary line of the same query, by their ids."""
    seeds_ = lines_of(spark, base, "seed_orthologs").where("query_id is not null").groupBy("query_id").agg(F.min("record_id").alias("seed_record"))
    found = lines_of(spark, base, "eggnog_summary").select(F.concat_ws("|", F.get("fields", F.lit(0)), "query_id").alias("query_id"), "record_id", "hit")
    first = found.groupBy("query_id").agg(F.min("record_id").alias("summary_record"), F.min_by("hit", "record_id").alias("summary_hit"))
    return seeds_.join(first, "query_id", "left")


def a19_sources(spark: SparkSession, base: str) -> DataFrame:
    return integrated(spark, base).groupBy("sources").agg(F.count(F.lit(1)).alias("n"))


def placed(spark: SparkSession, base: str) -> DataFrame:
    """Summary rows with the taxonomy of their gene's contig."""
    df = table(spark, base, "homology_summary").withColumn("contig", parse.gene_contig("cluster_gene"))
    return df.join(table(spark, base, "taxonomy").select("contig", "phylum", "family", "genus", "species"), "contig", "left")


def c3_profile(spark: SparkSession, base: str) -> DataFrame:
    """Genes per family with the share of all, missing families being Unclassified."""
    counts = placed(spark, base).groupBy(parse.or_default("family", "Unclassified").alias("family")).agg(F.count(F.lit(1)).alias("n"))
    return ranking.with_share(counts, "n").withColumn("share", F.round("share", 6))


def a21_levels(spark: SparkSession, base: str) -> DataFrame:
    """Rows, sum and mean of lengths at three levels, in one pass of grouping sets."""
    level = F.when(F.grouping_id() == 3, "family").when(F.grouping_id() == 5, "genus").otherwise("species")
    df = placed(spark, base).select(*(parse.or_default(c, "Unclassified").alias(c) for c in ("family", "genus", "species")), "length_bp")
    out = df.groupingSets([["family"], ["genus"], ["species"]], "family", "genus", "species").agg(level.alias("level"), F.count(F.lit(1)).alias("n"), F.sum("length_bp").alias("total"), F.round(F.avg("length_bp"), 6).alias("mean"))
    return out.select("level", F.coalesce("family", "genus", "species").alias("taxon"), "n", "total", "mean")


def c20_top_genera(spark: SparkSession, base: str) -> DataFrame:
    """Genera by rows; only the first five are labelled."""
    counts = placed(spark, base).groupBy(parse.or_default("genus", "Unclassified").alias("genus")).agg(F.count(F.lit(1)).alias("n"))
    return ranking.label_top(counts, "genus", [F.desc("n"), F.asc("genus")], 5)


def c1_panel(spark: SparkSession, base: str) -> DataFrame:
    """Contigs of clustered genes, newest versions, matched with the taxonomy's; a row per kind of file, or unmatched."""
    panel = integrate.newest_versions(members(spark, base).select(parse.gene_contig("gene").alias("contig")), "contig")
    known = integrate.newest_versions(table(spark, base, "taxonomy").select("contig"), "contig")
    matched, unmatched = integrate.match_panel(panel, known)
    kinds = F.explode(F.array(F.lit("fna"), F.lit("gff"))).alias("kind")
    return matched.select("base", "accession", "found", kinds).unionByName(unmatched.select("base", "accession", F.lit(None).cast("string").alias("found"), F.lit("unmatched").alias("kind")))


def a2_ranks_known(spark: SparkSession, base: str) -> DataFrame:
    counts = table(spark, base, "taxonomy").groupBy(F.when(F.col("species_taxid").isNull(), "no species id").when(F.col("genus").isNull(), "no genus").otherwise("complete").alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return ranking.with_share(counts, "n").withColumn("share", F.round("share", 6))


def c18_coverage(spark: SparkSession, base: str) -> DataFrame:
    """The family that covers most of each cluster's genes."""
    covered = enrich.coverage(placed(spark, base), "conserved_id", "family", "cluster_gene")
    out = enrich.best_term(covered, "conserved_id", "family", "of_group")
    return out.select("conserved_id", "family", "n", "group_size", "term_size", F.round("of_group", 6).alias("of_group"), F.round("of_term", 6).alias("of_term"))


def a22_terms(spark: SparkSession, base: str) -> DataFrame:
    cells = placed(spark, base).where("genus is not null and conserved_id is not null").select("conserved_id", "genus").distinct()
    return cells.groupBy("genus").agg(F.count(F.lit(1)).alias("n_clusters"), F.concat_ws(";", F.array_sort(F.collect_list("conserved_id"))).alias("clusters"))


def o12_sample(spark: SparkSession, base: str) -> DataFrame:
    """Three comparable rows of each cluster, the same ones every time."""
    df = table(spark, base, "homology_summary").select(*KEYS).where("conserved_id is not null and cluster_gene is not null").distinct()
    return ranking.sample_per_group(df, ["conserved_id"], "cluster_gene", 3, "2024")


def j37_sampled_rows(spark: SparkSession, base: str) -> DataFrame:
    """The sampled keys of each cluster joined back to their best summary row."""
    return o12_sample(spark, base).join(summary(spark, base), KEYS).select(*KEYS, "human_gene", "length_bp", "comprehensive_score")


def j39_set_sizes(spark: SparkSession, base: str) -> DataFrame:
    """The size of a random set for each cluster id met in the summary: that of the cluster of this id, else of the cluster in the same place of the list, else 0."""
    met = table(spark, base, "homology_summary").where("conserved_id is not null").select(F.col("conserved_id").alias("set_id")).distinct()
    known = table(spark, base, "conserved_cluster").where("gene_count is not null").select("conserved_id", "gene_count")
    named = ranking.dense_ids(met, [F.asc("set_id")], "place").join(known.withColumnsRenamed({"conserved_id": "set_id", "gene_count": "own"}), "set_id", "left")
    listed = ranking.dense_ids(known, [F.asc("conserved_id")], "place").select("place", F.col("gene_count").alias("beside"))
    return named.join(listed, "place", "left").select("set_id", "place", F.coalesce("own", "beside", F.lit(0)).alias("size"))


def j30_by_name(spark: SparkSession, base: str) -> DataFrame:
    """Rows per genus joined with the organisms that bear its name: as many rows as there are organisms, or one."""
    counts = placed(spark, base).where("genus is not null").groupBy("genus").agg(F.count(F.lit(1)).alias("n_rows"))
    first = F.substring_index("organism_name", " ", 1)
    named = table(spark, base, "taxonomy").where("organism_name is not null").select(first.alias("genus"), "organism_name", "gcf")
    return counts.join(named, "genus", "left")


def w22_first_symbols(spark: SparkSession, base: str) -> DataFrame:
    """The first row of each gene symbol, in the order of cluster and gene; the symbol's other rows are left out."""
    df = table(spark, base, "homology_summary").select(gene().alias("symbol"), *KEYS).where("symbol is not null and conserved_id is not null and cluster_gene is not null")
    return df.groupBy("symbol").agg(F.min(F.struct(*KEYS)).alias("x")).select("symbol", "x.*")


def named_families(spark: SparkSession, base: str) -> DataFrame:
    """(gene_id, cluster_representative, name): family members with their human gene, written."""
    from .clusters import c10_families

    rows = c10_families(spark, base).select("gene_id", "cluster_representative")
    return Scratch(spark).put(rows.join(lookup(spark, base).where("name not in ('NO HIT', 'UNKNOWN')").withColumnRenamed("gene", "gene_id"), "gene_id", "left"))[0]


def a17_family_names(spark: SparkSession, base: str) -> DataFrame:
    """Size of each family and the sorted distinct human genes of its members (bounded by the names there are)."""
    rows = named_families(spark, base)
    sizes = rows.groupBy("cluster_representative").agg(F.count(F.lit(1)).alias("family_size"))
    names = rows.where("name is not null").select("cluster_representative", "name").distinct().groupBy("cluster_representative").agg(F.count(F.lit(1)).alias("n_names"), F.array_join(F.array_sort(F.collect_list("name")), ",").alias("member_genes"))
    return sizes.join(names, "cluster_representative", "left").withColumns({"n_names": F.coalesce("n_names", F.lit(0)), "member_genes": F.coalesce("member_genes", F.lit(""))})


def j19_groups(spark: SparkSession, base: str) -> DataFrame:
    """The families of each human gene, a row for each: its group is the genes of these families (``a17_family_names``).

    Written out per gene the groups of a large family would be all of its pairs; this says the same in
    as many rows as there are memberships.
    """
    return named_families(spark, base).where("name is not null").select("name", "cluster_representative").distinct()


def c10_annotated(spark: SparkSession, base: str) -> DataFrame:
    """Summary rows with the group of the gene picked by each of the four criteria, and the first group there is.

    A group is named by the smallest family of the gene, with the number of its families beside it.
    """
    groups, _ = Scratch(spark).put(j19_groups(spark, base).groupBy("name").agg(F.min("cluster_representative").alias("group"), F.count(F.lit(1)).alias("n_families")))
    picked = {"length": "human_gene_by_length", "evalue": "human_gene_by_evalue", "identity": "human_gene_by_identity", "comprehensive": "human_gene"}
    out = table(spark, base, "homology_summary").select(*KEYS, *(F.upper(F.trim(c)).alias(f"gene_by_{x}") for x, c in picked.items()))
    for x in picked:
        out = out.join(groups.select(F.col("name").alias(f"gene_by_{x}"), F.col("group").alias(f"group_by_{x}"), F.col("n_families").alias(f"families_by_{x}")), f"gene_by_{x}", "left")
    return out.select(*KEYS, *(c.format(x) for x in picked for c in ("gene_by_{}", "group_by_{}", "families_by_{}")), F.coalesce(*(f"group_by_{x}" for x in picked), F.lit("")).alias("group_all"))


def o7_batches(spark: SparkSession, base: str) -> DataFrame:
    out = ranking.even_batches(table(spark, base, "conserved_cluster").select("conserved_id"), [F.asc("conserved_id")], 7)
    return out.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("conserved_id").alias("first_id"), F.max("conserved_id").alias("last_id"))


def p23_open_work(spark: SparkSession, base: str) -> DataFrame:
    """Clusters with no summary row of high identity yet."""
    done = table(spark, base, "homology_summary").where("identity_pct >= 99 and not isnan(identity_pct) and conserved_id is not null").select("conserved_id").distinct()
    return table(spark, base, "conserved_cluster").select("conserved_id", "gene_count").join(done, "conserved_id", "left_anti")


def a38_completion(spark: SparkSession, base: str) -> DataFrame:
    """Done and total genes per cluster: listed genes that have a summary row."""
    done = table(spark, base, "homology_summary").where("conserved_id is not null").select("conserved_id", F.col("cluster_gene").alias("gene"), F.lit(True).alias("done")).distinct()
    out = members(spark, base).join(done, ["conserved_id", "gene"], "left").groupBy("conserved_id").agg(F.count("done").alias("n_done"), F.count(F.lit(1)).alias("n_all"))
    return out.withColumn("rate", F.round(F.col("n_done") / F.col("n_all"), 6))


def j25_by_any_id(spark: SparkSession, base: str) -> DataFrame:
    """Matches that touch a candidate gene from either side, each once."""
    df = table(spark, base, "gene_match").select("match_id", F.trim(F.substring_index("query_id", "|", -1)).alias("q"), F.trim(F.substring_index("subject_id", "|", -1)).alias("s"))
    return integrate.by_any_id(df, seeds(spark, base), ["q", "s"], "match_id").select("match_id", "q", "s")


def g16_flow(spark: SparkSession, base: str) -> DataFrame:
    """Links of a layered graph cluster -> family -> genus with weights, for the clusters of most rows."""
    df = placed(spark, base).where("conserved_id is not null and family is not null and genus is not null")
    top = ranking.top_rows(df.groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("conserved_id")], 10)
    df = df.join(top.select("conserved_id"), "conserved_id", "left_semi")
    links = df.select(F.explode(F.array(F.struct(F.col("conserved_id").alias("source"), F.col("family").alias("target")), F.struct(F.col("family").alias("source"), F.col("genus").alias("target")))).alias("x")).select("x.*")
    weights = links.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    names = weights.select(F.explode(F.array("source", "target")).alias("name")).distinct()
    ids = ranking.dense_ids(names, [F.asc("name")], "id", 0)
    out = weights.join(ids.withColumnsRenamed({"name": "source", "id": "source_id"}), "source").join(ids.withColumnsRenamed({"name": "target", "id": "target_id"}), "target")
    return out.select("source", "target", "weight", "source_id", "target_id")


def c19_evidence(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of candidate genes scored by family (null if unknown), match and shared clusters."""
    genes = ranking.dense_ids(ranking.top_rows(graph.degrees(simple(spark, base)), [F.desc("degree"), F.asc("node")], 12).select("node"), [F.asc("node")], "k")
    pairs = genes.alias("x").join(genes.alias("y"), F.col("x.k") < F.col("y.k")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))  # of twelve genes
    family = graph.components(close_edges(spark, base))
    fa, fb = (family.withColumnsRenamed({"node": c, "component": f"f{c}"}) for c in "ab")
    shared = enrich.shared_terms(members(spark, base).withColumnRenamed("conserved_id", "term"), genes.select(F.col("node").alias("gene")), 1)
    out = pairs.join(fa, "a", "left").join(fb, "b", "left").join(simple(spark, base), ["a", "b"], "left").join(shared, ["a", "b"], "left")
    c = (F.col("fa") == F.col("fb")).cast("int")
    p, e = F.col("score").isNotNull().cast("int"), F.coalesce("shared", F.lit(0)).cast("int")
    return out.select("a", "b", c.alias("c"), p.alias("p"), e.alias("e"), parse.evidence_sum(c, p, e).alias("total"))


def x_sets(spark: SparkSession, base: str) -> DataFrame:
    """Genes by the tables that name them: union with a tag, intersection and difference in one aggregate."""
    own = lambda name, column: table(spark, base, name).select(F.col(column).alias("gene"), F.lit(name).alias("t"))
    tagged = own("homology_summary", "cluster_gene").unionByName(own("blast_hit", "cluster_gene")).where("gene is not null")
    return tagged.groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set("t")), "+").alias("named_in")).groupBy("named_in").agg(F.count(F.lit(1)).alias("n"))


def lookup(spark: SparkSession, base: str) -> DataFrame:
    """(gene, name): one human gene per cluster gene, that of the best score, then the first by name."""
    df = table(spark, base, "homology_summary").where("cluster_gene is not null and human_gene is not null and comprehensive_score is not null and not isnan(comprehensive_score)")
    return df.groupBy(F.col("cluster_gene").alias("gene")).agg(F.min_by(gene(), F.struct(-F.col("comprehensive_score"), gene())).alias("name"))


def w20_first_name(spark: SparkSession, base: str) -> DataFrame:
    return lookup(spark, base)


def f20_mapped_lists(spark: SparkSession, base: str) -> DataFrame:
    """Gene lists with each gene replaced by its human gene, or kept where it has none."""
    rows = table(spark, base, "conserved_cluster").select("conserved_id", F.posexplode(parse.items("gene_list")).alias("at", "gene"))
    named = rows.join(lookup(spark, base), "gene", "left").select("conserved_id", F.struct("at", F.coalesce("name", "gene").alias("name")).alias("x"))
    return named.groupBy("conserved_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["name"]), "/").alias("names"))


def j12_intervals(spark: SparkSession, base: str) -> DataFrame:
    """Listed genes met among the hits at the same interval, in either orientation, per cluster."""
    at = lambda c: parse.gene_interval(c).alias("i")
    listed = members(spark, base).select("conserved_id", at("gene")).select("conserved_id", "i.contig", "i.start", "i.end").where("contig is not null").distinct()
    hit = table(spark, base, "blast_hit").select("cluster_gene").distinct().select(at("cluster_gene")).select("i.contig", "i.start", "i.end").distinct()
    return listed.join(hit, ["contig", "start", "end"], "left_semi").groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n_intervals"))


def j23_fallback(spark: SparkSession, base: str) -> DataFrame:
    """Listed genes found in the summary by id, else by contig and ordinal (the first by name), else not at all."""
    place = lambda c: F.nullif(F.regexp_extract(c, r"^(.*_[^_]+)_\d+_\d+$", 1), F.lit(""))
    known = table(spark, base, "homology_summary").where("cluster_gene is not null").select(F.col("cluster_gene").alias("found")).distinct()
    rows = members(spark, base).select("gene").distinct().withColumn("place", place("gene"))
    near = known.withColumn("place", place("found")).where("place is not null").groupBy("place").agg(F.min("found").alias("near"))
    out = rows.join(known.withColumn("gene", F.col("found")), "gene", "left").join(near, "place", "left")
    how = F.when(F.col("found").isNotNull(), "id").when(F.col("near").isNotNull(), "place").otherwise("none")
    return out.select("gene", F.coalesce("found", "near").alias("match"), how.alias("how"))


def a20_by_genome(spark: SparkSession, base: str) -> DataFrame:
    """Several figures at once per contig: genes, total and mean length, named ones and their share."""
    df = placed(spark, base).where("contig is not null").select("contig", "length_bp", gene().alias("g"))
    named = F.count_if(~F.coalesce(F.col("g"), F.lit("UNKNOWN")).isin("NO HIT", "UNKNOWN"))
    out = df.groupBy("contig").agg(F.count(F.lit(1)).alias("n"), F.sum("length_bp").alias("total"), F.round(F.avg("length_bp"), 6).alias("mean"), named.alias("n_named"))
    return out.withColumn("share", F.round(F.col("n_named") / F.col("n"), 1))


_KEYED = "conserved_id is not null and cluster_gene is not null"
_CONTIG = r"nullif(regexp_extract(cluster_gene, '^(.*)_[^_]+_\d+_\d+$', 1), '')"
_PLACED = f"placed as (select h.*, phylum, family, genus, species from (select *, {_CONTIG} contig from homology_summary) h left join taxonomy t using (contig))"
_OR = "coalesce(nullif(trim({0}, ' '), ''), 'Unclassified')"


def _integrated() -> str:
    from .general import _JUDGED
    from .hits import _BEST

    return (
        _JUDGED.strip().rstrip(")") + "),\n" + _BEST.replace("with hit as", "hit as", 1).replace("best as (", "prot_best as (", 1).split(",\nlong as")[0].replace(" from best", " from prot_best") + f""",
nucl as (select conserved_id, cluster_gene, unnest(max(struct_pack(s := coalesce(comprehensive_score, -1), g := coalesce(human_gene, ''), l := coalesce(length_bp, -1), i := coalesce(identity_pct, -1), e := coalesce(e_value, -1),
    human_gene := human_gene, e_value := e_value))) from homology_summary where {_KEYED} group by 1, 2),
n2 as (select conserved_id, cluster_gene, human_gene, e_value from nucl where human_gene is null or not contains(lower(human_gene), 'no hit')),
p2 as (select conserved_id, cluster_gene, subject_by_comprehensive prot_gene, evalue_by_comprehensive prot_evalue from prot_best),
e0 as (select f[1] conserved_id, q cluster_gene, hit egg_hit, cast(trim(e, ' ') as double) egg_evalue, record_id from judged where reason is null and file_kind = 'eggnog_summary'),
e2 as (select conserved_id, cluster_gene, first(egg_hit order by egg_evalue, record_id) egg_hit, min(egg_evalue) egg_evalue from e0 group by 1, 2),
sd as (select q query_id, first(f order by record_id desc) f from judged where reason is null and file_kind = 'seed_orthologs' and q is not null group by 1),
al as (select coalesce(n2.conserved_id, p2.conserved_id, e2.conserved_id) conserved_id, coalesce(n2.cluster_gene, p2.cluster_gene, e2.cluster_gene) cluster_gene, human_gene, e_value, prot_gene, prot_evalue, egg_hit, egg_evalue,
    n2.conserved_id is not null n, p2.conserved_id is not null p, e2.conserved_id is not null g
    from n2 full join p2 using (conserved_id, cluster_gene) full join e2 on e2.conserved_id = coalesce(n2.conserved_id, p2.conserved_id) and e2.cluster_gene = coalesce(n2.cluster_gene, p2.cluster_gene))"""
    )


def _sql() -> dict[str, str]:
    from .clusters import _MATCH, _MEMBER, _NEAR, _SEED

    cov = f"with {_PLACED}, cell as (select distinct conserved_id, family, cluster_gene from placed where conserved_id is not null and family is not null and cluster_gene is not null), b as (select conserved_id, family, count(*) n from cell group by 1, 2), g as (select conserved_id, count(distinct cluster_gene) group_size from cell group by 1), t as (select family, count(distinct cluster_gene) term_size from cell group by 1)"
    newest = "select regexp_replace(contig, '\\.[0-9]+$', '') base, first(contig order by coalesce(try_cast(nullif(regexp_extract(contig, '\\.([0-9]+)$', 1), '') as int), 0) desc, contig desc) accession from {0} where contig is not null group by 1"
    name = "look as (select cluster_gene gene, first(upper(trim(human_gene, ' ')) order by comprehensive_score desc, upper(trim(human_gene, ' '))) name from homology_summary where cluster_gene is not null and human_gene is not null and comprehensive_score is not null and not isnan(comprehensive_score) group by 1)"
    at = "nullif(regexp_extract({0}, '^(.*)_[^_]+_\\d+_\\d+$', 1), '') contig, least({1}, {2}) lo, greatest({1}, {2}) hi"
    pos = lambda c: at.format(c, *(f"try_cast(nullif(regexp_extract({c}, '^.*_[^_]+_(\\d+)_(\\d+)$', {k}), '') as bigint)" for k in (1, 2)))
    fam = _NEAR.replace("with recursive ", f"with recursive {name}, ") + ", nf as (select node, component, name from lab left join (select * from look where name not in ('NO HIT', 'UNKNOWN')) on gene = node)"
    spot = "nullif(regexp_extract({0}, '^(.*_[^_]+)_\\d+_\\d+$', 1), '')"
    return {
        "w20_first_name": f"with {name} select * from look",
        "f20_mapped_lists": f"with {name}, m as (select conserved_id, list_filter(list_transform(string_split(gene_list, ' | '), lambda x: trim(x, ' ')), lambda x: x <> '') l from conserved_cluster), e as (select conserved_id, unnest(l) gene, unnest(range(len(l))) k from m) select conserved_id, string_agg(coalesce(name, gene), '/' order by k) names from e left join look using (gene) group by 1",
        "j12_intervals": f"with {_MEMBER}, a as (select distinct conserved_id, {pos('gene')} from member), b as (select distinct {pos('cluster_gene')} from blast_hit) select conserved_id, count(*) n_intervals from a semi join b using (contig, lo, hi) group by 1",
        "j23_fallback": f"with {_MEMBER}, k as (select distinct cluster_gene f from homology_summary where cluster_gene is not null), n as (select {spot.format('f')} place, min(f) near from k group by 1 having place is not null), r as (select distinct gene, {spot.format('gene')} place from member) select gene, coalesce(f, near) as match, case when f is not null then 'id' when near is not null then 'place' else 'none' end how from r left join k on f = gene left join n using (place)",
        "a20_by_genome": f"with {_PLACED}, g as (select contig, length_bp, coalesce(upper(trim(human_gene, ' ')), 'UNKNOWN') not in ('NO HIT', 'UNKNOWN') named from placed where contig is not null) select contig, count(*) n, sum(length_bp) total, round(avg(length_bp), 6) mean, count(*) filter (named) n_named, round(count(*) filter (named) / count(*), 1) share from g group by 1",
        "c9_integrated": _integrated() + """ select conserved_id, cluster_gene, human_gene, e_value, prot_gene, prot_evalue, egg_hit, egg_evalue,
            coalesce(f[2], 'NA') seed_hit, coalesce(f[3], 'NA') seed_evalue, coalesce(f[4], 'NA') seed_score, coalesce(f[9], 'NA') seed_identity, coalesce(f[10], 'NA') seed_coverage,
            case when n and g then 'Both' when n then 'BLAST only' when g then 'eggNOG only' else 'BLASTP only' end source, gene_count, species_count, coalesce(nullif(human_gene, ''), nullif(prot_gene, ''), nullif(egg_hit, ''), 'NA') any_gene
            from al left join conserved_cluster using (conserved_id) left join sd on query_id = conserved_id || '|' || cluster_gene""",
        "j17_annotated_seeds": _integrated() + """, sq as (select q query_id, min(record_id) seed_record from judged where reason is null and file_kind = 'seed_orthologs' and q is not null group by 1),
            su as (select f[1] || '|' || q query_id, min(record_id) summary_record, arg_min(hit, record_id) summary_hit from judged where reason is null and file_kind = 'eggnog_summary' group by 1) select * from sq left join su using (query_id)""",
        "j37_sampled_rows": _integrated() + f""", sa as (select conserved_id, cluster_gene from (select distinct conserved_id, cluster_gene from homology_summary where {_KEYED}) qualify row_number() over (partition by conserved_id order by md5('2024|' || conserved_id || '|' || cluster_gene), cluster_gene) <= 3),
            de as (select conserved_id, cluster_gene, unnest(max(struct_pack(s := coalesce(comprehensive_score, -1), g := coalesce(human_gene, ''), l := coalesce(length_bp, -1), i := coalesce(identity_pct, -1), e := coalesce(e_value, -1), human_gene := human_gene, length_bp := length_bp, comprehensive_score := comprehensive_score))) from homology_summary where {_KEYED} group by 1, 2)
            select conserved_id, cluster_gene, human_gene, length_bp, comprehensive_score from sa join de using (conserved_id, cluster_gene)""",
        "j39_set_sizes": "with m as (select set_id, row_number() over (order by set_id) place from (select distinct conserved_id set_id from homology_summary where conserved_id is not null)), k as (select conserved_id, gene_count, row_number() over (order by conserved_id) place from conserved_cluster where gene_count is not null) select set_id, m.place, coalesce(a.gene_count, b.gene_count, 0) size from m left join k a on a.conserved_id = set_id left join k b on b.place = m.place",
        "j30_by_name": f"with {_PLACED}, c as (select genus, count(*) n_rows from placed where genus is not null group by 1), n as (select split_part(organism_name, ' ', 1) genus, organism_name, gcf from taxonomy where organism_name is not null) select * from c left join n using (genus)",
        "w22_first_symbols": f"select upper(trim(human_gene, ' ')) symbol, unnest(min(struct_pack(conserved_id := conserved_id, cluster_gene := cluster_gene))) from homology_summary where human_gene is not null and {_KEYED} group by 1",
        "a17_family_names": fam + ", d as (select distinct component, name from nf where name is not null), g as (select component, count(*) n_names, string_agg(name, ',' order by name) member_genes from d group by 1), z as (select component, count(*) family_size from nf group by 1) select component cluster_representative, family_size, coalesce(n_names, 0) n_names, coalesce(member_genes, '') member_genes from z left join g using (component)",
        "j19_groups": fam + " select distinct name, component cluster_representative from nf where name is not null",
        "c10_annotated": fam + ", gr as (select name, min(component) grp, count(distinct component) n from nf where name is not null group by 1), h as (select conserved_id, cluster_gene, upper(trim(human_gene_by_length, ' ')) a, upper(trim(human_gene_by_evalue, ' ')) b, upper(trim(human_gene_by_identity, ' ')) c, upper(trim(human_gene, ' ')) d from homology_summary) select conserved_id, cluster_gene, a gene_by_length, w.grp group_by_length, w.n families_by_length, b gene_by_evalue, x.grp group_by_evalue, x.n families_by_evalue, c gene_by_identity, y.grp group_by_identity, y.n families_by_identity, d gene_by_comprehensive, z.grp group_by_comprehensive, z.n families_by_comprehensive, coalesce(w.grp, x.grp, y.grp, z.grp, '') group_all from h left join gr w on w.name = a left join gr x on x.name = b left join gr y on y.name = c left join gr z on z.name = d",
        "a19_sources": _integrated() + " select concat_ws('+', case when n then 'nucl' end, case when p then 'prot' end, case when g then 'egg' end) sources, count(*) n from al group by 1",
        "c3_profile": f"with {_PLACED} select {_OR.format('family')} family, count(*) n, round(count(*) / (select count(*) from placed), 6) share from placed group by 1",
        "a21_levels": f"with {_PLACED} " + " union all ".join(f"select '{c}' level, {_OR.format(c)} taxon, count(*) n, sum(length_bp) total, round(avg(length_bp), 6) mean from placed group by 2" for c in ("family", "genus", "species")),
        "c20_top_genera": f"with {_PLACED}, c as (select {_OR.format('genus')} genus, count(*) n from placed group by 1) select genus, n, case when row_number() over (order by n desc, genus) <= 5 then genus end label from c",
        "c1_panel": f"with {_MEMBER}, m as (select nullif(regexp_extract(gene, '^(.*)_[^_]+_\\d+_\\d+$', 1), '') contig from member), panel as ({newest.format('m')}), known as ({newest.format('taxonomy')}) select base, accession, found, unnest(['fna', 'gff']) kind from panel join (select base, accession found from known) using (base) union all select base, accession, null, 'unmatched' from panel where base not in (select base from known)",
        "a2_ranks_known": "select case when species_taxid is null then 'no species id' when genus is null then 'no genus' else 'complete' end state, count(*) n, round(count(*) / (select count(*) from taxonomy), 6) share from taxonomy group by 1",
        "c18_coverage": cov + " select conserved_id, family, n, group_size, term_size, round(n / group_size, 6) of_group, round(n / term_size, 6) of_term from b join g using (conserved_id) join t using (family) qualify row_number() over (partition by conserved_id order by n / group_size desc, family) = 1",
        "a22_terms": f"with {_PLACED} select genus, count(distinct conserved_id) n_clusters, array_to_string(list_sort(list(distinct conserved_id)), ';') clusters from placed where genus is not null and conserved_id is not null group by 1",
        "o12_sample": f"select conserved_id, cluster_gene from (select distinct conserved_id, cluster_gene from homology_summary where {_KEYED}) qualify row_number() over (partition by conserved_id order by md5('2024|' || conserved_id || '|' || cluster_gene), cluster_gene) <= 3",
        "o7_batches": "with r as (select conserved_id, row_number() over (order by conserved_id) - 1 k, count(*) over () n from conserved_cluster) select cast(floor(k / ceil(n / 7)) as bigint) + 1 batch, count(*) n, min(conserved_id) first_id, max(conserved_id) last_id from r group by 1",
        "p23_open_work": "select conserved_id, gene_count from conserved_cluster where conserved_id not in (select conserved_id from homology_summary where identity_pct >= 99 and not isnan(identity_pct) and conserved_id is not null)",
        "a38_completion": f"with {_MEMBER}, d as (select distinct conserved_id, cluster_gene gene, true done from homology_summary where conserved_id is not null) select conserved_id, count(done) n_done, count(*) n_all, round(count(done) / count(*), 6) rate from member left join d using (conserved_id, gene) group by 1",
        "j25_by_any_id": f"with {_SEED}, g as (select match_id, trim(split_part(query_id, '|', -1), ' ') q, trim(split_part(subject_id, '|', -1), ' ') s from gene_match) select * from g where q in (select node from seed) or s in (select node from seed)",
        "g16_flow": f"with {_PLACED}, ok as (select * from placed where conserved_id is not null and family is not null and genus is not null), top as (select conserved_id from ok group by 1 order by count(*) desc, conserved_id limit 10), o2 as (select * from ok where conserved_id in (select conserved_id from top)), l as (select conserved_id source, family target from o2 union all select family, genus from o2), w as (select source, target, count(*) weight from l group by 1, 2), ids as (select name, row_number() over (order by name) - 1 id from (select source name from w union select target from w)) select source, target, weight, x.id source_id, y.id target_id from w join ids x on x.name = source join ids y on y.name = target",
        "c19_evidence": _NEAR + f", {_MATCH.replace('raw as', 'raw2 as').replace('from raw ', 'from raw2 ').replace('both_ways', 'ways')}, {_MEMBER}, deg as (select node, count(*) d from ways group by 1), gs as (select node from deg order by d desc, node limit 12), pr as (select x.node a, y.node b from gs x join gs y on x.node < y.node), own as (select distinct conserved_id, gene from member where gene in (select node from gs)), sh as (select x.gene a, y.gene b, count(*) shared from own x join own y on x.conserved_id = y.conserved_id and x.gene < y.gene group by 1, 2), j as (select a, b, cast(f.component = h.component as int) c, cast(score is not null as int) p, cast(coalesce(shared, 0) as int) e from pr left join lab f on f.node = a left join lab h on h.node = b left join edge using (a, b) left join sh using (a, b)) select *, coalesce(c, 0) + p + e total from j",
        "x_sets": "with u as (select cluster_gene gene, 'homology_summary' t from homology_summary union all select cluster_gene, 'blast_hit' from blast_hit), g as (select gene, array_to_string(list_sort(list(distinct t)), '+') named_in from u where gene is not null group by 1) select named_in, count(*) n from g group by 1",
    }


QUERIES = {
    f.__name__: f
    for f in (
        c9_integrated, j17_annotated_seeds, j37_sampled_rows, j39_set_sizes, j30_by_name, w22_first_symbols, a17_family_names, j19_groups, c10_annotated, a19_sources, c3_profile, a21_levels, c20_top_genera, c1_panel, a2_ranks_known, c18_coverage, a22_terms, o12_sample, o7_batches,
        p23_open_work, a38_completion, j25_by_any_id, g16_flow, c19_evidence, x_sets, w20_first_name, f20_mapped_lists, j12_intervals, j23_fallback, a20_by_genome,
    )
}
QUERIES["q23_open_work"] = QUERIES.pop("p23_open_work")
SQL = _sql()
SQL["q23_open_work"] = SQL.pop("p23_open_work")
