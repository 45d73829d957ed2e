"""Queries through files: tables are written in the layouts of the pipeline's tools and read back by their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sinks, streaming
from ..functions import parse
from ..operators import integrate, ranking
from ..session import Scratch, table
from ..sources import files
from .clusters import members, occurrences
from .hits import best


def text(*parts) -> F.Column:
    """Fields joined by tabs, missing ones empty."""
    return F.concat_ws("\t", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in parts))


def s1_headed(spark: SparkSession, base: str) -> DataFrame:
    """A tab-separated file with a header: required columns, one of them also found by its position."""
    at = Scratch(spark).at("table")
    sinks.delimited(table(spark, base, "taxonomy").select("contig", "gcf", "species"), at, "\t")
    df = files.table_with_header(spark, at, ["contig", "species"])
    found = files.column_or_position(df, "absent", 1)
    assert found.columns == ["absent"] and files.column_or_position(df, "gcf", 0).columns == ["gcf"]
    return df.select("contig", "species", F.col(df.columns[1]).alias("by_place"))


def s14_quoted(spark: SparkSession, base: str) -> DataFrame:
    """A comma-separated file whose cells hold commas, quotes and long texts."""
    at = Scratch(spark).at("table")
    cells = table(spark, base, "conserved_cluster").select("conserved_id", F.regexp_replace("gene_list", r" \| ", ',"').alias("genes"), "species_cluster_map")
    sinks.delimited(cells, at)
    return files.table_with_header(spark, at, ["conserved_id", "genes"], ",")


def s3_ids(spark: SparkSession, base: str) -> DataFrame:
    """The sorted list of ids below its comments, read back without them."""
    at = Scratch(spark).at("ids")
    sinks.commented_list(table(spark, base, "conserved_cluster"), at, "conserved_id", ["ids of conserved clusters", "one a line"])
    return files.id_list(spark, at)


def s4_distances(spark: SparkSession, base: str) -> DataFrame:
    at = Scratch(spark).at("distances")
    own = lambda c: F.concat(F.lit("/genomes/run 1/"), F.trim(F.substring_index(c, "|", -1)), F.lit(".fna"))
    rows = table(spark, base, "gene_match").where("query_id is not null and subject_id is not null and perc_identity is not null and not isnan(perc_identity)")
    rows.select(text(own("query_id"), own("subject_id"), F.lit(1) - F.col("perc_identity") / 100, "evalue", F.lit("1/1000")).alias("value")).write.text(at)
    return files.distances(spark, at).select(parse.strip_suffix("g1", [".fna", ".fa"]).alias("g1"), parse.strip_suffix("g2", [".fna", ".fa"]).alias("g2"), "dist")


def s6_assemblies(spark: SparkSession, base: str) -> DataFrame:
    """The assembly summary by position, its numbers tried."""
    at = Scratch(spark).at("assemblies")
    empty = F.lit("")
    table(spark, base, "taxonomy").select(text("gcf", empty, empty, empty, F.lit("na"), "taxid", F.concat("species_taxid", F.when(F.length("gcf") % 2 == 0, "x").otherwise("")), "organism_name").alias("value")).write.text(at)
    df = files.delimited(spark, at, "assembly_summary")
    return df.select(F.col("assembly_accession").alias("gcf"), F.col("taxid").try_cast("int").alias("taxid"), F.col("species_taxid").try_cast("int").alias("species_taxid"), "organism_name")


def s7_accessions(spark: SparkSession, base: str) -> DataFrame:
    """Lines that begin with an accession give two files each; others are left out."""
    at = Scratch(spark).at("accessions")
    odd = F.when(F.col("contig").endswith(".1"), F.concat(F.lit("# "), "gcf")).otherwise(F.col("gcf"))
    table(spark, base, "taxonomy").where("gcf is not null").select(F.concat_ws(" ", odd, "organism_name").alias("value")).write.text(at)
    return files.accessions(spark, at)


def annotation_files(spark: SparkSession, base: str) -> str:
    """Annotation files of the listed genes: a mark per contig and its coding lines behind it; a folder per length of the contig's name."""
    at = Scratch(spark).at("gff")
    rows = members(spark, base).select("gene").distinct().select("gene", parse.gene_interval("gene").alias("i")).where("i.contig is not null and i.start is not null")
    rows = rows.select(F.col("i.contig").alias("contig"), F.col("i.start").alias("start"), F.col("i.end").alias("end"), F.col("i.strand").alias("strand"), "gene")
    coding = rows.select("contig", "start", "end", "gene", text("contig", F.lit("tool"), F.lit("CDS"), "start", "end", F.lit("."), "strand", F.lit("0"), F.concat(F.lit("ID="), "gene", F.lit(";locus_tag=L#"), "start")).alias("value"))
    marks = rows.groupBy("contig").agg(F.max("end").alias("most")).select("contig", F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"), F.lit("").alias("gene"), F.concat_ws(" ", F.lit(files.REGION), "contig", F.lit("1"), "most").alias("value"))
    placed = coding.unionByName(marks).withColumn("file", F.concat(F.lit("g"), F.substring("contig", -3, 1)))
    sinks.whole_files(placed, at, "file", [F.asc("contig"), F.asc("start"), F.asc("end"), F.asc("gene")])
    return at


def s8_gff(spark: SparkSession, base: str) -> DataFrame:
    return files.gff(spark, annotation_files(spark, base), "CDS").select("contig", "feature", "start_pos", "end_pos", "strand", "id", "locus_tag")


def s9_intervals(spark: SparkSession, base: str) -> DataFrame:
    return files.cds_intervals(spark, annotation_files(spark, base))


def q22_strands(spark: SparkSession, base: str) -> DataFrame:
    """Coding lines with corrected strands, written file by file and read again."""
    again = Scratch(spark).at("corrected")
    sinks.lines(files.corrected_strands(spark, annotation_files(spark, base)), again, "file", [F.asc("region"), F.asc("at")])
    return files.gff(spark, again, "CDS").select("contig", "start_pos", "end_pos", "strand", "id")


def s10_best_files(spark: SparkSession, base: str) -> DataFrame:
    names = table(spark, base, "raw_record").where("file_name is not null").select(F.concat(F.lit("/data/"), "file_name").alias("path")).distinct()
    return files.best_file_per_folder(spark, names, ["eggnog_homology_summary.csv", ".emapper.seed_orthologs", "_blast.txt"])


def s31_listing(spark: SparkSession, base: str) -> DataFrame:
    """Bytes of the files of each kind, from a listing of what was written."""
    at = Scratch(spark).at("lines")
    table(spark, base, "raw_record").where("raw_line is not null and file_kind is not null").select("file_kind", F.col("raw_line").alias("value")).write.partitionBy("file_kind").text(at)
    kind = F.regexp_extract("path", "file_kind=([^/]+)/", 1)
    return files.listing(spark, at, "*.txt").groupBy(kind.alias("file_kind")).agg(F.sum("length").alias("n_bytes"))


def file_sizes(spark: SparkSession, base: str) -> DataFrame:
    """(folder, name, size): the files that raw lines came from."""
    rows = table(spark, base, "raw_record").where("file_name is not null")
    return rows.groupBy(F.substring_index("file_name", "/", 1).alias("folder"), parse.basename("file_name").alias("name")).agg(F.sum(F.length("raw_line")).alias("size"))


def j7_sizes(spark: SparkSession, base: str) -> DataFrame:
    """Size of each cluster's hit file, found by the name it must have; 0 where there is none."""
    sizes = file_sizes(spark, base).groupBy("name").agg(F.max("size").alias("size"))
    wanted = table(spark, base, "conserved_cluster").select("conserved_id", F.concat("conserved_id", F.lit("_blast.txt")).alias("name"))
    return wanted.join(sizes, "name", "left").select("conserved_id", F.coalesce("size", F.lit(0)).alias("size"))


def a12_known_sizes(spark: SparkSession, base: str) -> DataFrame:
    return j7_sizes(spark, base).where("size > 0").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max("size").alias("most"), F.round(F.avg("size"), 6).alias("mean"))


def o8_largest_files(spark: SparkSession, base: str) -> DataFrame:
    """The largest file of each folder, of equal ones the first by name."""
    return file_sizes(spark, base).groupBy("folder").agg(F.min_by("name", F.struct(-F.col("size"), "name")).alias("name"), F.max("size").alias("size"))


def j6_first_files(spark: SparkSession, base: str) -> DataFrame:
    """The first file by name that belongs to each cluster: its id is the name up to the first mark that no id has."""
    names = file_sizes(spark, base).select(F.regexp_extract("name", "^([A-Za-z]+_[0-9]+)", 1).alias("conserved_id"), "name")
    first = names.groupBy("conserved_id").agg(F.min("name").alias("name"), F.count_distinct("name").alias("n_files"))
    return table(spark, base, "conserved_cluster").select("conserved_id").join(first, "conserved_id", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)))


def sequences(spark: SparkSession, base: str) -> DataFrame:
    """(conserved_id, gene, sequence): listed genes with a sequence derived from their names."""
    letters = F.translate(F.concat(F.md5("gene"), F.md5(F.reverse("gene"))), "0123456789abcdef", "ACGTACGTACGTACGT")
    return members(spark, base).distinct().withColumn("sequence", letters)


def s11_fasta(spark: SparkSession, base: str) -> DataFrame:
    """Sequences over two lines, with marks inside headers; also reversed and complemented."""
    at = Scratch(spark).at("fasta")
    record = F.concat(F.lit(">"), "gene", F.lit(" 5'->3' [x>y]\n"), F.substring("sequence", 1, 40), F.lit("\n"), F.expr("substring(sequence, 41)"))
    sequences(spark, base).select("gene", "sequence").distinct().select(record.alias("value")).write.text(at)
    return files.fasta(spark, at).select("header", "sequence", parse.reverse_complement("sequence").alias("other_strand"))


def c7_recruited(spark: SparkSession, base: str) -> DataFrame:
    """Sequences of the genes of highly conserved clusters: coding sequences named by their place, met by interval, a file per cluster."""
    scratch = Scratch(spark)
    i = parse.gene_interval("gene")
    coding = sequences(spark, base).select("gene", "sequence").distinct().withColumn("i", i).where("i.contig is not null and i.start is not null")
    head = F.concat(F.lit("cds-"), "gene", F.lit("::"), "i.contig", F.lit(":"), F.col("i.start") - 1, F.lit("-"), "i.end", F.lit("("), "i.strand", F.lit(")"))
    coding.select(F.concat(F.lit(">"), head, F.lit("\n"), "sequence").alias("value")).write.text(scratch.at("coding"))
    high = table(spark, base, "conserved_cluster").where("species_count >= 5").select("conserved_id")
    wanted = members(spark, base).join(high, "conserved_id", "left_semi").select("conserved_id", "gene", i.alias("i")).select("conserved_id", "gene", "i.contig", F.col("i.start").alias("start_pos"), F.col("i.end").alias("end_pos")).distinct()
    found = wanted.join(files.cds_sequences(spark, scratch.at("coding")), ["contig", "start_pos", "end_pos"])
    sinks.fasta(found, scratch.at("recruited"), "gene", "sequence", "conserved_id")
    return files.fasta(spark, scratch.at("recruited")).groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sequence")).alias("n_bases"), F.min("header").alias("first_gene"))


def s12_blocks(spark: SparkSession, base: str) -> DataFrame:
    """Synteny blocks: matches by query and target contig, written file by file, best first, and read back."""
    at = Scratch(spark).at("blocks")
    own = lambda c: F.trim(F.substring_index(c, "|", -1))
    rows = table(spark, base, "gene_match").select("match_id", own("query_id").alias("gene_a"), own("subject_id").alias("gene_b"), "evalue", "bit_score")
    rows = rows.withColumns({"query": parse.gene_contig("gene_a"), "target": parse.gene_contig("gene_b")}).where("query is not null and target is not null")
    figures = rows.groupBy("query", "target").agg(F.min("evalue").alias("cluster_p"), F.max("bit_score").alias("multihit_p"), F.count(F.lit(1)).cast("int").alias("gene_count"), F.min("match_id").alias("first"))
    named = rows.join(figures, ["query", "target"]).withColumns({"file": F.concat(F.lit("from_"), "query"), "block": F.concat("target", F.lit(":#"), "first"), "at": F.col("match_id")})
    sinks.blocks(named, at)
    return files.blocks(spark, at).select("file", "block", "query", "target", "cluster_p", "gene_count", "gene_a", "gene_b")


def s17_hits(spark: SparkSession, base: str) -> DataFrame:
    """Hit files of twelve or thirteen fields among comments and short lines."""
    at = Scratch(spark).at("hits")
    rows = table(spark, base, "raw_record").where("file_kind = 'blast' and raw_line is not null and not contains(raw_line, '\n')")
    rows.select(F.regexp_replace(parse.basename("file_name"), r"\W", "_").alias("file"), F.col("raw_line").alias("value")).write.partitionBy("file").text(at)
    return files.delimited(spark, at, "blast_hit").where("bitscore is not null").select(F.col("file").cast("string").alias("file"), F.coalesce("qseqid", F.lit("")).alias("query"), parse.pipe_field_or_all("sseqid", 2).alias("subject")).where("subject is not null")


def s18_families(spark: SparkSession, base: str) -> DataFrame:
    """Family files, one per cluster, of (representative, member), under keys made unique by the cluster's id."""
    at = Scratch(spark).at("families")
    genes = parse.items("gene_list")
    rows = table(spark, base, "conserved_cluster").select("conserved_id", F.get(genes, F.lit(0)).alias("first"), F.explode(genes).alias("gene"))
    sinks.by_file(rows.select("conserved_id", text("first", "gene").alias("value")), at, "conserved_id")
    prefixed = lambda c: F.concat_ws("|", "conserved_id", c)
    return files.delimited(spark, at, "family_pairs").select(prefixed("member").alias("gene_id"), prefixed("representative").alias("cluster_representative"))


def s19_annotations(spark: SparkSession, base: str) -> DataFrame:
    """Annotation files with a preamble, whose columns stand in another order in every other file, read under their names."""
    at = Scratch(spark).at("annotations")
    df = table(spark, base, "homology_summary").where("conserved_id is not null and cluster_gene is not null and human_gene is not null").select("conserved_id", "cluster_gene", "human_gene").distinct()
    even = F.length("conserved_id") % 2 == 0
    one = lambda *parts: text(*parts)
    lines = df.select("conserved_id", F.lit(2).alias("k"), F.when(even, one("cluster_gene", "human_gene", F.length("human_gene"))).otherwise(one("cluster_gene", F.length("human_gene"), "human_gene")).alias("value"))
    ids = df.select("conserved_id").distinct()
    head = ids.select("conserved_id", F.lit(1).alias("k"), F.when(even, F.lit("#query\tPreferred_name\tsize")).otherwise(F.lit("#query\tsize\tPreferred_name")).alias("value"))
    top = ids.select("conserved_id", F.lit(0).alias("k"), F.lit("## tool\t# of queries").alias("value"))
    sinks.whole_files(lines.unionByName(head).unionByName(top), at, "conserved_id", [F.asc("k")])
    return files.annotations(spark, at).select("query", "Preferred_name", F.col("size").cast("int").alias("size"))


def s21_matrix(spark: SparkSession, base: str) -> DataFrame:
    """Matrix files, one per tissue, each with its own samples."""
    from .statistics import matrix

    at = Scratch(spark).at("matrix")
    cells = F.array_sort(F.collect_list(F.struct("sample", "value")))
    rows = matrix(spark, base).groupBy("tissue", "gene").agg(cells.alias("x"))
    lines = rows.select("tissue", F.lit(3).alias("k"), text(F.md5("gene"), "gene", F.array_join(F.transform("x", lambda c: c["value"].cast("string")), "\t")).alias("value"))
    names = rows.groupBy("tissue").agg(F.min(F.transform("x", lambda c: c["sample"])).alias("s"), F.count(F.lit(1)).alias("n"))
    head = names.select("tissue", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.lit("#1.2").alias("value")), F.struct(F.lit(1).alias("k"), text("n", F.size("s")).alias("value")), F.struct(F.lit(2).alias("k"), text(F.lit("Name"), F.lit("Description"), F.array_join("s", "\t")).alias("value")))).alias("h")).select("tissue", "h.*")
    placed = lines.unionByName(head).withColumn("file", F.regexp_replace("tissue", r"\W", "_"))
    sinks.whole_files(placed, at, "file", [F.asc("k")])
    return files.expression_matrix(spark, at)


def s22_samples(spark: SparkSession, base: str) -> DataFrame:
    """Samples and tissues without the index column and without repeats; donors are the sample's first three parts."""
    at = Scratch(spark).at("samples")
    orders = table(spark, base, "orders").select(F.monotonically_increasing_id().alias("row"), F.concat_ws("-", F.date_format("o_orderdate", "yyyy-MM-dd"), F.regexp_replace("o_orderpriority", "-", "_")).alias("sample"), F.col("o_orderpriority").alias("tissue"))
    sinks.delimited(orders, at)
    names = {"1-URGENT": "urgent", "4-NOT SPECIFIED": "any"}
    df = files.table_with_header(spark, at, ["sample", "tissue"], ",").drop("row").dropDuplicates()
    return df.select("sample", parse.sample_prefix("sample").alias("donor"), parse.aliased("tissue", names).alias("tissue"))


def j26_pathways(spark: SparkSession, base: str) -> DataFrame:
    """Links of pathways (genera) and genes met with the pathways' names; name lines may be short of fields, quotes are plain."""
    from .statistics import annotation

    scratch = Scratch(spark)
    key = lambda c: F.concat(F.lit("path:"), F.regexp_replace(c, " ", "_"))
    annotation(spark, base).select(text(key("term"), F.concat("gene", F.lit('"'))).alias("value")).write.text(scratch.at("links"))
    genera = table(spark, base, "taxonomy").where("genus is not null").groupBy("genus").agg(F.min("family").alias("family"))
    genera.select(F.concat_ws("\t", key("genus"), F.concat(F.lit('"'), "family")).alias("value")).write.text(scratch.at("names"))
    links, names = (files.delimited(spark, scratch.at(x), f"pathway_{x}") for x in ("links", "names"))
    return links.join(names, "pathway_id").groupBy("pathway_id", "pathway_name").agg(F.count_distinct("gene_id").alias("n_genes"), F.min("gene_id").alias("first_gene"))


def s28_seeds(spark: SparkSession, base: str) -> DataFrame:
    """A folder of seed-ortholog files: two of their columns, without comments."""
    at = Scratch(spark).at("seeds")
    rows = table(spark, base, "raw_record").where("file_kind = 'seed_orthologs' and raw_line is not null and not contains(raw_line, '\n') and instr(raw_line, '\t') > 1")
    rows.select(F.regexp_replace("file_name", r"\W", "_").alias("file"), F.col("raw_line").alias("value")).write.partitionBy("file").text(at)
    return files.delimited(spark, at, "seed_orthologs").select("query", F.coalesce("hit", F.lit("")).alias("hit"))


def k8_manifest(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "taxonomy").where("gcf is not null")
    return sinks.manifest(df, F.concat(F.lit("/all/"), "gcf", F.lit(".fna.gz")), F.concat(F.lit("/panel/"), parse.strip_version("gcf"), F.lit(".fna.gz")))


def k10_outputs(spark: SparkSession, base: str) -> DataFrame:
    """Rows and width of each output of a best-hit run, as read back."""
    scratch = Scratch(spark)
    keys = ["conserved_id", "cluster_gene"]
    found, _ = scratch.put(best(spark, base))
    names = sinks.hit_outputs(found, scratch.at("outputs"), keys, 8)
    out = None
    for name in names:
        df = files.table_with_header(spark, f"{scratch.at('outputs')}/{name}", keys, ",")
        gene = next(c for c in df.columns if c.startswith("subject_by_"))
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.max(F.length(gene)).alias("longest"), F.count_distinct(*keys).alias("n_keys")).withColumn("output", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def stream_loaded(spark: SparkSession, base: str) -> DataFrame:
    """Hit lines loaded as a stream of files, each once, in two runs: what came later is added, what was there isn't repeated."""
    scratch = Scratch(spark)
    rows = table(spark, base, "blast_hit").select("hit_id", "conserved_id", "bit_score")
    late = F.pmod(F.xxhash64("hit_id"), F.lit(3)) == 0
    for part in (~late, late):
        rows.where(part).write.mode("append").option("header", False).csv(scratch.at("in"))
        streaming.load_new(spark, scratch.at("in"), "hit_id long, conserved_id string, bit_score double", scratch.at("out"), scratch.at("progress"), lambda df: df.where("hit_id is not null"))
    return spark.read.parquet(scratch.at("out")).groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hit_id").alias("n_hits"))


def f24_lineages(spark: SparkSession, base: str) -> DataFrame:
    """Lineages joined to one cell and taken apart again: seven levels, and two ranks by name."""
    ranks = ["kingdom", "phylum", "tax_class", "tax_order", "family", "genus", "species"]
    known = [F.when(F.col(r).isNotNull(), F.lit(r)) for r in ranks]
    df = table(spark, base, "taxonomy").select("contig", F.concat_ws(";", *ranks).alias("names"), F.concat_ws(";", *known).alias("ranks"))
    return df.select("contig", *parse.lineage_levels("names", [f"level_{k}" for k in range(1, 8)]), parse.lineage_rank("names", "ranks", "family").alias("family"), parse.lineage_rank("names", "ranks", "genus").alias("genus"))


def f9_short_ids(spark: SparkSession, base: str) -> DataFrame:
    """Gene ids by their first two tokens and last two numbers, per contig."""
    df = members(spark, base).distinct().select(parse.short_gene_interval("gene").alias("i"), parse.first_tokens("gene", 2).alias("tokens"))
    return df.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count("i.contig").alias("n_contigs"), F.min("i.start").alias("least"), F.max("i.end").alias("most"))


def q24_targets(spark: SparkSession, base: str) -> DataFrame:
    """All targets of each query but the query itself."""
    met = occurrences(spark, base).select("query", "target").distinct()
    every = met.select(F.col("target").alias("other")).distinct()
    per = met.groupBy("query").agg(F.count_if(F.col("target") != F.col("query")).alias("n_met"))
    known = per.join(every, F.col("query") == F.col("other"), "left").select("query", "n_met", F.col("other").isNotNull().cast("int").alias("own"))
    total = every.where("other is not null").agg(F.count(F.lit(1)).alias("n_all"))
    return known.crossJoin(F.broadcast(total)).select("query", "n_met", (F.col("n_all") - F.col("own") - F.col("n_met")).alias("n_open"))  # one row


def o13_head(spark: SparkSession, base: str) -> DataFrame:
    """The first rows of the layout, three for each homologous name there is, in the order of file."""
    from .clusters import c12_layout

    layout, _ = Scratch(spark).put(c12_layout(spark, base))
    names = layout.select("homologous_id").distinct().count()
    return ranking.top_rows(layout, [F.asc("molecule"), F.asc("homologous_id"), F.asc("conserved_id")], 3 * names).select("molecule", "homologous_id", "conserved_id", "gene")


def o14_first_clusters(spark: SparkSession, base: str) -> DataFrame:
    """The genes of the first six clusters in the table's order of ids."""
    first = ranking.top_rows(table(spark, base, "conserved_cluster").select("conserved_id"), [F.asc("conserved_id")], 6)
    return members(spark, base).join(first, "conserved_id", "left_semi").groupBy("conserved_id").agg(F.count(F.lit(1)).alias("n_genes"), F.min("gene").alias("first_gene"))


def j18_zipped(spark: SparkSession, base: str) -> DataFrame:
    """Two lists side by side by position: the genes of seed lines and those of summary lines, each sorted."""
    rows = table(spark, base, "raw_record").where("raw_line is not null and not startswith(raw_line, '#')")
    seeds = rows.where("file_kind = 'seed_orthologs'").select(F.substring_index("raw_line", "\t", 1).alias("seed")).where("seed <> ''").distinct()
    eggs = rows.where("file_kind = 'eggnog_summary'").select(F.substring_index("raw_line", ",", 1).alias("summary")).where("summary <> ''").distinct()
    return integrate.zipped(seeds, [F.asc("seed")], eggs, [F.asc("summary")])


def _queries() -> dict:
    fs = (
        s1_headed, s14_quoted, s3_ids, s4_distances, s6_assemblies, s7_accessions, s8_gff, s9_intervals, q22_strands, s10_best_files, s31_listing, j7_sizes, a12_known_sizes, o8_largest_files, j6_first_files,
        s11_fasta, c7_recruited, s12_blocks, s17_hits, s18_families, s19_annotations, s21_matrix, s22_samples, j26_pathways, s28_seeds, k8_manifest, k10_outputs, stream_loaded, f24_lineages, f9_short_ids, q24_targets,
        o13_head, o14_first_clusters, j18_zipped,
    )
    return {f.__name__: f for f in fs}


def _sql() -> dict[str, str]:
    from .clusters import _AT, _I, _MEMBER, SQL as CLUSTERS
    from .hits import _BEST
    from .statistics import _ANN, _MATRIX

    own = "trim(split_part({0}, '|', -1), ' ')"
    na = "coalesce({0}, 'NA') {0}"
    size = "size as (select split_part(file_name, '/', 1) folder, split_part(file_name, '/', -1) name, sum(length(raw_line)) size from raw_record where file_name is not null group by 1, 2)"
    cds = f"{_MEMBER}, cds as (select gene, contig, least(p, q) s, greatest(p, q) e, case when p > q then '-' else '+' end strand from (select gene, {_I.format('gene')} from (select distinct gene from member)) where contig is not null and p is not null and q is not null)"
    letters = "translate(md5(gene) || md5(reverse(gene)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    known = f"known as (select name, max(size) size from size group by 1), fs as (select conserved_id, coalesce(size, 0) size from conserved_cluster left join known on name = conserved_id || '_blast.txt')"
    return {
        "s1_headed": f"select {na.format('contig')}, {na.format('species')}, coalesce(gcf, 'NA') by_place from taxonomy",
        "s14_quoted": f"select conserved_id, coalesce(replace(gene_list, ' | ', ',\"'), 'NA') genes, {na.format('species_cluster_map')} from conserved_cluster",
        "s3_ids": "select distinct conserved_id id from conserved_cluster where conserved_id is not null",
        "s4_distances": f"select {own.format('query_id')} g1, {own.format('subject_id')} g2, 1 - perc_identity / 100 dist from gene_match where query_id is not null and subject_id is not null and perc_identity is not null and not isnan(perc_identity)",
        "s6_assemblies": "select gcf, try_cast(taxid as int) taxid, try_cast(species_taxid || case when length(gcf) % 2 = 0 then 'x' else '' end as int) species_taxid, organism_name from taxonomy",
        "s7_accessions": r"select gcf accession, k kind, gcf || '.' || k || '.gz' name from taxonomy, (select unnest(['fna', 'gff']) k) where regexp_matches(gcf, '^GC[AF]_[0-9]+\.[0-9]+$') and not ends_with(contig, '.1')",
        "s8_gff": f"with {cds} select contig, 'CDS' feature, s start_pos, e end_pos, strand, gene id, 'L#' || s locus_tag from cds",
        "s9_intervals": f"with {cds} select contig, s - 1 as begin, e end_pos, gene name, strand from cds",
        "q22_strands": f"with {cds}, r as (select *, case when strand = '-' then row_number() over (partition by contig, strand order by s, e, gene) end k from cds) select contig, s start_pos, e end_pos, case when k = 1 or strand = '-' and s = 1 then '+' else strand end strand, gene id from r",
        "s10_best_files": "with f as (select distinct file_name, split_part(file_name, '/', 1) folder, case when ends_with(file_name, 'eggnog_homology_summary.csv') then 0 when ends_with(file_name, '.emapper.seed_orthologs') then 1 when ends_with(file_name, '_blast.txt') then 2 end r from raw_record where file_name is not null) select folder, '/data/' || first(file_name order by r, file_name) path from f where r is not null group by 1",
        "s31_listing": "select file_kind, sum(strlen(raw_line) + 1) n_bytes from raw_record where raw_line is not null and file_kind is not null group by 1",
        "j7_sizes": f"with {size}, {known} select * from fs",
        "a12_known_sizes": f"with {size}, {known} select count(*) n, min(size) least, max(size) most, round(avg(size), 6) mean from fs where size > 0",
        "o8_largest_files": f"with {size} select folder, first(name order by size desc, name) name, max(size) size from size group by 1",
        "j6_first_files": f"with {size}, f as (select distinct c.conserved_id, name from conserved_cluster c join size on starts_with(name, c.conserved_id) and not regexp_matches(substr(name, length(c.conserved_id) + 1, 1), '[0-9]')) select conserved_id, min(name) name, count(name) n_files from conserved_cluster left join f using (conserved_id) group by 1",
        "s11_fasta": f"with {_MEMBER}, g as (select distinct gene, {letters} s from member) select gene || ' 5''->3'' [x>y]' header, s sequence, translate(reverse(s), 'ACGT', 'TGCA') other_strand from g",
        "c7_recruited": f"with {cds}, hi as (select distinct conserved_id, gene from member where conserved_id in (select conserved_id from conserved_cluster where species_count >= 5)), w as (select conserved_id, gene, {_I.format('gene')} from hi), d as (select conserved_id, w.gene, {letters.replace('gene', 'cds.gene')} q from w join cds on cds.contig = w.contig and cds.s = least(p, q) and cds.e = greatest(p, q)) select conserved_id, count(*) n, sum(length(q)) n_bases, min(gene) first_gene from d group by 1",
        "s12_blocks": f"with g as (select match_id, {own.format('query_id')} gene_a, {own.format('subject_id')} gene_b, evalue, bit_score from gene_match), i as (select *, nullif(regexp_extract(gene_a, '^(.*)_[^_]+_\\d+_\\d+$', 1), '') query, nullif(regexp_extract(gene_b, '^(.*)_[^_]+_\\d+_\\d+$', 1), '') target from g) select 'from_' || query file, target || ':#' || min(match_id) over w as block, query, target, min(evalue) over w cluster_p, count(*) over w gene_count, gene_a, gene_b from i where query is not null and target is not null window w as (partition by query, target)",
        "s17_hits": r"""with f as (select regexp_replace(split_part(file_name, '/', -1), '\W', '_', 'g') file, string_split(raw_line, chr(9)) f from raw_record where file_kind = 'blast' and not contains(raw_line, chr(10)) and not starts_with(raw_line, '#') and trim(raw_line, ' ' || chr(9)) <> '')
            select file, f[1] query, case when len(string_split(f[2], '|')) >= 2 then string_split(f[2], '|')[-2] else f[2] end subject from f where try_cast(f[12] as double) is not null and f[2] <> ''""",
        "s18_families": "with m as (select conserved_id, list_filter(list_transform(string_split(gene_list, ' | '), lambda x: trim(x, ' ')), lambda x: x <> '') l from conserved_cluster) select conserved_id || '|' || unnest(l) gene_id, conserved_id || '|' || l[1] cluster_representative from m",
        "s19_annotations": "select cluster_gene query, human_gene Preferred_name, length(human_gene) size from (select distinct conserved_id, cluster_gene, human_gene from homology_summary where conserved_id is not null and cluster_gene is not null and human_gene is not null)",
        "s21_matrix": f"with {_MATRIX} select md5(gene) gene_id, gene symbol, sample, value from long",
        "s22_samples": "select distinct strftime(o_orderdate, '%Y-%m-%d') || '-' || replace(o_orderpriority, '-', '_') sample, strftime(o_orderdate, '%Y-%m-%d') donor, case o_orderpriority when '1-URGENT' then 'urgent' when '4-NOT SPECIFIED' then 'any' else o_orderpriority end tissue from orders",
        "j26_pathways": f"with ann as {_ANN}, nm as (select genus, min(family) family from taxonomy where genus is not null group by 1) select 'path:' || replace(term, ' ', '_') pathway_id, '\"' || family pathway_name, count(distinct gene) n_genes, min(gene || '\"') first_gene from ann join nm on genus = term group by 1, 2",
        "s28_seeds": "with f as (select string_split(raw_line, chr(9)) f from raw_record where file_kind = 'seed_orthologs' and not contains(raw_line, chr(10)) and not starts_with(raw_line, '#') and instr(raw_line, chr(9)) > 1 and trim(raw_line, ' ' || chr(9)) <> '') select f[1] query, f[2] hit from f",
        "k8_manifest": r"select distinct '/all/' || gcf || '.fna.gz' source, '/panel/' || regexp_replace(gcf, '\.[0-9]+$', '') || '.fna.gz' target from taxonomy where gcf is not null",
        "k10_outputs": _BEST + """, o as (select 'summary' output, 19 + 1 n_columns, subject_by_length s from best union all select 'simple', 4, subject_by_comprehensive from best union all select 'clean', 20, case when length(subject_by_length) > 8 then left(subject_by_length, 5) || '...' else subject_by_length end from best"""
        + "".join(f" union all select 'by_{x}', 6, subject_by_{x} from best" for x in ("length", "evalue", "identity", "comprehensive")) + ") select output, n_columns, count(*) n_rows, count(*) n_keys, max(length(s)) longest from o group by 1, 2",
        "stream_loaded": "select conserved_id, count(*) n, count(distinct hit_id) n_hits from blast_hit where hit_id is not null group by 1",
        "f24_lineages": "with l as (select contig, string_split(concat_ws(';', kingdom, phylum, tax_class, tax_order, family, genus, species), ';') l, family, genus from taxonomy) select contig, " + ", ".join(f"coalesce(l[{k}], '') level_{k}" for k in range(1, 8)) + ", family, genus from l",
        "f9_short_ids": f"with {_MEMBER}, d as (select distinct conserved_id, gene from member), t as (select string_split(gene, '_') f from d), u as (select array_to_string(f[1:2], '_') tokens, case when len(f) >= 4 then array_to_string(f[1:2], '_') end c, case when len(f) >= 4 then try_cast(f[-2] as bigint) end a, case when len(f) >= 4 then try_cast(f[-1] as bigint) end b from t) select tokens, count(*) n, count(c) n_contigs, min(least(a, b)) as least, max(greatest(a, b)) most from u group by 1",
        "q24_targets": f"with {_AT}, met as (select distinct query, target from occ), ev as (select distinct target o from met where target is not null) select query, count(*) filter (target <> query) n_met, (select count(*) from ev where o <> query) - count(*) filter (target <> query) n_open from met group by 1",
        "o13_head": "with lay as (" + CLUSTERS["c12_layout"] + ") select molecule, homologous_id, conserved_id, gene from lay order by molecule, homologous_id, conserved_id limit (select 3 * count(distinct homologous_id) from lay)",
        "o14_first_clusters": f"with {_MEMBER}, f as (select conserved_id from conserved_cluster order by conserved_id limit 6) select conserved_id, count(*) n_genes, min(gene) first_gene from member where conserved_id in (select conserved_id from f) group by 1",
        "j18_zipped": "with r as (select * from raw_record where raw_line is not null and not starts_with(raw_line, '#')), s as (select seed, row_number() over (order by seed) k from (select distinct split_part(raw_line, chr(9), 1) seed from r where file_kind = 'seed_orthologs') where seed <> ''), e as (select summary, row_number() over (order by summary) k from (select distinct split_part(raw_line, ',', 1) summary from r where file_kind = 'eggnog_summary') where summary <> '') select k as at, seed, summary from s full join e using (k)",
    }


QUERIES = _queries()
SQL = _sql()
