"""Readers of the pipeline's files. All stay lazy; Spark splits the files and reads compressed ones by extension.

Block, sequence and annotation files are read as text records split at the marks that begin a record at the
start of a line, so that no window over a whole file is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions import parse
from .schemas import schema


def delimited(spark: SparkSession, path: str | list[str], kind: str, sep: str = "\t", header: bool = False, comment: str | None = "#") -> DataFrame:
    """A delimited file of a known layout; quotes are plain characters in tab-separated files."""
    reader = spark.read.schema(schema(kind)).option("sep", sep).option("header", header).option("mode", "PERMISSIVE").option("maxCharsPerColumn", -1)
    if comment:
        reader = reader.option("comment", comment)
    if sep == "\t":
        reader = reader.option("quote", "")
    return reader.csv(path)


def table_with_header(spark: SparkSession, path: str, required: list[str], sep: str = "\t", comment: str | None = None) -> DataFrame:
    """A delimited file with a header, all columns as strings; a missing required column is an error."""
    reader = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).option("maxCharsPerColumn", -1)
    df = (reader.option("comment", comment) if comment else reader).csv(path)
    first = df.columns[0].lstrip("\ufeff")
    df = df.withColumnRenamed(df.columns[0], first)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {df.columns}")
    return df


def column_or_position(df: DataFrame, name: str, position: int) -> DataFrame:
    """One column by name, or by position where there is no such name."""
    return df.select(F.col(f"`{name if name in df.columns else df.columns[position]}`").alias(name))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id): trimmed lines without comments and blank lines."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> '' and not startswith(id, '#')")


def distances(spark: SparkSession, path: str) -> DataFrame:
    """(g1, g2, dist) of a headerless distance table, paths cut to file names."""
    return delimited(spark, path, "distance", comment=None).select(parse.basename("g1_path").alias("g1"), parse.basename("g2_path").alias("g2"), "dist")


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Alignment hits with the name of their file; lines of fewer than twelve fields are left out."""
    return delimited(spark, path, "blast_hit").where("bitscore is not null").withColumn("file", parse.basename(F.input_file_name()))


def best_file_per_folder(spark: SparkSession, paths: DataFrame, suffixes: list[str]) -> DataFrame:
    """Of the column ``path`` the file of each folder with the earliest of the suffixes."""
    rank = F.coalesce(*(F.when(F.col("path").endswith(s), F.lit(k)) for k, s in enumerate(suffixes)))
    folder = F.substring_index(F.regexp_replace("path", "/[^/]*$", ""), "/", -1)
    return paths.withColumn("rank", rank).where("rank is not null").withColumn("folder", folder).groupBy("folder").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def gff(spark: SparkSession, path: str, feature: str | None = None) -> DataFrame:
    """(contig, source, feature, start_pos, end_pos, score, strand, phase, attributes, id, locus_tag) of annotation lines."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where("not startswith(value, '#')").select(parts.alias("f")).where("size(f) >= 9")
    names = ["contig", "source", "feature", "start_pos", "end_pos", "score", "strand", "phase", "attributes"]
    df = lines.select(*(F.get("f", F.lit(k)).alias(n) for k, n in enumerate(names))).withColumns({c: F.col(c).try_cast("long") for c in ("start_pos", "end_pos")})
    if feature:
        df = df.where(F.col("feature") == feature)
    attribute = lambda k: F.nullif(F.regexp_extract("attributes", rf"(?:^|;)\s*{k}=([^;]*)", 1), F.lit(""))
    return df.withColumns({"id": attribute("ID"), "locus_tag": attribute("locus_tag")})


def cds_intervals(spark: SparkSession, path: str) -> DataFrame:
    """(contig, begin, end_pos, name, strand) of coding features, zero-based; nameless ones are named by their place."""
    df = gff(spark, path, "CDS")
    name = F.coalesce("id", F.concat_ws("_", "contig", "start_pos", "end_pos"))
    return df.select("contig", (F.col("start_pos") - 1).alias("begin"), "end_pos", name.alias("name"), "strand")


#: The line that begins a region of an annotation file.
REGION = "##sequence-region"


def corrected_strands(spark: SparkSession, path: str) -> DataFrame:
    """(file, region, at, value): annotation lines with the first minus coding line behind each region mark turned to plus.

    A minus coding line that starts at 1 is turned as well. Files are cut at the region marks, so each
    region is one record; ``at`` is the line within it. Lines before a file's first mark are a region of
    their own. ``sinks.lines`` writes the result back file by file.
    """
    read = spark.read.option("lineSep", f"\n{REGION}").text(path)
    records = read.select(parse.basename(F.input_file_name()).alias("file"), "value").where("value <> ''").withColumn("region", F.monotonically_increasing_id())
    # Behind a mark that was a separator the record goes on with a blank; a file's first record has all of its text.
    whole = F.when(F.col("value").rlike("^[ \t]"), F.concat(F.lit(REGION), "value")).otherwise(F.col("value"))
    lines = records.select("file", "region", F.posexplode(F.split(whole, "\n")).alias("at", "value")).where("value <> ''")
    f = F.split("value", "\t")
    minus = (F.get(f, F.lit(2)) == "CDS") & (F.get(f, F.lit(6)) == "-")
    order = F.sum(F.coalesce(minus, F.lit(False)).cast("int")).over(W.partitionBy("region").orderBy("at"))
    turn = minus & ((order == 1) | (F.get(f, F.lit(3)) == "1"))
    turned = F.concat_ws("\t", F.slice(f, 1, 6), F.lit("+"), F.slice(f, 8, 100))
    return lines.withColumn("value", F.when(turn, turned).otherwise(F.col("value")))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence[, columns of partition folders]), lines of a sequence joined; a record begins with ``>`` at the start of a line."""
    records = spark.read.option("lineSep", "\n>").text(path).withColumn("value", F.regexp_replace("value", "^>", "")).where("trim(value) <> ''")
    at = F.instr("value", "\n")
    header = F.when(at > 0, F.expr("substring(value, 1, instr(value, '\n') - 1)")).otherwise(F.col("value"))
    sequence = F.when(at > 0, F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "")).otherwise("")
    return records.select(F.trim(F.regexp_replace(header, "\r", "")).alias("header"), sequence.alias("sequence"), *(c for c in records.columns if c != "value"))


def cds_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start_pos, end_pos, strand, sequence) of coding sequences named by their place; starts become one-based."""
    df = fasta(spark, path).select(parse.cds_header("header").alias("h"), "sequence")
    return df.select("h.contig", (F.col("h.start") + 1).alias("start_pos"), F.col("h.end").alias("end_pos"), "h.strand", "sequence")


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, query, target, cluster_p, multihit_p, gene_count, at, gene_a, gene_b): member lines of synteny blocks."""
    read = spark.read.option("lineSep", "\n#").text(path)  # a folder ``file=...`` names the file itself
    records = (read if "file" in read.columns else read.withColumn("file", parse.basename(F.input_file_name()))).withColumn("value", F.regexp_replace("value", "^#", "")).where("trim(value) <> ''")
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    head = F.split(F.get(lines, F.lit(0)), "\t")
    rows = records.select("file", head.alias("h"), F.posexplode_outer(F.filter(lines, lambda x: x.startswith(">"))).alias("at", "line"))
    pair = F.split(F.regexp_replace("line", "^>", ""), "\t")
    number = lambda k, t: F.get("h", F.lit(k)).try_cast(t)
    return rows.select(
        "file", F.get("h", F.lit(0)).alias("block"), F.get("h", F.lit(1)).alias("query"), F.get("h", F.lit(2)).alias("target"), number(3, "double").alias("cluster_p"), number(4, "double").alias("multihit_p"),
        number(5, "int").alias("gene_count"), "at", F.get(pair, F.lit(0)).alias("gene_a"), F.get(pair, F.lit(1)).alias("gene_b"),
    )


def accessions(spark: SparkSession, path: str, pattern: str = r"^GC[AF]_[0-9]+\.[0-9]+$") -> DataFrame:
    """(accession, kind, name): a row for the sequences and one for the annotation of each line that begins with an accession."""
    first = F.split("value", r"\s+")[0]
    rows = spark.read.text(path).select(first.alias("accession")).where(F.col("accession").rlike(pattern))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.concat("accession", F.lit(f".{k}.gz")).alias("name")) for k in ("fna", "gff")))
    return rows.select("accession", F.explode(kinds).alias("x")).select("accession", "x.*")


def annotations(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """Functional annotation lines below a ``##`` preamble; each file's header line begins with ``#query``.

    Files may have their columns in another order, or others: each is read by its own header, and the
    result has all columns, null where a file lacks one. ``with_file`` adds the file's name as ``file``.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), "value").where("not startswith(value, '##')")
    headers = lines.where("startswith(value, '#query')").select("path", F.split(F.expr("substring(value, 2)"), "\t").alias("names"))
    layouts = sorted(tuple(r.names) for r in headers.select("names").distinct().collect())  # a row per version of the tool
    rows = lines.where("not startswith(value, '#')").select("path", F.split("value", "\t").alias("f"))
    rows = rows.withColumn("names", F.array(*(F.lit(n) for n in layouts[0]))) if len(layouts) == 1 else rows.join(headers, "path")
    every = list(dict.fromkeys(n for names in layouts for n in names))
    place = lambda n: F.array_position("names", F.lit(n))
    columns = [F.when(place(n) > 0, F.get("f", (place(n) - 1).cast("int"))).alias(n) for n in every]
    return rows.select(*([parse.basename("path").alias("file")] if with_file else []), *columns)


def expression_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, symbol, sample, value) of matrix files with two lines before the header, each file by its own header; lines of another width are left out."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), "value").where("not startswith(value, '#') and instr(value, '\t') > 0")
    headers = lines.where("startswith(value, 'Name\t')").select("path", F.split("value", "\t").alias("names"))
    rows = lines.where("not startswith(value, 'Name\t')").select("path", F.split("value", "\t").alias("f")).join(headers, "path").where("size(f) = size(names)")
    tail = lambda c: F.slice(c, F.lit(3), F.greatest(F.size("names") - 2, F.lit(1)))
    cells = rows.select(F.get("f", F.lit(0)).alias("gene_id"), F.get("f", F.lit(1)).alias("symbol"), F.explode(F.arrays_zip(tail("names").alias("s"), tail("f").alias("v"))).alias("x"))
    return cells.select("gene_id", "symbol", F.col("x.s").alias("sample"), F.col("x.v").try_cast("double").alias("value"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files below a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")


def json_records(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of a stored JSON response (an array of objects) by an explicit schema."""
    return spark.read.schema(ddl).option("multiLine", True).json(path)
