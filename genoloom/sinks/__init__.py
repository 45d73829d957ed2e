"""Writers of tables, sequences and blocks; Spark's committer makes each write whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def delimited(df: DataFrame, path: str, sep: str = ",", missing: str = "NA") -> None:
    """Columns as text with a header; nulls are written as ``missing`` only here."""
    df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias(c) for c in df.columns)).write.option("sep", sep).option("header", True).csv(path)


def fasta(df: DataFrame, path: str, header: str, sequence: str, partition: str | None = None) -> None:
    """A sequence file per value of ``partition``; values without rows give no file."""
    text = F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col(sequence)).alias("value")
    out = df.where(F.col(sequence).isNotNull()).select(text, *([partition] if partition else []))
    by_file(out, path, partition) if partition else out.write.text(path)


def parts(df: DataFrame) -> int:
    """As many tasks as shuffles have. Named to a repartitioning, so that small outputs of very many files aren't gathered in one task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_file(df: DataFrame, path: str, file: str, value: str = "value") -> None:
    """Text lines in any order, a folder per ``file``; a large file is several parts, a small one mostly a single one."""
    placed = df.repartitionByRange(parts(df), F.col(file), F.xxhash64(value))
    placed.select(F.col(value).alias("value"), file).write.partitionBy(file).text(path)


def lines(df: DataFrame, path: str, file: str, order: list[Column], value: str = "value") -> None:
    """Text lines in order, a folder per ``file``; a large file's lines are several parts whose names follow the order."""
    placed = df.repartitionByRange(parts(df), F.col(file), *order).sortWithinPartitions(F.col(file), *order)
    placed.select(F.col(value).alias("value"), file).write.partitionBy(file).text(path)


def whole_files(df: DataFrame, path: str, file: str, order: list[Column], value: str = "value") -> None:
    """Text lines in order, one part per ``file``, for layouts whose first lines hold for the whole file."""
    df.repartition(parts(df), file).sortWithinPartitions(F.col(file), *order).select(F.col(value).alias("value"), file).write.partitionBy(file).text(path)


def commented_list(df: DataFrame, path: str, item: str, comments: list[str]) -> None:
    """The distinct items in order, below comment lines that begin with ``#``."""
    head = df.sparkSession.createDataFrame([(0, k, f"# {c}") for k, c in enumerate(comments)], "part int, at int, value string")
    rows = df.select(F.lit(1).alias("part"), F.lit(0).alias("at"), F.col(item).cast("string").alias("value")).where("value is not null").distinct()
    head.unionByName(rows).orderBy("part", "at", "value").select("value").write.text(path)


def blocks(df: DataFrame, path: str) -> None:
    """Synteny blocks in their file layout, a folder per ``file`` as the input had them, best first: by both p-values, then by more genes."""
    line = F.concat_ws("\t", F.concat(F.lit(">"), "gene_a"), "gene_b")
    keys = ["file", "block", "query", "target", "cluster_p", "multihit_p", "gene_count"]
    rows = df.where("gene_a is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", line.alias("line")))).alias("lines"))  # a block's genes
    head = F.concat_ws("\t", F.concat(F.lit("#"), "block"), "query", "target", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys[4:]))
    order = [F.asc_nulls_last("cluster_p"), F.asc_nulls_last("multihit_p"), F.desc_nulls_last("gene_count"), F.asc("block")]
    text = F.concat_ws("\n", head, F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit("")).alias("value")
    lines(rows.withColumn("value", text), path, "file", order)


def hit_outputs(best: DataFrame, path: str, keys: list[str], most: int = 100) -> list[str]:
    """The outputs of a best-hit run as folders of CSV: summary, simple, one detailed per criterion, and clean, with texts cut to ``most``.

    best: the columns of ``ranking.best_hits``, as a written table. Returns the names of the outputs.
    """
    from ..functions import parse

    criteria = [c.removeprefix("subject_by_") for c in best.columns if c.startswith("subject_by_")]
    outputs = {"summary": best, "simple": best.select(*keys, "subject_by_comprehensive", "comprehensive_score")}
    outputs |= {f"by_{x}": best.select(*keys, *(c for c in best.columns if c.endswith(f"_by_{x}"))) for x in criteria}
    texts = {c for c, t in best.dtypes if t == "string"} - set(keys)
    outputs["clean"] = best.select(*(parse.truncated(c, most).alias(c) if c in texts else F.col(c) for c in best.columns))
    for name, df in outputs.items():
        delimited(df, f"{path}/{name}")
    return list(outputs)


def manifest(df: DataFrame, source: Column, target: Column) -> DataFrame:
    """(source, target) of files to copy or link: a table to act on, nothing is moved here."""
    return df.select(source.alias("source"), target.alias("target")).distinct()
