"""Integration of evidence from several sources: full outer joins with provenance, annotation, panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parse


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes last in the order given (a struct comparison, combined before the shuffle); null keys are left out."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    return kept.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def combine(sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of sources with unique keys; ``sources`` names those present, joined by ``+`` in the order given."""
    marked = [df.withColumn(f"__in_{name}", F.lit(name)) for name, df in sources.items()]
    out = reduce(lambda a, b: a.join(b, keys, "full"), marked)
    return out.withColumn("sources", F.concat_ws("+", *(f"__in_{n}" for n in sources))).drop(*(f"__in_{n}" for n in sources))


def provenance(nucleotide: Column, protein: Column, annotation: Column) -> Column:
    """Kind of evidence: ``Both``, ``BLAST only``, ``eggNOG only``, ``BLASTP only``."""
    return F.when(nucleotide & annotation, "Both").when(nucleotide, "BLAST only").when(annotation, "eggNOG only").when(protein, "BLASTP only")


def newest_versions(df: DataFrame, accession: str) -> DataFrame:
    """(base, accession): the highest numeric version of each accession."""
    c = F.col(accession)
    return df.where(c.isNotNull()).groupBy(parse.strip_version(c).alias("base")).agg(F.max_by(c, F.struct(parse.version(c), c)).alias("accession"))


def match_panel(panel: DataFrame, assemblies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) of two tables (base, accession), on the base."""
    matched = panel.join(assemblies.withColumnRenamed("accession", "found"), "base")
    return matched, panel.join(assemblies, "base", "left_anti")


def by_any_id(df: DataFrame, wanted: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Rows any of whose id columns is wanted, each once: one semi-join per column and a distinct by ``key``."""
    parts = [df.join(wanted.select(F.col(wanted.columns[0]).alias(c)), c, "left_semi").select(*df.columns) for c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts).dropDuplicates([key])


def zipped(left: DataFrame, left_order: list[Column], right: DataFrame, right_order: list[Column]) -> DataFrame:
    """(at, columns of both): rows of two tables side by side by their position (from 1) in each one's order; the longer one's rest has nulls."""
    from .ranking import dense_ids

    return dense_ids(left, left_order, "at").join(dense_ids(right, right_order, "at"), "at", "full")


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns wanted that are there, in the order wanted."""
    return df.select(*(F.col(f"`{c}`") for c in columns if c in df.columns))
