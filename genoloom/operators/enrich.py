"""Terms and genes: over-representation, coverage, shared-term networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import stats
from .ranking import first_per_group


def over_representation(annotation: DataFrame, genes: DataFrame, min_size: int = 10, max_size: int = 500) -> DataFrame:
    """(term, n_term, n_hit, n_drawn, n_all, p, adjusted) of each term with a hit.

    annotation: (term, gene); genes: (gene). The universe is the annotated genes; sets outside the sizes
    given are left out. p is the hypergeometric tail, corrected over the tested terms.
    """
    annotation = annotation.select("term", "gene").where("term is not null and gene is not null").distinct()
    drawn = annotation.select("gene").distinct().join(genes.select("gene").distinct(), "gene", "left_semi").withColumn("hit", F.lit(1))
    sizes = annotation.join(drawn, "gene", "left").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"), F.count("hit").alias("n_hit"))
    n = annotation.select("gene").distinct().count()
    k = drawn.count()
    tested = sizes.where(F.col("n_term").between(min_size, max_size) & (F.col("n_hit") > 0)).withColumn("n_drawn", F.lit(k)).withColumn("n_all", F.lit(n))
    tested = tested.withColumn("p", stats.hypergeometric_tail(F.col("n_hit"), F.col("n_term"), F.col("n_drawn"), F.col("n_all")))
    return adjusted(tested, [], "p")


def adjusted(df: DataFrame, keys: list[str], p: str) -> DataFrame:
    """``df`` with the Benjamini-Hochberg value of column p within keys; null where p is."""
    df = df.withColumn("__one", F.lit(1))
    keyed = [*keys, "__one"]
    table = stats.benjamini_hochberg(df, keyed, p)
    return df.join(table.withColumnRenamed("v", p), [*keyed, p], "left").drop("__one")


def strict_or_all(df: DataFrame, strict) -> DataFrame:
    """The rows that pass ``strict``, or all of them if none does."""
    marked = df.withColumn("__strict", F.coalesce(strict, F.lit(False)))
    any_strict = marked.agg(F.max("__strict").alias("__any"))
    return marked.crossJoin(F.broadcast(any_strict)).where("__strict or not __any").drop("__strict", "__any")  # the right side is one row


def coverage(rows: DataFrame, group: str, term: str, item: str) -> DataFrame:
    """(group, term, n, group_size, term_size, of_group, of_term): distinct items of a group under a term, and both shares."""
    cells = rows.select(group, term, item).where(f"{group} is not null and {term} is not null and {item} is not null").distinct()
    both = cells.groupBy(group, term).agg(F.count(F.lit(1)).alias("n"))
    size = lambda key, name: cells.select(key, item).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))
    out = both.join(size(group, "group_size"), group).join(size(term, "term_size"), term)
    return out.withColumn("of_group", F.col("n") / F.col("group_size")).withColumn("of_term", F.col("n") / F.col("term_size"))


def best_term(covered: DataFrame, group: str, term: str, by: str) -> DataFrame:
    return first_per_group(covered, [group], [F.desc(by), F.asc(term)])


def shared_terms(annotation: DataFrame, genes: DataFrame, at_least: int = 2) -> DataFrame:
    """(a, b, shared): pairs of the given genes (under terms of a bounded number of them) with at least so many terms in common."""
    own = annotation.select("term", "gene").distinct().join(genes.select("gene").distinct(), "gene", "left_semi")
    pairs = own.alias("x").join(own.alias("y"), "term").where("x.gene < y.gene")
    return pairs.groupBy(F.col("x.gene").alias("a"), F.col("y.gene").alias("b")).agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= at_least)


def closure(links: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, up): each of the ``terms`` (a column ``term``) with itself and all terms above it by links (child, parent), a level per round."""
    from ..session import Scratch

    scratch = Scratch(terms.sparkSession)
    front, _ = scratch.put(terms.select("term", F.col("term").alias("up")).distinct())
    out = front
    while not front.isEmpty():
        step = front.join(links.withColumnRenamed("child", "up"), "up").select("term", F.col("parent").alias("up")).distinct()
        front, _ = scratch.put(step.join(out, ["term", "up"], "left_anti"))
        out = out.unionByName(front)
    return out


def slim(annotation: DataFrame, links: DataFrame, level: DataFrame) -> DataFrame:
    """(term, n_genes): distinct genes under each term of the ``level`` (a column ``term``), whatever lower term they are annotated with."""
    above = closure(links, annotation.select("term").distinct()).join(level.select(F.col("term").alias("up")), "up", "left_semi")
    rows = annotation.join(above, "term").select(F.col("up").alias("term"), "gene").distinct()
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n_genes"))
