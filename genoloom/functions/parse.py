"""Parsers of identities packed into strings, and other scalar helpers; all are expressions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_version(c: str | Column) -> Column:
    """``GCF_1.2`` -> ``GCF_1``: a numeric version at the end is taken off."""
    return F.regexp_replace(col(c), r"\.[0-9]+$", "")


def version(c: str | Column) -> Column:
    """The numeric version of an accession, 0 without one."""
    return F.coalesce(F.try_element_at(F.split(F.regexp_extract(col(c), r"\.([0-9]+)$", 1), ","), F.lit(1)).try_cast("int"), F.lit(0))


def basename(c: str | Column) -> Column:
    return F.substring_index(col(c), "/", -1)


def strip_suffix(c: str | Column, suffixes: list[str]) -> Column:
    """Takes one of the suffixes off the end."""
    return F.regexp_replace(col(c), "(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$", "")


def pipe_field(c: str | Column, k: int) -> Column:
    """Field k (from 0) of a pipe-delimited identity, null if there are too few."""
    return F.get(F.split(col(c), r"\|"), F.lit(k))


def pipe_field_or_all(c: str | Column, least: int) -> Column:
    """The field before the last where there are at least ``least`` fields, else the whole value."""
    parts = F.split(col(c), r"\|")
    return F.when(F.size(parts) >= least, F.element_at(parts, -2)).otherwise(col(c))


def gene_contig(c: str | Column) -> Column:
    """Contig of a gene id ``<contig>_<ordinal>_<pos>_<pos>``, null if it isn't one."""
    return F.nullif(F.regexp_extract(col(c), r"^(.*)_[^_]+_\d+_\d+$", 1), F.lit(""))


def gene_position(c: str | Column, k: int) -> Column:
    """First (0) or second (1) position of a gene id."""
    return F.nullif(F.regexp_extract(col(c), r"^.*_[^_]+_(\d+)_(\d+)$", k + 1), F.lit("")).try_cast("long")


def first_tokens(c: str | Column, n: int = 2) -> Column:
    """The first n tokens of an id cut at ``_``."""
    return F.substring_index(col(c), "_", n)


def short_gene_interval(c: str | Column) -> Column:
    """struct(contig, start, end) of a gene id whose contig is its first two tokens; null without four tokens or numbers at the end."""
    parts = F.split(col(c), "_")
    ok = F.size(parts) >= 4
    a, b = (F.when(ok, F.element_at(parts, k)).try_cast("long") for k in (-2, -1))
    return F.struct(F.when(ok, first_tokens(c)).alias("contig"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"))


def gene_interval(c: str | Column) -> Column:
    """struct(contig, start, end, strand); on the minus strand the id has the larger position first."""
    a, b = gene_position(c, 0), gene_position(c, 1)
    return F.struct(gene_contig(c).alias("contig"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), F.when(a > b, "-").when(a <= b, "+").alias("strand"))


def cds_header(c: str | Column) -> Column:
    """struct(contig, start, end, strand) of ``>cds-X::contig:start-end(strand)``; strand ``+`` if it isn't given."""
    pattern = r"^>?(?:.*::)?([^:]+):(\d+)-(\d+)(?:\(([+-])\))?"
    part = lambda k: F.nullif(F.regexp_extract(col(c), pattern, k), F.lit(""))
    return F.struct(part(1).alias("contig"), part(2).try_cast("long").alias("start"), part(3).try_cast("long").alias("end"), F.coalesce(part(4), F.lit("+")).alias("strand"))


def comparison(c: str | Column) -> Column:
    """struct(query, target, block) of ``<query>_with_<target>:#<n>``."""
    name = F.regexp_replace(col(c), r":#[^:#]*$", "")
    sides = F.split(name, "_with_", 2)
    return F.struct(F.get(sides, F.lit(0)).alias("query"), F.get(sides, F.lit(1)).alias("target"), F.nullif(F.regexp_extract(col(c), r":#([^:#]*)$", 1), F.lit("")).alias("block"))


def items(c: str | Column, sep: str = r" \| ") -> Column:
    """A delimited cell as an array without blanks around and empty items."""
    return F.filter(F.transform(F.split(col(c), sep), lambda x: F.trim(x)), lambda x: x != "")


def or_default(c: str | Column, default: str) -> Column:
    """Null and blank values replaced."""
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(default))


def first_filled(*columns: str | Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in columns))


def numbered(n: str | Column, prefix: str, digits: int) -> Column:
    """``Conserved_007`` of 7; wider numbers keep all digits."""
    return F.format_string(f"{prefix}%0{digits}d", col(n))


def truncated(c: str | Column, most: int) -> Column:
    """At most ``most`` characters, the last three of longer values being dots."""
    return F.when(F.length(col(c)) > most, F.concat(F.substring(col(c), 1, most - 3), F.lit("..."))).otherwise(col(c))


def stars(p: str | Column) -> Column:
    """Signs of significance."""
    return F.when(col(p) < 0.001, "***").when(col(p) < 0.01, "**").when(col(p) < 0.05, "*").when(col(p).isNotNull(), "ns")


def bucket(c: str | Column, edges: list[float]) -> Column:
    """``(a,b]`` of right-closed buckets between the edges, null outside."""
    out = None
    for a, b in zip(edges, edges[1:]):
        here, name = (col(c) > a) & (col(c) <= b), f"({a:g},{b:g}]"
        out = F.when(here, name) if out is None else out.when(here, name)
    return out


def lineage_rank(names: str | Column, ranks: str | Column, rank: str) -> Column:
    """The name whose parallel rank is ``rank`` (the last one, if repeated), null if there is none."""
    n, r = F.split(col(names), ";"), F.split(col(ranks), ";")
    hits = F.filter(F.arrays_zip(n.alias("n"), r.alias("r")), lambda x: x["r"] == rank)
    return F.try_element_at(hits, F.lit(-1))["n"]


def lineage_levels(c: str | Column, levels: list[str]) -> list[Column]:
    """A ``;``-joined lineage as one column per level, empty where it is short."""
    parts = F.split(col(c), ";")
    return [F.coalesce(F.get(parts, F.lit(k)), F.lit("")).alias(level) for k, level in enumerate(levels)]


def reverse_complement(c: str | Column) -> Column:
    return F.translate(F.reverse(col(c)), "ACGTacgt", "TGCAtgca")


def pair_key(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """Both ends of an undirected pair in canonical order."""
    return F.least(col(a), col(b)), F.greatest(col(a), col(b))


def sample_prefix(c: str | Column) -> Column:
    """The first three dash-separated tokens of a sample id."""
    return F.regexp_replace(col(c), r"^([^-]*-[^-]*-[^-]*)-.*$", "$1")


def aliased(c: str | Column, names: dict[str, str]) -> Column:
    """Values of a small alias table replaced, others kept."""
    out = col(c)
    for a, b in names.items():
        out = F.when(col(c) == a, b).otherwise(out)
    return out


def evidence_sum(c: Column, *others: Column) -> Column:
    """Sum of evidence, the first part being left out where it is null."""
    out = F.coalesce(c, F.lit(0))
    for x in others:
        out = out + x
    return out
