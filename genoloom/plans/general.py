"""Queries of the general large-scale operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import skew
from ..session import table
from ..sources import rejects

def gene() -> Column:
    """Human genes without blanks at the ends, in upper case."""
    return F.upper(F.trim("human_gene"))


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "homology_summary")
    return skew.frequent_values(df, {"conserved_id": F.col("conserved_id"), "human_gene": gene()}).select("field", "key_value")


def p1_clusters(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "homology_summary").select("conserved_id", gene().alias("gene"), "e_value")
    return skew.key_profile(df, "conserved_id", "gene", "e_value").withColumnsRenamed({"n_distinct": "n_genes", "median": "median_e_value"})


def p1_genes(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "homology_summary").select(gene().alias("gene"), "conserved_id")
    return skew.key_profile(df, "gene", "conserved_id").withColumnsRenamed({"gene": "human_gene", "n_distinct": "n_clusters"})


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return rejects.rejects(rejects.load_lines(table(spark, base, "raw_record")))


def p2_loaded(spark: SparkSession, base: str) -> DataFrame:
    return rejects.loaded(rejects.load_lines(table(spark, base, "raw_record")))


def p2_reasons(spark: SparkSession, base: str) -> DataFrame:
    parsed = rejects.load_lines(table(spark, base, "raw_record"))
    return parsed.groupBy("file_kind", "status", "reason", "bad_field").agg(F.count(F.lit(1)).alias("n_lines"))


_NUMBER = r"'^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)? *$'"
_JUDGED = rf"""
with line as (select record_id, file_kind, raw_line,
        case file_kind when 'eggnog_summary' then ',' else chr(9) end sep from raw_record
    where raw_line is not null and not starts_with(raw_line, '#') and not regexp_full_match(raw_line, '[ \t]*')
        and not (file_kind = 'eggnog_summary' and raw_line = 'Conserved ID,Cluster Gene,Human Gene,E-value,Score,Percent Identity')),
cut as (select *,
        file_kind <> 'eggnog_summary' or regexp_full_match(raw_line, '([^",]*|"([^"]|"")*")(,([^",]*|"([^"]|"")*"))*') whole,
        case when file_kind <> 'eggnog_summary' then string_split(raw_line, chr(9))
            else list_transform(regexp_extract_all(',' || raw_line, ',("(?:[^"]|"")*"|[^",]*)', 1),
                lambda f: case when f[1] = '"' then replace(f[2:-2], '""', '"') else f end) end f from line),
cell as (select *, case file_kind when 'blast' then f[11] when 'seed_orthologs' then f[3] else f[4] end e,
        case file_kind when 'blast' then f[3] when 'seed_orthologs' then f[9] else f[6] end p,
        case file_kind when 'seed_orthologs' then f[2] when 'eggnog_summary' then f[3] end h,
        case file_kind when 'blast' then f[1] when 'seed_orthologs' then f[1] else f[2] end q,
        case file_kind when 'eggnog_summary' then f[3] else f[2] end hit,
        case file_kind when 'blast' then f[12] when 'seed_orthologs' then f[4] else f[5] end s from cut),
tried as (select *,
        not regexp_matches(e, {_NUMBER}) or regexp_matches(e, '^ *-[0-9.]*[1-9]') bad_e,
        not (file_kind = 'eggnog_summary' and p = '-') and (not regexp_matches(p, {_NUMBER})
            or regexp_matches(p, '^ *-[0-9.]*[1-9]') or coalesce(try_cast(trim(p, ' ') as double), 1e308) > 100) bad_p,
        file_kind <> 'blast' and not regexp_matches(h, '^[0-9]+\.[A-Za-z][A-Za-z0-9_.\-]*$') bad_h from cell),
judged as (select *, case
        when not whole then 'quoting'
        when file_kind = 'blast' and len(f) not in (12, 13) or file_kind = 'seed_orthologs' and len(f) <> 11
            or file_kind = 'eggnog_summary' and len(f) <> 6 then 'column_count'
        when bad_e or bad_p or bad_h then 'invalid_value' end reason from tried)
"""
_COUNTS = "select {key}, count(*) n_rows, count(distinct {of}) {name}{more} from (select conserved_id, upper(trim(human_gene, ' ')) human_gene, e_value from homology_summary) where {key} is not null group by 1"

QUERIES = {"p1_found": p1_found, "p1_clusters": p1_clusters, "p1_genes": p1_genes, "p2_found": p2_found, "p2_loaded": p2_loaded, "p2_reasons": p2_reasons}
SQL = {
    "p1_found": """
        with long as (select 'conserved_id' field, conserved_id key_value from homology_summary
            union all select 'human_gene', upper(trim(human_gene, ' ')) from homology_summary)
        select field, key_value from long where key_value is not null group by 1, 2
        having count(*) * 100 >= 2 * (select count(*) from homology_summary)""",
    "p1_clusters": _COUNTS.format(key="conserved_id", of="human_gene", name="n_genes", more=", median(case when isnan(e_value) then null else e_value end) median_e_value"),
    "p1_genes": _COUNTS.format(key="human_gene", of="conserved_id", name="n_clusters", more=""),
    "p2_found": _JUDGED + "select record_id, reason from judged where reason is not null",
    "p2_loaded": _JUDGED + """select record_id, file_kind, q query_id, hit, cast(trim(e, ' ') as double) evalue,
        try_cast(trim(p, ' ') as double) perc_identity, case when regexp_matches(s, """ + _NUMBER + """) then cast(trim(s, ' ') as double) end score
        from judged where reason is null""",
    "p2_reasons": _JUDGED + """select file_kind, case when reason is null then 'ok' else 'bad' end status, reason,
            case when reason = 'invalid_value' then case when bad_e then 'evalue' when bad_p then 'perc_identity' else 'Hit' end end bad_field, count(*) n_lines
        from judged group by all
        union all select file_kind, 'skip', null, null, count(*) from raw_record where record_id not in (select record_id from line) group by 1""",
}
