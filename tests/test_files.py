"""Readers and writers on small files written here."""

import gzip

import pytest
from genoloom import sinks, streaming
from genoloom.sources import files
from pyspark.sql import functions as F


def test_gff_and_strands(spark, tmp_path):
    lines = ["##sequence-region c1 1 9", "c1\tp\tCDS\t5\t9\t.\t+\t0\tID=a", "c1\tp\tCDS\t10\t19\t.\t-\t0\tID=b;locus_tag=t", "c1\tp\tCDS\t1\t9\t.\t-\t0\tx=1", "c1\tp\tCDS\t30\t39\t.\t-\t0\tID=d", "##sequence-region c2 1 9", "c2\tp\tCDS\t7\t9\t.\t-\t0\tID=e", ""]
    (tmp_path / "a.gff").write_text("\n".join(lines))
    with gzip.open(tmp_path / "b.gff.gz", "wt") as f:
        f.write("\n".join(lines))
    for name in ("a.gff", "b.gff.gz"):
        df = files.gff(spark, str(tmp_path / name), "CDS")
        assert df.count() == 5 and df.where("locus_tag = 't'").first().start_pos == 10
    assert files.cds_intervals(spark, str(tmp_path / "a.gff")).where("begin = 0").first().name == "c1_1_9"
    out = files.corrected_strands(spark, str(tmp_path / "a.gff")).orderBy("region", "at").collect()
    assert [r.value.split("\t")[6] for r in out if "CDS" in r.value] == ["+", "+", "+", "-", "+"]
    assert out[0].value.startswith("##sequence-region c1")


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "s.fa").write_text(">cds-1::c1:0-6(-)\nACG\nTTT\n>cds-2::c2:9-12\nAAA\n")
    df = files.cds_sequences(spark, str(tmp_path / "s.fa"))
    assert {tuple(r) for r in df.collect()} == {("c1", 1, 6, "-", "ACGTTT"), ("c2", 10, 12, "+", "AAA")}
    sinks.fasta(df, str(tmp_path / "out"), "contig", "sequence", "contig")
    back = files.fasta(spark, str(tmp_path / "out" / "contig=c1"))
    assert [tuple(r) for r in back.collect()] == [("c1", "ACGTTT")]


def test_blocks_round_trip(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("#1\tq\tt\t0.5\t0.1\t2\n>a\tb\n>c\td\n\n#10\tq\tt\tbad\t0.1\t1\n>e\tf\n#2\tq\tt\t1e-9\t0.1\t3\n>g\th\n")
    df = files.blocks(spark, str(tmp_path / "b.tsv"))
    assert df.count() == 4 and df.where("block = '1'").count() == 2 and df.where("block = '10'").first().cluster_p is None
    sinks.blocks(df, str(tmp_path / "out"))
    got = [r.value for r in spark.read.text(str(tmp_path / "out"), lineSep="#").where("value <> ''").collect()]
    assert sorted(x.split("\t")[0] for x in got) == ["1", "10", "2"]
    assert {(r.block, r.gene_a) for r in files.blocks(spark, str(tmp_path / "out")).collect()} == {("1", "a"), ("1", "c"), ("10", "e"), ("2", "g")}


def test_lists_and_tables(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# c\n a \n\nb\n")
    assert [r.id for r in files.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["a", "b"]
    (tmp_path / "d.tsv").write_text("/x/g1.fa\t/y/g2.fa\t0.1\t0\t1/2\n")
    assert tuple(files.distances(spark, str(tmp_path / "d.tsv")).first()) == ("g1.fa", "g2.fa", 0.1)
    (tmp_path / "t.csv").write_text("﻿id,x\n1,2\n")
    df = files.table_with_header(spark, str(tmp_path / "t.csv"), ["id"], ",")
    assert df.columns == ["id", "x"] and files.column_or_position(df, "none", 1).first()[0] == "2"
    with pytest.raises(ValueError):
        files.table_with_header(spark, str(tmp_path / "t.csv"), ["other"], ",")
    (tmp_path / "h.txt").write_text("q\ts\t90\t10\t0\t0\t1\t10\t1\t10\t1e-5\t50\t5\" end\n# c\nshort\tline\n")
    got = files.hits(spark, str(tmp_path / "h.txt")).collect()
    assert len(got) == 1 and got[0].stitle == '5" end' and got[0].file == "h.txt"
    assert files.listing(spark, str(tmp_path), "*.tsv").count() == 1


def test_annotation_and_matrix(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("## x\n#query\tGOs\tDescription\nq1\tg\td\n## end\n")
    assert files.annotations(spark, str(tmp_path / "a.tsv")).first().asDict() == {"query": "q1", "GOs": "g", "Description": "d"}
    (tmp_path / "m.gct").write_text("#1.2\n2\t2\nName\tDescription\ts1\ts2\nENS1.1\tA\t1.5\t2\nENS2.1\tB\t\t4\n")
    got = {(r.symbol, r.sample): r.value for r in files.expression_matrix(spark, str(tmp_path / "m.gct")).collect()}
    assert got == {("A", "s1"): 1.5, ("A", "s2"): 2.0, ("B", "s1"): None, ("B", "s2"): 4.0}
    (tmp_path / "e.json").write_text('[{"term": "t", "fdr": 0.1, "inputGenes": ["a", "b"]}]')
    assert files.json_records(spark, str(tmp_path / "e.json"), "term string, fdr double, inputGenes array<string>").first().inputGenes == ["a", "b"]


def test_best_file(spark):
    paths = spark.createDataFrame([("/r/a/x_result.tsv",), ("/r/a/x_sorted_clusters.txt",), ("/r/b/y_result.tsv",), ("/r/c/z.log",)], "path string")
    got = {r.folder: r.path for r in files.best_file_per_folder(spark, paths, ["_sorted_clusters.txt", "_result.tsv"]).collect()}
    assert got == {"a": "/r/a/x_sorted_clusters.txt", "b": "/r/b/y_result.tsv"}


def test_delimited_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 1.5)], "x string, y double")
    sinks.delimited(df, str(tmp_path / "o"), "\t")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "o")).collect() if not r.value.startswith("x\t")) == ["a\tNA", "b\t1.5"]
    assert sinks.manifest(df, F.col("x"), F.concat(F.lit("/t/"), "x")).count() == 2


def test_incremental_loading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    at = [str(tmp_path / x) for x in ("in", "out", "progress")]
    (tmp_path / "in" / "1.csv").write_text("1,a\n")
    run = lambda: streaming.load_new(spark, at[0], "k int, v string", at[1], at[2], lambda df: df.where("k > 0"))
    assert run() == 1 and run() == 0
    (tmp_path / "in" / "2.csv").write_text("2,b\n-1,c\n")
    assert run() == 1
    assert {(r.k, r.v) for r in spark.read.parquet(at[1]).collect()} == {(1, "a"), (2, "b")}


def test_marks_inside_lines(spark, tmp_path):
    (tmp_path / "s.fa").write_text(">a 5'->3' [b->c]\nAC\nGT\n>b\nAA>TT\n>c\n")
    assert [tuple(r) for r in files.fasta(spark, str(tmp_path / "s.fa")).collect()] == [("a 5'->3' [b->c]", "ACGT"), ("b", "AA>TT"), ("c", "")]
    (tmp_path / "x_with_y.tsv").write_text("\n#1\tNZ_1_with_NZ_2:#3\tt#\t0.5\t0.1\t2\n>a#1\tb>\n\n#2\tq\tt\t0.5\t0.1\t2\n>c\td\n")
    got = [(r.block, r.query, r.target, r.gene_a, r.gene_b) for r in files.blocks(spark, str(tmp_path / "x_with_y.tsv")).collect()]
    assert got == [("1", "NZ_1_with_NZ_2:#3", "t#", "a#1", "b>"), ("2", "q", "t", "c", "d")]


def test_files_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "anno").mkdir()
    (tmp_path / "anno" / "c1.tsv").write_text("## x\n#query\tGOs\tDescription\nq1\tg1\td1\n")
    (tmp_path / "anno" / "c2.tsv").write_text("## x\n#query\tDescription\tKEGG\nq2\td2\tk2\n## end\n")
    got = {r.file: r.asDict() for r in files.annotations(spark, str(tmp_path / "anno"), with_file=True).collect()}
    assert got["c1.tsv"] == {"file": "c1.tsv", "query": "q1", "GOs": "g1", "Description": "d1", "KEGG": None}
    assert got["c2.tsv"] == {"file": "c2.tsv", "query": "q2", "GOs": None, "Description": "d2", "KEGG": "k2"}
    (tmp_path / "gct").mkdir()
    (tmp_path / "gct" / "1.gct").write_text("#1.2\n1\t2\nName\tDescription\ts1\ts2\nE1\tA\t1\t2\n")
    (tmp_path / "gct" / "2.gct").write_text("#1.2\n1\t1\nName\tDescription\ts3\nE1\tA\t3\nE2\tB\t4\t5\n")
    assert {(r.sample, r.value) for r in files.expression_matrix(spark, str(tmp_path / "gct")).collect()} == {("s1", 1.0), ("s2", 2.0), ("s3", 3.0)}


def test_folder_of_genomes_is_written_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = "{0}\tp\tCDS\t{1}\t99\t.\t-\t0\tID=x"
    for name in ("g1.gff", "g2.gff"):
        (tmp_path / "in" / name).write_text("\n".join(["##gff-version 3", "##sequence-region c1 1 9", line.format("c1", 5), line.format("c1", 7), "##sequence-region c2 1 9", line.format("c2", 8)]) + "\n")
    df = files.corrected_strands(spark, str(tmp_path / "in"))
    sinks.lines(df, str(tmp_path / "out"), "file", [F.asc("region"), F.asc("at")])
    for name in ("g1.gff", "g2.gff"):
        parts = sorted((tmp_path / "out" / f"file={name}").glob("*.txt"))
        got = "".join(p.read_text() for p in parts).splitlines()
        assert got[:2] == ["##gff-version 3", "##sequence-region c1 1 9"] and [x.split("\t")[6] for x in got if "CDS" in x] == ["+", "-", "+"] and got[4] == "##sequence-region c2 1 9"


def test_blocks_are_sorted_file_by_file(spark, tmp_path):
    rows = [("f1", "1", 0.5, 0.1, 2), ("f1", "2", 0.1, 0.2, 2), ("f1", "3", 0.1, 0.1, 2), ("f1", "4", None, 0.1, 9), ("f2", "5", 0.9, 0.9, 1)]
    df = spark.createDataFrame([(f, b, "q", "t", p, m, n, k, f"a{k}", "x") for f, b, p, m, n in rows for k in range(n)], "file string, block string, query string, target string, cluster_p double, multihit_p double, gene_count int, at int, gene_a string, gene_b string")
    sinks.blocks(df, str(tmp_path / "out"))
    order = lambda f: [x.split("\t")[0] for p in sorted((tmp_path / "out" / f"file={f}").glob("*.txt")) for x in p.read_text().splitlines() if x.startswith("#")]
    assert order("f1") == ["#3", "#2", "#1", "#4"] and order("f2") == ["#5"]
    assert files.blocks(spark, str(tmp_path / "out")).where("file = 'f1'").count() == 15


def test_commented_list(spark, tmp_path):
    sinks.commented_list(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string"), str(tmp_path / "o"), "x", ["n = 2"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "o").glob("*.txt"))) == "# n = 2\na\nb\n"
    assert [r.id for r in files.id_list(spark, str(tmp_path / "o")).collect()] == ["a", "b"]
