import random

import numpy as np
import pytest
from genoloom.llm import truncation
from pyspark.sql import functions as F

BASE = "/root/testdata/sf0.01"
DDL = "doc_id long, text string, lang string, source string, p double, code int, kind string"


def codes(text, kind):
    b = truncation.masked(text, kind)
    return b, *truncation.contexts(b, kind)


@pytest.mark.parametrize(
    ("kind", "text", "want"),
    [
        ("c", 'x = "a{b";', b'x = "\1\1\1";'),
        ("c", "/* ab */x", b"\3\3\3\3\3\3  x"),
        ("c", "/* ab", b"\3\3\3\3\3"),
        ("c", "// a-\nx", b"\2\2\2\2\6\nx"),
        ("python", '"""a\nb"""', b'"' + b"\1" * 7 + b'"'),
        ("python", "# don't\nx", b"\2" * 7 + b"\nx"),
        ("sql", "'it''s' --x", b"'\1\1\1\1\1' \6\6\2"),
        ("text", "don't { stop…", b"don't { stop\4"),
        ("json", '{"a": "b', b'{"\1": "\1'),
    ],
)
def test_masked(kind, text, want):
    assert bytes(truncation.masked(text, kind)) == want.replace(b"\1" * 7 + b'"', b"\1" * 7 + b'"')


def test_depth_and_line_ends():
    text = "void f() {\n" + "    g(1);\n" * 6 + "}\n"
    _, code, counts = codes(text, "c")
    depth = code // (truncation.LAST * truncation.SECOND * truncation.THIRD * truncation.WORDS)
    assert depth[-1] == 0 and depth[40] == 1 and (depth[: truncation.NEAR] == 3).all()
    assert not counts[np.array([c == "\n" for c in text])].any()


def test_marks_of_omission():
    assert truncation._end("abc […]\n") == ("abc", "abc")
    assert truncation._end("abc...") == ("abc", "abc")
    assert truncation._end("abc ...\r\n") == ("abc ...", "abc")
    assert truncation._end("abc�") == ("abc", "abc")
    assert truncation._end("abc.\n") == ("abc.", "abc.")


def test_language_is_guessed_only_without_signs():
    assert truncation.language("def f(x):\n    return self.x\n\ndef g(x):\n    return f(x)\n", "go") == "python"
    assert truncation.language("func f() {\n}\n" * 5, "go") == "go"
    assert truncation.language("x", None) in truncation.SIGNS


def test_held_out_accuracy(spark):
    """Texts cut here at random places, some to a few characters, are found, and complete ones of the same tables aren't blamed."""
    df = spark.read.parquet(f"{BASE}/documents.parquet")
    r = random.Random(4)
    rows = [(x.doc_id, x.text, x.lang, x.source) for x in df.select("doc_id", "text", "lang", "source").collect()]
    whole = {x.doc_id for x in truncation.truncated(df, "doc_id", "text", "lang", "source").where("p < 0.02").collect()}
    chosen = {d for d, t, *_ in rows if d in whole and t and len(t) > 300 and r.random() < 0.1}
    tiny = {d for d in chosen if r.random() < 0.15}
    data = [(d, t[: r.randrange(6, 25) if d in tiny else r.randrange(100, len(t) - 60)] if d in chosen else t, lang, s) for d, t, lang, s in rows]
    got = {x.doc_id: x.p for x in truncation.truncated(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), "doc_id", "text", "lang", "source").collect()}
    recall = lambda ids: np.mean([got[d] > 0.5 for d in ids])
    assert len(chosen) > 40 and len(tiny) > 5 and recall(chosen) >= 0.9 and recall(tiny) >= 0.9 and recall(whole - chosen) < 0.01


def test_repeated_tables_give_the_same_decisions(spark):
    """Every text ten times, under new ids."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    find = lambda x: {r.doc_id: r.p for r in truncation.truncated(x, "doc_id", "text", "lang", "source").collect()}
    once, often = find(df), find(df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("doc_id", F.col("doc_id") * 10 + F.col("k")))
    assert len(often) == 10 * len(once) > 500 and all(p == pytest.approx(once[d // 10], abs=1e-9) for d, p in often.items())


def test_defined_results(spark):
    rows = [(1, None, "c", "s"), (2, "", "c", "s"), (3, " \n\t", "c", "s"), (4, "x", None, None), (None, "int f() {\n  return 0;\n}\n", "c", "s"), (5, "int f() {\n  return 0;\n}\n", "c", "s"), (5, "int f() {\n  return 0;\n}\n", "c", "s"), (6, "word " * 200_000, "text", None)]
    df = spark.createDataFrame([(*x, 0.5, 1, "k") for x in rows], DDL).repartition(3)
    got = truncation.truncated(df, "doc_id", "text", "lang", "source")
    assert got.columns == ["doc_id", "source", "kind", "p"]
    found = sorted((str(r.doc_id), r.source) for r in got.collect())
    assert found == sorted([("4", None), ("None", "s"), ("5", "s"), ("5", "s"), ("6", None)])
    assert got.where("p is null or p < 0 or p > 1").count() == 0
    assert truncation.truncated(df.limit(0), "doc_id", "text", "lang", "source").count() == 0


@pytest.mark.parametrize("n", [500, 5_000, 50_000])
def test_limits_are_the_same_at_every_size(spark, n):
    """Of the same shares, only the length that stands out is a limit, though ordinary ones reach many texts."""
    rng = np.random.default_rng(n)
    lengths = np.where(rng.random(n) < 0.05, 1024, np.exp(rng.normal(7, 0.7, n)).astype(int) + truncation.NEAR + 1)
    rows = [("s", int(x), k) for k, x in enumerate(lengths)] + [("s", 700, -1)] * n
    got = truncation.limits(spark.createDataFrame(rows, "source string, n_chars long, text_hash long"), "n_chars")
    assert [r.n_chars for r in got.collect()] == [1024]
    narrow = [("s", int(x), k) for k, x in enumerate(rng.integers(1000, 1012, n))]
    assert truncation.limits(spark.createDataFrame(narrow, "source string, n_chars long, text_hash long"), "n_chars").isEmpty()


def test_rates_of_contexts_are_written_before_texts_meet_them(spark):
    """One plan for a whole round took more of the driver's memory than there is."""
    texts = spark.createDataFrame([(k, "text", k * 64, 0.1, 1) for k in range(4)], "row long, kind string, code long, p double, m long")
    went_on = truncation.going_on(spark.createDataFrame([("text", k * 64, 50) for k in range(4)], "kind string, code long, n_inside long"))
    odds = truncation.ending_odds(texts, went_on)
    plan = odds._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan and odds.where("ratio > 0").count() == 4
