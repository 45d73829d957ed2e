import pytest
from genoloom.sources import rejects

DDL = "record_id long, file_kind string, raw_line string, status string, reason int"
B = ["q", "s", "90.5", "100", "1", "0", "1", "100", "1", "100", "1e-5", "200"]
S = ["q", "990001.HPR1", "1e-5", "200", "1", "2", "3", "4", "50", "60", "70"]
E = ["Conserved_001", "g", "990001.HPR1", "1e-5", "200", "50"]


def line(parts, sep="\t", **changes):
    parts = list(parts)
    for k, v in changes.items():
        parts[int(k[1:])] = v
    return sep.join(parts)


CASES = [
    ("blast", line(B), "ok", None),
    ("blast", line([*B, ""]), "ok", None),
    ("blast", line([*B, 'a "quoted" title']), "ok", None),
    ("blast", line([*B, "x", "y"]), "bad", "column_count"),
    ("blast", line(B[:-1]), "bad", "column_count"),
    ("blast", line(B).replace("\t", ";"), "bad", "column_count"),
    ("blast", line(B, _10=" 1e-5 "), "ok", None),
    ("blast", line(B, _10="-1e-500"), "bad", "invalid_value"),
    ("blast", line(B, _10="-0.0e9"), "ok", None),
    ("blast", line(B, _10="1e99999"), "ok", None),
    ("blast", line(B, _10="."), "bad", "invalid_value"),
    ("blast", line(B, _10="nan"), "bad", "invalid_value"),
    ("blast", line(B, _10=""), "bad", "invalid_value"),
    ("blast", line(B, _10="１"), "bad", "invalid_value"),
    ("blast", line(B, _2="100.00000000000000000001"), "bad", "invalid_value"),
    ("blast", line(B, _2="1000e-1"), "ok", None),
    ("blast", line(B, _2="-"), "bad", "invalid_value"),
    ("blast", line(B, _2="1e2 "), "ok", None),
    ("blast", line([*B, "a\rb\ncn"]), "ok", None),
    ("blast", "# comment\t\t", "skip", None),
    ("blast", " \t ", "skip", None),
    ("blast", "", "skip", None),
    ("blast", None, "skip", None),
    ("blast", line([*B, "x" * 3_000_000]), "ok", None),
    ("seed_orthologs", line(S), "ok", None),
    ("seed_orthologs", line(S, _1="990001.1HPR"), "bad", "invalid_value"),
    ("seed_orthologs", line(S, _1=" 990001.HPR1"), "bad", "invalid_value"),
    ("seed_orthologs", line(S, _1="990001.HPR1\n"), "bad", "invalid_value"),
    ("seed_orthologs", line(S, _8="101"), "bad", "invalid_value"),
    ("seed_orthologs", line(S[:-1]), "bad", "column_count"),
    ("eggnog_summary", line(E, ","), "ok", None),
    ("eggnog_summary", line(E, ",", _5="-"), "ok", None),
    ("eggnog_summary", line(E, ",", _5=" -"), "bad", "invalid_value"),
    ("eggnog_summary", line(E, ",", _5='"-"'), "ok", None),
    ("eggnog_summary", line(E, ",", _1='"a,""b""\nc"'), "ok", None),
    ("eggnog_summary", line(E, ",", _1='"a'), "bad", "quoting"),
    ("eggnog_summary", line(E, ",", _1='"a"x'), "bad", "quoting"),
    ("eggnog_summary", line(E, ",", _1='a"'), "bad", "quoting"),
    ("eggnog_summary", line(E[:-1], ","), "bad", "column_count"),
    ("eggnog_summary", rejects.HEADER, "skip", None),
    ("blast", rejects.HEADER, "bad", "column_count"),
    (None, line(B), "bad", "unknown_kind"),
    ("other", line(B), "bad", "unknown_kind"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    data = [(k, kind, raw, "taken", 5) for k, (kind, raw, *_) in enumerate(CASES)]
    return {r.record_id: r for r in rejects.load_lines(spark.createDataFrame(data, DDL).repartition(3)).collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_line(parsed, k):
    assert (parsed[k].status, parsed[k].reason) == CASES[k][2:]


def test_values_come_through(parsed):
    by = {c[1]: parsed[k] for k, c in enumerate(CASES)}
    egg = by[line(E, ",", _1='"a,""b""\nc"')]
    assert egg.query_id == 'a,"b"\nc' and egg.evalue == 1e-5 and egg.perc_identity == 50 and egg.score == 200
    assert by[line([*B, "a\rb\ncn"])].fields[12] == "a\rb\ncn"
    assert len(parsed) == len(CASES)


def test_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, "blast", line(B), "", 0)] * 3, DDL)
    assert rejects.loaded(rejects.load_lines(df)).count() == 3
    assert rejects.load_lines(df.limit(0)).count() == 0
