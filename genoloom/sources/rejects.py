"""Loading of tool output lines, bad lines apart with their reason.

Each Arrow batch of lines is given to the pyarrow CSV reader, whose invalid-row callback reports lines
with a wrong number of fields; all fields are read as strings and then cast as whole vectors, and the
cells that don't fit are labelled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pv
from pyspark.sql import DataFrame, functions as F

# Layout of the three kinds of lines. Fields are counted from 0.
KINDS = {
    "blast": {"sep": "\t", "columns": (13, 12), "evalue": 10, "perc_identity": 2, "hit": None, "query": 0, "subject": 1, "score": 11},
    "seed_orthologs": {"sep": "\t", "columns": (11,), "evalue": 2, "perc_identity": 8, "hit": 1, "query": 0, "subject": 1, "score": 3},
    "eggnog_summary": {"sep": ",", "columns": (6,), "evalue": 3, "perc_identity": 5, "hit": 2, "query": 1, "subject": 2, "score": 4},
}
HEADER = "Conserved ID,Cluster Gene,Human Gene,E-value,Score,Percent Identity"
NUMBER = r"\A *[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)? *\z"
NEGATIVE = r"\A *-[0-9.]*[1-9]"
HIT = r"\A[0-9]+\.[A-Za-z][A-Za-z0-9_.\-]*\z"
QUOTED = r'\A(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*\z'

SCHEMA = "record_id long, file_kind string, status string, reason string, bad_field string, fields array<string>, query_id string, hit string, evalue double, perc_identity double, score double"
_ARROW = pa.schema([
    ("record_id", pa.int64()), ("file_kind", pa.string()), ("status", pa.string()), ("reason", pa.string()), ("bad_field", pa.string()),
    ("fields", pa.list_(pa.string())), ("query_id", pa.string()), ("hit", pa.string()), ("evalue", pa.float64()), ("perc_identity", pa.float64()), ("score", pa.float64()),
])

# Line ends inside a line would end the reader's row; they travel as a private-use character and a letter.
_MARK = "\ue000"
_THERE = {_MARK: _MARK + "e", "\n": _MARK + "n", "\r": _MARK + "r"}
_BACK = {v: k for k, v in _THERE.items()}


def _match(a: pa.Array, pattern: str) -> pa.Array:
    return pc.match_substring_regex(a, pattern)


def _packed(lines: pa.Array) -> pa.Array:
    if not pc.any(_match(lines, "[\n\r]")).as_py():
        return lines
    for a, b in _THERE.items():
        lines = pc.replace_substring(lines, a, b)
    return lines


def _unpacked(cells: pa.Array) -> pa.Array:
    if not pc.any(pc.match_substring(cells, _MARK)).as_py():
        return cells
    return pa.array([c if c is None or _MARK not in c else re.sub(_MARK + "[enr]", lambda m: _BACK[m[0]], c) for c in cells.to_pylist()], pa.string())


def read_lines(ids: pa.Array, lines: pa.Array, sep: str, columns: int, quoted: bool) -> tuple[pa.Array, list[pa.Array], list[int]]:
    """(ids of the lines with ``columns`` fields, their fields, ids of the others); ids are positions."""
    if not len(lines):
        return ids, [pa.array([], pa.string())] * columns, []
    rows = pc.binary_join_element_wise(pc.cast(ids, pa.string()), _packed(lines), sep)
    data = "\n".join(rows.to_pylist()).encode() + b"\n"
    rejected: list[int] = []

    def reject(row) -> str:
        rejected.append(int(row.text.split(sep, 1)[0]))
        return "skip"

    names = [str(k) for k in range(columns + 1)]
    got = pv.read_csv(
        pa.BufferReader(data),
        read_options=pv.ReadOptions(column_names=names, use_threads=False, block_size=min(len(data) + 1, 2**31 - 1)),
        parse_options=pv.ParseOptions(delimiter=sep, quote_char='"' if quoted else False, double_quote=quoted, invalid_row_handler=reject),
        convert_options=pv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
    ).combine_chunks()
    cells = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in got.columns]
    return pc.cast(cells[0], pa.int64()), [_unpacked(c) for c in cells[1:]], rejected


def numbers(cells: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(which cells are numbers, their values, else null)."""
    good = _match(cells, NUMBER)
    return good, pc.cast(pc.if_else(good, pc.utf8_trim(cells, " "), None), pa.float64())


def at_most_100(cells: pa.Array, values: pa.Array) -> pa.Array:
    """Whether the numbers are at most 100; where the double is 100 exactly, the digits decide."""
    fits = pc.less_equal(values, 100.0)
    edge = pc.fill_null(pc.equal(values, 100.0), False)
    if pc.any(edge).as_py():
        fits = pa.array([Decimal(c.strip(" ")) <= 100 if e else f for c, e, f in zip(cells.to_pylist(), edge.to_pylist(), fits.to_pylist())])
    return pc.fill_null(fits, False)


def _of_kind(kind: str, ids: pa.Array, positions: pa.Array, lines: pa.Array) -> Iterator[pa.RecordBatch]:
    at = KINDS[kind]

    def out(where: pa.Array, status: str, reason=None, bad=None, fields=None, parts=None) -> pa.RecordBatch:
        n = len(where)
        null = lambda t: pa.nulls(n, t)
        parts = parts or {}
        same = lambda v: pa.array([v] * n, pa.string())
        return pa.RecordBatch.from_arrays(
            [ids.take(where), same(kind), same(status) if isinstance(status, str) else status, reason if reason is not None else null(pa.string()), bad if bad is not None else null(pa.string()),
             fields if fields is not None else null(pa.list_(pa.string())), *(parts.get(k, null(t)) for k, t in (("query", pa.string()), ("hit", pa.string()), ("evalue", pa.float64()), ("perc_identity", pa.float64()), ("score", pa.float64())))],
            schema=_ARROW,
        )

    skip = pc.or_(pc.starts_with(lines, "#"), _match(lines, r"\A[ \t]*\z"))
    if kind == "eggnog_summary":
        skip = pc.or_(skip, pc.equal(lines, HEADER))
    yield out(positions.filter(skip), "skip")
    positions, lines = positions.filter(pc.invert(skip)), lines.filter(pc.invert(skip))
    quoted = kind == "eggnog_summary"
    if quoted:
        good = _match(lines, QUOTED)
        bad = positions.filter(pc.invert(good))
        yield out(bad, "bad", pa.array(["quoting"] * len(bad), pa.string()))
        positions, lines = positions.filter(good), lines.filter(good)
    for k, columns in enumerate(at["columns"]):
        where, cells, rejected = read_lines(positions, lines, at["sep"], columns, quoted)
        if len(where):
            is_e, e = numbers(cells[at["evalue"]])
            bad_e = pc.or_(pc.invert(is_e), _match(cells[at["evalue"]], NEGATIVE))
            p_cells = cells[at["perc_identity"]]
            is_p, p = numbers(p_cells)
            bad_p = pc.or_(pc.or_(pc.invert(is_p), _match(p_cells, NEGATIVE)), pc.invert(at_most_100(p_cells, p)))
            if quoted:
                bad_p = pc.and_(bad_p, pc.not_equal(p_cells, "-"))
            no = pa.array([False] * len(where))
            bad_h = no if at["hit"] is None else pc.invert(_match(cells[at["hit"]], HIT))
            field = pc.case_when(pc.make_struct(bad_e, bad_p, bad_h), "evalue", "perc_identity", "Hit", pa.nulls(len(where), pa.string()))
            bad = pc.is_valid(field)
            reason = pc.if_else(bad, "invalid_value", pa.nulls(len(where), pa.string()))
            flat = pa.concat_arrays(cells)
            order = pa.array(np.arange(len(where) * columns).reshape(columns, -1).T.ravel())
            fields = pa.ListArray.from_arrays(pa.array(np.arange(len(where) + 1, dtype=np.int32) * columns), flat.take(order))
            ok = pc.invert(bad)
            keep = lambda a: pc.if_else(ok, a, pa.nulls(len(where), a.type))
            parts = {"query": keep(cells[at["query"]]), "hit": keep(cells[at["subject"]]), "evalue": keep(e), "perc_identity": keep(p), "score": keep(numbers(cells[at["score"]])[1])}
            yield out(where, pc.if_else(bad, "bad", "ok"), reason, field, fields, parts)
        mask = pc.is_in(positions, value_set=pa.array(rejected, pa.int64()))
        positions, lines = positions.filter(mask), lines.filter(mask)
    yield out(positions, "bad", pa.array(["column_count"] * len(positions), pa.string()))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, kinds, lines = batch.columns
        where = pa.array(range(len(ids)), pa.int64())
        known = pc.is_in(kinds, value_set=pa.array(list(KINDS)))
        for kind in KINDS:
            mine = pc.fill_null(pc.and_(pc.equal(kinds, kind), pc.is_valid(lines)), False)
            if pc.any(mine).as_py():
                yield from _of_kind(kind, ids, where.filter(mine), lines.filter(mine))
        rest = pc.or_(pc.is_null(lines), pc.invert(known))
        n, rest_ids = pc.sum(rest).as_py() or 0, ids.filter(rest)
        if n:
            empty = pc.is_null(lines.filter(rest))
            status = pc.if_else(empty, "skip", "bad")
            reason = pc.if_else(empty, pa.nulls(n, pa.string()), "unknown_kind")
            yield pa.RecordBatch.from_arrays([rest_ids, kinds.filter(rest), status, reason, *(pa.nulls(n, f.type) for f in list(_ARROW)[4:])], schema=_ARROW)


def load_lines(df: DataFrame, record_id: str = "record_id", file_kind: str = "file_kind", raw_line: str = "raw_line") -> DataFrame:
    """One row per line: status ``ok``, ``bad`` (with reason and, for a value, the field) or ``skip``.

    Skipped are comments, blank and empty lines, the header of a summary, and null lines (no line at
    all). A line of an unknown or null kind is bad with the reason ``unknown_kind``. Fields of a bad
    value stay readable in ``fields``; typed columns are filled for good lines only. Repeated lines are
    judged one by one; an empty table gives no rows; other columns are ignored. No length is limited.
    """
    picked = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(file_kind).cast("string").alias("file_kind"), F.col(raw_line).cast("string").alias("raw_line"))
    return picked.mapInArrow(_parse, SCHEMA)


def rejects(parsed: DataFrame) -> DataFrame:
    """(record_id, reason) of the lines that can't be loaded."""
    return parsed.where("status = 'bad'").select("record_id", "reason")


def loaded(parsed: DataFrame) -> DataFrame:
    """The good lines as typed rows of the columns common to all kinds."""
    return parsed.where("status = 'ok'").select("record_id", "file_kind", "query_id", "hit", "evalue", "perc_identity", "score")
