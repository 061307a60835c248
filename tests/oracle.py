"""Compare a Spark result with a DuckDB result: columns, types, and rows in any order."""

from __future__ import annotations

import math

import pyarrow as pa


def _plain(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz is None else "timestamptz"
    return str(t)


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, list):
        return str([_cell(v) for v in value])
    return repr(value)


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns)) if columns else []


def compare(got: pa.Table, want: pa.Table) -> str:
    """What differs, or an empty text."""
    a = {n: _plain(got.schema.field(n).type) for n in got.column_names}
    b = {n: _plain(want.schema.field(n).type) for n in want.column_names}
    if a != b:
        return f"schema {sorted(set(a.items()) ^ set(b.items()))}"
    x, y = rows(got), rows(want)
    if len(x) != len(y):
        return f"{len(x)} rows, expected {len(y)}"
    wrong = [(p, q) for p, q in zip(x, y) if p != q]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
