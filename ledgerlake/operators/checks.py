"""Counts and checks over a finished table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def top_groups(df: DataFrame, keys: Sequence[str], n: int = 5, count: str = "n") -> DataFrame:
    """The ``n`` largest groups, largest first; equal counts in the order of their keys."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), *keys)
        .limit(n)
    )


def check_table(
    df: DataFrame,
    columns: Sequence[str] = (),
    min_rows: int = 1,
    rows: int | None = None,
    dims: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per check: ``check, passed, found``. All checks on data share one pass.

    Checks the number of rows, the presence of columns, and that each vector column has one
    length in every row.
    """
    aggregates, checks = _checks(df, columns, min_rows, rows, dict(dims or {}))
    return df.agg(*aggregates).select(F.inline(F.array(*checks)))


def observe_checks(
    df: DataFrame,
    columns: Sequence[str] = (),
    min_rows: int = 1,
    rows: int | None = None,
    dims: Mapping[str, int] | None = None,
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``check_table`` in the pass that writes: ``df`` to be written once, and its checks after that.

    What is counted are the rows that go by, so the written table is not read again.
    """
    aggregates, checks = _checks(df, columns, min_rows, rows, dict(dims or {}))
    seen = Observation()
    names = [f"n{i}" for i in range(len(aggregates))]
    observed = df.observe(seen, *[a.alias(n) for a, n in zip(aggregates, names)])

    def found() -> DataFrame:
        counts = [observed_values(seen).get(n, 0) for n in names]
        fields = ["n_rows", *[f"wrong_{i}" for i in range(len(counts) - 1)]]
        row = df.sparkSession.createDataFrame([tuple(counts)], ", ".join(f"{f} long" for f in fields))
        return row.select(F.inline(F.array(*checks)))

    return observed, found


def observed_values(seen: Observation) -> dict:
    """What was observed in a write; nothing where the optimizer saw that there are no rows, and observed none."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def _checks(df: DataFrame, columns: Sequence[str], min_rows: int, rows: int | None, dims: dict[str, int]):
    """Aggregates over ``df``, the number of rows first, and the checks as structs over their values."""
    present = [c for c in dims if c in df.columns]
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(present):
        wrong = F.col(c).isNull() | (F.size(c) != dims[c])
        aggregates.append(F.count_if(wrong).alias(f"wrong_{i}"))

    def check(name: str, passed, found):
        return F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            found.cast("bigint").alias("found"),
        )

    n_rows = F.col("n_rows")
    checks = [check(f"at least {min_rows} rows", n_rows >= min_rows, n_rows)]
    if rows is not None:
        checks.append(check(f"exactly {rows} rows", n_rows == rows, n_rows))
    for c in columns:
        there = F.lit(c in df.columns)
        checks.append(check(f"column {c}", there, there.cast("int")))
    for c, size in dims.items():
        if c in present:
            wrong = F.col(f"wrong_{present.index(c)}")
            checks.append(check(f"{size} values in {c}", wrong == 0, n_rows - wrong))
        else:
            checks.append(check(f"{size} values in {c}", F.lit(False), F.lit(0)))
    return aggregates, checks
