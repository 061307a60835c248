"""Run SQL text that was generated rather than written, within limits.

This keeps mistakes out; it is not a security boundary. Run it under a user who may read no more
than the listed tables.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Parts of a parsed plan that read something other than a named table.
REFUSED = ("UnresolvedIdentifier", "UnresolvedTableValuedFunction", "UnresolvedTVF")
# Calls that run code of the session; a parsed plan marks calls with a quote, plain texts have none.
REFUSED_CALLS = re.compile(r"'(?:[\w`]+\.)*`?(reflect|try_reflect|java_method|python_udf)`?\(", re.I)
# What a name may not be looked for in: texts and comments; then a name of several parts.
TOKENS = re.compile(
    r"""(?P<other>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|--[^\n]*|/\*.*?\*/)"""
    r"|(?P<name>(?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))+)",
    re.S,
)
MAX_FIELDS = "spark.sql.debug.maxToStringFields"
_one_at_a_time = threading.Lock()


def _parsed_plan(spark: SparkSession, sql: str) -> str:
    """The parsed plan, whole: by default Spark leaves out what comes after 25 fields."""
    before = spark.conf.get(MAX_FIELDS)
    spark.conf.set(MAX_FIELDS, str((1 << 31) - 1))
    try:
        text = spark.sql(f"EXPLAIN EXTENDED {sql}").first()[0]
    finally:
        spark.conf.set(MAX_FIELDS, before)
    parsed, mark, rest = text.partition("== Analyzed Logical Plan ==")
    if not mark:
        raise ValueError(f"the query cannot be explained: {text}")
    if "AnalysisException" in rest.split("==", 1)[0]:
        raise ValueError(f"the query does not fit the tables: {rest.strip()}")
    return parsed


def _view_names(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """A name without dots per table: its last part, or all parts where that part is not unique."""
    last = [name.lower().split(".")[-1] for name in tables]
    return {
        name: part if last.count(part) == 1 else name.lower().replace(".", "__")
        for name, part in zip(tables, last)
    }


def _with_views(sql: str, views: Mapping[str, str]) -> str:
    """The text with qualified table names, also in front of columns, replaced by those of views."""
    qualified = {tuple(name.lower().split(".")): view for name, view in views.items() if "." in name}

    def replaced(found: re.Match) -> str:
        if not found["name"]:
            return found[0]
        parts = re.findall(r"`[^`]+`|\w+", found["name"])
        plain = tuple(part.strip("`").lower() for part in parts)
        for name, view in qualified.items():
            if plain[: len(name)] == name:
                return ".".join([f"`{view}`", *parts[len(name) :]])
        return found[0]

    return TOKENS.sub(replaced, sql)


def run_guarded_sql(
    spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], max_rows: int
) -> DataFrame:
    """The rows of one SELECT over ``tables``, at most ``max_rows`` of them.

    Tables may have names of several parts, such as ``bronze.people``. The text is wrapped as a
    subquery, so anything but a single SELECT fails to parse. Spark's own parser then names every
    relation it mentions, in subqueries and common table expressions too; one that is not among
    ``tables`` is refused before anything runs. Calls take turns, as each borrows names of views.
    """
    views = _view_names(tables)
    # The line break keeps a trailing comment from swallowing the bracket.
    text = _with_views(sql.strip().rstrip(";"), views)
    wrapped = f"SELECT * FROM (\n{text}\n) LIMIT {int(max_rows)}"
    with _one_at_a_time:
        hidden = {v: spark.table(f"`{v}`") for v in views.values() if _is_view(spark, v)}
        try:
            for name, df in tables.items():
                df.createOrReplaceTempView(views[name])
            _check(spark, _parsed_plan(spark, wrapped), views.values())
            return spark.sql(wrapped)
        finally:
            # The result is resolved by now; the session gets back the views it had.
            for view in views.values():
                spark.catalog.dropTempView(view)
            for view, df in hidden.items():
                df.createOrReplaceTempView(view)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def _check(spark: SparkSession, plan: str, views: Iterable[str]) -> None:
    for part in REFUSED:
        if part in plan:
            raise ValueError(f"not allowed in a guarded query: {part}")
    call = REFUSED_CALLS.search(plan)
    if call:
        raise ValueError(f"not allowed in a guarded query: {call[1]}")
    allowed = {name.lower() for name in views}
    defined = {
        name.strip().lower()
        for names in re.findall(r"(?m)^[\s:+|-]*CTE \[([^\]]*)\]", plan)
        for name in names.split(",")
    }
    for name in defined - allowed:
        if spark.catalog.tableExists(name):
            raise ValueError(f"common table expression {name} hides a table of that name")
    read = {name.lower() for name in re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan)}
    refused = read - allowed - defined
    if refused:
        raise ValueError(f"tables not allowed: {', '.join(sorted(refused))}")
