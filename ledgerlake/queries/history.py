"""Queries on a versioned table in a folder, with the commits that ``versions`` derives from ``orders``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import changelog as L
from ..operators.history import VersionedTable
from ..plans import medallion
from ..workspace import shared_folder
from . import versions as V
from .registry import ORACLES, query, table

_BUILT: dict[tuple[str, str], VersionedTable] = {}


def new_table(spark: SparkSession, folder: str) -> VersionedTable:
    """All commits written one after another, with a state kept every three."""
    kept = table(spark, folder, "orders")
    types = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in V.KEY + V.COLUMNS)
    history = VersionedTable(spark, shared_folder(spark), types, ("o_orderkey",), every=3, ranges=16)
    log = V.orders_log(spark, folder)
    for version, branch, _, message, *_ in V.COMMITS:
        rows = log.where(F.col(L.VERSION) == version).select(*V.KEY, *V.COLUMNS, L.OP)
        history.commit(rows, message, f"2024-01-{version + 1:02d}", branch)
        if version == 2:
            history.create_branch("dev")
            history.create_branch("staging")
    return history


def built(spark: SparkSession, folder: str) -> VersionedTable:
    """The same table for all queries that only read, written once a session."""
    key = spark.sparkContext.applicationId, folder
    if key not in _BUILT:
        _BUILT[key] = new_table(spark, folder)
    return _BUILT[key]


@query(ORACLES["snapshots"])
def history_snapshots(spark, folder):
    return built(spark, folder).snapshots("dev")


@query(ORACLES["commit_log"])
def history_log(spark, folder):
    return built(spark, folder).commit_log("dev", 3)


@query(ORACLES["branch_heads"])
def history_heads(spark, folder):
    return built(spark, folder).branch_heads()


@query(ORACLES["as_of_version"])
def history_as_of_version(spark, folder):
    return built(spark, folder).read(2)


@query(ORACLES["as_of_first"])
def history_as_of_first(spark, folder):
    return built(spark, folder).read_first("dev")


@query(f"WITH {V.LOG} {V.state(V.ON_DEV + ' AND _version <= 4')}")
def history_as_of_time(spark, folder):
    """``dev`` between its second and third commit: a stored state and one version after it."""
    return built(spark, folder).read_at("2024-01-05 12:00:00", "dev")


@query(ORACLES["read_branch"])
def history_read_branch(spark, folder):
    return built(spark, folder).read(branch="dev")


@query(ORACLES["diff_versions"])
def history_diff(spark, folder):
    return built(spark, folder).diff(1, 5)


@query(ORACLES["compare_branches"])
def history_compare(spark, folder):
    """Two stored states side by side; ranges of keys with equal digests are not read."""
    history = built(spark, folder)
    differing = history.compare(history.head(), history, history.head("dev")).where("mine IS NOT NULL AND theirs IS NOT NULL")
    shown = [F.col(side)[c].alias(f"{c}_{name}") for side, name in (("mine", "main"), ("theirs", "dev")) for c in ("o_orderstatus", "o_totalprice")]
    return differing.select("o_orderkey", *shown)


@query(ORACLES["merge_conflicts"])
def history_conflicts(spark, folder):
    return built(spark, folder).conflicts("dev", "main")


@query(ORACLES["refork"])
def history_refork(spark, folder):
    """Both branches asked to move; only the empty one does. A new branch starts at the head."""
    history = new_table(spark, folder)
    for name in ("dev", "staging"):
        history.refork(name)
    history.create_branch("prod")
    history.create_branch("dev")
    return history.branches.select("branch", F.col("start").alias("fork_version"))


@query(ORACLES["rollback"])
def history_rollback(spark, folder):
    """After the rollback ``main`` reads as it did at version 1."""
    history = new_table(spark, folder)
    history.rollback(1, "roll back", V.COMMIT_TS)
    return history.read()


def _differs(a: str, b: str) -> str:
    return f"(({a}.o_orderkey IS NULL) <> ({b}.o_orderkey IS NULL) OR " + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in V.COLUMNS) + ")"


def _marked(rows: str, priority: str, mark: str) -> str:
    return f"""
    SELECT o_orderkey, d.o_custkey, CASE WHEN o_orderpriority = '{priority}' THEN d.o_orderstatus || '{mark}' ELSE d.o_orderstatus END AS o_orderstatus,
        d.o_totalprice FROM {rows} d JOIN orders USING (o_orderkey)"""


@query(f"""
WITH {V.LOG}, keys AS (SELECT o_orderkey FROM orders), base AS ({V.state(V.ON_STAGING)}), dev AS ({V.state(V.ON_DEV)}),
main AS ({V.state(V.ON_MAIN)}), dev8 AS ({_marked("dev", "2-HIGH", " OK")}),
picked AS (SELECT keys.o_orderkey, {_differs("dev8", "base")} AS theirs FROM keys
    LEFT JOIN dev8 ON dev8.o_orderkey = keys.o_orderkey LEFT JOIN base ON base.o_orderkey = keys.o_orderkey),
main9 AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM dev8 JOIN picked USING (o_orderkey) WHERE theirs
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM main JOIN picked USING (o_orderkey) WHERE NOT theirs),
dev10 AS ({_marked("dev8", "4-NOT SPECIFIED", " DONE")}),
late AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED')
SELECT * FROM dev10 SEMI JOIN late USING (o_orderkey)
UNION ALL SELECT * FROM main9 ANTI JOIN (SELECT o_orderkey FROM dev10 SEMI JOIN late USING (o_orderkey)) USING (o_orderkey)""")
def merge_nested(spark, folder):
    """A branch of a branch is merged into it, that one into ``main``, moves on, and is merged again from there."""
    history = new_table(spark, folder)
    priority = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")

    def mark(branch: str, wanted: str, text: str) -> None:
        rows = history.read(branch=branch).join(priority.where(F.col("o_orderpriority") == wanted), "o_orderkey", "left_semi")
        changed = rows.withColumns({"o_orderstatus": F.concat("o_orderstatus", F.lit(text)), L.OP: F.lit("U")})
        history.commit(changed, f"mark {wanted}", V.COMMIT_TS, branch)

    history.create_branch("review", at=4)
    mark("review", "2-HIGH", " OK")
    history.merge("review", "dev", "review done", V.COMMIT_TS, expected_head=6)
    history.merge("dev", "main", "first merge", V.COMMIT_TS, on_conflict="source")
    mark("dev", "4-NOT SPECIFIED", " DONE")
    history.merge("dev", "main", "second merge", V.COMMIT_TS, on_conflict="source")
    return history.read()


@query(ORACLES["etl_on_branch"])
def history_etl(spark, folder):
    """Silver is rebuilt on ``dev``, checked as it is written, and merged; ``main`` then equals the branch."""
    bronze = built(spark, folder)
    silver = VersionedTable(spark, shared_folder(spark), bronze.schema + ", status_upper string", bronze.keys)
    silver.commit(V.to_silver(bronze.read(2)).withColumn(L.OP, F.lit("I")), "first silver", V.COMMIT_TS)
    checks = {
        "some rows": F.count(F.lit(1)) > 0,
        "every status in capitals": F.bool_and(F.col("status_upper") == F.upper("o_orderstatus")),
    }
    medallion.etl_on_table_branch(bronze, silver, "dev", V.to_silver, V.COMMIT_TS, checks, expected_head=1)
    return silver.read()
