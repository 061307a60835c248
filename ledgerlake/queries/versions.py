"""Queries on change logs, derived from ``orders`` and ``events``.

Every order is on the log: loaded or appended on ``main``, some then edited on ``dev`` or on
``main``, or on both, so that a merge meets edits on one side, equal edits and conflicts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import moment
from ..operators import changelog as L
from ..plans import medallion
from ..workspace import shared_folder
from .registry import query, table

KEY = ["o_orderkey"]
COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice"]
COMMIT_TS = "2024-02-01 00:00:00"

# version, branch, op, message, rows of the commit, status written, price written
COMMITS = [
    (1, "main", "I", "initial load", "o_orderstatus <> 'P'", "o_orderstatus", "o_totalprice"),
    (2, "main", "I", "append", "o_orderstatus = 'P'", "o_orderstatus", "o_totalprice"),
    (3, "dev", "U", "mark urgent", "o_orderpriority = '1-URGENT'", "o_orderstatus || ' DEV'", "o_totalprice"),
    (4, "dev", "D", "drop low", "o_orderpriority = '5-LOW' AND o_orderstatus = 'F'", "o_orderstatus", "o_totalprice"),
    (5, "main", "U", "reprice", "o_orderstatus = 'F'", "o_orderstatus", "o_totalprice + 1"),
    (6, "dev", "U", "reprice medium", "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'", "o_orderstatus", "o_totalprice + 1"),
]

LOG = "log AS (" + " UNION ALL ".join(
    f"SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, {price} AS o_totalprice, "
    f"'{branch}' AS _branch, {v}::BIGINT AS _version, "
    f"TIMESTAMP '2024-01-01' + INTERVAL {v} DAY AS _ts, '{op}' AS _op, '{message}' AS _message "
    f"FROM orders WHERE {rows}"
    for v, branch, op, message, rows, status, price in COMMITS
) + ")"
ON_MAIN = "_branch = 'main'"
ON_DEV = "(_branch = 'dev' OR (_branch = 'main' AND _version <= 2))"
ON_STAGING = "(_branch = 'main' AND _version <= 2)"
DATA = ", ".join(KEY + COLUMNS)


def state(seen: str) -> str:
    return f"""
SELECT {DATA} FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _version DESC) AS place
    FROM log WHERE {seen}) WHERE place = 1 AND _op <> 'D'"""


def orders_log(spark: SparkSession, folder: str) -> DataFrame:
    """All commits in one scan: each order is unfolded into the change rows it takes part in."""

    def by_version(values: list[Column]) -> Column:
        """The value of the row's commit."""
        whens = zip((c[0] for c in COMMITS), values)
        return reduce(lambda w, vc: w.when(F.col(L.VERSION) == vc[0], vc[1]), whens, F)

    _, branch, op, message, rows, status, price = zip(*COMMITS)
    versions = F.array(*[F.lit(c[0]).cast("bigint") for c in COMMITS])
    return (
        table(spark, folder, "orders")
        .withColumn(L.VERSION, F.explode(versions))
        .where(by_version([F.expr(r) for r in rows]))
        .select(
            "o_orderkey",
            "o_custkey",
            by_version([F.expr(e) for e in status]).alias("o_orderstatus"),
            by_version([F.expr(e) for e in price]).alias("o_totalprice"),
            by_version([F.lit(b) for b in branch]).alias(L.BRANCH),
            L.VERSION,
            by_version(
                [moment(f"2024-01-{c[0] + 1:02d}", "timestamp_ntz") for c in COMMITS]
            ).alias(L.TS),
            by_version([F.lit(o) for o in op]).alias(L.OP),
            by_version([F.lit(m) for m in message]).alias(L.MESSAGE),
        )
    )


def forks(spark: SparkSession) -> DataFrame:
    """``dev`` and ``staging`` were both forked from ``main`` at version 2."""
    return spark.sql("SELECT * FROM VALUES ('dev', 2L), ('staging', 2L) AS t(branch, fork_version)")


@query(f"""
WITH {LOG}
SELECT _version, _ts, count(*) AS n_rows_changed, count(*) FILTER (_op = 'I') AS n_inserted,
       count(*) FILTER (_op = 'U') AS n_updated, count(*) FILTER (_op = 'D') AS n_deleted
FROM log WHERE {ON_DEV} GROUP BY _version, _ts""")
def snapshots(spark, folder):
    return L.snapshots(orders_log(spark, folder), "dev", forks(spark))


@query(f"WITH {LOG} {state(ON_MAIN + ' AND _version <= 2')}")
def as_of_version(spark, folder):
    return L.as_of_version(orders_log(spark, folder), KEY, 2)


@query(f"WITH {LOG} {state(ON_MAIN + ' AND _version <= 1')}")
def as_of_first(spark, folder):
    return L.as_of_first(orders_log(spark, folder), KEY)


@query(
    """
SELECT user_id, event_id AS last_event, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
    FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')
WHERE place = 1 AND event_type <> 'error'"""
)
def as_of_time(spark, folder):
    """The last event of each user at a time; an error takes the user off the table."""
    log = table(spark, folder, "events").select(
        "user_id",
        F.col("event_id").alias("last_event"),
        "event_type",
        "value",
        F.lit(L.MAIN).alias(L.BRANCH),
        F.col("event_id").alias(L.VERSION),
        F.col("ts").alias(L.TS),
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias(L.OP),
    )
    return L.as_of_time(log, ["user_id"], "2024-01-15 12:00:00")


@query(f"""
WITH {LOG}, a AS ({state(ON_MAIN + ' AND _version <= 1')}), b AS ({state(ON_MAIN)})
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed'
            ELSE 'changed' END AS change,
       {", ".join(f"a.{c} AS old_{c}, b.{c} AS new_{c}" for c in COLUMNS)}
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
   OR {" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in COLUMNS)}""")
def diff_versions(spark, folder):
    return L.diff_versions(orders_log(spark, folder), KEY, 1, 5)


@query(f"WITH {LOG} {state(ON_DEV)}")
def read_branch(spark, folder):
    return L.read_branch(orders_log(spark, folder), KEY, "dev", forks(spark))


UPDATED = "_branch, _version, _ts, _op, _message"


@query(f"""
WITH {LOG}
SELECT o_orderkey, o_custkey, o_orderstatus || ' HELD' AS o_orderstatus, o_totalprice,
       'dev' AS _branch, 7::BIGINT AS _version, TIMESTAMP '{COMMIT_TS}' AS _ts, 'U' AS _op,
       'hold' AS _message
FROM ({state(ON_DEV)}) WHERE o_totalprice > 400000""")
def update_on_branch(spark, folder):
    return L.update_on_branch(
        orders_log(spark, folder),
        KEY,
        "dev",
        forks(spark),
        F.col("o_totalprice") > 400000,
        {"o_orderstatus": F.concat("o_orderstatus", F.lit(" HELD"))},
        L.Commit(7, COMMIT_TS, "hold"),
    )


@query(f"""
WITH {LOG}, a AS ({state(ON_MAIN)}), b AS ({state(ON_DEV)})
SELECT a.o_orderkey, a.o_orderstatus AS o_orderstatus_main, a.o_totalprice AS o_totalprice_main,
       b.o_orderstatus AS o_orderstatus_dev, b.o_totalprice AS o_totalprice_dev
FROM a JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
   OR a.o_totalprice IS DISTINCT FROM b.o_totalprice""")
def compare_branches(spark, folder):
    log, compared = orders_log(spark, folder), ["o_orderstatus", "o_totalprice"]
    return L.compare_branches_of(log, KEY, compared, ("main", "dev"), forks(spark))


@query(f"""
WITH {LOG}, own AS (SELECT _branch AS branch, max(_version) AS head FROM log GROUP BY _branch),
     forks(branch, fork_version) AS (VALUES ('dev', 2::BIGINT), ('staging', 2))
SELECT branch, head AS head_version FROM own WHERE branch = 'main'
UNION ALL
SELECT forks.branch, coalesce(head, fork_version) FROM forks LEFT JOIN own USING (branch)""")
def branch_heads(spark, folder):
    return L.branch_heads(orders_log(spark, folder), forks(spark))


@query(f"""
WITH {LOG}
SELECT _version, max(_message) AS _message, max(_ts) AS _ts, count(*) AS n_rows_changed
FROM log WHERE {ON_DEV} GROUP BY _version ORDER BY _version DESC LIMIT 3""")
def commit_log(spark, folder):
    return L.commit_log(orders_log(spark, folder), "dev", forks(spark), 3)


@query(f"""
WITH {LOG}, forks(branch, fork_version) AS (VALUES ('dev', 2::BIGINT), ('staging', 2))
SELECT branch,
       CASE WHEN branch NOT IN (SELECT _branch FROM log)
            THEN (SELECT max(_version) FROM log WHERE {ON_MAIN}) ELSE fork_version END AS fork_version
FROM forks
UNION ALL SELECT 'prod', max(_version) FROM log WHERE {ON_MAIN}""")
def refork(spark, folder):
    """Both branches asked to move; only the empty one does. A new branch starts at the head."""
    log = orders_log(spark, folder)
    moved = reduce(lambda f, name: L.refork(f, log, name), ["dev", "staging"], forks(spark))
    return L.create_branch(L.create_branch(moved, log, "prod"), log, "dev")


def merge_sql(target: str, applied: str) -> str:
    """Base, source and target side by side, for every key of the log."""
    sides = ", ".join(
        f"{name}.o_orderkey IS NOT NULL AS {name}_alive, "
        + ", ".join(f"{name}.{c} AS {name}_{c}" for c in COLUMNS)
        for name in ("base", "source", "target")
    )

    def same(a: str, b: str) -> str:
        equal = [f"{a}_{c} IS NOT DISTINCT FROM {b}_{c}" for c in COLUMNS]
        return f"({' AND '.join([f'{a}_alive = {b}_alive', *equal])})"

    return f"""
WITH {LOG}, base AS ({state(ON_STAGING)}), source AS ({state(ON_DEV)}),
target AS ({state(target)}), keys AS (SELECT DISTINCT o_orderkey FROM log),
sides AS (
    SELECT keys.o_orderkey, {sides} FROM keys
    LEFT JOIN base USING (o_orderkey) LEFT JOIN source USING (o_orderkey)
    LEFT JOIN target USING (o_orderkey)),
changed AS (
    SELECT *, NOT {same('base', 'target')} AS is_conflict FROM sides
    WHERE NOT {same('base', 'source')} AND NOT {same('source', 'target')})
{applied}"""


def merged_rows(target: str) -> str:
    values = ", ".join(
        f"CASE WHEN source_alive THEN source_{c} ELSE target_{c} END AS {c}" for c in COLUMNS
    )
    return f"""
SELECT o_orderkey, {values}, '{target}' AS _branch, 7::BIGINT AS _version,
       TIMESTAMP '{COMMIT_TS}' AS _ts,
       CASE WHEN NOT source_alive THEN 'D' WHEN NOT target_alive THEN 'I' ELSE 'U' END AS _op,
       'merge' AS _message
FROM changed"""


MERGE = L.Commit(7, COMMIT_TS, "merge")


@query(merge_sql(ON_STAGING, merged_rows("staging")))
def merge_branch(spark, folder):
    """``dev`` into ``staging``, which did not move: nothing can conflict."""
    log = orders_log(spark, folder)
    return L.merge_branch(log, KEY, "dev", "staging", forks(spark), MERGE, 2).changes


@query(merge_sql(ON_MAIN, merged_rows("main")))
def merge_source_wins(spark, folder):
    log = orders_log(spark, folder)
    return L.merge_branch(log, KEY, "dev", "main", forks(spark), MERGE, 5, "source").changes


CONFLICT_KIND = (
    "CASE WHEN NOT {0}_alive THEN 'delete' WHEN NOT base_alive THEN 'insert' ELSE 'update' END"
)


@query(
    merge_sql(
        ON_MAIN,
        f"""
SELECT o_orderkey, {CONFLICT_KIND.format("source")} AS source_change,
       {CONFLICT_KIND.format("target")} AS target_change,
       {", ".join(f"{s}_{c}" for s in ("base", "source", "target") for c in COLUMNS)}
FROM changed WHERE is_conflict""",
    )
)
def merge_conflicts(spark, folder):
    log = orders_log(spark, folder)
    return L.merge_branch(
        log, KEY, "dev", "main", forks(spark), MERGE, on_conflict="target"
    ).conflicts


@query(
    merge_sql(
        ON_MAIN,
        f""", merged AS ({merged_rows("main")}),
after AS ({state(ON_MAIN).replace("FROM log", "FROM (SELECT * FROM log UNION ALL SELECT * FROM merged)")})
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       {", ".join(f"CASE WHEN a.o_orderkey IS NULL THEN b.{c} ELSE a.{c} END AS {c}" for c in COLUMNS)},
       'dev' AS _branch, 8::BIGINT AS _version, TIMESTAMP '{COMMIT_TS}' AS _ts,
       CASE WHEN a.o_orderkey IS NULL THEN 'D' WHEN b.o_orderkey IS NULL THEN 'I' ELSE 'U' END AS _op,
       'merge back' AS _message
FROM after a FULL JOIN source b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
   OR {" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in COLUMNS)}""",
    )
)
def merge_again(spark, folder):
    """``dev`` into ``main``, then ``main`` back into ``dev``, which had stayed as it was merged."""
    log, forked = orders_log(spark, folder), forks(spark)
    first = L.merge_branch(log, KEY, "dev", "main", forked, MERGE, 5, "source")
    back = L.Commit(8, COMMIT_TS, "merge back")
    after = log.unionByName(written(first.changes))
    return L.merge_branch(after, KEY, "main", "dev", forked, back, 6, merges=first.point).changes


@query(f"WITH {LOG} {state(ON_MAIN + ' AND _version <= 1')}")
def rollback(spark, folder):
    """After the rollback is committed, ``main`` reads as it did at version 1."""
    log = orders_log(spark, folder)
    rows = L.rollback_rows(log, KEY, 1, L.Commit(7, COMMIT_TS, "roll back"))
    return L.read_branch(log.unionByName(rows), KEY)


def written(df: DataFrame) -> DataFrame:
    """Change rows as a job commits them: stored, so that what reads them does not derive them again."""
    shared = shared_folder(df.sparkSession)
    df.write.partitionBy(L.BRANCH, L.VERSION).parquet(shared)
    return df.sparkSession.read.schema(df.schema).parquet(shared)


def to_silver(df: DataFrame) -> DataFrame:
    return df.withColumn("status_upper", F.upper("o_orderstatus"))


def run_etl(log, silver_log, transform, version, head, merges=None) -> medallion.BranchRun:
    """One ETL run on ``dev`` that stores its change rows, under ``version`` and the next."""
    etl, merge = L.Commit(version, COMMIT_TS, "etl"), L.Commit(version + 1, COMMIT_TS, "merge")
    return medallion.etl_on_branch(
        log, silver_log, KEY, "dev", forks(log.sparkSession), transform, etl, merge,
        expected_head=head, merges=merges, store=written,
    )


def first_silver(log: DataFrame) -> DataFrame:
    return to_silver(log.where((F.col(L.BRANCH) == L.MAIN) & (F.col(L.VERSION) <= 2)))


@query(f"WITH {LOG} SELECT *, upper(o_orderstatus) AS status_upper FROM ({state(ON_DEV)})")
def etl_on_branch(spark, folder):
    """Silver is rebuilt on ``dev``, checked and merged; ``main`` then equals the branch."""
    log = orders_log(spark, folder)
    silver_log = first_silver(log)
    run = run_etl(log, silver_log, to_silver, 7, 2)
    return L.read_branch(silver_log.unionByName(run.changes).unionByName(run.merge.changes), KEY)


@query(f"WITH {LOG} SELECT *, upper(o_orderstatus) || ' AGAIN' AS status_upper FROM ({state(ON_DEV)})")
def etl_twice(spark, folder):
    """A second run on the same branch, with another transformation, merges on top of the first."""

    def again(df: DataFrame) -> DataFrame:
        return df.withColumn("status_upper", F.concat(F.upper("o_orderstatus"), F.lit(" AGAIN")))

    log = orders_log(spark, folder)
    silver_log = first_silver(log)
    run = run_etl(log, silver_log, to_silver, 7, 2)
    silver_log = silver_log.unionByName(run.changes).unionByName(written(run.merge.changes))
    run = run_etl(log, silver_log, again, 9, 8, run.merge.point)
    return L.read_branch(silver_log.unionByName(run.changes).unionByName(run.merge.changes), KEY)
