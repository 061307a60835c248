"""One key, question or chunk that holds a third of all rows gives whole, right results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import changelog as L
from ledgerlake.operators.checks import top_groups

N = 300_000


def hot_log(spark):
    """Versions 0..N-1, one row each; every third row is of key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, N, 1, 16).select(
        key.alias("k"),
        F.col("id").alias("value"),
        F.when((F.col("id") >= 1000) & (F.col("id") % 5 == 4), "dev").otherwise("main").alias(L.BRANCH),
        F.col("id").alias(L.VERSION),
        F.expr("timestamp_ntz'2024-01-01'").alias(L.TS),
        F.lit("U").alias(L.OP),
        F.lit("m").alias(L.MESSAGE),
    )


def test_hot_key_is_read_and_merged(spark):
    log = hot_log(spark)
    forks = spark.sql("SELECT 'dev' AS branch, 999L AS fork_version")
    versions = range(N)
    on_main = [v for v in versions if v < 1000 or v % 5 != 4]
    on_dev = [v for v in versions if v < 1000 or v % 5 == 4]

    def table(seen):
        return {(0 if v % 3 == 0 else v): v for v in seen}

    main, dev = table(on_main), table(on_dev)
    assert dict(L.read_branch(log, ["k"]).collect()) == main
    assert dict(L.read_branch(log, ["k"], "dev", forks).collect()) == dev
    merge = L.merge_branch(log, ["k"], "dev", "main", forks, L.Commit(N, "2024-01-02"), on_conflict="source")
    after = dict(L.read_branch(log.unionByName(merge.changes), ["k"]).collect())
    base = table(range(1000))
    assert after == {**main, **{k: v for k, v in dev.items() if base.get(k) != v}}
    assert [r["k"] for r in merge.conflicts.collect()] == [0]


def test_hot_group_is_counted(spark):
    first = top_groups(hot_log(spark), ["k"], 2).collect()
    assert [tuple(r) for r in first] == [(0, N // 3), (1, 1)]
