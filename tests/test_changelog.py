"""Change logs against a model that replays every commit on plain dictionaries."""

from __future__ import annotations

import random

import pytest
from people import PEOPLE, PEOPLE_SCHEMA
from pyspark.sql import functions as F

from ledgerlake.operators import changelog as L

KEY = ["id"]
SCHEMA = (
    "id BIGINT, name STRING, size INT, _branch STRING, _version BIGINT, _ts TIMESTAMP_NTZ, "
    "_op STRING, _message STRING"
)
FORKS = {"dev": 3, "staging": 5, "empty": 4}


class History:
    """Commits on branches, and each branch's table after each of its commits."""

    def __init__(self, seed: int, keys: int = 120, commits: int = 14):
        rng = random.Random(seed)
        self.rows, self.tables = [], {"main": {0: {}}}
        for version in range(1, commits + 1):
            for name, fork in FORKS.items():
                if version == fork + 1:
                    self.tables[name] = {fork: dict(self.at("main", fork))}
            open_branches = [b for b in self.tables if b != "empty"]
            branch = rng.choice(open_branches)
            table = dict(self.at(branch, version))
            for key in rng.sample([*range(keys), None], rng.randint(1, keys // 2)):
                value = (rng.choice(["a", "b", None]), rng.choice([1, 2, None]))
                op = "D" if rng.random() < 0.3 else "U" if key in table else "I"
                if op == "D" and key not in table:
                    continue
                held = table.pop(key) if op == "D" else table.setdefault(key, value)
                if op != "D":
                    held = table[key] = value
                self.rows.append((key, *held, branch, version, op))
            self.tables[branch][version] = table

    def at(self, branch: str, version: int = 10**9) -> dict:
        known = self.tables[branch]
        return known[max(v for v in known if v <= version)]

    def versions(self, branch: str) -> list[int]:
        own = {r[4] for r in self.rows if r[3] == branch}
        if branch != "main":
            own |= {r[4] for r in self.rows if r[3] == "main" and r[4] <= FORKS[branch]}
        return sorted(own)

    def log(self, spark):
        frame = spark.createDataFrame(
            self.rows, "id BIGINT, name STRING, size INT, _branch STRING, _version BIGINT, _op STRING"
        )
        ts = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(_version as int))")
        return frame.select(
            "id", "name", "size", "_branch", "_version", ts.alias("_ts"), "_op",
            F.concat(F.lit("commit "), F.col("_version").cast("string")).alias("_message"),
        ).repartition(4)


@pytest.fixture(scope="module", params=[1, 2])
def history(request):
    return History(request.param)


@pytest.fixture
def forks(spark):
    return spark.createDataFrame(list(FORKS.items()), "branch STRING, fork_version BIGINT")


def table_of(df) -> dict:
    rows = df.select("id", "name", "size").collect()
    table = {r["id"]: (r["name"], r["size"]) for r in rows}
    assert len(table) == len(rows)
    return table


@pytest.mark.parametrize("branch", ["main", *FORKS])
def test_reads(spark, history, forks, branch):
    log = history.log(spark).cache()
    assert table_of(L.read_branch(log, KEY, branch, forks)) == history.at(branch)
    versions = history.versions(branch)
    for version in versions[:: max(1, len(versions) // 3)]:
        wanted = history.at(branch if version > FORKS.get(branch, 0) else "main", version)
        assert table_of(L.as_of_version(log, KEY, version, branch, forks)) == wanted
        day = f"2024-01-{version + 1:02d} 12:00:00"
        assert table_of(L.as_of_time(log, KEY, day, branch, forks)) == wanted
    first = history.at("main", versions[0])
    assert table_of(L.as_of_first(log, KEY, branch, forks)) == first
    listed = [r["_version"] for r in L.snapshots(log, branch, forks).collect()]
    assert listed == versions
    recent = [r["_message"] for r in L.commit_log(log, branch, forks, 3).collect()]
    assert recent == [f"commit {v}" for v in versions[::-1][:3]]


def test_heads(spark, history, forks):
    log = history.log(spark)
    heads = dict(L.branch_heads(log, forks).collect())
    for branch in ["main", *FORKS]:
        own = [r[4] for r in history.rows if r[3] == branch]
        assert heads[branch] == (max(own) if own else FORKS[branch])


def test_diff_and_rollback(spark, history, forks):
    log = history.log(spark).cache()
    versions = history.versions("main")
    for old, new in [(versions[0], versions[-1]), (versions[-1], versions[1])]:
        a, b = history.at("main", old), history.at("main", new)
        wanted = {}
        for key in a.keys() | b.keys():
            if a.get(key) != b.get(key):
                change = "added" if key not in a else "removed" if key not in b else "changed"
                wanted[key] = (change, a.get(key, (None, None)), b.get(key, (None, None)))
        got = {
            r["id"]: (r["change"], (r["old_name"], r["old_size"]), (r["new_name"], r["new_size"]))
            for r in L.diff_versions(log, KEY, old, new).collect()
        }
        assert got == wanted
    rows = L.rollback_rows(log, KEY, versions[0], L.Commit(99, "2024-06-01"))
    assert rows.columns == log.columns
    assert table_of(L.read_branch(log.unionByName(rows), KEY)) == history.at("main", versions[0])


@pytest.mark.parametrize(("source", "target"), [("dev", "main"), ("dev", "staging"), ("main", "dev"), ("staging", "empty")])
def test_merge(spark, history, forks, source, target):
    log = history.log(spark).cache()
    base = history.at("main", min(FORKS.get(b, 10**9) for b in (source, target)))
    ours, theirs = history.at(target), history.at(source)
    merged, conflicts = dict(ours), set()
    for key in base.keys() | theirs.keys():
        a, b, c = base.get(key), theirs.get(key), ours.get(key)
        if a != b and b != c:
            if a != c:
                conflicts.add(key)
            merged[key] = b
    merged = {k: v for k, v in merged.items() if v is not None}
    result = L.merge_branch(log, KEY, source, target, forks, L.Commit(99, "2024-06-01"), on_conflict="source")
    after = log.unionByName(result.changes)
    assert table_of(L.read_branch(after, KEY, target, forks)) == merged
    assert table_of(L.read_branch(after, KEY, source, forks)) == theirs
    assert {r["id"] for r in result.conflicts.collect()} == conflicts

    kept = L.merge_branch(log, KEY, source, target, forks, L.Commit(99, "2024-06-01"), on_conflict="target")
    wanted = {**merged, **{k: ours.get(k) for k in conflicts}}
    wanted = {k: v for k, v in wanted.items() if v is not None}
    assert table_of(L.read_branch(log.unionByName(kept.changes), KEY, target, forks)) == wanted
    if conflicts:
        failing = L.merge_branch(log, KEY, source, target, forks, L.Commit(99, "2024-06-01"))
        with pytest.raises(Exception, match="conflict between"):
            failing.changes.collect()


def test_replace(spark, history, forks):
    log = history.log(spark)
    table = {1: ("new", 9), 500: ("born", None), **{k: v for k, v in history.at("dev").items() if k == 2}}
    frame = spark.createDataFrame([(k, *v) for k, v in table.items()], "id BIGINT, name STRING, size INT")
    rows = L.replace_on_branch(log, KEY, frame, "dev", forks, L.Commit(99, "2024-06-01"))
    assert table_of(L.read_branch(log.unionByName(rows), KEY, "dev", forks)) == table
    assert 2 not in [r["id"] for r in rows.collect()]


def test_no_job_runs_while_a_change_is_built(spark, history, forks):
    log = history.log(spark)
    old, new = history.versions("main")[0], history.versions("main")[-1]
    group = f"built {id(history)}"
    spark.sparkContext.setJobGroup(group, group)
    L.diff_versions(log, KEY, old, new)
    L.rollback_rows(log, KEY, old, L.Commit(999, "2024-06-01"))
    L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(999, "2024-06-01"), new)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0


def test_stale_commits_and_repeated_keys_are_refused(spark, people_log):
    forks = spark.createDataFrame([("dev", 2)], "branch STRING, fork_version BIGINT")
    stale = L.Commit(2, "2024-02-01")
    dev = L.update_on_branch(
        people_log, KEY, "dev", forks, "id = 1", {"name": F.lit("x")}, L.Commit(3, "2024-02-01")
    )
    log = people_log.unionByName(dev)
    for rows in (
        L.update_on_branch(log, KEY, "main", None, "id = 1", {"name": F.lit("x")}, stale),
        L.delete_on_branch(log, KEY, "main", None, "id = 1", stale),
        L.rollback_rows(log, KEY, 1, stale),
        L.merge_branch(log, KEY, "dev", "main", forks, stale).changes,
        L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(3, "2024-02-01")).changes,
    ):
        with pytest.raises(Exception, match="is not above the latest version"):
            rows.collect()
    table = L.read_branch(log, KEY)
    with pytest.raises(Exception, match="more than one row"):
        L.replace_on_branch(log, KEY, table.unionByName(table.limit(1)), "main", None, L.Commit(9, "2024-02-01")).collect()


def test_merge_points_serve_both_directions(spark, people_log):
    forks = spark.createDataFrame([("dev", 2)], "branch STRING, fork_version BIGINT")

    def rename(log, version, branch, key, name):
        commit = L.Commit(version, "2024-02-01")
        rows = L.update_on_branch(log, KEY, branch, forks, f"id = {key}", {"name": F.lit(name)}, commit)
        return stored(log.unionByName(rows))

    log = rename(rename(people_log, 3, "main", 5, "main five"), 4, "dev", 1, "dev one")
    merge = L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(5, "2024-02-02"), 3)
    assert [tuple(r) for r in merge.point.collect()] == [("dev", "main", 4, 5)]
    log, merges = stored(log.unionByName(merge.changes)), stored(merge.point)
    log = rename(log, 6, "main", 1, "main one")
    back = L.merge_branch(log, KEY, "main", "dev", forks, L.Commit(7, "2024-02-03"), 4, merges=merges)
    assert sorted((r["id"], r["name"]) for r in back.changes.collect()) == [(1, "main one"), (5, "main five")]
    log, merges = stored(log.unionByName(back.changes)), stored(merges.unionByName(back.point))
    log = rename(log, 8, "dev", 2, "dev two")
    again = L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(9, "2024-02-04"), 6, merges=merges)
    assert [(r["id"], r["name"]) for r in again.changes.collect()] == [(2, "dev two")]
    assert again.conflicts.count() == 0


def test_keys_cannot_be_assigned(spark, history, forks):
    with pytest.raises(ValueError, match="keys"):
        L.update_on_branch(history.log(spark), KEY, "dev", forks, "true", {KEY[0]: F.lit(1)}, L.Commit(99, "2024-01-01"))


def stored(df):
    """Rows as a table holds them, without what they were derived from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@pytest.fixture
def people_log(spark):
    rows = [(*p, "main", 1, "I") for p in PEOPLE]
    rows += [(16, "Paula", "b", "Engineering", "Peru", "main", 2, "I"), (17, "Quino", "b", "Analytics", "Chile", "main", 2, "I")]
    log = spark.createDataFrame(rows, f"{PEOPLE_SCHEMA}, _branch STRING, _version BIGINT, _op STRING")
    return log.selectExpr(
        "*", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(_version as int)) as _ts", "'m' as _message"
    )


def test_fifteen_rows_then_seventeen(people_log):
    assert L.read_branch(people_log, KEY).count() == 17
    assert L.as_of_first(people_log, KEY).count() == 15
    assert L.snapshots(people_log).count() == 2


def test_update_shows_on_its_branch_only(spark, people_log):
    forks = L.create_branch(spark.createDataFrame([], "branch STRING, fork_version BIGINT"), people_log, "dev")
    rows = L.update_on_branch(
        people_log, KEY, "dev", forks, F.col("id") == 1, {"name": F.lit("Alba DEV")}, L.Commit(3, "2024-01-04", "rename")
    )
    log = people_log.unionByName(rows)
    pair = L.compare_branches(
        L.read_branch(log, KEY), L.read_branch(log, KEY, "dev", forks), KEY, ["name"], ("main", "dev")
    )
    assert [tuple(r) for r in pair.collect()] == [(1, "Alba", "Alba DEV")]
    gone = L.delete_on_branch(log, KEY, "dev", forks, "id = 2", L.Commit(4, "2024-01-05"))
    assert L.read_branch(log.unionByName(gone), KEY, "dev", forks).count() == 16
    assert L.read_branch(log.unionByName(gone), KEY).count() == 17


def test_second_merge_starts_at_the_first(spark, people_log):
    forks = spark.createDataFrame([("dev", 2)], "branch STRING, fork_version BIGINT")

    def rename(log, version, key, name):
        commit = L.Commit(version, "2024-02-01")
        return stored(
            log.unionByName(L.update_on_branch(log, KEY, "dev", forks, f"id = {key}", {"name": F.lit(name)}, commit))
        )

    log = rename(people_log, 3, 1, "first")
    log = stored(log.unionByName(L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(4, "2024-02-02"), 2).changes))
    on_main = L.update_on_branch(log, KEY, "main", None, "id = 1", {"name": F.lit("ours")}, L.Commit(5, "2024-02-03"))
    log = rename(log.unionByName(on_main), 6, 2, "second")
    again = L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(7, "2024-02-04"), 5, merged_upto=3)
    assert [(r["id"], r["name"]) for r in again.changes.collect()] == [(2, "second")]


def test_errors(spark, people_log):
    forks = spark.createDataFrame([("dev", 2)], "branch STRING, fork_version BIGINT")
    bad = {
        "unknown version 99": lambda: L.as_of_version(people_log, KEY, 99),
        "unknown version 77": lambda: L.rollback_rows(people_log, KEY, 77, L.Commit(9, "2024-02-01")),
        "unknown branch nope": lambda: L.read_branch(people_log, KEY, "nope", forks),
        "no version at 2020": lambda: L.as_of_time(people_log, KEY, "2020-01-01"),
        "main is not at version 1": lambda: L.merge_branch(
            people_log, KEY, "dev", "main", forks, L.Commit(9, "2024-02-01"), 1
        ).changes,
    }
    for message, make in bad.items():
        with pytest.raises(Exception, match=message):
            make().collect()
    with pytest.raises(ValueError, match="needs the table of forks"):
        L.read_branch(people_log, KEY, "dev")
    with pytest.raises(ValueError, match="on_conflict"):
        L.merge_branch(people_log, KEY, "dev", "main", forks, L.Commit(9, "2024-02-01"), on_conflict="x")


def test_branches_are_created_once_and_moved_only_when_empty(spark, people_log):
    forks = spark.createDataFrame([("dev", 1), ("staging", 1)], "branch STRING, fork_version BIGINT")
    own = L.update_on_branch(people_log, KEY, "dev", forks, "id = 1", {"name": F.lit("x")}, L.Commit(3, "2024-02-01"))
    log = people_log.unionByName(own)
    for name in ("dev", "staging"):
        forks = L.refork(forks, log, name)
    forks = L.create_branch(L.create_branch(forks, log, "dev"), log, "prod")
    assert dict(forks.collect()) == {"dev": 1, "staging": 2, "prod": 2}


def test_edits_of_different_keys_are_no_conflict(spark, people_log):
    forks = spark.createDataFrame([("dev", 2)], "branch STRING, fork_version BIGINT")
    log = people_log
    for version, branch, key in [(3, "main", 1), (4, "dev", 2), (5, "main", 3), (6, "dev", 3)]:
        commit = L.Commit(version, "2024-02-01")
        log = stored(
            log.unionByName(L.update_on_branch(log, KEY, branch, forks, f"id = {key}", {"name": F.lit("edited")}, commit))
        )
    merge = L.merge_branch(log, KEY, "dev", "main", forks, L.Commit(7, "2024-02-02"), 5)
    assert [r["id"] for r in merge.changes.collect()] == [2]
    assert merge.conflicts.count() == 0
