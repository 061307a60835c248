"""Versioned tables in a folder against a plain model, and what their plans read."""

from __future__ import annotations

import random
import uuid

import pytest
from people import plan_of
from pyspark.sql import functions as F

from ledgerlake.operators.changelog import OP
from ledgerlake.operators.history import CheckFailed, VersionedTable

SCHEMA = "id long, name string, n int"
TS = "2024-03-01"


def new(spark, every=16, schema=SCHEMA, keys=("id",)):
    return VersionedTable(spark, f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}", schema, keys, every)


def changes(spark, rows):
    return spark.createDataFrame(rows, f"{SCHEMA}, {OP} string")


def state(df):
    return {r["id"]: (r["name"], r["n"]) for r in df.collect()}


class Model:
    """Every version's state and ancestors, in dictionaries."""

    def __init__(self):
        self.states, self.seen, self.heads = {}, {}, {}

    def commit(self, branch, rows, merged=None):
        parent = self.heads.get(branch)
        version = max(self.states, default=0) + 1
        now = dict(self.states.get(parent, {}))
        for i, name, n, op in rows:
            now.pop(i, None)
            if op != "D":
                now[i] = (name, n)
        self.states[version] = now
        self.seen[version] = {version} | self.seen.get(parent, set()) | (self.seen[merged] if merged else set())
        self.heads[branch] = version
        return version

    def merge(self, source, target):
        a, b = self.heads[source], self.heads[target]
        base, theirs, ours = self.states[max(self.seen[a] & self.seen[b])], self.states[a], self.states[b]
        rows = [(i, *(theirs.get(i) or ours.get(i)), "U" if i in theirs else "D") for i in base.keys() | theirs.keys() if base.get(i) != theirs.get(i) and theirs.get(i) != ours.get(i)]
        return self.commit(target, rows, a)


def test_random_histories_against_the_model(spark):
    r = random.Random(3)
    history, model = new(spark, every=3), Model()
    branches = ["main"]
    first = [(i, f"a{i}", i, "I") for i in range(20)]
    assert history.commit(changes(spark, first), "load", TS) == model.commit("main", first)
    for step in range(9):
        kind = r.random()
        branch = r.choice(branches)
        if kind < 0.25 and len(branches) < 4:
            name = f"b{step}"
            at = r.choice([None, r.choice(sorted(model.states))])
            history.create_branch(name, at, branch)
            model.heads[name] = at or model.heads[branch]
            branches.append(name)
        elif kind < 0.5 and len(branches) > 1:
            source = r.choice([b for b in branches if b != branch])
            assert history.merge(source, branch, "merge", TS, on_conflict="source") == model.merge(source, branch)
        else:
            rows = [(i, r.choice(["x", "y", None]), r.choice([1, 2, None]), r.choice("UUD")) for i in r.sample(range(25), 6)]
            assert history.commit(changes(spark, rows), f"edit {step}", TS, branch) == model.commit(branch, rows)
    for branch in branches:
        assert state(history.read(branch=branch)) == model.states[model.heads[branch]]
    for version in r.sample(sorted(model.states), 2):
        assert state(history.read(version)) == model.states[version]
    a, b = model.states[2], model.states[max(model.states)]
    found = {x["id"]: x["change"] for x in history.diff(2, max(model.states)).collect()}
    assert found == {i: "added" if i not in a else "removed" if i not in b else "changed" for i in a.keys() | b.keys() if a.get(i) != b.get(i)}


def test_histories_read_commits_only(spark):
    history = new(spark)
    history.commit(changes(spark, [(1, "a", 1, "I"), (2, "b", 2, "I")]), "one", "2024-01-01")
    history.create_branch("dev")
    history.commit(changes(spark, [(1, "c", 1, "U"), (2, "b", 2, "D")]), "two", "2024-01-02", "dev")
    rows = [tuple(r)[2:] for r in history.snapshots("dev").collect()]
    assert rows == [(2, 2, 0, 0), (2, 0, 1, 1)]
    assert [r["_message"] for r in history.commit_log("dev", 1).collect()] == ["two"]
    assert {tuple(r) for r in history.branch_heads().collect()} == {("main", 1), ("dev", 2)}
    for df in (history.snapshots("dev"), history.commit_log("dev"), history.branch_heads(), history.branches):
        assert "/log" not in plan_of(df) and "name#" not in plan_of(df)


def test_a_read_scans_one_state_and_the_versions_after_it(spark):
    history = new(spark, every=4)
    for v in range(1, 7):
        history.commit(changes(spark, [(v, f"v{v}", v, "I"), (100, "hot", v, "U")]), f"c{v}", TS)
    plan = plan_of(history.read())
    assert "_state#" in plan and "PartitionFilters" in plan
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("_state" in f and "= 4" in f for f in filters)
    assert all("_state" in f or ("IN (5,6)" in f and "_version" in f) for f in filters)
    assert "SortAggregate" not in plan and state(history.read()) == {**{v: (f"v{v}", v) for v in range(1, 7)}, 100: ("hot", 6)}


def test_times_unknown_versions_and_stale_heads(spark):
    history = new(spark)
    assert history.read().count() == 0 and history.head() is None
    history.commit(changes(spark, [(1, "a", 1, "I")]), "one", "2024-01-01")
    history.commit(changes(spark, [(1, "b", 1, "U")]), "two", "2024-01-03")
    assert state(history.read_at("2024-01-02")) == {1: ("a", 1)} == state(history.read_first())
    for wrong in (lambda: history.read(9), lambda: history.read_at("2023-12-31"), lambda: history.read(branch="none"), lambda: history.refork("none")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(ValueError, match="not at version 1"):
        history.commit(changes(spark, []), "late", TS, expected_head=1)


def test_a_failed_check_or_write_leaves_no_commit(spark):
    history = new(spark)
    history.commit(changes(spark, [(1, "a", 1, "I")]), "one", TS)
    with pytest.raises(CheckFailed, match="names present"):
        history.commit(changes(spark, [(2, None, 1, "I")]), "two", TS, checks={"names present": F.bool_and(F.col("name").isNotNull()), "some": F.count(F.lit(1)) > 0})
    broken = changes(spark, [(3, "c", 1, "I")]).withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        history.commit(broken, "three", TS)
    assert state(history.read()) == {1: ("a", 1)} and history.head() == 1
    assert history.commit(changes(spark, [(2, "b", 1, "I")]), "two", TS, checks={"names present": F.bool_and(F.col("name").isNotNull())}) == 2
    assert state(history.read()) == {1: ("a", 1), 2: ("b", 1)}


def test_updates_deletes_replaces_and_rollbacks(spark):
    history = new(spark, every=2)
    history.commit(changes(spark, [(i, f"a{i}", i, "I") for i in range(4)]), "load", TS)
    history.update("n > 1", {"name": F.lit("big")}, "update", TS)
    history.delete("id = 0", "delete", TS)
    assert state(history.read()) == {1: ("a1", 1), 2: ("big", 2), 3: ("big", 3)}
    with pytest.raises(ValueError):
        history.update("n > 1", {"id": F.lit(1)}, "key", TS)
    version = history.replace(spark.createDataFrame([(1, "a1", 1), (9, "new", 9)], SCHEMA), "replace", TS)
    assert history.commit_at(version)["n_rows_changed"] == 3 and state(history.read()) == {1: ("a1", 1), 9: ("new", 9)}
    with pytest.raises(Exception, match="more than one row"):
        history.replace(spark.createDataFrame([(1, "a1", 1), (1, "b", 9)], SCHEMA), "twice", TS)
    history.rollback(2, "back", TS)
    assert state(history.read()) == {0: ("a0", 0), 1: ("a1", 1), 2: ("big", 2), 3: ("big", 3)}


def test_conflicts_and_what_wins(spark):
    history = new(spark)
    history.commit(changes(spark, [(i, "a", i, "I") for i in range(5)]), "load", TS)
    history.create_branch("dev")
    history.commit(changes(spark, [(0, "x", 0, "U"), (1, "x", 1, "U"), (2, "a", 2, "D"), (7, "x", 7, "I")]), "dev", TS, "dev")
    history.commit(changes(spark, [(0, "y", 0, "U"), (1, "x", 1, "U"), (2, "y", 2, "U"), (7, "y", 7, "I")]), "main", TS)
    kinds = {r["id"]: (r["source_change"], r["target_change"]) for r in history.conflicts("dev", "main").collect()}
    assert kinds == {0: ("update", "update"), 2: ("delete", "update"), 7: ("insert", "insert")}
    with pytest.raises(Exception, match="conflict between dev and main"):
        history.merge("dev", "main", "merge", TS)
    with pytest.raises(ValueError):
        history.merge("dev", "main", "merge", TS, on_conflict="both")
    assert history.head() == 3
    history.merge("dev", "main", "merge", TS, on_conflict="target")
    assert state(history.read())[0] == ("y", 0) and state(history.read())[2] == ("y", 2)
    history.merge("main", "dev", "back", TS)
    assert state(history.read(branch="dev")) == state(history.read())


def test_null_keys_and_keys_of_two_columns(spark):
    history = new(spark, every=2, schema="a string, b int, v double", keys=("a", "b"))
    rows = lambda r: spark.createDataFrame(r, f"a string, b int, v double, {OP} string")
    history.commit(rows([(None, 1, 1.0, "I"), ("x", None, 2.0, "I"), ("x", 1, 3.0, "I")]), "one", TS)
    history.commit(rows([(None, 1, 9.0, "U"), ("x", None, None, "D")]), "two", TS)
    history.commit(rows([("x", 1, None, "U")]), "three", TS)
    assert {tuple(r) for r in history.read().collect()} == {(None, 1, 9.0), ("x", 1, None)}
    assert {tuple(r)[:3] for r in history.diff(1, 3).collect()} == {(None, 1, "changed"), ("x", None, "removed"), ("x", 1, "changed")}


def test_more_versions_than_are_named(spark, monkeypatch):
    from ledgerlake.operators import history as module

    monkeypatch.setattr(module, "MAX_NAMED", 2)
    history = new(spark)
    for v in range(5):
        history.commit(changes(spark, [(v, "a", v, "I"), (0, "z", v, "U")]), "c", TS)
    assert state(history.read()) == {0: ("z", 4), **{v: ("a", v) for v in range(1, 5)}}


def test_checks_of_a_replaced_table_see_all_of_it(spark):
    history = new(spark)
    rows = spark.createDataFrame([(i, "a", i) for i in range(5)], SCHEMA)
    history.replace(rows, "first", TS, checks={"five": F.count(F.lit(1)) == 5})
    history.replace(rows.withColumn("n", F.when(F.col("id") == 3, 9).otherwise(F.col("n"))), "one row differs", TS, checks={"five": F.count(F.lit(1)) == 5})
    assert history.commit_at(2)["n_rows_changed"] == 1
    with pytest.raises(CheckFailed, match="six"):
        history.replace(rows, "again", TS, checks={"six": F.count(F.lit(1)) == 6})
    assert history.head() == 2


def filters_of(df):
    return [part.split("]")[0] for part in plan_of(df).split("PartitionFilters: [")[1:]]


def test_one_changed_row_opens_one_range(spark):
    def filled(rows):
        history = VersionedTable(spark, new(spark).folder, SCHEMA, ("id",), 16, ranges=8)
        history.commit(rows.withColumn(OP, F.lit("I")), "load", TS)
        return history

    rows = spark.range(20_000).selectExpr("id", "concat('n', id) AS name", "cast(id % 7 AS int) AS n")
    a, b = filled(rows), filled(rows.repartition(5).withColumn("n", F.when(F.col("id") == 77, 9).otherwise(F.col("n"))))
    found = a.compare(1, b, 1)
    ranges = [f.split("IN (")[1].split(")")[0] if "IN (" in f else f.split("_range")[2].split("= ")[1].split(",")[0].split(")")[0] for f in filters_of(found) if "_range" in f]
    assert len(ranges) == 2 and all("," not in r for r in ranges)
    assert [(r["id"], r["mine"]["n"], r["theirs"]["n"]) for r in found.collect()] == [(77, 0, 9)]
    assert a.compare(1, filled(rows.orderBy(F.desc("id"))), 1).count() == 0
    a.update("id = 77", {"n": F.lit(9)}, "one row", TS)
    assert a.compare(2, b, 1).count() == 0
    diff = a.diff(1, 2)
    assert all("_range" in f for f in filters_of(diff) if "_state" in f) and [r["id"] for r in diff.collect()] == [77]
    with pytest.raises(ValueError):
        a.compare(1, new(spark), 1)


def test_compared_tables_without_common_rows(spark):
    a, b = (VersionedTable(spark, new(spark).folder, SCHEMA, ("id",), 16, ranges=4) for _ in range(2))
    a.commit(changes(spark, [(1, "a", 1, "I"), (None, "n", 1, "I")]), "one", TS)
    b.commit(changes(spark, [(2, "b", 2, "I"), (1, "a", 1, "I")]), "one", TS)
    assert {(r["id"], r["mine"] is None, r["theirs"] is None) for r in a.compare(1, b, 1).collect()} == {(None, False, True), (2, True, False)}


def test_a_read_joins_later_versions_only(spark):
    history = new(spark)
    history.commit(changes(spark, [(1, "a", 1, "I"), (1, "twice", 1, "I"), (2, "b", 2, "D"), (None, "n", 3, "I")]), "one", TS)
    plan = plan_of(history.read())
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(tuple(r) for r in history.read().where("id IS NOT NULL").collect()) == [(1, "a", 1), (1, "twice", 1)]
    history.commit(changes(spark, [(1, "c", 1, "U"), (1, "d", 1, "U"), (4, "e", 4, "D"), (None, "m", 3, "U")]), "two", TS)
    plan = plan_of(history.read())
    assert plan.count("Join") == 1 and "Aggregate" not in plan
    rows = {(1, "c", 1), (1, "d", 1), (None, "m", 3)}
    assert {tuple(r) for r in history.read().collect()} == rows
    history.commit(changes(spark, [(4, "f", 4, "I")]), "three", TS)
    history.store_state(3)
    assert "/log" not in plan_of(history.read()) and {tuple(r) for r in history.read().collect()} == rows | {(4, "f", 4)}


def test_rows_move_once_into_a_state(spark, monkeypatch):
    plans = []
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a: (plans.append((path, plan_of(self._df))), write(self, path, *a))[1])
    history = new(spark)
    for v in range(3):
        history.commit(changes(spark, [(v, "a", v, "I"), (0, "z", v, "U")]), "c", TS)
    history.store_state(3)
    (plan,) = [p for path, p in plans if "/states/" in path]
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert state(history.read()) == {0: ("z", 2), 1: ("a", 1), 2: ("a", 2)}


def test_sides_share_the_layers_of_their_past(spark):
    history = new(spark, every=3)
    history.commit(changes(spark, [(i, "a", i, "I") for i in range(6)] + [(0, "b", 0, "I")]), "load", TS)
    history.create_branch("dev")
    history.commit(changes(spark, [(0, "x", 0, "U"), (0, "xx", 0, "U"), (1, "x", 1, "U"), (2, "a", 2, "D"), (3, "x", 3, "U"), (3, "a", 3, "D")]), "dev", TS, "dev")
    history.commit(changes(spark, [(1, "x2", 1, "U"), (7, "n", 7, "I")]), "more", TS, "dev")
    history.commit(changes(spark, [(0, "y", 0, "U"), (1, "y", 1, "U"), (3, "y", 3, "U")]), "main", TS)
    sides = history.merge_sides("dev", "main")
    assert "/states/" not in plan_of(sides)  # dev's head has a state, but its changes since the base say all
    found = sorted((r["id"], *(r[s] and r[s]["name"] for s in ("base", "source", "target")), r["is_conflict"]) for r in sides.where("id <> 0").collect())
    assert found == [(1, "a", "x2", "y", True), (2, "a", None, "a", False), (3, "a", "x", "y", True), (7, None, "n", None, False)]
    # Rows of one key meet each other side's, as many as there are.
    assert {(r["base"]["name"], r["source"]["name"], r["target"]["name"]) for r in sides.where("id = 0").collect()} == {(b, s, "y") for b in "ab" for s in ("x", "xx")}
    assert {r["id"]: r["change"] for r in history.diff(3, 1).collect()} == {0: "changed", 1: "changed", 2: "added", 3: "changed", 7: "removed"}


def test_sides_ask_the_commits_once(spark):
    history = new(spark)
    for v in range(3):
        history.commit(changes(spark, [(v, "a", v, "I")]), "load", TS)
    history.create_branch("dev")
    history.commit(changes(spark, [(1, "x", 1, "U")]), "dev", TS, "dev")
    asked = []
    spied = type("Spied", (VersionedTable,), {"commits": property(lambda self: asked.append(1) or VersionedTable.commits.fget(self))})
    table = spied(spark, history.folder, SCHEMA, ("id",))
    rows = table._sides({"base": 3, "source": 4, "target": 3}, 3, 4).collect()
    assert [(r["base"]["name"], r["source"]["name"], r["target"]["name"]) for r in rows] == [("a", "x", "a")]
    assert len(asked) <= 4  # the lines, the versions between two of them, and the layers of their past
