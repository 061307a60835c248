"""A versioned table in a folder: change rows, a table of commits, branches, and stored states.

``log/`` holds change rows by ``_version``. ``commits/`` has one row per commit, written after its change
rows: a version without that row does not exist for readers, and writing it again after a failure replaces it.
Histories, heads and ancestors come from this table alone, at the cost of the commits, not of the rows.

A commit row carries two maps of branch to version. ``line`` says which commits its state is made of: those of
each branch up to a version, along first parents. ``sees`` adds what merges took in. Branches may start at any
version of any branch, and as a branch is always taken up to a version, both maps are exact: the newest commit
that two commits both see is the base of a merge, found in two rows.

``states/`` holds the whole table at some versions, one at least every ``every`` commits of a line. A read takes
the newest state of its line and the change rows after it, as partition filters on literal versions. The newest
version of each changed key comes from a hash aggregate on keys and versions, and only these rows are joined
back, so no state is sorted.

States are stored by ``ranges`` of a hash of the key, with an order-free digest of each range. A diff, a merge or a
rollback opens only the ranges that its changed keys lie in; two states of any tables are compared by digests first,
and only ranges that differ are read.

One job writes at a time; ``expected_head`` refuses a commit on a branch that has moved.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .changelog import MAIN, OP, VERSION
from .checks import observed_values

COMMITS = (
    "version long, branch string, parent long, merged long, ts timestamp_ntz, message string, n_rows_changed long, "
    "n_inserted long, n_updated long, n_deleted long, line map<string,long>, sees map<string,long>, since long"
)
BRANCHES = "branch string, start long, change long"
#: Versions that a read names one by one; more are joined.
MAX_NAMED = 1000


class CheckFailed(ValueError):
    """A check on written rows does not hold; the commit was not made."""


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _tests(checks: Mapping[str, Column] | None) -> list[Column]:
    return [F.coalesce(c, F.lit(False)).alias(f"check_{i}") for i, c in enumerate((checks or {}).values())]


def _failed(checks: Mapping[str, Column] | None, found: Mapping) -> list[str]:
    return [name for i, name in enumerate(checks or {}) if not found.get(f"check_{i}")]


def _moment(ts: datetime | str) -> datetime:
    return datetime.fromisoformat(ts) if isinstance(ts, str) else ts


def _later(a: Mapping[str, int], b: Mapping[str, int]) -> dict[str, int]:
    return {k: max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}}


def _on(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


@dataclass(frozen=True)
class VersionedTable:
    """A table of ``schema`` (data columns, keys among them) in ``folder``; see the module."""

    spark: SparkSession
    folder: str
    schema: str
    keys: tuple[str, ...]
    every: int = 16
    ranges: int = 64

    # What is stored

    @property
    def columns(self) -> list[str]:
        return [c for c in self.spark.createDataFrame([], self.schema).columns if c not in self.keys]

    def _stored(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    @property
    def commits(self) -> DataFrame:
        """One row per commit."""
        return self._stored("commits", COMMITS)

    @property
    def branches(self) -> DataFrame:
        """(branch, start) of every branch but ``main``."""
        return self._stored("branches", BRANCHES).groupBy("branch").agg(F.max_by("start", "change").alias("start"))

    @property
    def log(self) -> DataFrame:
        return self._stored("log", f"{self.schema}, {OP} string, {VERSION} long")

    def _one(self, df: DataFrame):
        return next(iter(df.take(1)), None)

    def commit_at(self, version: int):
        """The row of a commit; a version that is not there is an error."""
        row = self._one(self.commits.where(F.col("version") == version))
        if row is None:
            raise ValueError(f"unknown version {version}")
        return row

    def head(self, branch: str = MAIN) -> int | None:
        """The newest version of a branch: its own, or where it starts. None for ``main`` without commits."""
        own = self.commits.where(F.col("branch") == branch).agg(F.max("version")).first()[0]
        if own is not None or branch == MAIN:
            return own
        start = self._one(self.branches.where(F.col("branch") == branch))
        if start is None:
            raise ValueError(f"unknown branch {branch}")
        return start["start"]

    # Histories, from commits alone

    def _line(self, version: int | None) -> DataFrame:
        """The commits that the state at a version is made of."""
        line = self.commit_at(version)["line"] if version is not None else {}
        return self.commits.where(self._within(line))

    @staticmethod
    def _within(line: Mapping[str, int], branch: str = "branch", version: str = "version") -> Column:
        parts = [(F.col(branch) == b) & (F.col(version) <= v) for b, v in sorted(line.items())]
        return reduce(Column.__or__, parts, F.lit(False))

    def snapshots(self, branch: str = MAIN) -> DataFrame:
        """One row per version of a branch's line, oldest first, with what it changed."""
        counts = ["n_rows_changed", "n_inserted", "n_updated", "n_deleted"]
        return self._line(self.head(branch)).select(F.col("version").alias(VERSION), F.col("ts").alias("_ts"), *counts).orderBy(VERSION)

    def commit_log(self, branch: str = MAIN, n: int = 3) -> DataFrame:
        """The last ``n`` commits of a branch's line, newest first."""
        names = [F.col("version").alias(VERSION), F.col("message").alias("_message"), F.col("ts").alias("_ts"), "n_rows_changed"]
        return self._line(self.head(branch)).select(*names).orderBy(F.desc(VERSION)).limit(n)

    def branch_heads(self) -> DataFrame:
        """(branch, head_version) of every branch that has one."""
        own = self.commits.groupBy("branch").agg(F.max("version").alias("own"))
        joined = own.join(self.branches, "branch", "full")
        return joined.select("branch", F.coalesce("own", "start").alias("head_version"))

    def create_branch(self, name: str, at: int | None = None, of: str = MAIN) -> None:
        """A branch that starts at a version, by default the head of ``of``. An existing branch stays as it is."""
        if name != MAIN and self._one(self.branches.where(F.col("branch") == name)) is None:
            self._place(name, self.commit_at(at)["version"] if at is not None else self.head(of))

    def refork(self, name: str, of: str = MAIN) -> None:
        """Move a branch without commits of its own to the head of another; others keep their start."""
        self.head(name)
        if self._one(self.commits.where(F.col("branch") == name)) is None:
            self._place(name, self.head(of))

    def _place(self, name: str, start: int | None) -> None:
        if start is None:
            raise ValueError("there is no version to start a branch at")
        change = self._stored("branches", BRANCHES).count()
        self.spark.createDataFrame([(name, start, change)], BRANCHES).coalesce(1).write.mode("append").parquet(f"{self.folder}/branches")

    # Reads

    def _range(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.ranges)).cast("int")

    def read(
        self, version: int | None = None, branch: str = MAIN, columns: Sequence[str] | None = None, ranges: Sequence[int] | None = None
    ) -> DataFrame:
        """The table at a version, or at the head of a branch; a table without commits has no rows.

        With ``ranges`` only keys in these, and only their part of the stored state is scanned.
        """
        wanted = self.columns if columns is None else list(columns)
        version = self.head(branch) if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self.schema).select(*self.keys, *wanted)
        bottom, later = self._layers(version, ranges)
        if later is None:
            return bottom.select(*self.keys, *wanted)
        last = self._last(later, ranges).where(F.col(OP) != "D").select(*self.keys, *wanted)
        if bottom is None:
            return last
        above = self._newest(later, ranges).alias("n")
        return bottom.select(*self.keys, *wanted).alias("s").join(above, _on(self.keys, "s", "n"), "left_anti").unionByName(last)

    def _layers(self, version: int, ranges: Sequence[int] | None = None) -> tuple[DataFrame | None, list[int] | DataFrame | None]:
        """What a version is made of: the rows at the bottom, a stored state or the oldest version, and the versions above, if any."""
        state, after = self._parts(version)
        if state is not None:
            return self._state(state, ranges), after if not isinstance(after, list) or after else None
        if not isinstance(after, list):
            return None, after
        oldest, *later = sorted(after)
        return self._in(self._changes([oldest]), ranges).where(F.col(OP) != "D"), later or None

    def _in(self, rows: DataFrame, ranges: Sequence[int] | None) -> DataFrame:
        return rows if ranges is None else rows.where(self._range().isin(list(ranges)))

    def _newest(self, versions: list[int] | DataFrame, ranges: Sequence[int] | None = None) -> DataFrame:
        """The keys in change rows of some versions, each with its newest one; of a single version as they come."""
        rows = self._in(self._changes(versions), ranges).select(*self.keys, VERSION)
        single = isinstance(versions, list) and len(versions) == 1
        return rows if single else rows.groupBy(*self.keys).agg(F.max(VERSION).alias(VERSION))

    def _last(self, versions: list[int] | DataFrame, ranges: Sequence[int] | None = None) -> DataFrame:
        """The change rows of some versions that no later one of them replaces. One version has no others to be joined with."""
        rows = self._in(self._changes(versions), ranges)
        if isinstance(versions, list) and len(versions) == 1:
            return rows
        # Not an equation of versions, so that rows are dealt by their keys alone, as later joins want them.
        newest = _on(self.keys, "r", "n") & (F.col(f"r.{VERSION}") >= F.col(f"n.{VERSION}"))
        return rows.alias("r").join(self._newest(versions, ranges).alias("n"), newest, "left_semi")

    def read_first(self, branch: str = MAIN) -> DataFrame:
        """The table at the oldest version of a branch's line."""
        oldest = self._line(self.head(branch)).agg(F.min("version")).first()[0]
        return self.read(oldest, branch)

    def version_at(self, ts: datetime | str, branch: str = MAIN) -> int:
        """The newest version of a branch's line at a time; a time before the first is an error."""
        found = self._line(self.head(branch)).where(F.col("ts") <= F.lit(_moment(ts)).cast("timestamp_ntz")).agg(F.max("version")).first()[0]
        if found is None:
            raise ValueError(f"no version at {ts} or before")
        return found

    def read_at(self, ts: datetime | str, branch: str = MAIN) -> DataFrame:
        return self.read(self.version_at(ts, branch))

    def _parts(self, version: int) -> tuple[int | None, list[int] | DataFrame]:
        """The newest stored state of a version's line, and the versions after it."""
        line = self._line(version)
        states = self._stored("state_list", "version long")
        state = line.join(states, "version").agg(F.max("version")).first()[0]
        after = line.where(F.col("version") > (state if state is not None else -1)).select("version")
        few = [r["version"] for r in after.limit(MAX_NAMED + 1).collect()]
        return state, few if len(few) <= MAX_NAMED else after

    def _changes(self, versions: list[int] | DataFrame) -> DataFrame:
        if isinstance(versions, list):
            return self.log.where(F.col(VERSION).isin(versions)) if versions else self.log.where(F.lit(False))
        return self.log.join(versions.withColumnRenamed("version", VERSION), VERSION, "left_semi")

    def _state(self, version: int, ranges: Sequence[int] | None = None) -> DataFrame:
        rows = self._stored("states", f"{self.schema}, _state long, _range int").where(F.col("_state") == version)
        return (rows if ranges is None else rows.where(F.col("_range").isin(list(ranges)))).drop("_state", "_range")

    def store_state(self, version: int) -> None:
        """Keep the whole table at a version, so that later reads start from it, with a digest of each range of keys."""
        state, after = self._parts(version)
        rows = self._changes(after).select(*self.keys, *self.columns, OP, VERSION)
        if state is not None:
            rows = rows.unionByName(self._state(state).withColumns({OP: F.lit("I"), VERSION: F.lit(-1).cast("long")}))
        # Rows move once, by parts of ranges: the newest of each key is found where its file is written.
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.ranges)
        dealt = rows.withColumns({"_range": self._range(), "_part": F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(parts))}).repartition("_range", "_part")
        newest = F.max(VERSION).over(Window.partitionBy("_range", "_part", *self.keys))
        alive = dealt.withColumn("_newest", newest).where((F.col(VERSION) == F.col("_newest")) & (F.col(OP) != "D"))
        alive = alive.select(*self.keys, *self.columns, "_range")
        alive.write.mode("overwrite").partitionBy("_range").parquet(f"{self.folder}/states/_state={version}")
        written = self._stored("states", f"{self.schema}, _state long, _range int").where(F.col("_state") == version)
        h = F.xxhash64(*self.keys, *self.columns)
        digests = written.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(20,0)")).alias("total"))
        digests.write.mode("overwrite").parquet(f"{self.folder}/digests/_state={version}")
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.folder}/state_list")

    def digests(self, version: int) -> DataFrame:
        """(_range, n, mixed, total) of a version; its state is stored first if it is not."""
        self.commit_at(version)
        if self._one(self._stored("state_list", "version long").where(F.col("version") == version)) is None:
            self.store_state(version)
        rows = self._stored("digests", "_range int, n long, mixed long, total decimal(30,0), _state long")
        return rows.where(F.col("_state") == version).drop("_state")

    # Comparing versions

    def _lines(self, versions: Sequence[int]) -> dict[int, dict[str, int]]:
        """The lines of some versions, all in one job."""
        rows = self.commits.where(F.col("version").isin(list(versions))).select("version", "line").collect()
        found = {r["version"]: r["line"] for r in rows}
        for version in versions:
            if version not in found:
                raise ValueError(f"unknown version {version}")
        return found

    def _between(self, first: Mapping[str, int], second: Mapping[str, int]) -> DataFrame | list[int]:
        """The versions that one of two lines has and the other has not."""
        if first == second:
            return []
        rows = self.commits.where(self._within(first) != self._within(second)).select("version")
        few = sorted(r["version"] for r in rows.limit(MAX_NAMED + 1).collect())
        return few if len(few) <= MAX_NAMED else rows

    def _sides(self, versions: Mapping[str, int], old: int, new: int) -> DataFrame:
        """Per key that changed between two versions, a struct of the data columns at each of ``versions``, null where the key is not there.

        The first of ``versions`` is ``old``, the common past of the others, where it is on their lines: they are then
        looked up in the change rows since, and below these in the layers of the first, whose exchanges are made once.
        """
        lines = self._lines([*versions.values()])
        between = self._between(lines[old], lines[new])
        changed = self._changes(between)
        found = sorted(r["r"] for r in changed.select(self._range().alias("r")).distinct().collect())  # at most ``ranges``
        ranges = found if len(found) < self.ranges else None
        out, below = changed.select(*self.keys).distinct(), self._stack(old, ranges)
        for name, version in versions.items():
            after_old = all(lines[version].get(b, 0) >= v for b, v in lines[old].items())
            since = between if version == new else self._between(lines[old], lines[version]) if after_old else None
            if not after_old or not isinstance(since, list) or len(since) > self.every:
                layers = self._stack(version, ranges)
            elif since and since == between:  # the keys are those of these very change rows
                layers = [self._last(since, ranges)]
            else:
                layers = [*([self._last(since, ranges)] if since else []), *below]
            out = self._looked_up(out, name, layers)
        return out

    def _stack(self, version: int, ranges: Sequence[int] | None) -> list[DataFrame]:
        """Rows in layers, newest first: the last change rows above, which have ``_op``, and the rows at the bottom."""
        bottom, later = self._layers(version, ranges)
        return ([self._last(later, ranges)] if later is not None else []) + ([bottom] if bottom is not None else [])

    def _looked_up(self, out: DataFrame, name: str, layers: Sequence[DataFrame]) -> DataFrame:
        """``out`` with a struct of the data columns from the first layer that has the key; null if that deletes it, or none has it."""
        kept = [F.col(f"k.{c}") for c in out.columns]
        row, is_found = F.lit(None), F.lit(False)
        for layer in layers:
            alive = layer.where(F.col(OP) != "D") if OP in layer.columns else layer
            side = alive.select(*self.keys, F.struct(*self.columns).alias("_row")).alias("s")
            joined = out.withColumns({"_row_above": row, "_found": is_found}).alias("k").join(side, _on(self.keys, "k", "s") & ~F.col("k._found"), "left")
            is_there = F.col("k._found") | F.col("s._row").isNotNull()
            out = joined.select(*kept, F.coalesce("k._row_above", "s._row").alias("_row"), is_there.alias("_found"))
            if OP in layer.columns and layer is not layers[-1]:
                dead = layer.where(F.col(OP) == "D").select(*self.keys).distinct().withColumn("_dead", F.lit(True)).alias("d")
                joined = out.alias("k").join(dead, _on(self.keys, "k", "d"), "left")
                out = joined.select(*kept, "k._row", (F.col("k._found") | F.col("d._dead").isNotNull()).alias("_found"))
            row, is_found = F.col("_row"), F.col("_found")
        return out.select(*[c for c in out.columns if c not in ("_row", "_found")], row.alias(name))

    def _same(self, a: str, b: str) -> Column:
        equal = [F.col(a)[c].eqNullSafe(F.col(b)[c]) for c in self.columns]
        return reduce(Column.__and__, equal, F.col(a).isNull() == F.col(b).isNull())

    def diff(self, old: int, new: int) -> DataFrame:
        """Rows added, removed or changed between two versions of any branches, with old and new values."""
        sides = self._sides({"old": old, "new": new}, old, new)
        change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
        values = [F.col(side)[c].alias(f"{side}_{c}") for side in ("old", "new") for c in self.columns]
        return sides.where(~self._same("old", "new")).select(*self.keys, change.alias("change"), *values)

    def compare(self, version: int, other: VersionedTable, other_version: int) -> DataFrame:
        """Keys whose rows differ between this table at a version and another table at one, with both rows (``mine``, ``theirs``).

        Both have the same columns, keys and ranges. Digests are compared first, and only ranges that differ are read.
        """
        if (self.schema, self.keys, self.ranges) != (other.schema, other.keys, other.ranges):
            raise ValueError("tables to compare have the same columns, keys and ranges")
        mine, theirs = self.digests(version), other.digests(other_version)
        met = mine.join(theirs.withColumnsRenamed({c: f"_{c}" for c in ("n", "mixed", "total")}), "_range", "full")
        equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n", "mixed", "total")]
        found = met.where(~reduce(Column.__and__, equal)).select("_range").collect()  # at most ``ranges``
        ranges = sorted(r["_range"] for r in found)
        a = self._state(version, ranges).select(*self.keys, F.struct(*self.columns).alias("mine")).alias("a")
        b = other._state(other_version, ranges).select(*self.keys, F.struct(*self.columns).alias("theirs")).alias("b")
        keys = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in self.keys]
        both = a.join(b, _on(self.keys, "a", "b"), "full").select(*keys, "mine", "theirs")
        return both.where(~self._same("mine", "theirs"))

    def base(self, a: int, b: int) -> int | None:
        """The newest version that two versions both see, merges included; None if there is none."""
        first, second = self.commit_at(a)["sees"], self.commit_at(b)["sees"]
        common = {k: min(first[k], second[k]) for k in first.keys() & second.keys()}
        return self.commits.where(self._within(common)).agg(F.max("version")).first()[0]

    # Writes

    def commit(
        self,
        rows: DataFrame,
        message: str,
        ts: datetime | str,
        branch: str = MAIN,
        expected_head: int | None = None,
        merged: int | None = None,
        checks: Mapping[str, Column] | None = None,
        failing: Callable[[], Sequence[str]] | None = None,
    ) -> int:
        """Write change rows (data columns and ``_op``) as the next version of a branch, and return it.

        Counts, and ``checks`` (aggregates of the change rows that must be true), are observed in the pass that
        writes; ``failing`` names what else failed in it. A check that fails leaves no commit. ``expected_head``
        refuses a branch that has moved.
        """
        own, last = self.commits.agg(F.max(F.when(F.col("branch") == branch, F.col("version"))), F.max("version")).first()
        parent = own if own is not None else self.head(branch)
        if expected_head is not None and parent != expected_head:
            raise ValueError(f"{branch} is not at version {expected_head}")
        version = (last or 0) + 1
        seen = Observation()
        ops = [F.count_if(F.col(OP) == op).alias(op) for op in "IUD"]
        tests = _tests(checks)
        shaped = self.spark.createDataFrame([], f"{self.schema}, {OP} string").schema
        written = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shaped.fields])
        written = written.observe(seen, F.count(F.lit(1)).alias("n"), *ops, *tests)
        written.write.mode("overwrite").parquet(f"{self.folder}/log/{VERSION}={version}")
        found = dict.fromkeys(("n", "I", "U", "D"), 0) | observed_values(seen)
        failed = [*_failed(checks, found), *(failing() if failing else ())]
        if failed:
            raise CheckFailed(f"not committed: {', '.join(failed)}")
        before = self.commit_at(parent) if parent is not None else None
        line = _later(before["line"] if before else {}, {branch: version})
        sees = _later(_later(before["sees"] if before else {}, {branch: version}), self.commit_at(merged)["sees"] if merged is not None else {})
        since = (before["since"] if before else 0) + 1
        full = since >= self.every
        counts = (found["n"], found["I"], found["U"], found["D"])
        row = (version, branch, parent, merged, _moment(ts), message, *counts, line, sees, 0 if full else since)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        if full:
            self.store_state(version)
        return version

    def update(self, where: Column | str, assign: Mapping[str, Column], message: str, ts: datetime | str, branch: str = MAIN) -> int:
        """``UPDATE … SET … WHERE`` on one branch. A key cannot be assigned."""
        if set(assign) & set(self.keys):
            raise ValueError(f"keys cannot be assigned: {sorted(set(assign) & set(self.keys))}")
        return self.commit(self.read(branch=branch).where(where).withColumns({**assign, OP: F.lit("U")}), message, ts, branch)

    def delete(self, where: Column | str, message: str, ts: datetime | str, branch: str = MAIN) -> int:
        """``DELETE … WHERE`` on one branch."""
        return self.commit(self.read(branch=branch).where(where).withColumn(OP, F.lit("D")), message, ts, branch)

    def replace(self, table: DataFrame, message: str, ts: datetime | str, branch: str = MAIN, checks: Mapping[str, Column] | None = None) -> int:
        """Make a branch hold exactly ``table``, by the rows that differ. Two rows of a key fail the write.

        ``checks`` are aggregates of the whole of ``table``, observed as its rows go by in the same pass.
        """
        seen = Observation()
        if checks:
            table = table.observe(seen, *_tests(checks))
        marked = self.read(branch=branch).withColumn("side", F.lit(0)).unionByName(table.select(*self.keys, *self.columns).withColumn("side", F.lit(1)))
        row = F.struct(*self.columns)
        # Keys hardly repeat, so rows are moved as they are, and not as wider partial aggregates.
        sides = marked.repartition(*self.keys).groupBy(*self.keys).agg(
            F.count_if(F.col("side") == 1).alias("times"),
            F.any_value(F.when(F.col("side") == 0, row), True).alias("old"),
            F.any_value(F.when(F.col("side") == 1, row), True).alias("new"),
        )
        twice = F.raise_error(F.lit("a key has more than one row")).cast("boolean")
        once = sides.where(F.when(F.col("times") > 1, twice).otherwise(F.lit(True)))
        failing = (lambda: _failed(checks, observed_values(seen))) if checks else None
        return self.commit(self._turned(once, "old", "new"), message, ts, branch, failing=failing)

    def _turned(self, sides: DataFrame, old: str, new: str) -> DataFrame:
        """Change rows that turn one side into another; a deletion carries what it removes."""
        op = F.when(F.col(new).isNull(), "D").when(F.col(old).isNull(), "I").otherwise("U")
        values = [F.coalesce(F.col(new), F.col(old))[c].alias(c) for c in self.columns]
        return sides.where(~self._same(old, new)).select(*self.keys, *values, op.alias(OP))

    def rollback(self, version: int, message: str, ts: datetime | str, branch: str = MAIN) -> int:
        """Bring a branch back to what it, or any branch, was at a version, as a new commit."""
        now = self.head(branch)
        sides = self._sides({"then": version, "now": now}, version, now)
        return self.commit(self._turned(sides, "now", "then"), message, ts, branch, expected_head=now)

    def merge_sides(self, source: str, target: str) -> DataFrame:
        """Base, source and target of every key that the source changed since the base, and whether it conflicts."""
        theirs, ours = self.head(source), self.head(target)
        base = self.base(theirs, ours)
        if base is None:
            raise ValueError(f"{source} and {target} have no version in common")
        sides = self._sides({"base": base, "source": theirs, "target": ours}, base, theirs)
        changed = sides.where(~self._same("base", "source") & ~self._same("source", "target"))
        return changed.withColumn("is_conflict", ~self._same("base", "target"))

    def conflicts(self, source: str, target: str) -> DataFrame:
        """Keys that both branches changed differently since their base, with the three rows."""

        def kind(side: str) -> Column:
            return F.when(F.col(side).isNull(), "delete").when(F.col("base").isNull(), "insert").otherwise("update")

        rows = [F.col(s)[c].alias(f"{s}_{c}") for s in ("base", "source", "target") for c in self.columns]
        both = [kind("source").alias("source_change"), kind("target").alias("target_change")]
        return self.merge_sides(source, target).where("is_conflict").select(*self.keys, *both, *rows)

    def merge(self, source: str, target: str, message: str, ts: datetime | str, on_conflict: str = "fail", expected_head: int | None = None) -> int:
        """Apply to ``target`` what ``source`` changed since the newest version both see; the source stays as it is.

        ``on_conflict``: ``fail``, or take the ``source`` or the ``target`` row. Rows are merged one by one.
        """
        if on_conflict not in ("fail", "source", "target"):
            raise ValueError(f"on_conflict is {on_conflict!r}, not fail, source or target")
        sides = self.merge_sides(source, target)
        if on_conflict == "fail":
            wrong = F.raise_error(F.lit(f"conflict between {source} and {target}")).cast("boolean")
            sides = sides.where(F.when(F.col("is_conflict"), wrong).otherwise(F.lit(True)))
        elif on_conflict == "target":
            sides = sides.where(~F.col("is_conflict"))
        rows = self._turned(sides, "target", "source")
        return self.commit(rows, message, ts, target, expected_head, merged=self.head(source))
