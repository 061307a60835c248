"""Versioned tables as change logs.

A log has the data columns and five more: ``_branch, _version, _ts, _op, _message``. Versions
are unique per commit over all branches. ``main`` is the root; another branch sees the rows of
``main`` up to the version it was forked at (one row ``branch, fork_version`` in ``forks``) and
its own rows after that. The row of a key with the highest version holds, and ``_op = 'D'``
hides the key. Store a log partitioned by ``_branch, _version``, so that reads prune.

How it scales: every read is one scan and one aggregate by key. ``max_by`` combines on the map
side, so a key with very many versions sends one row per task, not its history. Two or three
states of a table (for a diff or a merge) come out of the same single aggregate, not of joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import moment

BRANCH, VERSION, TS, OP, MESSAGE = "_branch", "_version", "_ts", "_op", "_message"
META = (BRANCH, VERSION, TS, OP, MESSAGE)
MAIN = "main"

@dataclass(frozen=True)
class Commit:
    """The version, time and message that a set of change rows is committed under."""

    version: int
    ts: datetime | str
    message: str = ""


@dataclass(frozen=True)
class Merge:
    """Change rows to append to the log, the keys both sides changed differently, and the merge point.

    ``point`` is one row ``source, target, source_version, version`` for the table of merges; append
    it when the change rows are committed.
    """

    changes: DataFrame
    conflicts: DataFrame
    point: DataFrame


def data_columns(log: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in log.columns if c not in META and c not in keys]


def _required(df: DataFrame, value: Column, problem: str) -> Column:
    """``value`` over ``df`` as a scalar; the query fails with ``problem`` if it is null."""
    found = df.agg(value.cast("bigint").alias("value"))
    failed = F.raise_error(F.lit(problem)).cast("bigint")
    return found.select(F.coalesce("value", failed)).scalar()


def _holds(df: DataFrame, condition: Column, problem: str) -> Column:
    """A scalar that is true; the query fails with ``problem`` if an aggregate of ``df`` is not."""
    failed = F.raise_error(F.lit(problem)).cast("boolean")
    found = df.agg(F.coalesce(condition, F.lit(False)).alias("holds"))
    return found.select(F.when(F.col("holds"), F.lit(True)).otherwise(failed)).scalar()


def _has_version(seen: DataFrame, version: int) -> Column:
    """Refuse a version that is not there. Reads no more than its partition of the log."""
    rows = seen.where(F.col(VERSION) == version)
    return _holds(rows, F.count(F.lit(1)) > 0, f"unknown version {version}")


def fork_version(forks: DataFrame, branch: str) -> Column:
    rows = forks.where(F.col("branch") == branch)
    return _required(rows, F.max("fork_version"), f"unknown branch {branch}")


def visible(branch: str, forks: DataFrame | None) -> Column:
    """Condition on log rows: seen from ``branch``."""
    on_main = F.col(BRANCH) == MAIN
    if branch == MAIN:
        return on_main
    if forks is None:
        raise ValueError(f"branch {branch} needs the table of forks")
    own = F.col(BRANCH) == branch
    # The plain condition on the branch comes first so that it prunes partitions.
    return F.col(BRANCH).isin(MAIN, branch) & (
        own | (on_main & (F.col(VERSION) <= fork_version(forks, branch)))
    )


def _seen(log: DataFrame, branch: str, forks: DataFrame | None) -> DataFrame:
    return log.where(visible(branch, forks))


def _latest(log: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> DataFrame:
    wanted = data_columns(log, keys) if columns is None else list(columns)
    row = F.max_by(F.struct(OP, *wanted), VERSION).alias("row")
    live = log.groupBy(*keys).agg(row).where(F.col("row")[OP] != "D")
    return live.select(*keys, *[F.col("row")[c].alias(c) for c in wanted])


# Reads


def commits_of(log: DataFrame) -> DataFrame:
    """One row per commit, with what it changed; a few narrow columns, in one hash aggregate."""

    def changed(op: str) -> Column:
        return F.count_if(F.col(OP) == op)

    return log.groupBy(BRANCH, VERSION, TS, MESSAGE).agg(
        F.count(F.lit(1)).alias("n_rows_changed"),
        changed("I").alias("n_inserted"),
        changed("U").alias("n_updated"),
        changed("D").alias("n_deleted"),
    )


def snapshots(log: DataFrame, branch: str = MAIN, forks: DataFrame | None = None) -> DataFrame:
    """One row per version seen from the branch, oldest first, with what it changed."""
    return commits_of(_seen(log, branch, forks)).drop(BRANCH, MESSAGE).orderBy(VERSION)


def read_branch(
    log: DataFrame,
    keys: Sequence[str],
    branch: str = MAIN,
    forks: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table as it stands on a branch. Name ``columns`` to shuffle no others."""
    return _latest(_seen(log, branch, forks), keys, columns)


def as_of_version(
    log: DataFrame,
    keys: Sequence[str],
    version: int,
    branch: str = MAIN,
    forks: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table at a version; a version the branch does not have fails the query."""
    seen = _seen(log, branch, forks)
    known = _required(
        seen.where(F.col(VERSION) == version), F.max(VERSION), f"unknown version {version}"
    )
    return _latest(seen.where(F.col(VERSION) <= version).where(known.isNotNull()), keys, columns)


def as_of_first(
    log: DataFrame,
    keys: Sequence[str],
    branch: str = MAIN,
    forks: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table at its oldest version."""
    seen = _seen(log, branch, forks)
    oldest = _required(seen, F.min_by(VERSION, F.struct(TS, VERSION)), "the log has no versions")
    return _latest(seen.where(F.col(VERSION) <= oldest), keys, columns)


def as_of_time(
    log: DataFrame,
    keys: Sequence[str],
    ts: datetime | str,
    branch: str = MAIN,
    forks: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table at a point in time; a time before the first version fails the query."""
    limit = moment(ts, log.schema[TS].dataType.simpleString())
    past = _seen(log, branch, forks).where(F.col(TS) <= limit)
    known = _required(past, F.max(VERSION), f"no version at {ts} or before")
    return _latest(past.where(known.isNotNull()), keys, columns)


def branch_heads(log: DataFrame, forks: DataFrame) -> DataFrame:
    """Each branch with its latest version: its own, or the one it was forked at."""
    heads = log.groupBy(F.col(BRANCH).alias("branch")).agg(F.max(VERSION).alias("own"))
    main = forks.sparkSession.sql(f"SELECT '{MAIN}' AS branch, CAST(NULL AS BIGINT) AS fork_version")
    return (
        forks.unionByName(main)
        .join(heads, "branch", "left")
        .select("branch", F.coalesce("own", "fork_version").alias("head_version"))
        .where("head_version IS NOT NULL")
    )


def commit_log(
    log: DataFrame, branch: str = MAIN, forks: DataFrame | None = None, n: int = 3
) -> DataFrame:
    """The last ``n`` commits seen from a branch, newest first."""
    commits = commits_of(_seen(log, branch, forks))
    return commits.select(VERSION, MESSAGE, TS, "n_rows_changed").orderBy(F.desc(VERSION)).limit(n)


# Branches


def create_branch(forks: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """``forks`` with a branch at the head of ``main``. An existing branch stays as it is."""
    head = log.where(F.col(BRANCH) == MAIN).agg(
        F.lit(name).alias("branch"), F.max(VERSION).alias("fork_version")
    )
    return forks.unionByName(head.join(forks, "branch", "left_anti"))


def refork(forks: DataFrame, log: DataFrame, branch: str) -> DataFrame:
    """``forks`` with an empty branch moved to the head of ``main``.

    A branch that has commits of its own keeps its fork.
    """
    own = log.where(F.col(BRANCH) == branch).agg(F.max(VERSION)).scalar()
    head = log.where(F.col(BRANCH) == MAIN).agg(F.max(VERSION)).scalar()
    moved = (F.col("branch") == branch) & own.isNull()
    return forks.withColumn("fork_version", F.when(moved, head).otherwise(F.col("fork_version")))


# Comparing states


def _only_keys(log: DataFrame, keys: Sequence[str], touched: DataFrame) -> DataFrame:
    """Log rows of the touched keys, so that a small change shuffles little of a large table."""
    wanted = touched.select(*[F.col(k).alias(f"_touched_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_touched_{k}")) for k in keys]
    return log.join(wanted, reduce(Column.__and__, same), "left_semi")


def _states(
    log: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    sides: Mapping[str, Column],
    touched: Column,
    once: Column | None = None,
) -> DataFrame:
    """Per touched key, the latest row under each side's condition, in one aggregate.

    More than one row of a key under ``once`` fails the query.

    A side is a struct of the data columns, null where the key is not alive. A fold also gives
    ``sides``' rows for deleted keys as null, so "alive" is simply "not null".
    """
    marked = log.select(
        *keys,
        VERSION,
        F.struct(OP, *columns).alias("row"),
        touched.alias("touched"),
        (F.lit(False) if once is None else once).alias("once"),
        *[F.when(cond, F.col(VERSION)).alias(f"at_{side}") for side, cond in sides.items()],
    )
    folded = marked.groupBy(*keys).agg(
        F.bool_or("touched").alias("touched"),
        F.count_if("once").alias("times"),
        *[F.max_by("row", f"at_{side}").alias(side) for side in sides],
    )

    def alive(side: str) -> Column:
        row = F.col(side)
        return F.when(
            row.isNotNull() & (row[OP] != "D"), F.struct(*[row[c].alias(c) for c in columns])
        ).alias(side)

    if once is not None:
        twice = F.raise_error(F.lit("a key has more than one row")).cast("boolean")
        folded = folded.where(F.when(F.col("times") > 1, twice).otherwise(F.lit(True)))
    return folded.where("touched").select(*keys, *[alive(side) for side in sides])


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    """Both states dead, or both alive with equal values (nulls equal each other)."""
    equal = [F.col(a)[c].eqNullSafe(F.col(b)[c]) for c in columns]
    both = [F.col(a).isNull() == F.col(b).isNull()]
    return reduce(Column.__and__, both + equal)


def _change_rows(
    log: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    before: str,
    after: str,
    branch: str,
    commit: Commit,
) -> DataFrame:
    """Change rows, in the shape of the log, that turn state ``before`` into ``after``.

    A deletion carries the values it removes.
    """
    old, new = F.col(before), F.col(after)
    op = F.when(new.isNull(), "D").when(old.isNull(), "I").otherwise("U")
    values = [F.coalesce(new, old)[c].alias(c) for c in columns]
    rows = states.where(~_same(before, after, columns)).select(*keys, *values, op.alias(OP))
    return _committed(rows, log, branch, commit)


def _committed(rows: DataFrame, log: DataFrame, branch: str, commit: Commit) -> DataFrame:
    """Rows that already have ``_op``, with the other log columns, in the order of the log.

    A version that is not above all versions of the log fails the query: reads would not see it.
    """
    newest = F.coalesce(F.max(VERSION), F.lit(commit.version - 1)) < commit.version
    stale = f"version {commit.version} is not above the latest version of the log"
    return (
        rows.where(_holds(log, newest, stale)).withColumns(
            {
                BRANCH: F.lit(branch),
                VERSION: F.lit(commit.version).cast("bigint"),
                TS: moment(commit.ts, log.schema[TS].dataType.simpleString()),
                MESSAGE: F.lit(commit.message),
            }
        )
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in log.schema.fields])
    )


def diff_versions(
    log: DataFrame,
    keys: Sequence[str],
    old: int,
    new: int,
    branch: str = MAIN,
    forks: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows added, removed or changed between two versions, with old and new values."""
    wanted = data_columns(log, keys) if columns is None else list(columns)
    low, high = min(old, new), max(old, new)
    seen = _seen(log, branch, forks).where(F.col(VERSION) <= high)
    known = _has_version(seen, old) & _has_version(seen, new)
    touched = F.col(VERSION) > low
    states = _states(
        _only_keys(seen, keys, seen.where(touched)).where(known),
        keys,
        wanted,
        {"old": F.col(VERSION) <= old, "new": F.col(VERSION) <= new},
        touched,
    )
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .otherwise("changed")
    )
    return states.where(~_same("old", "new", wanted)).select(
        *keys,
        change.alias("change"),
        *[F.col("old")[c].alias(f"old_{c}") for c in wanted],
        *[F.col("new")[c].alias(f"new_{c}") for c in wanted],
    )


def compare_branches(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    names: tuple[str, str] = ("a", "b"),
) -> DataFrame:
    """Keys present in both tables whose ``columns`` differ; a null differs from a value."""
    left = a.select(*keys, *[F.col(c).alias(f"{c}_{names[0]}") for c in columns])
    right = b.select(*keys, *[F.col(c).alias(f"{c}_{names[1]}") for c in columns])
    equal = [F.col(f"{c}_{names[0]}").eqNullSafe(F.col(f"{c}_{names[1]}")) for c in columns]
    return left.join(right, list(keys), "inner").where(~reduce(Column.__and__, equal))


def compare_branches_of(
    log: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    branches: tuple[str, str],
    forks: DataFrame | None = None,
) -> DataFrame:
    """``compare_branches`` of two branches of one log, in one scan and one aggregate."""
    a, b = branches
    states = _states(
        log.where(visible(a, forks) | visible(b, forks)),
        keys,
        columns,
        {"a": visible(a, forks), "b": visible(b, forks)},
        F.lit(True),
    )
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return states.where(both & ~_same("a", "b", columns)).select(
        *keys,
        *[F.col(side)[c].alias(f"{c}_{name}") for side, name in zip("ab", branches) for c in columns],
    )


# Writing change rows


def update_on_branch(
    log: DataFrame,
    keys: Sequence[str],
    branch: str,
    forks: DataFrame | None,
    where: Column | str,
    assign: Mapping[str, Column],
    commit: Commit,
) -> DataFrame:
    """Change rows of ``UPDATE … SET … WHERE`` on one branch. Other branches do not see them.

    A key cannot be assigned: that would leave the old row and add another one.
    """
    if set(assign) & set(keys):
        raise ValueError(f"keys cannot be assigned: {sorted(set(assign) & set(keys))}")
    rows = read_branch(log, keys, branch, forks).where(where)
    return _committed(rows.withColumns({**assign, OP: F.lit("U")}), log, branch, commit)


def delete_on_branch(
    log: DataFrame,
    keys: Sequence[str],
    branch: str,
    forks: DataFrame | None,
    where: Column | str,
    commit: Commit,
) -> DataFrame:
    """Change rows of ``DELETE … WHERE`` on one branch."""
    rows = read_branch(log, keys, branch, forks).where(where)
    return _committed(rows.withColumn(OP, F.lit("D")), log, branch, commit)


def replace_on_branch(
    log: DataFrame,
    keys: Sequence[str],
    table: DataFrame,
    branch: str,
    forks: DataFrame | None,
    commit: Commit,
) -> DataFrame:
    """Change rows that make the branch hold exactly ``table`` (create or replace).

    The new rows join the aggregate of the log as one more version, so keys that went away,
    came in or changed are found in the same pass. Two rows of one key in ``table`` fail the query.
    """
    columns = data_columns(log, keys)
    current = _seen(log, branch, forks).select(
        *keys, *columns, OP, VERSION, F.lit(False).alias("is_new")
    )
    incoming = table.select(
        *keys,
        *columns,
        F.lit("I").alias(OP),
        F.lit(commit.version).cast("bigint").alias(VERSION),
        F.lit(True).alias("is_new"),
    )
    states = _states(
        current.unionByName(incoming),
        keys,
        columns,
        {"before": ~F.col("is_new"), "after": F.col("is_new")},
        F.lit(True),
        once=F.col("is_new"),
    )
    return _change_rows(log, states, keys, columns, "before", "after", branch, commit)


def rollback_rows(
    log: DataFrame,
    keys: Sequence[str],
    version: int,
    commit: Commit,
    branch: str = MAIN,
    forks: DataFrame | None = None,
) -> DataFrame:
    """Change rows that bring the branch back to an earlier version, as a new commit."""
    columns = data_columns(log, keys)
    seen = _seen(log, branch, forks)
    touched = F.col(VERSION) > version
    states = _states(
        _only_keys(seen, keys, seen.where(touched)).where(_has_version(seen, version)),
        keys,
        columns,
        {"now": F.lit(True), "then": F.col(VERSION) <= version},
        touched,
    )
    return _change_rows(log, states, keys, columns, "now", "then", branch, commit)


def merge_branch(
    log: DataFrame,
    keys: Sequence[str],
    source: str,
    target: str,
    forks: DataFrame,
    commit: Commit,
    expected_head: int | None = None,
    on_conflict: str = "fail",
    merged_upto: int | None = None,
    merges: DataFrame | None = None,
) -> Merge:
    """Apply to ``target`` what ``source`` changed since their common ancestor.

    The ancestor is ``main`` at the older of the two forks. After an earlier merge of the two branches,
    in either direction, it is what that merge took in: its source at its ``source_version``, found in
    the table ``merges`` of merge points. ``merged_upto`` names the source's version without that table.
    The source stays as it is. With ``expected_head`` the merge is refused if the target has moved past it.

    Rows are merged one by one, which is finer than merging whole tables. A key is a conflict if
    both sides changed it since the ancestor and ended up different; the same change on both sides
    is none. ``on_conflict``: ``fail`` the query, or take the ``source`` or the ``target`` row.
    """
    if on_conflict not in ("fail", "source", "target"):
        raise ValueError(f"on_conflict is {on_conflict!r}, not fail, source or target")
    columns = data_columns(log, keys)
    forked = [fork_version(forks, b) for b in (source, target) if b != MAIN]
    ancestor = F.least(*forked) if len(forked) > 1 else forked[0]
    in_source, in_target = F.col("in_source"), F.col("in_target")
    base, touched = in_source & (F.col(VERSION) <= ancestor), in_source & (F.col(VERSION) > ancestor)
    if merged_upto is not None:
        upto = F.lit(merged_upto).cast("bigint")
        base, touched = in_source & (F.col(VERSION) <= upto), in_source & (F.col(VERSION) > upto)
    elif merges is not None:
        between = merges.where(F.col("source").isin(source, target) & F.col("target").isin(source, target))
        took = F.max_by(F.struct("source", "source_version"), "version").alias("took")
        # An aggregate gives a row, with a null, where the branches were never merged.
        last = between.agg(took).scalar()
        upto, forward = F.col(VERSION) <= last["source_version"], last["source"] == source
        base = F.when(last.isNull(), base).when(forward, in_source & upto).otherwise(in_target & upto)
        touched = F.when(last.isNotNull() & forward, in_source & ~upto).otherwise(touched)

    seen = log.where(F.col(BRANCH).isin(MAIN, source, target))
    if expected_head is not None:
        moved = f"{target} is not at version {expected_head}"
        head = F.max(VERSION) == expected_head
        seen = seen.where(_holds(_seen(log, target, forks), head, moved))
    marked = seen.select(
        *keys,
        *columns,
        OP,
        VERSION,
        visible(source, forks).alias("in_source"),
        visible(target, forks).alias("in_target"),
    ).select("*", F.coalesce(base, F.lit(False)).alias("is_base"), touched.alias("is_touched"))
    states = _states(
        _only_keys(marked, keys, marked.where("is_touched")),
        keys,
        columns,
        {"base": F.col("is_base"), "source": in_source, "target": in_target},
        F.col("is_touched"),
    )
    is_changed = ~_same("base", "source", columns) & ~_same("source", "target", columns)
    is_conflict = is_changed & ~_same("base", "target", columns)
    if on_conflict == "fail":
        # One expression, so that no other order of conditions can raise for an unchanged key.
        wrong = F.raise_error(F.lit(f"conflict between {source} and {target}")).cast("boolean")
        applied = states.where(F.when(is_conflict, wrong).otherwise(is_changed))
    elif on_conflict == "target":
        applied = states.where(is_changed & ~is_conflict)
    else:
        applied = states.where(is_changed)

    def kind(side: str) -> Column:
        gone, born = F.col(side).isNull(), F.col("base").isNull()
        return F.when(gone, "delete").when(born, "insert").otherwise("update")

    conflicts = states.where(is_conflict).select(
        *keys,
        kind("source").alias("source_change"),
        kind("target").alias("target_change"),
        *[F.col(s)[c].alias(f"{s}_{c}") for s in ("base", "source", "target") for c in columns],
    )
    rows = _change_rows(log, applied, keys, columns, "target", "source", target, commit)
    point = _seen(log, source, forks).agg(
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        F.max(VERSION).alias("source_version"),
        F.lit(commit.version).cast("bigint").alias("version"),
    )
    return Merge(rows, conflicts, point)
