"""Bronze, silver and gold tables of people-like data, on a table or on a branch of a change log.

The steps are row-wise, so none of them shuffles, and they take streaming frames as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import with_ingestion_ts, with_initial, with_record_source, with_upper
from ..operators.changelog import (
    MAIN,
    Commit,
    Merge,
    merge_branch,
    read_branch,
    replace_on_branch,
)
from ..operators.checks import check_table
from ..operators.history import VersionedTable
from ..sources.files import read_csv
from ..sources.tables import ensure_namespace, replace_table
from .ledger import Ledger, digest, key_of_files

LAYERS = ("bronze", "silver", "gold", "enriched")
PEOPLE_SCHEMA = "id INT, name STRING, bio STRING, department STRING, country STRING"
RECORD_SOURCE = "ledgerlake"


def bronze_to_silver(
    bronze: DataFrame, ts: Column | datetime | str | None = None, name: str = "name"
) -> DataFrame:
    """Bronze with ``name_upper`` and ``ingestion_ts``."""
    return with_ingestion_ts(with_upper(bronze, name, "name_upper"), ts)


def silver_by_initial(silver: DataFrame, name: str = "name") -> DataFrame:
    """Silver with ``name_initial``, to be written partitioned by it."""
    return with_initial(silver, name)


def silver_to_gold(silver: DataFrame, source: str = RECORD_SOURCE) -> DataFrame:
    return with_record_source(silver, source)


def enrich(
    bronze: DataFrame, embed: Callable[[DataFrame, str], DataFrame], text: str = "bio"
) -> DataFrame:
    """Bronze with a vector of its text column; the text carries the meaning, not the name."""
    return embed(bronze, text)


def run_layers(
    spark: SparkSession,
    csv_path: str,
    upto: str | None = None,
    ts: Column | datetime | str | None = None,
    embed: Callable[[DataFrame, str], DataFrame] | None = None,
    only: str | None = None,
    schema: str = PEOPLE_SCHEMA,
    prefix: str = "",
    path: str | None = None,
    ledger: Ledger | None = None,
    embed_version: str = "",
) -> dict[str, DataFrame]:
    """Write the layers as tables in order, up to one of them; or ``only`` that one.

    Each layer reads the stored table of the layer before, not its lineage, so nothing is worked
    out twice and a lost executor costs one layer at most. ``prefix`` goes before the namespaces
    and ``path`` is the folder for the files, where the catalog's own is not wanted. With a ``ledger``
    only layers are written whose input, or whose parameters, are not those of the last run; ``embed_version``
    names the model, and a time of ingestion that is not given does not count.
    """
    upto = upto or ("gold" if embed is None else "enriched")
    if embed is None and "enriched" in (upto, only):
        raise ValueError("the enriched layer needs embed")
    if upto not in LAYERS or (only is not None and only not in LAYERS):
        raise ValueError(f"layers are {', '.join(LAYERS)}")
    wanted = [only] if only else LAYERS[: LAYERS.index(upto) + 1]
    written: dict[str, DataFrame] = {}

    keys: dict[str, str] = {}

    def store(layer: str, namespace: str, table: str, df: Callable[[], DataFrame], source: str, *made_with: object, by: list[str] | None = None):
        name = f"{prefix}{namespace}.{table}"

        def write() -> DataFrame:
            ensure_namespace(spark, f"{prefix}{namespace}")
            return replace_table(df(), name, by, f"{path}/{prefix}{namespace}/{table}" if path else None)

        if ledger is None:
            written[layer] = write()
            return
        before = keys.get(source) or ledger.newest().get(f"{prefix}{source}") or key_of_files(spark, source)
        keys[layer] = digest(layer, name, before, *made_with)
        is_there = spark.catalog.tableExists(name)
        written[layer] = ledger.step(f"{prefix}{layer}", keys[layer], write, lambda: spark.table(name), is_there)

    def bronze() -> DataFrame:
        return spark.table(f"{prefix}bronze.people")

    def silver() -> DataFrame:
        return spark.table(f"{prefix}silver.people")

    if "bronze" in wanted:
        store("bronze", "bronze", "people", lambda: read_csv(spark, csv_path, schema), csv_path, schema)
    if "silver" in wanted:
        store("silver", "silver", "people", lambda: bronze_to_silver(bronze(), ts), "bronze", ts)
        by = ["name_initial"]
        store("silver_by_initial", "silver", "people_partitioned", lambda: silver_by_initial(silver()), "silver", by=by)
    if "gold" in wanted:
        store("gold", "gold", "people", lambda: silver_to_gold(silver()), "silver")
    if "enriched" in wanted:
        store("enriched", "silver", "people_embeddings", lambda: enrich(bronze(), embed), "bronze", embed_version)
    return written


@dataclass(frozen=True)
class BranchRun:
    """What an ETL run on a branch leaves: its change rows, its checks, and the merge to ``main``."""

    changes: DataFrame
    checks: DataFrame
    merge: Merge


def etl_on_branch(
    bronze_log: DataFrame,
    silver_log: DataFrame,
    keys: Sequence[str],
    branch: str,
    forks: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    commit: Commit,
    merge_commit: Commit,
    min_rows: int = 1,
    on_conflict: str = "fail",
    expected_head: int | None = None,
    merges: DataFrame | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> BranchRun:
    """Bring silver up to date on a branch, check it there, and merge it into ``main``.

    Reads bronze as the branch sees it, makes the branch's silver equal to ``transform`` of it, and
    checks that state. The merge fails the query if a check does not pass. ``store`` may write the
    change rows and return the stored ones, so that checks and merge do not work them out again.
    To run again on the same branch, hand over ``merges``, the merge points of the runs before.
    """
    silver = transform(read_branch(bronze_log, keys, branch, forks))
    changes = replace_on_branch(silver_log, keys, silver, branch, forks, commit)
    if store is not None:
        changes = store(changes)
    log = silver_log.unionByName(changes)
    checks = check_table(
        read_branch(log, keys, branch, forks), columns=silver.columns, min_rows=min_rows
    )
    failed = F.raise_error(F.lit(f"a check of branch {branch} did not pass")).cast("boolean")
    passed = checks.agg(F.bool_and("passed").alias("ok")).select(
        F.when(F.col("ok"), F.lit(True)).otherwise(failed)
    )
    merge = merge_branch(
        log, keys, branch, MAIN, forks, merge_commit, expected_head, on_conflict, merges=merges
    )
    return BranchRun(changes, checks, replace(merge, changes=merge.changes.where(passed.scalar())))


def etl_on_table_branch(
    bronze: VersionedTable,
    silver: VersionedTable,
    branch: str,
    transform: Callable[[DataFrame], DataFrame],
    ts: datetime | str,
    checks: Mapping[str, Column],
    on_conflict: str = "fail",
    expected_head: int | None = None,
) -> tuple[int, int]:
    """Bring silver up to date on a branch, and merge it into ``main``: the versions of both commits.

    ``checks`` are aggregates of the branch's new silver, observed in the pass that writes its changes; if one does
    not hold there is no commit and no merge. A branch that silver lacks starts at the head of its ``main``.
    """
    silver.create_branch(branch)
    done = silver.replace(transform(bronze.read(branch=branch)), "etl", ts, branch, checks)
    return done, silver.merge(branch, MAIN, "merge", ts, on_conflict, expected_head)
