"""Plans that must hold at any size: what is pruned, what is shuffled, and what never appears."""

from __future__ import annotations

import re

import pytest
from people import plan_of
from pyspark.sql import functions as F

from ledgerlake.queries import QUERIES
from ledgerlake.operators import changelog as L
from ledgerlake.operators import sections as S
from ledgerlake.plans.index import build_index

FOLDER = "/root/testdata/sf0.001"
KEY = ["o_orderkey"]


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    """A log as it should be stored: a partition per branch and version."""
    from ledgerlake.queries.versions import orders_log

    path = str(tmp_path_factory.mktemp("log") / "log")
    log = orders_log(spark, FOLDER)
    log.write.partitionBy(L.BRANCH, L.VERSION).parquet(path)
    return spark.read.schema(log.schema).parquet(path)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert "Exchange SinglePartition" not in re.sub(r"Subquery.*", "", plan, flags=re.S) or name in {
        "layer_checks",
        "guarded_sql",
    }


def test_version_reads_prune_partitions_and_columns(stored_log):
    plan = plan_of(L.as_of_version(stored_log, KEY, 2, columns=["o_orderstatus"]))
    partition = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "_branch" in partition and "_version" in partition
    assert "o_totalprice" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_branch_reads_skip_other_branches(spark, stored_log):
    forks = spark.sql("SELECT 'dev' AS branch, 2L AS fork_version")
    plan = plan_of(L.read_branch(stored_log, KEY, "dev", forks))
    partition = plan[plan.index("PartitionFilters: [") :][:300]
    assert "_branch" in partition and "dev" in partition


def test_folds_combine_before_the_shuffle(stored_log):
    plan = plan_of(L.read_branch(stored_log, KEY))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "partial_max_by" in before_shuffle


def test_a_diff_is_one_aggregate(stored_log):
    plan = plan_of(L.diff_versions(stored_log, KEY, 1, 5))
    assert plan.count("final_max_by") == 0 and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_indexing_never_shuffles(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        F.col("source").alias("source_path"), "text"
    )
    assert "Exchange" not in plan_of(S.chunk_documents(docs))
    assert "Exchange" not in plan_of(build_index(docs))


def test_sections_do_not_carry_whole_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        F.col("source").alias("source_path"), "text"
    )
    generate = re.search(r"Generate posexplode\(.*\), \[([^\]]*)\], false", plan_of(S.split_sections(docs)), re.S)
    assert "text" not in generate.group(1)


def test_retrieval_ranks_on_the_map_side(spark):
    plan = plan_of(QUERIES["retrieve_top3"](spark, FOLDER))
    mapped = plan[plan.index("MapInArrow") - 2000 : plan.index("MapInArrow")]
    assert "WindowGroupLimit" in mapped and "Partial" in mapped
    for name in ("grounded_prompts", "retrieve_grid"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        for node in re.findall(r"(?:MapInArrow best_of_task|FlatMapCoGroupsInArrow)[^\n]*", plan):
            assert "chunk_text" not in node and "embedding" in node
    plan = plan_of(QUERIES["retrieve_one"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan
    plan = plan_of(QUERIES["top_department_countries"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan
