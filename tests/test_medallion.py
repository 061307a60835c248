from __future__ import annotations

import uuid

import pytest
from people import PEOPLE_SCHEMA
from pyspark.sql import functions as F

from ledgerlake.operators import changelog as L
from ledgerlake.operators.embedding import embedder
from ledgerlake.plans import medallion as M
from ledgerlake.sources import files

TS = "2024-01-01 00:00:00"


def test_upper_names(spark):
    frame = spark.createDataFrame([(1, "mara"), (2, "ivo")], "id BIGINT, name STRING")
    silver = M.bronze_to_silver(frame)
    assert [r["name_upper"] for r in silver.orderBy("id").collect()] == ["MARA", "IVO"]
    assert "ingestion_ts" in silver.columns


def test_gold(people):
    gold = M.silver_to_gold(M.bronze_to_silver(people, TS), "nightly")
    assert gold.count() == 15
    assert {r["record_source"] for r in gold.collect()} == {"nightly"}


@pytest.fixture
def csv(people, tmp_path):
    path = str(tmp_path / "people.csv")
    files.write_csv(people, path)
    return path


def run(spark, csv, tmp_path, **options):
    prefix = f"n{uuid.uuid4().hex}_"
    return prefix, M.run_layers(spark, csv, ts=TS, prefix=prefix, path=str(tmp_path / "w"), embed=embedder(16), **options)


def test_all_layers(spark, csv, tmp_path):
    _, written = run(spark, csv, tmp_path)
    assert {k: v.count() for k, v in written.items()} == {
        "bronze": 15, "silver": 15, "silver_by_initial": 15, "gold": 15, "enriched": 15
    }
    silver, initial = written["silver"], written["silver_by_initial"]
    assert silver.select("ingestion_ts").distinct().collect() == initial.select("ingestion_ts").distinct().collect()
    assert initial.where("name_initial <> upper(substr(name, 1, 1))").count() == 0
    assert written["enriched"].where("size(embedding) = 16").count() == 15


def test_up_to_a_layer_and_only_one(spark, csv, tmp_path):
    prefix, written = run(spark, csv, tmp_path, upto="silver")
    assert set(written) == {"bronze", "silver", "silver_by_initial"}
    only = M.run_layers(spark, csv, only="gold", prefix=prefix, path=str(tmp_path / "w"))
    assert set(only) == {"gold"} and only["gold"].count() == 15
    with pytest.raises(ValueError, match="layers are"):
        M.run_layers(spark, csv, upto="platinum")


def test_steps_take_a_stream(spark, csv, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = spark.readStream.schema(PEOPLE_SCHEMA).option("header", True).csv(csv)
    gold = M.silver_to_gold(M.silver_by_initial(M.bronze_to_silver(stream)))
    query = gold.writeStream.option("checkpointLocation", state).trigger(availableNow=True).start(out, "parquet")
    query.awaitTermination(60)
    got = spark.read.parquet(out)
    assert got.count() == 15 and "record_source" in got.columns


@pytest.fixture
def branch(spark):
    schema = "id INT, name STRING, _branch STRING, _version BIGINT, _ts TIMESTAMP, _op STRING, _message STRING"

    def row(i, name, branch, version, op):
        return (i, name, branch, version, None, op, "m")

    bronze = spark.createDataFrame(
        [row(1, "ana", "main", 1, "I"), row(2, "bea", "main", 1, "I"), row(1, "ana dev", "dev", 2, "U"), row(3, "cid", "dev", 2, "I"), row(2, None, "dev", 3, "D")],
        schema,
    )
    silver = bronze.where("_version = 1").withColumn("name_upper", F.upper("name"))
    forks = spark.createDataFrame([("dev", 1)], "branch STRING, fork_version BIGINT")
    return bronze, silver, forks


def etl(branch, **options):
    bronze, silver, forks = branch
    return silver, M.etl_on_branch(
        bronze, silver, ["id"], "dev", forks, lambda df: df.withColumn("name_upper", F.upper("name")),
        L.Commit(4, TS, "etl"), L.Commit(5, TS, "merge"), **options,
    )


def test_etl_on_a_branch_is_merged_after_its_checks(branch):
    silver, result = etl(branch)
    assert all(r["passed"] for r in result.checks.collect())
    log = silver.unionByName(result.changes)
    assert L.read_branch(log, ["id"]).count() == 2
    merged = L.read_branch(log.unionByName(result.merge.changes), ["id"])
    assert sorted(map(tuple, merged.collect())) == [(1, "ana dev", "ANA DEV"), (3, "cid", "CID")]


def test_etl_with_a_failed_check_does_not_merge(branch):
    _, result = etl(branch, min_rows=100)
    with pytest.raises(Exception, match="a check of branch dev did not pass"):
        result.merge.changes.collect()


def test_the_enriched_layer_needs_embed(spark):
    for options in ({"only": "enriched"}, {"upto": "enriched"}):
        with pytest.raises(ValueError, match="embed"):
            M.run_layers(spark, "none.csv", **options)
