"""Tables whose columns change, and runs that go on where the last one stopped."""

from __future__ import annotations

import time
import uuid

import pytest
from people import PEOPLE_SCHEMA
from pyspark.sql import functions as F

from ledgerlake.operators.embedding import embedder
from ledgerlake.plans import ledger as G
from ledgerlake.plans import medallion as M
from ledgerlake.sources import files
from ledgerlake.sources.evolving import EvolvingTable


def new(spark, schema="id int, name string, price float"):
    return EvolvingTable.create(spark, f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}", schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_columns_keep_their_values_through_renames_and_swaps(spark):
    t = new(spark, "id int, a string, b string")
    t.append(frame(spark, [(1, "a1", "b1")], "id int, a string, b string"))
    t.rename("a", "x")
    t.rename("b", "a")
    t.rename("x", "b")
    t.append(frame(spark, [("a2", 2, "b2")], "a string, id int, b string"))
    assert t.read().columns == ["id", "b", "a"]
    assert rows(t.read()) == [(1, "a1", "b1"), (2, "b2", "a2")]
    assert rows(t.read(1)) == [(1, "a1", "b1")] and t.read(1).columns == ["id", "a", "b"]


def test_a_dropped_column_does_not_come_back(spark):
    t = new(spark)
    t.append(frame(spark, [(1, "old", 1.5)], "id int, name string, price float"))
    t.drop("name")
    t.add("name", "string")
    t.append(frame(spark, [(2, "new")], "id int, name string"))
    assert rows(t.read().select("id", "name", "price")) == [(1, None, 1.5), (2, "new", None)]
    assert rows(t.read(1)) == [(1, "old", 1.5)]


def test_files_are_read_by_wider_types(spark):
    t = new(spark, "i int, f float, s smallint, d date")
    t.append(spark.sql("SELECT 1 AS i, CAST(0.5 AS float) AS f, CAST(7 AS smallint) AS s, DATE '2024-01-02' AS d"))
    for name, kind in (("i", "bigint"), ("f", "double"), ("s", "int")):
        t.widen(name, kind)
    t.append(spark.sql("SELECT 5000000000 AS i, 1e300 AS f, 70000 AS s, DATE '2024-01-03' AS d"))
    assert [f.dataType.simpleString() for f in t.read().schema.fields] == ["bigint", "double", "int", "date"]
    assert [r[:3] for r in rows(t.read())] == [(1, 0.5, 7), (5000000000, 1e300, 70000)]


def test_wrong_changes_are_refused_and_leave_no_version(spark):
    t = new(spark)
    for wrong in (lambda: t.rename("none", "x"), lambda: t.rename("id", "name"), lambda: t.widen("price", "int"), lambda: t.widen("name", "bigint"),
                  lambda: t.add("id", "int"), lambda: t.drop("none"), lambda: t.read(9), lambda: t.append(spark.sql("SELECT 1 AS other"))):
        with pytest.raises(ValueError):
            wrong()
    assert t.version == 1 and t.read().count() == 0
    with pytest.raises(ValueError):
        EvolvingTable.create(spark, t.folder, "id int")


@pytest.fixture
def csv(people, tmp_path):
    path = str(tmp_path / "people.csv")
    files.write_csv(people, path)
    return path


def run(spark, csv, tmp_path, prefix, **options):
    ledger = G.Ledger(spark, str(tmp_path / "ledger"))
    options = {"embed": embedder(16), "ts": "2024-01-01 00:00:00"} | options
    written = M.run_layers(spark, csv, prefix=prefix, path=str(tmp_path / "w"), ledger=ledger, schema=PEOPLE_SCHEMA, **options)
    return ledger, written


def names(prefix, *layers):
    return [prefix + x for x in layers]


def test_a_second_run_writes_nothing(spark, csv, tmp_path):
    prefix = f"n{uuid.uuid4().hex}_"
    all_ = names(prefix, "bronze", "silver", "silver_by_initial", "gold", "enriched")
    first, written = run(spark, csv, tmp_path, prefix)
    assert first.ran == all_ and not first.skipped
    before = {k: v.inputFiles() for k, v in written.items()}
    second, again = run(spark, csv, tmp_path, prefix)
    assert second.skipped == all_ and not second.ran
    assert {k: v.inputFiles() for k, v in again.items()} == before and again["gold"].count() == 15


def test_changes_run_what_depends_on_them(spark, people, csv, tmp_path):
    prefix = f"n{uuid.uuid4().hex}_"
    run(spark, csv, tmp_path, prefix)
    ledger, _ = run(spark, csv, tmp_path, prefix, embed_version="2")
    assert ledger.ran == names(prefix, "enriched")
    ledger, _ = run(spark, csv, tmp_path, prefix, embed_version="2", ts="2024-02-02 00:00:00")
    assert ledger.ran == names(prefix, "silver", "silver_by_initial", "gold")
    spark.sql(f"DROP TABLE {prefix}gold.people")
    ledger, _ = run(spark, csv, tmp_path, prefix, embed_version="2", ts="2024-02-02 00:00:00")
    assert ledger.ran == names(prefix, "gold")
    time.sleep(1.1)
    files.write_csv(people.where("id < 10"), csv)
    ledger, written = run(spark, csv, tmp_path, prefix, embed_version="2", ts="2024-02-02 00:00:00")
    assert len(ledger.ran) == 5 and written["gold"].count() == 9


def test_a_failed_run_goes_on_where_it_stopped(spark, csv, tmp_path):
    prefix = f"n{uuid.uuid4().hex}_"

    def broken(df, column):
        return df.withColumn("embedding", F.raise_error(F.lit("model is gone")).cast("array<float>"))

    with pytest.raises(Exception, match="model is gone"):
        run(spark, csv, tmp_path, prefix, embed=broken)
    ledger, _ = run(spark, csv, tmp_path, prefix)
    assert ledger.ran == names(prefix, "enriched") and len(ledger.skipped) == 4


def test_keys_of_rows_do_not_depend_on_their_order(spark):
    a = frame(spark, [(1, "x"), (2, None), (2, None)], "id int, name string")
    assert G.key_of_rows(a) == G.key_of_rows(a.repartition(5).orderBy(F.desc("id")))
    assert G.key_of_rows(a) != G.key_of_rows(a.distinct()) != G.key_of_rows(a.limit(0))
