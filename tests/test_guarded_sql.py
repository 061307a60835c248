from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from ledgerlake.operators.guarded_sql import run_guarded_sql


@pytest.fixture
def offered(spark, people):
    people.write.mode("overwrite").saveAsTable("secret_people")
    return {"people_view": people}


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT upper(name) AS n FROM people_view",
        "SELECT name FROM people_view ORDER BY name; ",
        "WITH a AS (SELECT * FROM people_view), b AS (SELECT * FROM a) SELECT count(*) FROM b",
        "SELECT name FROM PEOPLE_VIEW WHERE id IN (SELECT max(id) FROM people_view) -- done",
        "SELECT 1 AS one",
        "SELECT 'reflect(x)' AS t, 'it''s secret_people' AS u FROM people_view",
    ],
)
def test_allowed(spark, offered, sql):
    assert run_guarded_sql(spark, sql, offered, 100).count() >= 1


def test_row_limit(spark, offered):
    assert run_guarded_sql(spark, "SELECT * FROM people_view", offered, 4).count() == 4


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT * FROM secret_people",
        "SELECT * FROM people_view WHERE id IN (SELECT id FROM secret_people)",
        "SELECT (SELECT max(name) FROM default.secret_people) AS n FROM people_view",
        "WITH x AS (SELECT * FROM secret_people) SELECT * FROM x",
        "WITH secret_people AS (SELECT * FROM secret_people) SELECT * FROM secret_people",
        "SELECT * FROM people_view UNION ALL SELECT * FROM spark_catalog.default.secret_people",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/part.parquet`",
        "SELECT * FROM identifier('secret_people')",
        "SELECT * FROM range(10)",
        "SELECT reflect('java.lang.System', 'getenv', 'HOME') AS h",
        "SELECT java_method('java.util.UUID', 'randomUUID') AS h",
        "SELECT 1) UNION ALL SELECT name FROM (SELECT name FROM secret_people",
        "DROP TABLE secret_people",
        "INSERT INTO secret_people SELECT * FROM people_view",
        "SELECT 1; DROP TABLE secret_people",
        "SELECT " + "1 AS a, " * 30 + "REFLECT('java.lang.System', 'getenv', 'HOME') AS h",
        "SELECT `reflect`('java.lang.System', 'getenv', 'HOME') AS h",
        "SELECT try_reflect('java.lang.System', 'getenv', 'HOME') AS h",
        "SELECT no_such_column FROM people_view",
        "",
    ],
)
def test_refused(spark, offered, sql):
    with pytest.raises(Exception):
        run_guarded_sql(spark, sql, offered, 10)
    assert spark.table("secret_people").count() == 15


def test_the_session_keeps_its_own_views(spark, offered):
    spark.range(3).createOrReplaceTempView("people_view")
    frame = run_guarded_sql(spark, "SELECT count(*) AS n FROM people_view", offered, 10)
    assert spark.table("people_view").count() == 3
    assert frame.first()["n"] == 15
    spark.catalog.dropTempView("people_view")
    run_guarded_sql(spark, "SELECT 1 AS one", offered, 10)
    assert not spark.catalog.tableExists("people_view")


def test_qualified_names(spark, offered):
    people = offered["people_view"]
    spark.sql("CREATE DATABASE IF NOT EXISTS hidden_ns")
    people.write.mode("overwrite").saveAsTable("hidden_ns.people")
    tables = {"bronze.people": people.where("id <= 5"), "lake.silver.people": people, "lake.silver.teams": people}
    sql = """
        SELECT b.id, lake.silver.teams.name, 'bronze.people' AS t -- bronze.people
        FROM Bronze.`people` b JOIN lake.silver.teams ON b.id = teams.id
        WHERE b.id IN (SELECT id FROM lake . silver . people)"""
    rows = run_guarded_sql(spark, sql, tables, 100).collect()
    assert len(rows) == 5 and {r["t"] for r in rows} == {"bronze.people"}
    for other in ("hidden_ns.people", "lake.hidden_ns.people", "spark_catalog.hidden_ns.people"):
        with pytest.raises(Exception):
            run_guarded_sql(spark, f"SELECT * FROM {other}", tables, 10)
    assert not spark.catalog.tableExists("teams")


def test_calls_at_once_keep_apart(spark, people):
    def count(n):
        tables = {"bronze.people": people.where(f"id <= {n}")}
        return run_guarded_sql(spark, "SELECT count(*) AS n FROM bronze.people", tables, 10).first()["n"]

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(count, range(1, 13))) == list(range(1, 13))
