from __future__ import annotations

import uuid

import pytest
from people import PEOPLE, PEOPLE_SCHEMA, plan_of
from pyspark.sql import functions as F

from ledgerlake import workspace
from ledgerlake.operators.checks import check_table, top_groups
from ledgerlake.sources import files, tables


def name() -> str:
    return f"t_{uuid.uuid4().hex}"


def test_csv_with_and_without_schema(spark, people, tmp_path):
    path = str(tmp_path / "people")
    files.write_csv(people, path)
    assert files.read_csv(spark, path, PEOPLE_SCHEMA).orderBy("id").collect() == people.collect()
    inferred = files.read_csv(spark, path)
    assert dict(inferred.dtypes)["id"] == "int"
    assert inferred.count() == 15


def test_json_records(spark, tmp_path):
    one_file = tmp_path / "records.json"
    one_file.write_text('[{"id": 1, "embedding": [0.5, 1]}, {"id": 2, "embedding": [2.25, -1.0]}]')
    frame = files.read_json_records(spark, str(one_file))
    assert frame.dtypes == [("embedding", "array<float>"), ("id", "bigint")]
    path = str(tmp_path / "new" / "folder")
    files.write_json(frame, path)
    assert files.read_json_records(spark, path, one_array=False).orderBy("id").collect() == frame.orderBy("id").collect()


def test_documents_whole(spark, tmp_path):
    (tmp_path / "labs").mkdir()
    texts = {"guide.md": "# Guía\n\nuno\r\ndos", "labs/lab one+a.md": "y", "labs/lab-02.md": "x\n"}
    for file, text in texts.items():
        (tmp_path / file).write_bytes(text.encode())
    found = files.read_documents(spark, [str(tmp_path / "guide.md"), str(tmp_path / "labs")])
    assert sorted(r["text"] for r in found.collect()) == sorted(texts.values())
    root = found.where("source_path LIKE '%guide.md'").first()["source_path"].removesuffix("guide.md")
    short = files.read_documents(spark, str(tmp_path), root)
    assert dict(short.collect()) == texts


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.bin").write_bytes(b"1")
    found = files.list_objects(spark, str(tmp_path))
    assert sorted((r["path"].rsplit("/", 1)[1], r["size"]) for r in found.collect()) == [("a.bin", 5), ("b.bin", 1)]
    assert "content" not in plan_of(found)


def test_replace_and_scan(spark, people):
    t = name()
    assert tables.replace_table(people, t).count() == 15
    assert tables.replace_table(people.limit(3), t).count() == 3
    assert spark.table(t).columns == people.columns


def test_partitioned_table_prunes(spark, people, tmp_path):
    stored = tables.replace_table(people, name(), ["country"], str(tmp_path / "p"))
    one = stored.where("country = 'Peru'")
    assert one.count() == people.where("country = 'Peru'").count()
    assert "PartitionFilters: [isnotnull(country" in plan_of(one)
    by_path = files.read_files(spark, str(tmp_path / "p"))
    assert by_path.count() == 15


def test_append_is_strict(spark, people):
    t = name()
    tables.replace_table(people, t)
    more = spark.createDataFrame([(16, "Paula", "b", "E", "Peru"), (17, "Quino", "b", "A", "Chile")], PEOPLE_SCHEMA)
    assert tables.append_rows(more, t).count() == 17
    with pytest.raises(Exception, match="INSERT_COLUMN_ARITY_MISMATCH"):
        tables.append_rows(more.drop("country"), t)
    assert spark.table(t).count() == 17


def test_append_evolving(spark, people):
    t = name()
    tables.replace_table(people, t)
    rows = spark.createDataFrame([(20, "Zoe", 1.5)], "id INT, name STRING, score DOUBLE")
    got = tables.append_evolving(rows, t)
    assert got.columns == [*people.columns, "score"]
    assert got.where("score IS NULL").count() == 15
    assert got.where("id = 20").first()["bio"] is None
    assert tables.append_evolving(rows.drop("score"), t).count() == 17


def test_namespaces_and_tables(spark, people):
    space, t = f"ns_{uuid.uuid4().hex}", name()
    tables.ensure_namespace(spark, space)
    tables.ensure_namespace(spark, space)
    tables.replace_table(people, f"{space}.{t}")
    assert [tuple(r) for r in tables.list_tables(spark, space).collect()] == [(space, t)]
    assert (space, t) in [tuple(r) for r in tables.list_tables(spark).collect()]


def test_conform(spark):
    row = [("c", "p", "t", 0, "x", [1.0, 2.0], "2024-01-01 00:00:00")]
    columns = ["chunk_id", "source_path", "section_title", "chunk_index", "chunk_text", "embedding", "ingestion_ts"]
    got = tables.conform(spark.createDataFrame(row, columns), tables.CHUNK_SCHEMA)
    assert [f.dataType for f in got.schema] == [f.dataType for f in tables.CHUNK_SCHEMA]
    null = spark.createDataFrame([("c", "p", None, 0, "x", [1.0], "2024-01-01")], "chunk_id string, source_path string, section_title string, chunk_index int, chunk_text string, embedding array<double>, ingestion_ts string")
    with pytest.raises(Exception, match="null in section_title"):
        tables.conform(null, tables.CHUNK_SCHEMA).collect()


def test_discover_matches_whole_names(spark):
    u = "0f8fad5b-d9cb-469f-a165-70867728950e"
    paths = [
        f"s3://w/silver/people_{u}/metadata/v1.json",
        f"s3://w/silver/people_{u}/metadata/v2.json",
        f"s3://w/silver/people_{u}/data/f.parquet",
        f"s3://w/silver/people_partitioned_{u}/metadata/v1.json",
        f"s3://w/silver/old_people_{u}/metadata/v1.json",
        "s3://w/silver/people_x/metadata/v1.json",
    ]
    frame = spark.createDataFrame([(p,) for p in paths], "path STRING")
    assert [r[0] for r in tables.discover_table_dirs(frame, "people").collect()] == [f"s3://w/silver/people_{u}"]


def test_top_groups_breaks_ties_by_key(spark, people):
    got = [tuple(r) for r in top_groups(people, ["department", "country"], 5).collect()]
    counts = {}
    for p in PEOPLE:
        counts[p[3:]] = counts.get(p[3:], 0) + 1
    wanted = sorted(((*k, n) for k, n in counts.items()), key=lambda r: (-r[2], r[:2]))[:5]
    assert got == wanted


def test_checks(spark, people):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id INT, v ARRAY<DOUBLE>")
    got = {r["check"]: (r["passed"], r["found"]) for r in check_table(vectors, ["id", "w"], 4, 3, {"v": 2, "u": 2}).collect()}
    assert got == {
        "at least 4 rows": (False, 3),
        "exactly 3 rows": (True, 3),
        "column id": (True, 1),
        "column w": (False, 0),
        "2 values in v": (False, 1),
        "2 values in u": (False, 0),
    }


def test_range(spark):
    assert [r[0] for r in spark.range(5).collect()] == [0, 1, 2, 3, 4]


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = spark.conf.get(workspace.CHECKPOINT_DIR)
    a, b = workspace.shared_folder(spark), workspace.shared_folder(spark)
    assert a.startswith(folder + "/") and a != b


def test_collects_stay_within_their_bound(spark):
    def rows(n):
        return spark.range(n).selectExpr("array(id, id) AS v")

    assert workspace.collect_vectors(rows(10), "v", 10, 1000).num_rows == 10
    assert workspace.collect_vectors(rows(11), "v", 10, 1000) is None
    assert workspace.collect_vectors(rows(10), "v", 10, 100) is None


def test_csv_keeps_quotes_commas_and_line_ends(spark, tmp_path):
    rows = [(1, 'says "hi", ok'), (2, 'two\nlines "'), (3, '"'), (4, "a\\b"), (5, None)]
    files.write_csv(spark.createDataFrame(rows, "id INT, text STRING"), f"{tmp_path}/csv")
    back = files.read_csv(spark, f"{tmp_path}/csv", "id INT, text STRING", multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == rows
