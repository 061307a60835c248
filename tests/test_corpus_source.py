"""The corpus source: empty files, order, packing, and what a listing reads."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.sources import corpus


@pytest.fixture
def folder(spark, tmp_path):
    texts = {f"s{i % 3}/d{i}.md": "" if i % 7 == 0 else f"text {i}\nμ\n" for i in range(50)} | {"one.txt": "x", "sub/deep/er/two.md": "y\r\n"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / ".hidden").mkdir()
    (tmp_path / ".hidden" / "x.md").write_text("no")
    return str(tmp_path), texts


def test_every_file_is_read_whole_also_empty_ones(spark, folder):
    path, texts = folder
    for place in (path, f"file://{path}"):
        rows = corpus.read_corpus(spark, place, relative=True).collect()
        assert [r["source_path"] for r in rows] == sorted(texts)
        assert {r["source_path"]: r["text"] for r in rows} == texts


def test_listing_opens_no_file(spark, folder, tmp_path):
    path, texts = folder
    secret = tmp_path / "s0" / "secret.md"
    secret.write_text("abc")
    secret.chmod(0)
    rows = {r["source_path"]: r for r in corpus.list_corpus(spark, path, relative=True, suffix=".md").collect()}
    assert rows.keys() == {n for n in texts if n.endswith(".md")} | {"s0/secret.md"}
    assert all(rows[n]["size"] == len(t.encode()) and rows[n]["modified"] for n, t in texts.items() if n in rows)


def test_small_files_share_a_task_and_large_ones_do_not(spark, folder):
    path, texts = folder
    register = corpus.register(spark)
    assert register is None
    few = spark.read.format("corpus").load(path)
    assert few.rdd.getNumPartitions() == 1
    many = spark.read.format("corpus").option("partitionBytes", 4 * corpus.OPEN_BYTES).load(path)
    assert many.rdd.getNumPartitions() >= len(texts) // 4 and many.count() == len(texts)
    sizes = [[f[1] for f in p.files] for p in corpus.packed([("a", 10, None), ("b", 10**9, None), ("c", 0, None)], 1 << 20)]
    assert sizes == [[10], [10**9], [0]]


def test_bytes_that_are_no_text_a_missing_folder_and_no_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\xff\xfeok")
    assert corpus.read_corpus(spark, str(tmp_path)).first()["text"] == "��ok"
    assert corpus.read_corpus(spark, str(tmp_path), suffix=".md").count() == 0
    with pytest.raises(PySparkException):
        corpus.read_corpus(spark, str(tmp_path / "none")).collect()


def test_what_is_written_is_read(spark, tmp_path):
    rows = [("a/1.txt", "x"), ("a/2.txt", None), ("b c/3.txt", "μ\n")]
    path = str(tmp_path / "out")
    assert corpus.write_corpus(spark.createDataFrame(rows, "source_path string, text string"), path) == 3
    back = corpus.read_corpus(spark, path, relative=True)
    assert {tuple(r) for r in back.collect()} == {(n, t or "") for n, t in rows}
    assert back.where(F.length("text") == 0).count() == 1
