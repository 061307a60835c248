"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns, and no rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm.common import work_folder
from ledgerlake.llm.decontamination import mark_documents
from ledgerlake.llm.imatch import fingerprint_documents
from ledgerlake.llm.packing import pack_documents
from ledgerlake.llm.quality import score_documents
from ledgerlake.llm.queries import vocabulary
from ledgerlake.llm.sharding import shard_documents
from ledgerlake.llm.simhash import near_components
from ledgerlake.llm.suffixes import removed_summary
from ledgerlake.llm.tokencounts import count_tokens
from ledgerlake.llm.tokenfiles import read_token_files, write_token_files
from ledgerlake.llm.tokens import Encoder

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def files(docs):
    place = work_folder(docs.sparkSession, "test")
    return read_token_files(docs.sparkSession, place, write_token_files(docs, WORDS, 1, place))


def labels(spark):
    return spark.createDataFrame([(7, 1, 0), (8, 1, 0), (13, 0, 0), (None, 1, None), (9, None, 1)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "null item of some more words"), (3, "too short")], "item_id long, text string")


OPERATORS = {
    "op1": lambda d: pack_documents(d, BYTES).filter("piece = 0"),
    "op2": shard_documents,
    "op3": files,
    "op4": removed_summary,
    "op5": lambda d: mark_documents(d, benchmark(d.sparkSession)),
    "op6": lambda d: score_documents(d, labels(d.sparkSession)),
    "op7": lambda d: count_tokens(d, BYTES, work_folder(d.sparkSession, "cache")),
    "op9": fingerprint_documents,
    "op10": near_components,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(nasty, name):
    ids = lambda df: sorted((r["doc_id"] is not None, r["doc_id"]) for r in df.select("doc_id").collect())
    assert ids(OPERATORS[name](nasty)) == ids(nasty)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(empty, name):
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(spark, nasty, empty, tmp_path, name, stage):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = stage(spark, nasty, str(tmp_path))
    assert kept.columns == nasty.columns
    assert [f.dataType for f in kept.schema] == [f.dataType for f in nasty.schema]
    assert kept.count() <= nasty.count()
    assert stage(spark, empty, str(tmp_path)).count() == 0


def test_tied_rows_of_one_text_share_their_results(nasty):
    rows = near_components(nasty).filter(F.col("doc_id").isin(7, 8)).collect()
    assert {r["component_id"] for r in rows} == {7}
    cut = {(r["doc_id"], r["n_removed"]) for r in removed_summary(nasty).collect()}
    assert (11, 0) in cut and any(i == 12 and n > 40_000 for i, n in cut)


def test_results_of_missing_texts(nasty):
    assert {(r["n_bytes"], r["n_tokens"]) for r in OPERATORS["op7"](nasty).filter("doc_id in (5, 6)").collect()} == {(0, 0)}
    assert {r["fingerprint"] for r in near_components(nasty).filter("doc_id in (5, 6, 9)").collect()} == {0}
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in shard_documents(nasty).collect()}
    assert sizes[5] == sizes[6] == (1, 0)
    scores = {r["score"] for r in OPERATORS["op6"](nasty).collect()}
    assert all(0 <= s <= 1 for s in scores)


def test_words_and_their_parts_share_one_cache():
    from tokenizers import Tokenizer

    coder, plain = Encoder(WORDS, max_pieces=8), Tokenizer.from_file(WORDS)
    calls = []
    piece = coder._piece
    coder._piece = lambda p: calls.append(p) or piece(p)
    for text in ("Haus haus. Haus haus", "éa%%% abc1.x Haus, (haus) 37.5", "don't .foo!bar a-b", "one two three four five six"):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert list(memoryview(coder.ids_of(text)).cast("I")) == ids
    assert calls.count("haus") == 1 and len(coder.spaced) == 8
