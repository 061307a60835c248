"""Sections and chunks against a model that follows the rules line by line."""

from __future__ import annotations

import hashlib
import random

import pytest

from ledgerlake.operators import sections as S
from ledgerlake.plans.index import build_index
from ledgerlake.sources.tables import CHUNK_SCHEMA

BLANK = " \t\xa0　\x1f"


def title_of(line: str) -> str | None:
    """The heading text of a line, or None."""
    hashes = len(line) - len(line.lstrip("#"))
    rest = line[hashes:]
    if 1 <= hashes <= 6 and len(rest) >= 2 and rest[0].isspace():
        return rest.strip()
    return None


def model_sections(text: str) -> list[tuple[int, str, str]]:
    found: list[list] = [[0, "Introducción", []]]
    for line in text.splitlines():
        title = title_of(line)
        if title is not None:
            found.append([len(found), title, []])
        found[-1][2].append(line)
    joined = [(n, title, "\n".join(lines).strip()) for n, title, lines in found]
    return [s for s in joined if s[2]]


def model_chunks(text: str, limit: int) -> list[str]:
    paragraphs, lines = [], []
    for line in [*text.split("\n"), ""]:
        if line.strip():
            lines.append(line)
        elif lines:
            paragraphs.append("\n".join(lines).strip())
            lines = []
    chunks: list[list[str]] = []
    for p in paragraphs:
        if not chunks or sum(map(len, chunks[-1])) + len(p) > limit:
            chunks.append([])
        chunks[-1].append(p)
    return ["\n\n".join(c) for c in chunks]


EDGES = [
    "",
    "\n\n \n",
    "# A",
    "# A\n# B\n## C",
    "\n\n# A\ntext",
    "####### seven\n###### six",
    "#no space\n# \n#  \n#\tTab title ",
    "```\n# in a fence\n```\n",
    "one\r\ntwo\r\n\r\n# T\rthree\x0bfour\x0c# U\x1cfive\x85# V\u2028# W\u2029six\x1e# X\x1f7",
    "a\n\nb\n \t\n\n c \n\xa0\nd",
    "# Título\xa0　\n\n" + "p" * 40 + "\n\n" + "q" * 5,
    "x" * 10 + "\n\n" + "y" * 10 + "\n\n" + "z",
    "x" * 10 + "\n\n" + "y" * 11,
    "w" * 60,
    "text # not a heading\n #neither",
    "\x1f\n# T\x1f\n\x1f\n",
]


def random_text(rng: random.Random) -> str:
    pieces = ["# T", "## Uno dos", "#", "##x", "", "", "", "abc", "dé fg", "h" * 9, " i ", "\t", "\xa0", "####### z"]
    ends = ["\n"] * 8 + ["\r\n", "\r", "\x0b", "\x85", "\u2028", "\u2029", "\x1d"]
    return "".join(rng.choice(pieces) + rng.choice(ends) for _ in range(rng.randint(0, 40)))


def texts() -> list[str]:
    rng = random.Random(7)
    return EDGES + [random_text(rng) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(f"d{i}", t) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "source_path STRING, text STRING")


def test_sections(docs):
    got = {}
    for r in S.split_sections(docs).collect():
        got.setdefault(r["source_path"], []).append((r["section_no"], r["section_title"], r["section_text"]))
    for i, text in enumerate(texts()):
        assert sorted(got.get(f"d{i}", [])) == model_sections(text), repr(text)


@pytest.mark.parametrize("limit", [1, 20, 1800])
def test_chunks(docs, limit):
    got = {}
    for r in S.chunk_documents(docs, limit).collect():
        place = (r["section_no"], r["chunk_index"])
        got.setdefault(r["source_path"], []).append((*place, r["section_title"], r["chunk_text"]))
        fields = [r["source_path"], r["section_title"], str(r["chunk_index"]), r["chunk_text"]]
        assert r["chunk_id"] == hashlib.sha256("|".join(fields).encode()).hexdigest()
    for i, text in enumerate(texts()):
        wanted = [
            (no, index, title, chunk)
            for no, title, section in model_sections(text)
            for index, chunk in enumerate(model_chunks(section, limit))
        ]
        assert sorted(got.get(f"d{i}", [])) == wanted, repr(text)


def test_limit_counts_text_but_not_joints(spark):
    text = "\n\n".join(["x" * 600] * 4)
    section = spark.createDataFrame([("p", 1, "t", text)], "source_path STRING, section_no INT, section_title STRING, section_text STRING")
    chunks = [r["chunk_text"] for r in S.pack_chunks(section).orderBy("chunk_index").collect()]
    assert [len(c) for c in chunks] == [1804, 600]


def test_a_huge_section_is_packed_whole(spark):
    n = 60_000
    docs = spark.range(1).selectExpr(
        "'big' AS source_path", f"array_join(transform(sequence(1, {n} + cast(id AS int)), i -> concat('p', i)), '\n\n') AS text"
    )
    rows = S.chunk_documents(docs).orderBy("chunk_index").collect()
    assert "\n\n".join(r["chunk_text"] for r in rows) == "\n\n".join(f"p{i}" for i in range(1, n + 1))
    assert all(len(r["chunk_text"].replace("\n\n", "")) <= 1800 for r in rows)


def test_chunks_per_source(docs):
    counts = S.chunks_per_source(S.chunk_documents(docs)).collect()
    assert [r["chunks"] for r in counts] == sorted((r["chunks"] for r in counts), reverse=True)


def test_index_has_its_schema_and_repeats_its_ids(docs):
    index = build_index(docs, ts="2024-01-01")
    assert [(f.name, f.dataType) for f in index.schema] == [(f.name, f.dataType) for f in CHUNK_SCHEMA]
    first = {r["chunk_id"] for r in index.select("chunk_id").collect()}
    assert first == {r["chunk_id"] for r in build_index(docs.repartition(3)).select("chunk_id").collect()}
    assert index.where("size(embedding) <> 64 OR ingestion_ts IS NULL").count() == 0
