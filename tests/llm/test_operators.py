"""The operators against brute force, on small tables."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import chat, decontamination, imatch, packing, quality, sharding, simhash, suffixes, tokenfiles
from ledgerlake.llm.common import work_folder
from ledgerlake.llm.queries import vocabulary
from ledgerlake.llm.registry import ORACLES, QUERIES
from ledgerlake.llm.tokencounts import count_tokens, read_cache, tokenizer_version
from ledgerlake.llm.tokens import Encoder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


def rows_of(spark, name):
    return QUERIES[name](spark, FOLDER).toPandas()


# Tokens

SPACES = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", " ", "\x1c", " ", "​", ""])
BITS = st.sampled_from(["ab", "Zürich", "ÉAI", "don't", "I'll", "x.y", "3km", "<|endoftext|>", "<|startoftext|>", "é", "ﬁ", "İ", "ß", "_", "a-b", "…", "日本", "👍🏽", "!!", "ΣΑΣ", "'s", "ʼn"])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    own, library = Encoder(vocabulary(name), max_pieces=8), Tokenizer.from_file(vocabulary(name))

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.tuples(BITS | st.text(max_size=4), SPACES), max_size=9))
    def check(parts):
        text = "".join(a + b for a, b in parts)
        if not any(0xD800 <= ord(c) < 0xE000 for c in text):
            assert np.frombuffer(own.ids_of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    check()


# Packing

@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_fills_bins_without_gaps(sizes):
    bins, places, fills = packing.best_fit(np.array(sizes, np.int64), 50)
    for b, fill in enumerate(fills):
        inside = sorted((places[i], sizes[i]) for i in np.flatnonzero(bins == b))
        assert [p for p, _ in inside] == [sum(s for _, s in inside[:k]) for k in range(len(inside))]
        assert fill == sum(s for _, s in inside) <= 50


def test_packing(spark, texts):
    found = rows_of(spark, "op1_best_fit_packing")
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = set()
    for doc, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.add((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert set(found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, rows in found.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 1024
    assert found.sequence_id.nunique() <= 1.02 * found.length.sum() / 1024 + 1


@pytest.mark.parametrize("lengths", ["1 + id * 37 % 99", "51 + id * 37 % 49", "if(id % 3 = 0, 60 + id % 30, 1 + id % 12)"])
def test_packing_over_several_levels(spark, monkeypatch, lengths):
    """Forty items a task: every underfull bin goes on, so the fill stays near that of one task for all."""
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 40)
    rows = spark.range(1500).selectExpr("id", f"{lengths} AS length")
    found = packing.pack(rows, 100, work_folder(spark, "levels")).toPandas()
    assert sorted(found.id) == list(range(1500))
    for _, bin_ in found.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == [0, *np.cumsum(bin_.length)[:-1]] and bin_.length.sum() <= 100
    assert found.sequence_id.nunique() <= len(packing.best_fit(found.length.to_numpy(), 100)[2]) * 1.1


# Sharding

@pytest.mark.parametrize("hot", [0, 3])
def test_shards_are_even_and_keep_copies_together(spark, documents, hot):
    docs = documents if not hot else documents.selectExpr("doc_id", f"if(doc_id % {hot} = 0, 'hot', text) AS text")
    found = sharding.shard_documents(docs).toPandas()
    counts = found.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1 and len(counts) == 8
    assert (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    groups = found.groupby(["text_crc32", "size"]).shard.agg(["count", "nunique"])
    most = counts["count"].max()
    least = np.ceil(groups["count"] / most)
    assert (groups["nunique"] <= least + 1).all() and (groups["nunique"] - least).sum() <= 1


# Token files

def test_token_files(spark, texts):
    found = rows_of(spark, "op3_token_files").sort_values("doc_id")
    library, start = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0
    for row, (doc, text) in zip(found.itertuples(), sorted(texts.items())):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_a_reader_takes_only_the_frames_it_wants(tmp_path):
    fs, base = tokenfiles.file_system(str(tmp_path))
    writer = tokenfiles.Writer(fs.open_output_stream(f"{base}/a.zst", compression=None), 2, frame_bytes=64)
    docs = [(i, np.arange(i % 40, dtype="<u4")) for i in range(200)] + [(None, np.arange(3, dtype="<u4"))]
    for doc, ids in docs:
        writer.add(doc, ids)
    writer.close()
    reader = tokenfiles.Reader(fs.open_input_file(f"{base}/a.zst"))
    read, frame = [], reader.frame
    reader.frame = lambda i: (read.append(i), frame(i))[1]
    assert [(d, x.tolist()) for d, x in reader.documents()] == [(d, x.tolist()) for d, x in docs]
    read.clear()
    assert [(d, len(x)) for d, x in reader.documents({77, 150})] == [(77, 37), (150, 30)] and len(read) == 2
    data = bytearray((tmp_path / "a.zst").read_bytes())
    data[20] ^= 1
    (tmp_path / "b.zst").write_bytes(data)
    with pytest.raises(Exception):
        list(tokenfiles.Reader(fs.open_input_file(f"{base}/b.zst")).documents())


# Suffixes

def cut_by_hand(rows, length=100):
    seen, out = set(), {}
    for doc, text in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_repeated_bytes(spark, hot):
    rng, line = np.random.default_rng(3), "a line that very many of the documents hold, and that is longer than the limit of a hundred bytes. "
    rows = []
    for i in range(60):
        own = "".join(rng.choice(list("abcdefg "), 300))
        other = rows[i // 2][1] if i else ""
        rows.append((i * 3 - 40, [own, own + line + own[:150], line * 2 + own, other, other[:200] + "x" + other[200:], "ab" * 130, "é" * 70 + own][i % 7]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: tuple(r)[1:] for r in suffixes.removed_summary(docs, hot=hot).collect()}
    assert found == cut_by_hand(sorted(rows))


def test_multikey_sort_finds_equal_windows():
    data = np.random.default_rng(0).integers(0, 2, 400).astype(np.uint8)
    starts = np.arange(380)
    rows, classes = suffixes.multikey_sort(data, starts, np.zeros(380, np.int64), 11)
    got = sorted(sorted(rows[classes == c].tolist()) for c in set(classes.tolist()))
    by = {}
    for s in starts.tolist():
        by.setdefault(data[s : s + 11].tobytes(), []).append(s)
    assert got == sorted(v for v in by.values() if len(v) > 1)


# Decontamination

def test_templates_catch_other_values_and_check_them(spark):
    asked = "then Tom has 12 apples and 7 pears, so Tom sells 12 apples at the market today"
    other = "then Ann has 9 apples and 4 pears, so Ann sells 9 apples at the market today"
    mixed = "then Ann has 9 apples and 4 pears, so Bob sells 8 apples at the market today"
    docs = [(1, f"something before. {asked} and after"), (2, f"x y z {other}"), (3, mixed), (4, asked.upper()), (5, "apples and pears at the market")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.mark_documents(frame, spark.createDataFrame([(70, asked)], "item_id long, text string"))
    held = {r["doc_id"]: r["item_ids"] for r in found.collect()}
    assert held == {1: [70], 2: [70], 3: [], 4: [70], 5: []}


def test_passages_of_the_benchmark_are_found(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plain = lambda s: " ".join(s.lower().split())
    items = [plain(r["text"]) for r in benchmark.collect()]
    want = {r["doc_id"] for r in documents.collect() if any(i in plain(r["text"]) for i in items)}
    found = {r["doc_id"] for r in decontamination.mark_documents(documents, benchmark).filter("contaminated").collect()}
    assert want and found == want


# Quality

def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.score_documents(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id)
    assert (found.predicted == found.quality).mean() > 0.97
    good, bad = found[found.quality == 1].score.values, found[found.quality == 0].score.values
    assert (good[:, None] > bad[None, :]).mean() > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", (labels.quality != quality.held_out(labels.doc_id).cast("int")).cast("int"))
    a, b = (quality.score_documents(documents, x).toPandas().sort_values("doc_id").score.values for x in (labels, turned))
    assert np.allclose(a, b)


# Counts

def test_counts_and_their_cache(spark, documents, texts):
    cache, path = work_folder(spark, "counts"), vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = {d: (len(t.encode()), len(n := library.encode(t).ids), len(n) > 512) for d, t in texts.items()}
    half = count_tokens(documents.filter("doc_id % 2 = 0"), path, cache).collect()
    stored = read_cache(spark, cache, tokenizer_version(path)).count()
    assert 0 < stored <= len(half)
    found = count_tokens(documents, path, cache)
    assert {r["doc_id"]: tuple(r)[1:] for r in found.collect()} == want
    digests = read_cache(spark, cache, tokenizer_version(path))
    assert digests.count() == digests.select("digest").distinct().count() == len(set(texts.values()))
    assert read_cache(spark, cache, "another version").count() == 0


# Chat

def test_chat_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    got = QUERIES["op8_chat_formatting"](spark, FOLDER).toArrow()
    assert compare(got, con.execute(ORACLES["op8_chat_formatting"]).to_arrow_table()) == ""


def test_layouts_give_the_same_turns(spark):
    q, a = "1 < 2 & [INST] <|end|> &lt;", 'said "</s>"\nand more'
    records = [
        {"messages": [{"role": "user", "content": q}, {"role": "assistant", "content": a}]},
        {"conversations": [{"value": q, "from": "human"}, {"from": "gpt", "value": a}]},
        {"prompt": q, "completion": a},
        {"response": a, "prompt": q},
        {"question": q, "answer": a},
        {"instruction": q, "output": a},
        {"instruction": q, "input": "", "output": a},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, "no json"), (91, None), (92, '{"other": 1}'), (None, '{"messages": []}')]
    turns = chat.canonical(spark.createDataFrame(rows, "conv_id long, payload string"))
    back = chat.read_segments(chat.format_turns(turns)).collect()
    for i in range(len(records)):
        assert sorted((r["turn"], r["role"], r["text"], r["loss_text"]) for r in back if r["conv_id"] == i) == [(0, "user", q, ""), (1, "assistant", a, a)]
    assert sorted((r["conv_id"], r["text"]) for r in back if (r["conv_id"] or 0) >= 90) == [(90, "no json"), (91, ""), (92, '{"other": 1}')]


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (None, 0, "a\nb", "<"), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS segment", "2 AS payload")
    found = {r["conv_id"]: r for r in chat.summary(chat.format_turns(chat.canonical(frame))).collect()}
    assert {k: v["n_turns"] for k, v in found.items()} == {1: 2, None: 1, 2: 2}
    assert found[1]["turns_sha256"] == hashlib.sha256(b"\nx\nuser\n\n").hexdigest()
    assert found[None]["turns_sha256"] == hashlib.sha256(b"a\nb\n<\n").hexdigest()
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.summary(chat.format_turns(chat.canonical(none))).count() == 0


# Fingerprints

def test_imatch(spark, texts):
    found = rows_of(spark, "op9_imatch").set_index("doc_id")
    order = sorted(texts, reverse=True)
    for i, doc in enumerate(order):
        text, following = texts[doc], texts[order[(i + 1) % len(order)]]
        part = len(text) // 3
        assert found.loc[doc].edited_sha256 == hashlib.sha256((text[: len(text) - part] + following[:part]).encode()).hexdigest()
        assert found.loc[doc].n_chars == len(text)
    by_text = found.assign(text=[texts[d] for d in found.index]).groupby("text").fingerprint.nunique()
    assert by_text.max() == 1
    assert found.near_edited.between(0, 1).all() and found.near_next.between(0, 1).all()
    assert found.near_edited.mean() > found.near_next.mean() + 0.1


def _signed_hash(data, seed=42):
    h = xxhash.xxh64_intdigest(data, seed)
    return h - (1 << 64) if h >> 63 else h


def _terms(text):
    return {_signed_hash(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}


def prints_by_hand(texts):
    """Fingerprints of all texts, worked out again without Spark."""
    df = Counter(h for t in texts for h in _terms(t))
    kept = [h for h, k in df.items() if max(2, 1e-4 * len(texts)) <= k <= 0.2 * len(texts)]
    bits = 1 << 12
    while bits < 16 * len(kept):
        bits *= 2
    places = lambda h: (h % bits, _signed_hash(struct.pack("<q", h)) % bits)
    known = {p for h in kept for p in places(h)}
    out = []
    for t in texts:
        left = sorted(h for h in _terms(t) if all(p in known for p in places(h)))
        level = min(max(len(left).bit_length() - 2, 0), 17) if left else 0
        sides = []
        for n in (level, level + 1):
            side = []
            for s in range(16):
                some = [h for h in left if (h % (1 << 64)) >> 3 * s & ((1 << n) - 1) == 0]
                seed = 42
                for h in some:
                    seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed)
                side.append(f"{seed:016x}" if some else None)
            sides.append(side)
        out.append((level, *sides))
    return out


def likeness_by_hand(a, b):
    def share(x, y):
        used = [(p, q) for p, q in zip(x, y) if p or q]
        return sum(p == q for p, q in used) / len(used) if used else 0.0

    if a[0] == b[0]:
        return 1.0 if not any(a[1]) and not any(b[1]) else max(share(a[1], b[1]), share(a[2], b[2]))
    return share(a[1], b[2]) if a[0] - b[0] == 1 else share(a[2], b[1]) if b[0] - a[0] == 1 else 0.0


def test_imatch_prints_and_likenesses_by_hand(spark, texts):
    found = rows_of(spark, "op9_imatch").set_index("doc_id")
    order = sorted(texts, reverse=True)
    prints = dict(zip(texts, prints_by_hand(list(texts.values()))))
    shown = lambda p: f"{p[0]}:" + ":".join(".".join(h or "-" for h in side) for side in p[1:])
    assert found.fingerprint.to_dict() == {d: shown(p) for d, p in prints.items()}
    assert sum(any(p[1]) for p in prints.values()) > 0.8 * len(prints)
    for i, doc in enumerate(order):
        assert found.loc[doc].near_next == pytest.approx(likeness_by_hand(prints[doc], prints[order[(i + 1) % len(order)]]))


def test_terms_of_one_document_and_of_most_are_in_no_print(spark):
    docs = spark.createDataFrame([(i, f"shared word{i} other{i // 3}") for i in range(30)], "doc_id long, text string")
    known = imatch.lexicon(docs)
    row = imatch.fingerprint(docs.filter("doc_id = 4"), "text", known, "print").first()["print"]
    kept = [_signed_hash(b"other1")]  # "shared" stands in all documents, "word4" in one
    assert row["level"] == 0
    assert all(x is not None for x in row["low"]) and len(set(row["low"])) == 1
    for s, x in enumerate(row["high"]):
        assert (x is not None) == any((h % (1 << 64)) >> 3 * s & 1 == 0 for h in kept)
    alone = imatch.fingerprint(docs.filter("doc_id = 4").selectExpr("'shared word4' AS text"), "text", known, "print").first()["print"]
    assert not any(alone["low"]) and not any(alone["high"])


# SimHash

def simhash_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    found = rows_of(spark, "op10_simhash").set_index("doc_id")
    prints = {d: simhash_by_hand(t) for d, t in texts.items()}
    assert {d: int(f, 16) for d, f in found.fingerprint.items()} == prints
    root = {d: d for d in prints}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert found.component_id.to_dict() == {d: top(d) for d in prints}


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4))
def test_prints_within_four_bits_share_a_key(x, flips):
    y = x
    for f in flips:
        y ^= 1 << f
    keys = [set(simhash.join_keys(np.array([v], np.uint64))[1].tolist()) for v in (x, y)]
    assert keys[0] & keys[1]


def test_chains_of_near_prints_are_one_component(spark):
    prints = [0]
    for i in range(60):
        prints.append(prints[-1] ^ (0xF << (i * 4 % 60)))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in set(prints)], "fingerprint long")
    folder = work_folder(spark, "chain")
    found = simhash.components(simhash.near_links(frame, folder), folder).collect()
    assert len({r["root"] for r in found}) == 1 and len(found) == len(set(prints))


# Pipeline

def test_pipeline(spark, documents):
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), documents.schema)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    good, unique, cut, clean = (kept[n] for n, _ in corpus_pipeline.STAGES[:-1])
    prints = {}
    for d in sorted(good):
        prints.setdefault(simhash_by_hand(good[d]), d)
    roots = {d: d for d in prints.values()}
    values = list(prints)

    def top(d):
        while roots[d] != d:
            d = roots[d]
        return d

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = sorted((top(prints[a]), top(prints[b])))
                roots[y] = x
    assert set(unique) == {top(d) for d in roots} and all(unique[d] == good[d] for d in unique)
    assert {d: len(t.encode()) for d, t in cut.items()}.keys() == unique.keys()
    by_hand = cut_by_hand(sorted(unique.items()))
    assert all(len(cut[d].encode()) <= by_hand[d][0] - by_hand[d][1] for d in cut)
    assert set(clean) <= set(cut)
    packed = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(packed.doc_id) == set(clean) and packed.groupby("sequence_id").length.sum().max() <= 1024
