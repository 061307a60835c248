"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into two segments A, B of 23 bits and one, C, of 18. The perfect binary
Golay code (23, 12) has a codeword within 3 bits of every 23-bit word. A segment's keys are the indices
of all codewords within 4 bits of it, 1 or 6 of them: two words that differ in at most 2 bits share
one (their midpoint's codeword). Errors a, b, c in the segments with a + b + c <= 4 then leave one of
these equal, by the pigeonhole:

* a, b, c <= 2: a key of A, a key of B and a third of C;
* c >= 3, so a + b <= 1: all of A and a key of B, or a key of A and all of B;
* a >= 3, so b + c <= 1: a key of B and all of C, or all of B and a half of C; likewise b >= 3.

So every pair within 4 bits meets under a key of 30 to 35 bits, and few others do. Fingerprints that
meet are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, work_folder
from .components import components

ship(__name__)

SEED = 42
MAX_BITS = 4
SEGMENT = 23
LANES = np.uint64(0x0101010101010101)
SHINGLES_AT_ONCE = 1 << 18
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every shingle of a text: ASCII lower case, words between ASCII white space."""
    found = text.encode().lower().split()
    if not found:
        return []
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    joined = b" ".join(found)
    ends = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits that over half of them have; 0 for an empty run.

    Adds eight one-byte counters at a time, over blocks of at most 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    blocks = -(-sizes // 255)
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    inside = np.arange(blocks.sum()) - np.repeat(first_block, blocks)
    starts = np.repeat(first, blocks) + 255 * inside
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, starts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_block, axis=0)
        for byte in range(8):
            bit = np.uint64(8 * byte + shift)
            out[full] |= (2 * ones[:, byte] > sizes).astype(np.uint64) << bit
    return out


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``docs`` with ``fingerprint`` (long): 0 for a null text and for one without words."""
    schema = "doc_id long, digest long, fingerprint long"

    def run(batches):
        for batch in batches:
            hashes, counts, prints = [], [], []

            def flush():
                prints.append(majority(np.array(hashes, np.uint64), np.array(counts, np.int64)))
                hashes.clear(), counts.clear()

            for value in batch.column(2):
                found = shingle_hashes(value.as_py(), words)
                hashes.extend(found)
                counts.append(len(found))
                if len(hashes) >= SHINGLES_AT_ONCE:
                    flush()
            flush()
            signed = np.concatenate(prints).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], names=["doc_id", "digest", "fingerprint"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("digest"), text.alias("text")).mapInArrow(run, schema)


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and up to 6 error patterns for each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(SEGMENT - 1, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    ones = [remainder(1 << i) for i in range(SEGMENT)]
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for i in range(SEGMENT):
        table, bit = (low, i) if i < 12 else (high, i - 12)
        table[np.arange(len(table)) >> bit & 1 == 1] ^= ones[i]
    patterns = np.full((1 << 11, 6), -1, np.int64)
    used = np.zeros(1 << 11, np.int64)
    for weight in range(5):
        for places in combinations(range(SEGMENT), weight):
            syndrome = 0
            for p in places:
                syndrome ^= ones[p]
            patterns[syndrome, used[syndrome]] = sum(1 << p for p in places)
            used[syndrome] += 1
    return low, high, patterns


def segment_keys(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each 23-bit word, six columns, -1 where there is none."""
    low, high, patterns = _golay()
    errors = patterns[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of some fingerprints (unsigned)."""
    a = (prints & np.uint64(0x7FFFFF)).astype(np.int64)
    b = (prints >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64)
    c = (prints >> np.uint64(46)).astype(np.int64)
    ka, kb = segment_keys(a), segment_keys(b)
    rows, keys = [], []

    def add(kind: int, key: np.ndarray, valid: np.ndarray) -> None:
        row = np.broadcast_to(np.arange(len(prints)).reshape(-1, *[1] * (key.ndim - 1)), key.shape)
        rows.append(row[valid])
        keys.append(key[valid] | kind << 40)

    everyone = np.ones(len(prints), bool)
    both = (ka[:, :, None] >= 0) & (kb[:, None, :] >= 0)
    pair = ka[:, :, None] << 12 | kb[:, None, :]
    for third in range(3):
        add(third, pair << 6 | (c >> 6 * third & 0x3F)[:, None, None], both)
    add(3, a[:, None] << 12 | kb, kb >= 0)
    add(4, b[:, None] << 12 | ka, ka >= 0)
    add(5, c[:, None] << 12 | kb, kb >= 0)
    add(6, c[:, None] << 12 | ka, ka >= 0)
    for half in range(2):
        part = c >> 9 * half & 0x1FF
        add(7 + half, b << 9 | part, everyone)
        add(9 + half, a << 9 | part, everyone)
    return np.concatenate(rows), np.concatenate(keys)


def links(prints: np.ndarray, bits: int = MAX_BITS) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints: no pair beyond what connects them."""
    left = prints
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            at, wave = wave[0], wave[1:]
            near = np.bitwise_count(left ^ at) <= bits
            found = left[near]
            yield from ((int(at), int(x)) for x in found)
            wave, left = np.concatenate([wave, found]), left[~near]


def near_links(prints: DataFrame, folder: str) -> DataFrame:
    """Edges (u, v) that connect all distinct ``fingerprint`` values of ``prints`` within 4 bits.

    Equal fingerprints count once. Rows of a key come sorted, so a task holds the fingerprints of one
    key at a time, and gives at most one edge less than these.
    """
    spark = prints.sparkSession

    def to_keys(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(values), 2000):
                some = values[i : i + 2000]
                rows, keys = join_keys(some)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(some[rows].view(np.int64))], names=["key", "fingerprint"])

    def to_links(batches):
        held_key, held = None, np.empty(0, np.uint64)
        pairs: list[tuple[int, int]] = []

        def out():
            ends = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["u", "v"])

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(keys):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            sizes = np.diff(cuts)
            if keys[0] == held_key:
                held = np.concatenate([held, values[: cuts[1]]])
            else:
                pairs.extend(links(held))
                held = values[: cuts[1]]
            held_key = keys[0]
            if len(cuts) > 2:
                pairs.extend(links(held))
                inner = np.flatnonzero(sizes[1:-1] > 1) + 1
                for i in inner:
                    pairs.extend(links(values[cuts[i] : cuts[i + 1]]))
                held_key, held = keys[-1], values[cuts[-2] :].copy()
            if len(pairs) > 50_000:
                yield out()
        pairs.extend(links(held))
        yield out()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by number: adaptive execution would join these few bytes to very few tasks, which make a hundred keys of each
    keyed = prints.select("fingerprint").distinct().repartition(n, "fingerprint").mapInArrow(to_keys, "key long, fingerprint long")
    dealt = keyed.repartition(n, "key").sortWithinPartitions("key", "fingerprint")
    return stored(dealt.mapInArrow(to_links, "u long, v long").distinct(), folder, "links")


def near_components(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, digest, fingerprint, root, component_id) of every row of ``docs``.

    Rows whose fingerprints differ in at most 4 bits are linked; ``component_id`` is the smallest
    ``doc_id`` that links reach, the row's own included, and null only if all of these are null. ``root``
    is the smallest fingerprint reached. Null texts and texts without words have fingerprint zero, and
    are linked with each other like any others. Repeated rows stay. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "simhash")
    prints = stored(fingerprints(docs, words), folder, "prints")
    edges = near_links(prints, folder)
    roots = components(edges, folder)
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    known = least.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "doc_id"
    )
    known = stored(known, folder, "roots")
    smallest = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = known.select("fingerprint", "root").join(smallest, "root")
    return prints.join(of, "fingerprint").select("doc_id", "digest", "fingerprint", "root", "component_id")


def keep_one(docs: DataFrame, words: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, the one with the smallest ``doc_id``; all its columns.

    Of several such rows (repeated or null ids) one text is chosen by its hash, and one row of it.
    """
    return keep_first(docs, near_components(docs, words))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each root of ``found`` (doc_id, digest, root), as ``keep_one`` says."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest"))
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("_own"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_digest"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["_own", "_hash"]).select("row.*")
