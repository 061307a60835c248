"""Removal of repeated byte strings, by sorted suffixes.

Every string of ``length`` bytes that also starts earlier is covered. All suffixes of a corpus are far
too many to move, so each window of ``length`` bytes is owned by an anchor inside it: the leftmost of
the smallest hashes of ``GRAM`` bytes. Equal windows have equal anchors at equal places, so only windows
whose anchor's bytes occur twice can be repeated.

1. Anchors' hashes are dealt out by value; a document gets back its anchors that occur elsewhere too.
2. Such an anchor's windows and their bytes are one record. Tasks merge equal records: the earliest
   stands, all windows of the others are repeated.
3. Sampled splitters range-partition the records by the suffix at the anchor, and a bucket sorts them.
   Windows of different texts under one anchor are sorted with a multikey sort, eight bytes at a time,
   and equal ones compared. An anchor may lie across a splitter, at the first or the last place of a
   bucket, and an anchor may have very many surroundings (a line that a third of all documents hold):
   their windows go on, merged per task and dealt by hash, and those with equal hashes are compared.
4. Documents meet the starts of their repeated windows, and the covered bytes are cut out.

Hashes only choose what is compared; what is removed was compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, ship, stored, text_of, work_folder

ship(__name__)

LENGTH = 100
GRAM = 32
CHUNK = 1 << 20
PLACE_BITS = np.uint64((1 << 24) - 1)
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
HOT = 20_000
#: Bytes of text whose anchors one bucket holds, on average. So many buckets at least that most anchors of a document
#: lie in different ones: more of them then make no more rows of a document.
BYTES_PER_BUCKET, LEAST_BUCKETS = 16 << 20, 64
RECORDS_AT_ONCE = 50_000
LEAST = -(1 << 63)

#: Of an anchor: its hash, its place in the document, bytes of its windows before it (at most, at least).
ANCHOR = np.dtype([("hash", "<u8"), ("place", "<i8"), ("most", "u1"), ("least", "u1")])
RUN = np.dtype([("first", "<i8"), ("last", "<i8")])


def _powers() -> dict[int, np.uint64]:
    return {m: np.uint64(pow(BASE, m, 1 << 64)) for m in (1, 2, 4, 8, 16)}


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``GRAM`` bytes of ``data``, by doubling a polynomial."""
    power = _powers()
    h = data.astype(np.uint64)
    h += np.uint64(1)
    h *= MIX
    h ^= h >> np.uint64(32)
    for m in (1, 2, 4, 8, 16):
        h = h[:-m] * power[m] + h[m:]
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def find_anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash) over texts that lie one after another in ``data``."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, np.empty(0, np.uint64)
    hashes = gram_hashes(data)
    m = hashes & ~PLACE_BITS
    m |= np.arange(len(m), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    if width > reach:
        m = np.minimum(m[: len(m) - (width - reach)], m[width - reach :])
    inside = np.ones(len(data), bool)
    for e in ends.tolist():
        inside[max(0, e - length + 1) : e] = False
    windows = np.flatnonzero(inside[: len(m)])
    if not len(windows):
        return none, none, none, np.empty(0, np.uint64)
    at = (m[windows] & PLACE_BITS).astype(np.int64)
    cuts = np.flatnonzero(np.diff(at)) + 1
    firsts, lasts = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [len(at) - 1]])
    return at[firsts], windows[firsts], windows[lasts], hashes[at[firsts]]


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of about a megabyte: bytes, ends, and of each segment its text and place in it."""
    parts, owners, places, size = [], [], [], 0
    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, len(text) - length + 1, CHUNK):
            part = text[start : start + CHUNK + length - 1]
            parts.append(part)
            owners.append(i)
            places.append(start)
            size += len(part)
            if size >= CHUNK:
                yield _chunk(parts, owners, places)
                parts, owners, places, size = [], [], [], 0
    if parts:
        yield _chunk(parts, owners, places)


def _chunk(parts, owners, places):
    ends = np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), ends, np.array(owners), np.array(places)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in column.to_pylist()]


def _deal_anchors(buckets: int, length: int):
    """Rows for (bucket): the anchors of a batch, and the documents that they are of."""

    def run(batches):
        for batch in batches:
            docs = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            found, owners = [], []
            for data, ends, of, base in _segments(_texts(batch.column(2)), length):
                at, first, last, hashes = find_anchors(data, ends, length)
                seg = np.searchsorted(ends, at, side="right")
                rows = np.empty(len(at), ANCHOR)
                rows["hash"], rows["place"] = hashes, at - np.concatenate([[0], ends])[seg] + base[seg]
                rows["most"], rows["least"] = at - first, at - last
                found.append(rows)
                owners.append(of[seg])
            if not found:
                continue
            rows, owner = np.concatenate(found), np.concatenate(owners)
            bucket = (rows["hash"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, owner, bucket = rows[order], owner[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
                turns = np.concatenate([[0], np.flatnonzero(np.diff(owner[a:b])) + 1])
                counts = np.diff(np.concatenate([turns, [b - a]])).astype("<u4")
                columns = (rows["hash"], rows["place"].astype("<u4"), rows["most"], rows["least"])
                some = rows["place"][a:b]
                high = (some >> 32).astype("<u4") if some.max(initial=0) >> 32 else np.empty(0, "<u4")
                out.append(
                    (int(bucket[a]), *[np.ascontiguousarray(c[a:b]).tobytes() for c in columns], high.tobytes(), docs[owner[a:b][turns]].astype("<i8").tobytes(), counts.tobytes())
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))],
                names=["bucket", "hashes", "places", "most", "least", "high", "docs", "counts"],
            )

    return run


DEALT = "bucket int, hashes binary, places binary, most binary, least binary, high binary, docs binary, counts binary"


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Of one bucket, the anchors whose hash occurs twice, as bytes for each document."""

    def column(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table[name].to_pylist()), kind)

    hashes = column("hashes", "<u8")
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    docs = column("docs", "<i8").reshape(-1, 2)
    owner = np.repeat(np.arange(len(docs)), column("counts", "<u4"))[twice]
    rows = np.empty(int(twice.sum()), ANCHOR)
    places = column("places", "<u4").astype(np.int64)
    at = 0
    for low, high in zip(table["places"].to_pylist(), table["high"].to_pylist()):
        if high:
            places[at : at + len(low) // 4] |= np.frombuffer(high, "<u4").astype(np.int64) << 32
        at += len(low) // 4
    rows["hash"], rows["place"] = hashes[twice], places[twice]
    rows["most"], rows["least"] = column("most", "u1")[twice], column("least", "u1")[twice]
    cuts = np.flatnonzero(np.diff(owner)) + 1 if len(owner) else np.empty(0, np.int64)
    edges = [0, *cuts.tolist(), len(owner)] if len(owner) else [0]
    blobs = [rows[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    of = docs[owner[edges[:-1]]] if blobs else np.empty((0, 2), np.int64)
    return pa.table({"doc": pa.array(of[:, 0]), "digest": pa.array(of[:, 1]), "anchors": pa.array(blobs, pa.binary())})


#: Bytes around an anchor, where in them it stands, and its windows' starts; without bytes, repeated windows.
RECORD = "whole boolean, bytes binary, before int, doc long, digest long, first long, last long"
RECORD_KINDS = (pa.bool_(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
RECORD_NAMES = ["whole", "bytes", "before", "doc", "digest", "first", "last"]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(RECORD_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, RECORD_KINDS)], names=RECORD_NAMES)


def _cut_records(length: int):
    """A record for each distinct surroundings of an anchor, and runs of repeated windows."""

    def run(batches):
        earliest: dict[bytes, tuple] = {}
        out: list[tuple] = []

        def stand():
            for data, (place, before) in earliest.items():
                out.append((True, data, before, *place, place[2] + len(data) - length))
            earliest.clear()

        for batch in batches:
            docs, digests, lists = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for doc, digest, text, blobs in zip(docs, digests, _texts(batch.column(2)), lists):
                anchors = np.sort(np.frombuffer(b"".join(blobs), ANCHOR), order="place")
                tail = None
                for at, most, least in zip(*(anchors[c].tolist() for c in ("place", "most", "least"))):
                    data = text[at - most : at - least + length]
                    mine = (doc, digest, at - most)
                    known = earliest.setdefault(data, (mine, most))[0]
                    if known == mine:
                        continue
                    if mine < known:
                        earliest[data] = (mine, most)
                    later = max(mine, known)
                    if tail is not None and later is mine and tail[1] + 1 == at - most:
                        tail[1] = at - least  # goes on where the run before it ends
                    else:
                        if tail is not None:
                            out.append((False, None, None, doc, digest, *tail))
                            tail = None
                        if later is mine:
                            tail = [at - most, at - least]
                        else:
                            out.append((False, None, None, *known, known[2] + len(data) - length))
                if tail is not None:
                    out.append((False, None, None, doc, digest, *tail))
                if len(earliest) > 4 * RECORDS_AT_ONCE:
                    stand()
                while len(out) > RECORDS_AT_ONCE:
                    yield _records(out[:RECORDS_AT_ONCE])
                    del out[:RECORDS_AT_ONCE]
        stand()
        for i in range(0, len(out), RECORDS_AT_ONCE):
            yield _records(out[i : i + RECORDS_AT_ONCE])

    return run


def multikey_sort(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``starts`` that share all ``length`` bytes with another of their group, and classes of these.

    A three-way split at every step, for all groups at once: sort by the next eight bytes within a
    group, split it where they change, and go on with parts of two and more.
    """
    rows = np.arange(len(starts))
    for depth in [*range(0, length - 8, 8), max(0, length - 8)]:
        if not len(rows):
            break
        words = data[(starts[rows] + depth)[:, None] + np.arange(min(8, length))]
        words = np.pad(words, ((0, 0), (8 - words.shape[1], 0))).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((words, groups))
        rows, groups, words = rows[order], groups[order], words[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (groups[1:] != groups[:-1]) | (words[1:] != words[:-1])
        part = np.cumsum(fresh) - 1
        several = np.bincount(part)[part] > 1
        rows, groups = rows[several], part[several]
    return rows, groups


def repeated_windows(records: list[tuple], length: int) -> list[tuple]:
    """Runs (doc, digest, first, last) of windows that are equal to an earlier one, among records of whole anchors."""
    out = []
    kept: dict[bytes, tuple] = {}
    for data, before, doc, digest, first in records:
        mine = (doc, digest, first, before)
        known = kept.setdefault(data, mine)
        if known[:3] != mine[:3]:
            kept[data] = min(known, mine)
            later = max(known, mine)
            out.append((*later[:3], later[2] + len(data) - length))
    by_gram: dict[bytes, list] = {}
    for data, mine in kept.items():
        by_gram.setdefault(data[mine[3] : mine[3] + GRAM], []).append((mine, data))
    groups = [g for g in by_gram.values() if len(g) > 1]
    several = sorted((mine, data, g) for g, group in enumerate(groups) for mine, data in group)
    if not several:
        return out
    sizes = np.array([len(d) for _, d, _ in several])
    flat = np.frombuffer(b"".join(d for _, d, _ in several), np.uint8)
    windows = sizes - length + 1
    of = np.repeat(np.arange(len(several)), windows)
    inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(np.cumsum(sizes) - sizes, windows) + inside
    before = np.array([m[3] for m, _, _ in several])[of] - inside
    group = np.array([g for _, _, g in several])[of] * 256 + before
    rows, classes = multikey_sort(flat, starts, group, length)
    if not len(rows):
        return out
    order = np.lexsort((rows, classes))  # rows stand in the order of the corpus
    rows, classes = rows[order], classes[order]
    later = np.sort(rows[1:][classes[1:] == classes[:-1]])
    cuts = np.flatnonzero((np.diff(later) != 1) | (np.diff(of[later]) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(later)]):
        if b > a:
            mine = several[of[later[a]]][0]
            out.append((mine[0], mine[1], mine[2] + int(inside[later[a]]), mine[2] + int(inside[later[b - 1]])))
    return out


RUNS = "doc long, digest long, first long, last long"
#: A run of repeated windows, or windows of one bucket by hash: their bytes and places, one after another.
MET = f"bucket int, windows binary, places binary, {RUNS}"
MET_KINDS = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
MET_NAMES = ["bucket", "windows", "places", "doc", "digest", "first", "last"]


def _met(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(MET_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, MET_KINDS)], names=MET_NAMES)


def _run(doc: int, digest: int, first: int, last: int) -> tuple:
    return None, None, None, doc, digest, first, last


def window_hashes(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    words = np.pad(windows, ((0, 0), (0, -windows.shape[1] % 8))).view("<u8")
    h = np.zeros(len(words), np.uint64)
    for i in range(words.shape[1]):
        h = (h ^ words[:, i]) * MIX
        h ^= h >> np.uint64(32)
    return h


class _Windows:
    """Single windows of some records, equal ones merged and dealt by hash, and runs of repeated ones."""

    def __init__(self, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.earliest: dict[bytes, tuple] = {}
        self.out: list[tuple] = []

    def add(self, records: list[tuple]) -> None:
        for data, _, doc, digest, first in records:
            run = None
            for i in range(len(data) - self.length + 1):
                mine, window = (doc, digest, first + i), data[i : i + self.length]
                known = self.earliest.setdefault(window, mine)
                if mine > known:
                    if run is not None and run[1] + 1 == first + i:
                        run[1] = first + i  # goes on where the run before it ends
                    else:
                        if run is not None:
                            self.out.append(_run(doc, digest, *run))
                        run = [first + i, first + i]
                elif mine < known:
                    self.earliest[window] = mine
                    self.out.append(_run(*known, known[2]))
            if run is not None:
                self.out.append(_run(doc, digest, *run))

    def take(self, at_least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.out) + len(self.earliest) > at_least:
            for i in range(0, len(self.out), RECORDS_AT_ONCE):
                yield _met(self.out[i : i + RECORDS_AT_ONCE])
            self.out.clear()
            if self.earliest:
                yield _met(list(self._dealt()))
                self.earliest.clear()

    def _dealt(self) -> Iterator[tuple]:
        windows = np.frombuffer(b"".join(self.earliest), np.uint8).reshape(-1, self.length)
        places = np.array(list(self.earliest.values()), "<i8")
        bucket = (window_hashes(windows) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = (np.flatnonzero(np.diff(bucket[order])) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(order)]):
            rows = order[a:b]
            yield int(bucket[rows[0]]), windows[rows].tobytes(), places[rows].tobytes(), None, None, None, None


def _compare_records(length: int, hot: int, buckets: int):
    """Records sorted by their anchors' suffixes.

    Anchors inside the bucket are compared here, several at a time. The first and the last of a bucket
    may go on in the next one, and an anchor may have very many records: these go on as windows.
    """

    def run(batches):
        held: list[tuple] = []  # records of anchors that are whole
        own: list[tuple] = []  # records of the anchor that is being read
        gram, is_first, spilling = None, True, False
        windows = _Windows(length, buckets)
        for batch in batches:
            for record in zip(*(c.to_pylist() for c in batch.columns)):
                here = record[0][record[1] : record[1] + GRAM]
                if here != gram:
                    if is_first or spilling:
                        windows.add(own)
                    else:
                        held.extend(own)
                    is_first = gram is None
                    gram, own, spilling = here, [], False
                    if len(held) >= RECORDS_AT_ONCE:
                        yield _met([_run(*r) for r in repeated_windows(held, length)])
                        held = []
                own.append(record)
                if len(own) > hot:
                    spilling = True
                    windows.add(own)
                    own = []
                    yield from windows.take(at_least=8 * RECORDS_AT_ONCE)
        windows.add(own)
        yield _met([_run(*r) for r in repeated_windows(held, length)])
        yield from windows.take()

    return run


def later_windows(windows: list[bytes], places: list[bytes], length: int) -> list[tuple]:
    """(doc, digest, first) of each window that is equal to another that stands earlier in the corpus.

    Only windows whose hash occurs twice are compared, and these by all of their bytes.
    """
    flat = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, length)
    at = np.frombuffer(b"".join(places), "<i8").reshape(-1, 3)
    hashes = window_hashes(flat)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    earliest: dict[bytes, tuple] = {}
    out = []
    for i in order[twice].tolist():
        mine, window = tuple(at[i].tolist()), flat[i].tobytes()
        known = earliest.setdefault(window, mine)
        if mine != known:
            earliest[window] = min(mine, known)
            out.append(max(mine, known))
    return out


def _compare_windows(length: int):
    """Windows in the order of their buckets, one bucket at a time."""

    def run(batches):
        bucket, windows, places = None, [], []

        def late() -> pa.RecordBatch:
            rows = [(*place, place[2]) for place in later_windows(windows, places, length)]
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "digest", "first", "last"])

        for batch in batches:
            for mine, some, of in zip(*(c.to_pylist() for c in batch.columns)):
                if mine != bucket and windows:
                    yield late()
                    windows, places = [], []
                bucket = mine
                windows.append(some)
                places.append(of)
        if windows:
            yield late()

    return run


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs [start, end) of bytes under windows: ``starts`` are runs (first, last) of their starts."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    runs = np.sort(starts, order="first")
    begins, ends = runs["first"], np.maximum.accumulate(runs["last"] + length)
    fresh = np.concatenate([[True], begins[1:] > ends[:-1]])
    return np.stack([begins[fresh], ends[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(ends) - 1]])]], axis=1)


def _keyed(docs: DataFrame) -> tuple[Column, Column, Column]:
    text = text_of()
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("doc"), F.xxhash64(text).alias("digest"), text.cast("binary").alias("data")


def repeated_runs(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc, digest, runs): starts of the windows of ``length`` bytes that also start earlier.

    Earlier means a smaller ``doc_id``, or the same row and an earlier start. Rows that share both
    ``doc_id`` and text are one document; rows that share ``doc_id`` only follow the hash of their texts.
    A null ``doc_id`` comes before all others, a null text is empty. ``runs`` is little-endian pairs of
    64-bit (first, last), one pair after another, in lists; documents without any do not occur.
    """
    if not GRAM < length <= GRAM + 256:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 256}")
    spark = docs.sparkSession
    folder = work_folder(spark, "suffixes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(*_keyed(docs))
    n_bytes = keyed.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-n_bytes // BYTES_PER_BUCKET))
    dealt = keyed.mapInArrow(_deal_anchors(buckets, length), DEALT)
    twice = dealt.groupBy("bucket").applyInArrow(_repeated_anchors, "doc long, digest long, anchors binary")
    twice = stored(twice, folder, "anchors")

    lists = twice.groupBy("doc", "digest").agg(F.collect_list("anchors").alias("anchors"))
    with_text = keyed.join(lists, ["doc", "digest"]).select("doc", "digest", "data", "anchors")
    records = stored(with_text.mapInArrow(_cut_records(length), RECORD), folder, "records", by="whole")
    drop(spark, f"{folder}/anchors")

    suffix = [F.expr(f"substring(bytes, before + 1, {GRAM})"), F.col("bytes")]
    ordered = records.filter("whole").select("bytes", "before", "doc", "digest", "first").repartitionByRange(n, *suffix)
    met = stored(ordered.sortWithinPartitions(*suffix).mapInArrow(_compare_records(length, hot, n), MET), folder, "met")
    drop(spark, f"{folder}/records/whole=true")

    names = ["doc", "digest", "first", "last"]
    singles = met.filter(F.col("bucket").isNotNull()).select("bucket", "windows", "places")
    singles = singles.repartitionByRange(n, "bucket").sortWithinPartitions("bucket")
    late = stored(singles.mapInArrow(_compare_windows(length), RUNS), folder, "late")

    runs = records.filter(~F.col("whole")).select(*names)
    every = runs.unionByName(met.filter(F.col("bucket").isNull()).select(*names)).unionByName(late)
    packed = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("first", "last")]))
    return every.groupBy("doc", "digest").agg(F.collect_list(packed).alias("runs"))


def _whole_characters(data: bytes, first: int, end: int) -> tuple[int, int]:
    """``data[first:end]`` without the rest of a character at its start and the begin of one at its end."""

    def inside(at):
        return 0 < at < len(data) and data[at] & 0xC0 == 0x80

    while first < end and inside(first):
        first += 1
    while end > first and inside(end):
        end -= 1
    return first, end


def cut_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, characters: bool = False) -> DataFrame:
    """(row, data, spans, kept) of every row of ``docs``.

    ``row`` holds its columns, ``data`` the UTF-8 bytes of its text (null: empty), ``spans`` the maximal
    removed byte ranges, ``kept`` the other bytes in order; with ``characters`` without those of characters
    that a range cuts in two. No rows give no rows. See ``repeated_runs``.
    """

    def run(batches):
        for batch in batches:
            spans, kept = [], []
            for data, runs in zip(_texts(batch.column(1)), batch.column(2).to_pylist()):
                starts = np.frombuffer(b"".join(runs or ()), RUN.newbyteorder(">"))
                ranges = covered(starts.astype(RUN), length)
                at, parts = 0, []
                for a, b in [*ranges.tolist(), [len(data), len(data)]]:
                    first, end = _whole_characters(data, at, a) if characters else (at, a)
                    parts.append(data[first:end])
                    at = b
                spans.append([{"first": a, "end": b} for a, b in ranges.tolist()])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["row", "data", "spans", "kept"],
            )

    runs = repeated_runs(docs, length, hot)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    keyed = docs.select(row, *_keyed(docs))
    joined = keyed.join(runs, ["doc", "digest"], "left").select("row", "data", "runs")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {kind}, data binary, spans array<struct<first: bigint, end: bigint>>, kept binary")


def removed_summary(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    A null text is empty; a null ``doc_id`` comes before all others. Rows that share id and text are one document, cut
    alike; rows that share an id only follow the hash of their texts. Other columns are not read. No rows give no rows.
    """
    cut = cut_repeats(docs.select("doc_id", "text"), length, hot)
    n_bytes = F.octet_length("data").cast("long")
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; all columns as they were, ``n_chars`` counted anew.

    Cuts fall between bytes, so a character that is cut in two is dropped; all others stay. A null text stays null.
    """
    names = docs.columns
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("all"), F.col("text").isNull().alias("null"), "doc_id", "text")
    cut = cut_repeats(marked, length, characters=True)
    out = []
    for c in names:
        if c == "text":
            value = F.when(~F.col("row.null"), F.col("kept").cast("string"))
        elif c == "n_chars":
            value = F.when(~F.col("row.null"), F.length(F.col("kept").cast("string")).cast(docs.schema[c].dataType))
        else:
            value = F.col("row")["all"][c]
        out.append(value.alias(c))
    return cut.select(*out)
