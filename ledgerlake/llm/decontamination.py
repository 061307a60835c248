"""Benchmark decontamination by templates.

Texts become templates: numbers (digits, or words by a grammar), ordinals, units, amounts and capitalised
names give typed placeholders, all other words their lower case. A number of several words is one
placeholder; a word that may be a unit is one after a number. Windows of five template words of the benchmark
are joined by hash with those of the documents. An item is found in a document where 0.8 of its windows or
more match, each once, near one shift of places, and where every slot value of the item stands for one value
of the document in all of these: so the same question with other numbers or names is caught, and a text that
merely fits the template piece by piece is not. A capital at a sentence's start has the same one reading as
any other; that the values are equal, or stand for each other throughout, is left to the slots.

Next to templates every item is looked for word by word (without regard to case, and to marks around words),
which also serves items of fewer words than a window, or with nothing but slots in it.

Windows are filtered in the tasks by a Bloom filter of the benchmark, whose size is fixed; beyond the
number of windows that it is made for it lets more through, and the join still decides.
"""

from __future__ import annotations

import re
import sys
import types
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import measures
from .common import ship, stored, work_folder
from .measures import GOES_ON, HUNDRED, NUMBER, ONE, SCALE, TEEN, TEN, is_ordinal, number_class, unit_words

ship(__name__, measures.__name__)

WORDS = 5
SHARE = 0.8
#: Bits of the Bloom filter, and how many of them a window sets.
BLOOM_BITS, BLOOM_PROBES = 1 << 23, 3
#: A window of a template counts if it has so many words that are no placeholders.
LEAST_PLAIN = 2
#: Matches whose places differ by fewer words than this belong together.
NEAR = 16
MAX_KNOWN_WORDS = 200_000
#: Words of documents that are worked on at once.
WORDS_AT_ONCE = 1 << 15
BASE = np.uint64(0x9E3779B97F4A7C15)

DIGITS = re.compile(r"[+\-]?[$€£¥₹₩]?\d[\d.,:/]*%?")
AMOUNT = re.compile(r"[+\-]?[$€£¥₹₩]?\d[\d.,]*([^\d\s]+)")
EDGES = "\"'“”‘’«»()[]{}<>.,;:!?¡¿*_`|~#&-–—"
ALWAYS_UNITS, AFTER_NUMBERS = unit_words()

# What a word is, beyond the number classes 1 to 6.
PLAIN, ORDINAL, UNIT, MAY_BE_UNIT, NAME, NAME_OR_UNIT, SECOND, AMOUNTS, AND, PER, SKIP = 0, *range(7, 17)
KINDS = 17
NUMBERS = np.isin(np.arange(KINDS), (NUMBER, ONE, TEEN, TEN, HUNDRED, SCALE))
RUNS_ON = np.zeros((KINDS, KINDS), bool)
for _pair in GOES_ON:
    RUNS_ON[_pair] = True
RUNS_ON[TEN, ORDINAL] = True
JOINS_AND = np.isin(np.arange(KINDS), (HUNDRED, SCALE))
AFTER_AND = np.isin(np.arange(KINDS), (ONE, TEEN, TEN))
#: Names of placeholders by kind.
TYPES = {NUMBER: "<number>", ORDINAL: "<ordinal>", UNIT: "<unit>", NAME: "<name>", AMOUNTS: "<amount>"}
SLOT_HASH = np.zeros(KINDS, np.uint64)
for _kind, _type in TYPES.items():
    SLOT_HASH[_kind] = xxhash.xxh64_intdigest(_type)

# Kinds of windows: of templates with enough plain words, literal, of templates with one plain word; whole short items.
TEMPLATE, LITERAL, WEAK, SHORT, SHORT_LITERAL = range(5)


def word_kind(raw: str) -> tuple[int, str]:
    """What a word is, and its value: lower case, without marks around it. Words of marks only are skipped."""
    bare = raw.strip(EDGES)
    if not bare:
        return SKIP, ""
    low = bare.lower()
    if DIGITS.fullmatch(low):
        return NUMBER, low
    if number := number_class(low):
        return number, low
    if low == "second":
        return SECOND, low
    if is_ordinal(low):
        return ORDINAL, low
    if low in ALWAYS_UNITS:
        return UNIT, low
    if (m := AMOUNT.fullmatch(low)) and (m[1] in ALWAYS_UNITS or m[1] in AFTER_NUMBERS):
        return AMOUNTS, low
    named = bare[0].isupper() and (len(bare) == 1 or bare[1:].upper() != bare[1:])  # words in capitals only are no names
    if low in AFTER_NUMBERS:
        return (NAME_OR_UNIT if named else MAY_BE_UNIT), low
    if named:
        return NAME, low
    return (AND if low == "and" else PER if low == "per" else PLAIN), low


class Words(dict):
    """A number for each word seen, and tables of what the numbers stand for.

    For words beyond a bounded number the tables are begun anew by ``tidy``.
    """

    def __init__(self):
        super().__init__()
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.values: list[str] = []
        self.hashes = np.empty(1024, np.uint64)
        self.kinds = np.empty(1024, np.int8)

    def tidy(self) -> None:
        if len(self) > MAX_KNOWN_WORDS:
            self._clear()

    def __missing__(self, raw: str) -> int:
        n = len(self.values)
        if n == len(self.kinds):
            self.hashes, self.kinds = (np.concatenate([t, np.empty_like(t)]) for t in (self.hashes, self.kinds))
        self.kinds[n], value = word_kind(raw)
        self.hashes[n] = xxhash.xxh64_intdigest(value)
        self.values.append(value)
        self[raw] = n
        return n


def _known_words() -> Words:
    """The worker's words. They outlive a task, though this code is shipped by value."""
    held = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker"))
    if "template_words" not in held.__dict__:
        held.__dict__.clear()  # one kind of cache in a worker at a time
        held.__dict__["template_words"] = Words()
    return held.__dict__["template_words"]


class Templates:
    """The templates of several texts, one after another.

    ``text`` says which text a template word is of, ``hashes`` what it is in the template and ``literal``
    what it is itself, ``plain`` whether it is no placeholder; ``value`` gives its words.
    """

    def __init__(self, texts: list[str], known: Words):
        known.tidy()
        split = [t.split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter((known[w] for some in split for w in some), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(len(texts)), sizes)
        kinds = known.kinds[words].astype(np.int64)
        keep = kinds != SKIP
        if not keep.all():
            words, of, kinds = words[keep], of[keep], kinds[keep]
        n = len(words)
        goes_on = np.zeros(n, bool)
        if n > 1:
            same = of[1:] == of[:-1]
            goes_on[1:] = RUNS_ON[kinds[:-1], kinds[1:]] & same
            inner = np.flatnonzero((kinds[1:-1] == AND) & JOINS_AND[kinds[:-2]] & AFTER_AND[kinds[2:]] & same[:-1] & same[1:]) + 1
            goes_on[inner] = goes_on[inner + 1] = True
        ends = np.ones(n, bool)
        ends[:-1] = ~goes_on[1:]
        self.starts = np.flatnonzero(~goes_on)
        self.stops = np.flatnonzero(ends) + 1
        last = kinds[self.stops - 1]
        self.text = of[self.starts]
        before = np.zeros(len(last), np.int64)
        before[1:] = np.where(self.text[1:] == self.text[:-1], last[:-1], 0)
        measured = NUMBERS[before] | (before == PER)
        kind = np.where(NUMBERS[last], NUMBER, last)
        kind = np.where((last == MAY_BE_UNIT) | (last == NAME_OR_UNIT) | (last == SECOND), np.where(measured, UNIT, np.where(last == SECOND, ORDINAL, np.where(last == NAME_OR_UNIT, NAME, PLAIN))), kind)
        kind = np.where((kind == AND) | (kind == PER), PLAIN, kind)
        self.plain = kind == PLAIN
        hashes = known.hashes[words]
        long_runs = self.stops - self.starts > 1
        self.literal = hashes[self.stops - 1] if n else hashes
        if long_runs.any():
            mixed = hashes * (2 * np.uint64(3) ** np.minimum(np.arange(n) - np.repeat(self.starts, self.stops - self.starts), 30).astype(np.uint64) + np.uint64(1))
            self.literal = np.where(long_runs, np.add.reduceat(mixed, self.starts), self.literal)
        self.hashes = np.where(self.plain, self.literal, SLOT_HASH[kind])
        self.words, self.known = words, known
        self.first = np.searchsorted(self.text, np.arange(len(texts)))
        self.size = np.diff(np.append(self.first, len(self.text)))

    def value(self, at: int) -> str:
        return " ".join(self.known.values[w] for w in self.words[self.starts[at] : self.stops[at]])

    def slots(self, at: int, length: int) -> str:
        """The slot values of a window, with their places in it."""
        return "\x1f".join(f"{i}\x1e{self.value(at + i)}" for i in range(length) if not self.plain[at + i])

    def windows(self, kind: int, length: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every window of a kind, and where it starts."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        of = self.literal if kind in (LITERAL, SHORT_LITERAL) else self.hashes
        h = np.full(n, kind << 8 | length, np.uint64)
        for i in range(length):
            h = h * BASE + of[i : i + n]
        inside = self.text[:n] == self.text[length - 1 :]
        if kind in (TEMPLATE, WEAK, SHORT):
            plain = np.zeros(n, np.int64)
            for i in range(length):
                plain += self.plain[i : i + n]
            inside &= plain == 1 if kind == WEAK else plain >= LEAST_PLAIN
        at = np.flatnonzero(inside)
        h = h[at]
        return h ^ (h >> np.uint64(31)), at


def bloom_places(hashes: np.ndarray, probe: int) -> np.ndarray:
    return ((hashes >> np.uint64(20 * probe)) * BASE >> np.uint64(64 - 23)).astype(np.int64)


ITEMS = "hash long, item_id long, kind int, place int, n_windows int, item_slots string, length int"
FOUND = "doc_id long, digest long, hash long, at int, doc_slots string"


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(hash, item_id, kind, place, n_windows, item_slots, length) of all items; an item without words has none."""
    names = [c.split()[0] for c in ITEMS.split(", ")]
    types_ = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32())

    def run(batches):
        known = _known_words()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), (v.as_py() for v in batch.column(1))):
                t = Templates([text or ""], known)
                n = len(t.hashes)
                wanted = [(LITERAL, WORDS), (TEMPLATE, WORDS)] if n >= WORDS else [(SHORT_LITERAL, n), (SHORT, n)] if n else []
                if n >= WORDS and t.plain.sum() >= LEAST_PLAIN and not len(t.windows(TEMPLATE)[0]):
                    wanted[1] = WEAK, WORDS
                for kind, length in wanted:
                    found, places = t.windows(kind, length)
                    for h, at in zip(found.view(np.int64).tolist(), places.tolist()):
                        slots = "" if kind in (LITERAL, SHORT_LITERAL) else t.slots(at, length)
                        rows.append((h, item, kind, at, len(found), slots, length))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types_)], names=names)

    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, ITEMS)


def bloom_of(found: DataFrame) -> np.ndarray:
    """The filter's bits, as bytes: of a fixed size, put together by Spark."""

    def run(batches):
        bits = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for probe in range(BLOOM_PROBES):
                bits[bloom_places(hashes, probe)] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(words[used])], names=["word", "bits"])

    words = np.zeros(BLOOM_BITS // 64, np.int64)
    for row in found.select("hash").mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return words.view(np.uint8)


def document_windows(docs: DataFrame, bloom: np.ndarray, kinds: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, digest, hash, at, doc_slots) of the windows of ``kinds`` (kind, length) that pass the filter."""
    held = docs.sparkSession.sparkContext.broadcast(bloom.tobytes())
    names = [c.split()[0] for c in FOUND.split(", ")]
    types_ = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())

    def run(batches):
        bits = np.frombuffer(held.value, np.uint8)
        known = _known_words()

        def found_in(ids, digests, texts, rows):
            t = Templates(texts, known)
            for kind, length in kinds:
                hashes, at = t.windows(kind, length)
                for probe in range(BLOOM_PROBES):  # most windows fail at the first
                    places = bloom_places(hashes, probe)
                    passed = bits[places >> 3] >> (places & 7).astype(np.uint8) & 1 != 0
                    hashes, at = hashes[passed], at[passed]
                for h, a in zip(hashes.view(np.int64).tolist(), at.tolist()):
                    i = t.text[a]
                    slots = "" if kind in (LITERAL, SHORT_LITERAL) else t.slots(a, length)
                    rows.append((ids[i], digests[i], h, a - int(t.first[i]), slots))

        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, texts, start, chars = [], [], 0, 0
            for i, value in enumerate(batch.column(2)):
                texts.append(value.as_py() or "")
                chars += len(texts[-1])
                if chars > 6 * WORDS_AT_ONCE or i == len(ids) - 1:
                    found_in(ids[start : i + 1], digests[start : i + 1], texts, rows)
                    texts, start, chars = [], i + 1, 0
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types_)], names=names)

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    return keyed.mapInArrow(run, FOUND)


def _values(text: str) -> list[str]:
    return [v.split("\x1e")[1] for v in text.split("\x1f")] if text else []


def best_share(matches: list[tuple[int, int, str, str]], n_windows: int, low: int, high: int) -> float:
    """The largest share of an item's windows that match consistently near one shift from ``low`` to below ``high``.

    ``matches`` are (place, shift, the item's slots, the document's). At every shift each item value stands
    for the document value that most matches give it. Matches that say otherwise go; places without a match
    take one from the nearest shift that is consistent with those before.
    """
    by_shift: dict[int, list] = {}
    for place, shift, i, d in sorted(matches):
        by_shift.setdefault(shift, []).append((place, list(zip(_values(i), _values(d)))))
    best = 0
    for base in sorted(s for s in by_shift if low <= s < high):
        near = [s for s in by_shift if abs(s - base) < NEAR]
        if len({p for s in near for p, _ in by_shift[s]}) <= best:
            continue
        votes = Counter(pair for _, pairs in by_shift[base] for pair in set(pairs))
        stands: dict[str, str] = {}
        for (i, d), _ in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
            stands.setdefault(i, d)
        placed: set[int] = set()
        for shift in sorted(near, key=lambda s: (abs(s - base), s)):
            for place, pairs in by_shift[shift]:
                if place not in placed:
                    new = dict(pairs)
                    if all(new[i] == d and stands.get(i, d) == d for i, d in pairs):
                        stands |= new
                        placed.add(place)
        best = max(best, len(placed))
    return best / n_windows


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, digest, item_id, found) of the benchmark items that documents hold.

    ``found`` is the share of the item's windows. Texts that are null or empty hold nothing, and items like
    these are held by none. Rows of one ``doc_id`` and text count once. Matches are gathered by document, item and
    a range of 3 x ``NEAR`` shifts, so no list is longer than that many times the item, however long the document.
    """
    folder = work_folder(docs.sparkSession, "leaks")
    items = stored(benchmark_windows(benchmark), folder, "items")
    kinds = sorted((r["kind"], r["length"]) for r in items.select("kind", "length").distinct().collect())  # at most ten
    mine = stored(document_windows(docs, bloom_of(items), kinds).distinct(), folder, "windows")
    shift = F.col("at") - F.col("place")
    cell = F.floor(shift / NEAR).cast("int")
    met = mine.join(items, "hash").select(
        "doc_id", "digest", "item_id", "kind", "n_windows",
        F.struct("place", shift.alias("shift"), "item_slots", "doc_slots").alias("match"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
    )
    grouped = met.groupBy("doc_id", "digest", "item_id", "kind", "cell").agg(
        F.first("n_windows").alias("n_windows"), F.collect_list("match").alias("matches")
    )
    enough = grouped.filter(F.size(F.array_distinct("matches.place")) >= share * F.col("n_windows"))

    def run(batches):
        for batch in batches:
            found = []
            for matches, n, c in zip(batch.column(4), batch.column(3).to_pylist(), batch.column(5).to_pylist()):
                found.append(best_share([tuple(m.values()) for m in matches.as_py()], n, c * NEAR, (c + 1) * NEAR))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.float64())], names=["doc_id", "digest", "item_id", "found"])

    shares = enough.select("doc_id", "digest", "item_id", "n_windows", "matches", "cell").mapInArrow(run, "doc_id long, digest long, item_id long, found double")
    return shares.filter(F.col("found") >= share).groupBy("doc_id", "digest", "item_id").agg(F.max("found").alias("found"))


def mark_documents(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, contaminated, item_ids, found) of every row: the items it holds, in order, and the largest share.

    Null and empty texts hold nothing; repeated rows and null ids each have their result. Other columns are not read.
    """
    found = leaks(docs, benchmark, share).groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("found").alias("found")
    )
    found = found.withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_digest"))
    same = rows["doc_id"].eqNullSafe(found["_id"]) & (rows["_digest"] == found["digest"])
    return rows.join(found, same, "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("found", F.lit(0.0)).alias("found"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Null and empty texts hold nothing and stay; rows that repeat an id and a text stay or go together, rows that
    share an id only by their texts. No rows give no rows.
    """
    found = leaks(docs, benchmark, share).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("_own"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_digest"))
    return marked.join(found, same, "left_anti").select("row.*")
