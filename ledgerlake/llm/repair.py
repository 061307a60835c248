"""Conversation structure repair by a grammar-compressed shortest path.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each row may be kept, given the role that is due,
or deleted, and empty turns may be inserted; rows that are blank or repeat an earlier row must go. A row
matters to the cheapest edits by its initial and its fault only, so conversations become sequences of nine
symbols, cut into chunks of bounded size. Re-Pair replaces pairs of symbols that occur often in the whole
table by rules. A symbol has a min-plus matrix: from each state of the pattern to each, the least cost and the
ASCII-least audit of that cost. A rule's matrix is the product of its two symbols' ones; its audits are ropes,
which share those of the parts. Rules are evaluated once, bottom-up, and every distinct sequence once, as a
product over what the grammar leaves of it. Chunks of one conversation are joined by the same product.

Equal costs between the same states never have audits of which one begins the other (the audit settles the
state, and further inserts cost more), so the least audit of a product is made of the least of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import buckets_for, drop, ship, stored, work_folder

ship(__name__)

RETYPE, REMOVE, ADD, CUT_OFF = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
LEGAL = ("su", "ua", "au")
#: Symbol of a row that must go; the others are 1 + 2 * (place in ``INITIALS``, or 3) + (is cut off).
GONE = 0
TERMINALS = 9

#: A chunk ends at so many rows or so many characters of text.
CHUNK_ROWS, CHUNK_CHARS = 1024, 16_384
#: Pairs read in a round, rules in all, and the least share of symbols that a round must save.
PAIRS, MAX_RULES, LEAST_GAIN = 256, 1024, 0.01

#: Distinct sequences that one task counts and rewrites.
SEQUENCES_PER_TASK = 20_000

SPACES = " \t\n\u000b\f\r"
BASE, MODULUS = 1_000_003, (1 << 127) - 1

CHUNKS = (
    "conv_id long, part int, chunk long, symbols binary, roles array<string>, texts array<string>, blank long, duplicate long, "
    "truncated long, illegal long, n_turns long, low long, high long, first_initial string, last_initial string"
)
ENTRIES = "symbols binary, entries array<struct<i:int,j:int,cost:long,audit:string>>"
DECISIONS = "conv_id long, part int, chunk long, state int, audit string, cost long"
SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, position long, role string, text string"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in, by the crc32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes it the user's.
    A null role or text is one space, and so is a null number within the key.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), part("role").alias("role"), part("text").alias("text"), kind.alias("_kind"))
    changed = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    left = rows.where("_kind <> 0").select("conv_id", "turn", role.alias("role"), changed.alias("text"), times.alias("_copy"))
    return left.drop("_copy")


class Rope:
    """A text made of two others, with a hash that tells equal ones apart from others (127 bits)."""

    __slots__ = ("left", "right", "text", "size", "hash", "power")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * BASE + ord(c)) % MODULUS
            self.power = pow(BASE, self.size, MODULUS)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % MODULUS
            self.power = left.power * right.power % MODULUS

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope(left=self, right=other)

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.left is None:
                parts.append(rope.text)
            else:
                todo += (rope.right, rope.left)
        return "".join(parts)


def less(a: Rope, b: Rope) -> bool:
    """Whether one text is before another; equal stretches are passed over by their hashes."""
    xs, ys = [a], [b]
    while xs and ys:
        x, y = xs.pop(), ys.pop()
        if x is y or (x.size == y.size and x.hash == y.hash):
            continue
        if x.left is not None and (x.size >= y.size or y.left is None):
            xs += (x.right, x.left)
            ys.append(y)
        elif y.left is not None:
            ys += (y.right, y.left)
            xs.append(x)
        else:
            n = min(x.size, y.size)
            if x.text[:n] != y.text[:n]:
                return x.text < y.text
            xs += [Rope(x.text[n:])] if x.size > n else []
            ys += [Rope(y.text[n:])] if y.size > n else []
    return not xs and bool(ys)


Matrix = dict[tuple[int, int], tuple[int, Rope]]


def offer(matrix: dict, at, cost: int, audit: Rope) -> bool:
    """Take an entry that is cheaper, or as cheap and before the one there."""
    known = matrix.get(at)
    if known is None or cost < known[0] or (cost == known[0] and less(audit, known[1])):
        matrix[at] = cost, audit
        return True
    return False


def due(state: int) -> int:
    """The state after the turn that a state waits for: a user's, or after it an assistant's."""
    return ASSISTANT if state == USER else USER


def terminal(symbol: int) -> Matrix:
    """The matrix of one row: turns inserted before it, then what happens to it."""
    out: Matrix = {}
    whose, cut_off = divmod(symbol - 1, 2)
    for start in range(4):
        state, inserted = start, 0
        while True:
            cost, audit = ADD * inserted, "I" * inserted
            offer(out, (start, state), cost + REMOVE, Rope(audit + "D"))
            if symbol != GONE:
                cost += CUT_OFF * cut_off
                offer(out, (start, due(state)), cost + RETYPE, Rope(audit + "R"))
                if whose == 0 and state == START:
                    offer(out, (start, SYSTEM), cost, Rope(audit + "K"))
                if whose > 0 and whose + 1 == due(state):
                    offer(out, (start, due(state)), cost, Rope(audit + "K"))
            state, inserted = due(state), inserted + 1
            if state == start or inserted > 2:
                break
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (cost, audit) in a.items():
        for j in range(4):
            more = b.get((k, j))
            if more is not None:
                offer(out, (i, j), cost + more[0], audit + more[1])
    return out


def closing(state: int) -> int:
    """Turns to insert at the end."""
    return {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def symbol_of(initial: str, cut_off: bool) -> int:
    place = INITIALS.find(initial) if initial else -1
    return 1 + 2 * (place if place >= 0 else 3) + cut_off


# Re-Pair over all sequences


def _decoded(column) -> list[np.ndarray]:
    return [np.frombuffer(v, np.int32) for v in column.to_pylist()]


def pair_counts(sequences: Iterable[np.ndarray], times: Iterable[int]) -> dict[int, int]:
    """How often each pair of neighbours occurs, as ``left << 32 | right``."""
    out: dict[int, int] = {}
    for s, n in zip(sequences, times):
        for pair, k in zip(*np.unique(s[:-1].astype(np.int64) << 32 | s[1:], return_counts=True)):
            out[int(pair)] = out.get(int(pair), 0) + int(k) * n
    return out


def chosen(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs, most frequent first, that share no symbol: all can be replaced at once."""
    used: set[int] = set()
    out = []
    for pair in pairs:
        if used.isdisjoint(pair):
            used.update(pair)
            out.append(pair)
    return out


def rewritten(s: np.ndarray, rules: dict[tuple[int, int], int]) -> np.ndarray:
    """A sequence with its pairs replaced, from left to right."""
    out, i, items = [], 0, s.tolist()
    while i < len(items):
        rule = rules.get((items[i], items[i + 1])) if i + 1 < len(items) else None
        out.append(items[i] if rule is None else rule)
        i += 1 if rule is None else 2
    return np.array(out, np.int32)


def grammar(sequences: DataFrame, folder: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``sequences`` (symbols, n) with ``coded``, and the rules: rule r stands for a pair, as symbol TERMINALS + r.

    Spark counts pairs and rewrites; the driver sees ``PAIRS`` counts a round and at most ``MAX_RULES`` rules.
    """
    def start(batches):
        for batch in batches:
            coded = [np.frombuffer(v, np.uint8).astype(np.int32).tobytes() for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(coded, pa.binary())], names=["symbols", "n", "coded"])

    def count(batches):
        total: dict[int, int] = {}
        symbols = 0
        for batch in batches:
            found, times = _decoded(batch.column(1)), batch.column(0).to_pylist()
            symbols += sum(len(s) * n for s, n in zip(found, times))
            for pair, k in pair_counts(found, times).items():
                total[pair] = total.get(pair, 0) + k
        total[-1] = symbols
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pair", "k"])

    given = stored(sequences.select("symbols", "n"), folder, "sequences")
    few = given.coalesce(buckets_for(given.count(), per_bucket=SEQUENCES_PER_TASK))  # rounds over short lists should be short
    now = stored(few.mapInArrow(start, "symbols binary, n long, coded binary"), folder, "coded0")
    rules: list[tuple[int, int]] = []
    while len(rules) < MAX_RULES:
        counts = now.select("n", "coded").mapInArrow(count, "pair long, k long").groupBy("pair").agg(F.sum("k").alias("k"))
        top = counts.orderBy(F.col("pair") >= 0, F.desc("k"), "pair").limit(PAIRS + 1).collect()
        frequent = [(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF) for r in top[1:] if r["k"] > 1]
        new = chosen(frequent)[: MAX_RULES - len(rules)]
        saved = sum(r["k"] for r in top[1:] if (r["pair"] >> 32, r["pair"] & 0xFFFFFFFF) in set(new))
        if not new or saved < LEAST_GAIN * top[0]["k"]:
            break
        made = {pair: TERMINALS + len(rules) + i for i, pair in enumerate(new)}
        rules += new

        def rewrite(batches, made=made):
            for batch in batches:
                coded = [rewritten(s, made).tobytes() for s in _decoded(batch.column(2))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(coded, pa.binary())], names=["symbols", "n", "coded"])

        now = stored(now.mapInArrow(rewrite, now.schema), folder, f"coded{len(rules)}")
    return now, rules


def matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    """The matrix of every symbol, bottom-up; at most ``TERMINALS + MAX_RULES`` of sixteen entries."""
    out = [terminal(s) for s in range(TERMINALS)]
    for left, right in rules:
        out.append(product(out[left], out[right]))
    return out


def evaluate(coded: Iterable[int], known: list[Matrix]) -> Matrix:
    found: Matrix = {(s, s): (0, Rope()) for s in range(4)}
    for symbol in coded:
        found = product(found, known[symbol])
    return found


# Streams over sorted partitions


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    """The same columns in Arrow; called on the driver, which knows the session."""
    return to_arrow_schema(T.StructType.fromDDL(schema))


class _Chunk:
    """Rows of one conversation that follow each other."""

    def __init__(self):
        self.symbols = bytearray()
        self.roles, self.texts, self.chars = [], [], 0
        self.faults = [0, 0, 0]
        self.illegal = self.n_turns = 0
        self.low = self.high = None
        self.first = self.last = None

    def add(self, turn, role: str, text: str, fault: int, times: int) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += (times - 1) * (initial + initial not in LEGAL)
        self.last = initial
        if fault:
            self.faults[fault - 1] += times
        if turn is not None and turn != self.high:
            self.n_turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault in (1, 2):
            self.symbols += bytes(times)
        else:
            self.symbols.append(symbol_of(initial, fault == 3))
            self.roles.append(role), self.texts.append(text)
            self.chars += len(text)

    def full(self) -> bool:
        return len(self.symbols) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def row(self, conv, part: int, chunk: int) -> tuple:
        facts = (*self.faults, self.illegal, self.n_turns, self.low, self.high, self.first, self.last)
        return (conv, part, chunk, bytes(self.symbols), self.roles, self.texts, *facts)


def _chunker(schema: pa.Schema):
    """Chunks of rows (conv_id, turn, role, text, kind, is_first, times) that come in order."""

    def run(batches):
        part, number, conv, chunk, out = TaskContext.get().partitionId(), 0, None, None, []
        for row_conv, turn, role, text, kind, is_first, times in _rows(batches):
            if chunk is None or row_conv != conv:
                if chunk is not None:
                    out.append(chunk.row(conv, part, number))
                    number += 1
                conv, chunk = row_conv, _Chunk()
            first = 1 if kind == 1 else 2 if not is_first else 3 if kind == 2 else 0
            copies = [(first, 1)] + ([(1 if kind == 1 else 2, times - 1)] if times > 1 else [])
            for fault, left in copies:
                while left:
                    if chunk.full():
                        out.append(chunk.row(conv, part, number))
                        number, chunk = number + 1, _Chunk()
                    some = min(left, CHUNK_ROWS)
                    chunk.add(turn, role, text, fault, some)
                    left -= some
            if len(out) >= 200:
                yield _batch(out, schema)
                out = []
        if chunk is not None:
            out.append(chunk.row(conv, part, number))
        if out:
            yield _batch(out, schema)

    return run


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with one first value, each to be read before the next."""
    yield from groupby(rows, key=itemgetter(0))


def _decider(schema: pa.Schema):
    """The audit of every chunk (conv_id, part, chunk, entries), once its whole conversation was seen.

    Of a conversation it holds the entries of its chunks: some eleven bytes a row.
    """

    def run(batches):
        out = []
        for conv, rows in _groups(_rows(batches)):
            best = {START: (0, Rope())}
            steps = []
            for _, part, chunk, entries in rows:
                after: dict = {}
                via: dict[int, dict] = {}
                for e in entries:
                    if e["i"] in best:
                        cost, audit = best[e["i"]]
                        if offer(after, e["j"], cost + e["cost"], audit + Rope(e["audit"])):
                            via[e["j"]] = e
                best = after
                steps.append((part, chunk, via))
            ends: dict = {}
            for state, (cost, audit) in best.items():
                extra = closing(state)
                if offer(ends, 0, cost + ADD * extra, audit + Rope("I" * extra)):
                    last = state
            found, tail = [], "I" * closing(last)
            for part, chunk, via in reversed(steps):
                e = via[last]
                found.append((conv, part, chunk, e["i"], e["audit"] + tail, e["cost"] + ADD * len(tail)))
                last, tail = e["i"], ""
            out += found
            if len(out) >= 2000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return run


def edited(symbols: bytes, roles: list[str], texts: list[str], state: int, audit: str) -> Iterator[tuple[str, str]]:
    """The turns that the edits of a chunk leave."""
    at = held = 0
    for edit in audit:
        if edit == "I":
            yield ("assistant" if state == USER else "user"), ""
            state = due(state)
            continue
        is_held = symbols[at] != GONE
        if edit == "R":
            yield ("assistant" if state == USER else "user"), texts[held]
            state = due(state)
        elif edit == "K":
            yield roles[held], texts[held]
            state = SYSTEM if roles[held][:1] == "s" else due(state)
        at, held = at + 1, held + is_held


def _applied(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, its chunks with their decisions) of rows in order, a decision before its chunk."""

    def met(some):
        decision = None
        for row in some:
            if row[3] == 0:
                decision = row[4:7]
            else:
                yield decision, row[7:]

    for conv, some in _groups(rows):
        yield conv, met(some)


def _summarizer(schema: pa.Schema):
    def run(batches):
        out = []
        for conv, chunks in _applied(_rows(batches)):
            digest, audits, any_turn = hashlib.sha256(), [], False
            faults, illegal, cost, n_turns = [0, 0, 0], 0, 0, 0
            low = high = last = None
            for (state, audit, paid), (symbols, roles, texts, *facts) in chunks:
                for role, text in edited(symbols, roles, texts, state, audit):
                    digest.update((("\n" if any_turn else "") + f"{role}:{text}").encode())
                    any_turn = True
                audits.append(audit)
                cost += paid
                faults = [a + b for a, b in zip(faults, facts[:3])]
                between, turns, least, most, first, end = facts[3:]
                illegal += between + (last is not None and last + first not in LEGAL)
                n_turns += turns - (least is not None and least == high)
                low = least if low is None else low
                high = most if most is not None else high
                last = end
            gaps = 0 if low is None else high - low + 1 - n_turns
            out.append((conv, gaps, *faults, illegal, cost, "".join(audits), digest.hexdigest()))
            if len(out) >= 2000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return run


def _writer(schema: pa.Schema):
    def run(batches):
        out, size = [], 0
        for conv, chunks in _applied(_rows(batches)):
            position = 0
            for (state, audit, _), (symbols, roles, texts, *_) in chunks:
                for role, text in edited(symbols, roles, texts, state, audit):
                    out.append((conv, position, role, text))
                    position, size = position + 1, size + len(text)
                if size > 1 << 22 or len(out) >= 10_000:
                    yield _batch(out, schema)
                    out, size = [], 0
        if out:
            yield _batch(out, schema)

    return run


# The operator


def _in_order(conversations: DataFrame, folder: str) -> DataFrame:
    """Chunks of all conversations. Equal rows count as one with a number of times; ranges split any conversation."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    bare = F.rtrim("text", F.lit(SPACES))
    kind = F.when(F.length(bare) == 0, 1).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 2).otherwise(0)
    given = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = given.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    rows = rows.withColumns({"kind": kind, "mark": F.unhex(F.sha2("text", 256))})
    rows = stored(rows, folder, "rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.groupBy("conv_id", "role", "mark").agg(F.min(place).alias("first")).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    marked = rows.join(firsts, same).select(
        "conv_id", "turn", "role", "text", "kind", F.col("turn").eqNullSafe(F.col("first.turn")).alias("is_first"), "times", "mark"
    )
    marked = stored(marked, folder, "marked")
    drop(rows.sparkSession, f"{folder}/rows")
    order = ["conv_id", "turn", "role", "mark"]
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark")
    chunks = stored(sorted_rows.mapInArrow(_chunker(_arrow(CHUNKS)), CHUNKS), folder, "chunks")
    drop(rows.sparkSession, f"{folder}/marked")
    return chunks


def _decided(conversations: DataFrame) -> DataFrame:
    """Chunks and, before each, its decision, in the order of conversations within each partition."""
    folder = work_folder(conversations.sparkSession, "repair")
    chunks = _in_order(conversations, folder)
    sequences = chunks.groupBy("symbols").agg(F.count("*").alias("n"))
    coded, rules = grammar(sequences, folder)
    known = matrices(rules)
    entries_schema = _arrow(ENTRIES)

    def evaluated(batches):
        for batch in batches:
            rows = []
            for symbols, s in zip(batch.column(0).to_pylist(), _decoded(batch.column(1))):
                found = evaluate(s.tolist(), known)
                rows.append((symbols, [{"i": i, "j": j, "cost": c, "audit": str(a)} for (i, j), (c, a) in found.items()]))
            if rows:
                yield _batch(rows, entries_schema)

    entries = stored(coded.select("symbols", "coded").mapInArrow(evaluated, ENTRIES), folder, "entries")
    met = chunks.select("conv_id", "part", "chunk", "symbols").join(entries, "symbols").select("conv_id", "part", "chunk", "entries")
    met = met.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    decisions = stored(met.mapInArrow(_decider(_arrow(DECISIONS)), DECISIONS), folder, "decisions")
    both = decisions.withColumn("kind", F.lit(0)).unionByName(chunks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.select("conv_id", "part", "chunk", "kind", "state", "audit", "cost", *_names(CHUNKS)[3:])
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "kind")


def repair_summary(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation that has rows.

    Rows are taken by turn, null turns first; rows of one turn by role, then by the digest of their text, so
    that equal ones follow each other. A null role or text is one space; rows without a ``conv_id`` are one
    conversation. Other columns are not read. No rows give no rows. A conversation of any length is cut over
    tasks by ranges; its audit and digest come from one task, as a stream of chunks.
    """
    return _decided(conversations).mapInArrow(_summarizer(_arrow(SUMMARY)), SUMMARY)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations; cases as in ``repair_summary``."""
    return _decided(conversations).mapInArrow(_writer(_arrow(TURNS)), TURNS)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair_summary`` of the damaged rows, for every ``conv_id`` of the undamaged ones.

    A conversation that lost all its rows has zeros, an empty audit and the digest of nothing.
    """
    found = repair_summary(damage(conversations)).withColumnRenamed("conv_id", "_conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = _names(SUMMARY)
    return joined.select("conv_id", *[F.coalesce(c, F.lit(nothing.get(c, 0))).alias(c) for c in names[1:]])
