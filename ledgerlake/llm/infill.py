"""Fill-in-the-middle texts by secondary-sort assembly.

A text is cut into units (its lines) at two places drawn from its id. Tasks emit the three parts as pieces
of consecutive units, keyed by document and by position in the output. One repartition by document with a
sort inside the partitions brings the pieces of a document together in output order, and a reader streams
them: it feeds digests (or the text, if asked for) piece by piece, finds the marks in the stream of
characters itself, and emits what stands between them under its position in the restored text. These are
sorted again within the same partitions, without another shuffle, and streamed into the restored text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

#: Code points of a piece: more units begin the next one, and a longer unit is cut.
PIECE_CHARS = 16_384
BATCH_CHARS = 1 << 22

PIECES = "row long, position int, doc_id long, n long, form string, prefix_chars long, middle_chars long, piece string"
PARTS = "row long, part int, position int, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, output string, piece string"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Infill:
    """How texts are transformed: the seed of the draws, shares in hundredths, and the three marks.

    A mark begins with a character that no mark has at another place, so marks cannot overlap.
    """

    seed: int = 7
    share: int = 100
    spm_share: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        firsts = {m[:1] for m in marks}
        if "" in firsts or len(set(marks)) < 3 or any(c in m[1:] for c in firsts for m in marks):
            raise ValueError("marks must differ, and their first characters stand at no other place in them")
        if any(a != b and b.startswith(a) for a in marks for b in marks):
            raise ValueError("a mark must not begin another")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def order(self, form: str) -> tuple[int, int, int]:
        """The parts (prefix 0, middle 1, suffix 2) in the order in which a form writes them."""
        return (0, 2, 1) if form == "psm" else (2, 0, 1)

    def mark(self, part: int) -> str:
        return (self.prefix, self.middle, self.suffix)[part]


def n_units(text: str) -> int:
    return text.count("\n") + (not text.endswith("\n")) if text else 0


def unit_start(text: str, unit: int) -> int:
    """Where a unit begins, in code points; the length of the text for the one past the last."""
    at = 0
    for _ in range(unit):
        at = text.find("\n", at) + 1
        if not at:
            return len(text)
    return at


def draw(doc_id: int | None, text: str, how: Infill) -> tuple[int, str, int, int]:
    """Units, form, and the two cuts of a text in code points. A null id counts as no digits."""
    n = n_units(text)
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= how.share or any(m in text for m in how.marks):
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start = unit_start(text, low)
    return n, "spm" if h4 % 100 < how.spm_share else "psm", start, start + unit_start(text[start:], high - low)


def chunks(text: str, start: int, end: int) -> Iterator[str]:
    """Whole units of a stretch, as many as a piece takes; only a unit that is longer is cut."""
    while start < end:
        stop = min(start + PIECE_CHARS, end)
        if stop < end:
            line = text.rfind("\n", start, stop) + 1
            stop = line if line > start else stop
        yield text[start:stop]
        start = stop


def pieces_of(text: str, form: str, a: int, b: int, how: Infill) -> Iterator[str]:
    """The output of a text in order, marks included; an empty text has one empty piece."""
    if form == "plain":
        yield from chunks(text, 0, len(text)) if text else ("",)
        return
    places = ((0, a), (a, b), (b, len(text)))
    for part in how.order(form):
        yield how.mark(part)
        yield from chunks(text, *places[part])


class Reader:
    """Finds the parts in a stream of output characters, from the form alone."""

    def __init__(self, form: str, how: Infill):
        self.parts = (1,) if form == "plain" else how.order(form)
        self.marks = [] if form == "plain" else [how.mark(p) for p in self.parts]
        self.part = 1 if form == "plain" else None
        self.held = ""

    def read(self, some: str) -> Iterator[tuple[int, str]]:
        """(part, characters) of what is sure; the end of ``some`` may be held back as the start of a mark."""
        text = self.held + some
        while self.marks:
            at = text.find(self.marks[0])
            if at < 0:
                break
            if self.part is not None and at:
                yield self.part, text[:at]
            text = text[at + len(self.marks[0]) :]
            self.marks.pop(0)
            self.part = self.parts[len(self.parts) - len(self.marks) - 1]
        keep = len(self.marks[0]) - 1 if self.marks else 0
        self.held = text[len(text) - keep :] if keep else ""
        sure = text[: len(text) - keep] if keep else text
        if sure:
            yield self.part, sure

    def close(self) -> Iterator[tuple[int, str]]:
        if self.marks:
            raise ValueError("the output lacks a mark of its form")
        if self.held:
            yield self.part, self.held


class _Out:
    """Rows gathered to batches of bounded size."""

    def __init__(self, schema: str):
        types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        self.schema = pa.schema([(n, types[t]) for n, t in (c.split() for c in schema.split(", "))])
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= BATCH_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.size = [], 0


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def infill_pieces(docs: DataFrame, how: Infill = Infill()) -> DataFrame:
    """The outputs of all documents as pieces (``PIECES``), each keyed by its row and its place in the output.

    The facts of a document stand on its first piece only. ``row`` is the place of the row in the input,
    so rows that repeat an id or a whole row stay apart and no key is hot.
    """

    def run(batches):
        out = _Out(PIECES)
        for row, doc, text in _rows(batches):
            text = text or ""
            n, form, a, b = draw(doc, text, how)
            facts = (doc, n, form, None if form == "plain" else a, None if form == "plain" else b - a)
            for position, piece in enumerate(pieces_of(text, form, a, b, how)):
                yield from out.add((row, position, *(facts if not position else (None,) * 5), piece), len(piece))
        yield from out.flush()

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(run, PIECES)


def infill_documents(docs: DataFrame, how: Infill = Infill(), with_text: bool = False) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row.

    ``n`` counts units; the two lengths are null where the form is plain. ``restored_sha256`` is of the text
    rebuilt from the output and its form. ``with_text`` adds ``output``, the transformed text. A null text is
    empty, and an empty one plain; a null id draws like an id without digits. Rows that repeat an id or a
    whole row each have their result. Other columns are not read. No rows give no rows.
    """
    parts = _sorted_by(infill_pieces(docs, how).repartition("row"), "position").mapInArrow(_assembler(how, with_text), PARTS)
    result = RESULT + ", output string" if with_text else RESULT
    return _sorted_by(parts, "part", "position").mapInArrow(_restorer(result, with_text), result)


def _sorted_by(df: DataFrame, *order: str) -> DataFrame:
    return df.sortWithinPartitions("row", *order)


def _assembler(how: Infill, with_text: bool):
    """Streams pieces in output order; gives the facts of each document as part -1 and its restored pieces."""

    def run(batches):
        out = _Out(PARTS)
        nothing = (None,) * 7
        at, facts, digest, reader, text, places = None, (), None, None, [], [0, 0, 0]

        def emit(found):
            for part, some in found:
                yield from out.add((at, part, places[part], *nothing, some), len(some))
                places[part] += 1

        def close():
            if at is not None:
                yield from emit(reader.close())
                whole = "".join(text) if with_text else None
                yield from out.add((at, -1, 0, *facts, digest.hexdigest(), whole, None), len(whole or ""))

        for row, position, *own, piece in _rows(batches):
            if row != at:
                yield from close()
                if position:
                    raise ValueError("a document's first piece is missing")
                at, facts, digest, reader, text, places = row, tuple(own), hashlib.sha256(), Reader(own[2], how), [], [0, 0, 0]
            digest.update(piece.encode())
            if with_text:
                text.append(piece)
            yield from emit(reader.read(piece))
        yield from close()
        yield from out.flush()

    return run


def _restorer(result: str, with_text: bool):
    """Streams restored pieces, the facts of their document first, into a digest."""

    def run(batches):
        out = _Out(result)
        at, facts, digest = None, (), None

        def close():
            if at is not None:
                *known, whole = facts
                yield from out.add((*known, digest.hexdigest(), *((whole,) if with_text else ())), len(whole or ""))

        for row, part, _, *own, piece in _rows(batches):
            if row != at:
                yield from close()
                at, facts, digest = row, tuple(own), hashlib.sha256()
            if part >= 0:
                digest.update(piece.encode())
        yield from close()
        yield from out.flush()

    return run


def restore(output: str, form: str, how: Infill = Infill()) -> str:
    """The text of one output."""
    reader, parts = Reader(form, how), ["", "", ""]
    for part, some in (*reader.read(output), *reader.close()):
        parts[part] += some
    return "".join(parts)
