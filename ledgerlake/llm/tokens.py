"""Exact token ids from the vocabulary files, with a bounded cache of pieces in every Python worker.

A text is cut where both of its parts are certain to be tokenized apart, each distinct piece goes to
the tokenizer once per worker, and the ids of a text are the ids of its pieces joined. Texts where a
cut could be unsafe (special strings, white space beyond ASCII) are encoded whole. With a byte-level
vocabulary a group of texts is cut at its spaces by Arrow, and each distinct word of it is cut and looked up once.
"""

from __future__ import annotations

import codecs
import gc
import re
import sys
import types
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters and marks between which both kinds of pre-tokenizer always cut; no apostrophe, because of
# contractions, no digits, and no İ, which lower case turns into two characters.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
MARKS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
PIECE = re.compile(rf" ?[{LETTERS}]+(?=[{MARKS}\s]|\Z)| ?\S+|\s+(?!\S)|\s")
WORD = re.compile(rf"[{LETTERS}]+(?=[{MARKS}\s]|\Z)|\S+")
SIMPLE = re.compile(rf" ?[{LETTERS}]+")
UNSAFE_ASCII = re.compile("[\x1c-\x1f]")
UNSAFE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
# White space beside a space, at the end or at the start: then single spaces are no safe cuts.
WIDE = re.compile(r" \s|[^\S ] |\s\Z|\A\s")
#: Cheap tests that come first: nearly all texts hold no white space but single spaces and line feeds.
OTHER_SPACES = "\t\r\x0b\x0c"
WIDE_PAIRS = ("  ", " \n", "\n ")
MAX_PIECES = 400_000
MAX_PIECE_CHARS = 64
#: Characters of the texts whose distinct words are looked up together, at most.
GROUP_CHARS = 4 << 20


def _byte_level() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(plain)))
    return [table[b] for b in range(256)]


def has_wide_space(text: str) -> bool:
    """Whether ``WIDE`` finds something, for a text without unsafe characters."""
    if any(c in text for c in OTHER_SPACES):
        return WIDE.search(text) is not None
    return any(p in text for p in WIDE_PAIRS) or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")


class Encoder:
    """One vocabulary file; ``ids_of`` gives the ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        from array import array

        self._array = array
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ids_of = lambda text: self._pack(self.model.encode(text))
            return
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.special = [t["content"] for t in parts.get("added_tokens") or []]
        kind = self._kind(parts)
        if kind is None:
            self.ids_of = self._whole
            return
        self.lower = kind == "words"
        self.split = (WORD if self.lower else PIECE).findall
        if self.lower:  # no spaces in pieces: a word and a part of a word that are spelled alike are one entry
            self.parts = self.spaced = Pieces(self._word, max_pieces)
        else:
            self.parts = Pieces(self._piece, max_pieces)
            self.ids_of_each = self._grouped
        self.alphabet = "".join(_byte_level())

    @staticmethod
    def _kind(parts: dict) -> str | None:
        """``bytes`` or ``words`` for the two layouts whose cuts are known; None: always encode whole."""
        normalizer, pre = parts.get("normalizer"), parts.get("pre_tokenizer") or {}
        if parts["model"].get("dropout") or parts["model"]["type"] != "BPE":
            return None
        if normalizer is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "bytes"
        steps = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
        inner = [s["type"] for s in pre.get("pretokenizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and inner == ["Split", "ByteLevel"]:
            return "words"
        return None

    def _pack(self, ids: list[int]) -> bytes:
        packed = self._array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        if SIMPLE.fullmatch(piece):  # one pre-token: straight to the model
            plain = piece.lower() if self.lower else piece
            mapped, _ = codecs.charmap_decode(plain.encode(), "strict", self.alphabet)
            return self._pack([t.id for t in self.model.tokenize(mapped)])
        return self._whole(piece)

    def _word(self, piece: str) -> bytes:
        """A word, or a part of one; a part is never cut again."""
        if SIMPLE.fullmatch(piece):
            return self._piece(piece)
        parts = self.split(piece)
        return self._whole(piece) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def _unsafe(self, text: str) -> bool:
        return bool((UNSAFE_ASCII if text.isascii() else UNSAFE).search(text)) or any(s in text for s in self.special)

    def ids_of(self, text: str) -> bytes:
        if self._unsafe(text):
            return self._whole(text)
        if self.lower:
            return b"".join(map(self.spaced.__getitem__, text.split()))
        return b"".join(map(self.parts.__getitem__, self.split(text)))

    def ids_of_each(self, texts: Iterable[str]) -> Iterable[bytes]:
        return map(self.ids_of, texts)

    def _grouped(self, texts: Iterable[str]) -> Iterable[bytes]:
        """The ids of each text; texts are held in groups of ``GROUP_CHARS`` characters at most."""
        held, chars = [], 0
        for text in texts:
            if held and chars + len(text) > GROUP_CHARS:
                yield from self._group(held)
                held, chars = [], 0
            held.append(text)
            chars += len(text)
        yield from self._group(held)

    def _group(self, texts: list[str]) -> list[bytes]:
        """The ids of each text of a group, its distinct words looked up once."""
        apart = [not t or len(t) > GROUP_CHARS or has_wide_space(t) or self._unsafe(t) for t in texts]
        alike = [t for t, a in zip(texts, apart) if not a]
        if not alike:
            return [self.ids_of(t) for t in texts]
        words = pc.split_pattern(pa.array(alike, pa.string()), " ")
        coded = words.values.dictionary_encode()
        # No word holds a space or has white space at an end, so the parts that start with a space start the words.
        distinct = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        parts = self.split(" " + pc.binary_join(distinct, " ")[0].as_py())
        ids = pa.array(list(map(self.parts.__getitem__, parts)), pa.binary())
        first = np.flatnonzero(pc.starts_with(pa.array(parts, pa.string()), " ").to_numpy(zero_copy_only=False))
        _, ends, data = ids.buffers()
        starts = np.frombuffer(ends, np.int32, len(ids) + 1)[np.append(first, len(ids))]
        whole = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(starts), data])
        _, ends, data = whole.take(coded.indices).buffers()
        ends, at, data = np.frombuffer(ends, np.int32, len(coded) + 1), words.offsets.to_numpy(), memoryview(data)
        rests = (data[start:end] for start, end in zip(ends[at[:-1] + 1].tolist(), ends[at[1:]].tolist()))
        return [self.ids_of(t) if a else self.ids_of(t.partition(" ")[0]) + next(rests) for t, a in zip(texts, apart)]


class Pieces(dict):
    """Remembers what ``make`` gives for a piece, for a bounded number of short pieces."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(self) < self.most and len(piece) <= MAX_PIECE_CHARS:
            self[piece] = ids
        return ids


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file. It outlives a task, though this code is shipped by value."""
    held = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker"))
    known = held.__dict__.setdefault("encoders", {})
    if path not in known:
        held.__dict__.clear()  # one kind of cache in a worker at a time
        known = held.__dict__.setdefault("encoders", {})
        gc.disable()  # the caches hold no cycles, and walking them again and again costs more than the work
        known[path] = Encoder(path)
    return known[path]


def ids_of_all(path: str, texts: Iterable[str | None]) -> Iterable[bytes]:
    each = encoder(path).ids_of_each
    gc.collect()  # what earlier batches and tasks of this worker left in cycles, their texts among them
    return each(t or "" for t in texts)
