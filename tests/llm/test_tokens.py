from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import tokens
from ledgerlake.llm.queries import vocabulary
from ledgerlake.llm.tokens import Encoder, ids_of_all

BYTES = vocabulary("byte_bpe_50k.json")
BITS = ["ab", "Zürich", "ab.\nÉAI", "don't", "x.y", "3km", "<|endoftext|>", "é", "İ", "_", "日本", "👍🏽", "!!", "\x00", "", " ", "\n", "\xa0"]


def ids(packed) -> list[int]:
    return memoryview(bytes(packed)).cast("I").tolist()


def test_texts_of_a_group_have_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_CHARS", 20)
    own, library = Encoder(BYTES, max_pieces=8), Tokenizer.from_file(BYTES)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(BITS), max_size=9).map(" ".join), max_size=9))
    def check(texts):
        found = [ids(i) for i in own.ids_of_each(iter(texts))]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]

    check()


def test_a_word_of_many_texts_is_encoded_once_even_with_a_full_cache(monkeypatch):
    made = []
    piece = Encoder._piece
    monkeypatch.setattr(Encoder, "_piece", lambda self, p: made.append(p) or piece(self, p))
    own, library = Encoder(BYTES, max_pieces=1), Tokenizer.from_file(BYTES)
    texts = [f"a haus, Zürich haus.\nhaus {'Wort ' * (n % 3)}x" for n in range(100)]
    found = [ids(i) for i in own.ids_of_each(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert made.count(" Zürich") == made.count(" Wort") == 1 and made.count(" haus") == 2  # " haus" starts two words


def test_null_and_empty_texts_and_no_texts():
    library = Tokenizer.from_file(BYTES)
    texts = [None, "", "one", "a b", None, " a  b "]
    found = [ids(i) for i in ids_of_all(BYTES, texts)]
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(ids_of_all(BYTES, [])) == []
