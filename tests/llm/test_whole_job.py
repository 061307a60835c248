"""The whole job of operators where a part of it was once left out."""

from __future__ import annotations

import random

import pytest
from ledgerlake.llm import decontamination, sharding, suffixes


# Shards without free documents

@pytest.mark.parametrize("sizes", [[2] * 2000, [2, 3, 5, 7] * 200 + [1] * 5, [700, 900] + [2] * 1000])
def test_copies_gather_where_few_or_no_rows_are_free(spark, sizes):
    r = random.Random(7)
    texts = [f"text {g}" for g, n in enumerate(sizes) for _ in range(n)]
    r.shuffle(texts)
    found = sharding.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas()
    counts = found.groupby("shard").size()
    assert len(counts) == 8 and counts.max() - counts.min() <= 1
    shards = found.assign(text=[texts[d] for d in found.doc_id]).groupby("text").shard.agg(["count", "nunique"])
    least = -(-shards["count"] // counts.max())
    assert (shards["nunique"] > least).mean() < 0.03
    large = shards[shards["count"] > 100]
    assert (large["nunique"] <= large["count"] // 450 + 2).all()


def test_grants_keep_counts_and_follow_cycles():
    assert sharding._grants([[0, 5, 0], [0, 0, 4], [3, 0, 0]], [0, 0, 0])[0] == [[0, 3, 0], [0, 0, 3], [3, 0, 0]]
    r = random.Random(8)
    for _ in range(300):
        wishes = [[0 if i == j or r.random() < 0.4 else r.randrange(9) for j in range(8)] for i in range(8)]
        free = [r.choice([0, 0, 3, 20]) for _ in range(8)]
        granted, returned = sharding._grants(wishes, free)
        assert all(0 <= granted[i][j] <= wishes[i][j] for i in range(8) for j in range(8))
        assert all(sum(returned[j]) <= free[j] for j in range(8))
        for s in range(8):
            out = sum(granted[s]) + sum(returned[s])
            into = sum(granted[i][s] + returned[i][s] for i in range(8))
            assert out == into


# Characters at cuts

def test_only_characters_cut_in_two_are_dropped(spark):
    shared = " ".join(map(str, range(60)))
    texts = {1: "clean � text", 2: f"one é{shared}a", 3: f"two ĩ{shared}b �", 4: None}  # é and ĩ end in the same byte
    docs = spark.createDataFrame([(d, t, len(t or "")) for d, t in texts.items()], "doc_id long, text string, n_chars int")
    cut = {x["doc_id"]: (x["text"], x["n_chars"]) for x in suffixes.without_repeats(docs).collect()}
    assert cut == {1: (texts[1], 12), 2: (texts[2], len(texts[2])), 3: ("two b �", 7), 4: (None, None)}


def test_pieces_keep_whole_characters():
    data = "aé�👍b".encode()
    for a in range(len(data) + 1):
        for b in range(a, len(data) + 1):
            first, end = suffixes._whole_characters(data, a, b)
            want = data[a:b].decode(errors="ignore") if a < b else ""
            assert data[first:end].decode() == want


# Decontamination

def _held(spark, items, docs):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    marked = decontamination.mark_documents(frame, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {x["doc_id"]: x["item_ids"] for x in marked.collect()}


def test_items_that_repeat_a_window_nearby_are_found(spark):
    asked = "we know that if John is 5 years old and Mary is 7 years old then how old are they together in all"
    other = "we know that if Rita is 8 years old and Paul is 3 years old then how old are they together in all"
    mixed = "we know that if Rita is 8 years old and Rita is 8 years old then how old are they together in all"
    docs = [asked, f"some words before {other} and after", "if John is 5 years old and Mary is 7 years old", mixed]
    held = _held(spark, [asked], docs)
    assert held[0] == held[1] == [0] and held[2] == []


def test_names_at_the_start_of_sentences_are_read_both_ways(spark):
    asked = "Tom has 3 apples. Tom buys 5 more. How many apples does Tom have?"
    other = "Ann has 9 apples. Ann buys 4 more. How many apples does Ann have?"
    wrong = "Ann has 9 apples. Bob buys 4 more. How many apples does Eve have?"
    assert _held(spark, [asked], [asked, other, f"first words, {other}", wrong]) == {0: [0], 1: [0], 2: [0], 3: []}


def test_short_items_are_matched_as_a_whole(spark):
    items = ["name three primes", "7 8 9 10 11 12"]
    docs = ["please name three primes now", "name four", "1 2 7 8 9 10 11 12 13", "1 2 3 4 5 6 7"]
    assert _held(spark, items, docs) == {0: [0], 1: [], 2: [1], 3: []}


NAMES = "Tom Ann Rita Paul Eve John Mary Hugo Nina Karl".split()
AMOUNTS = ["3", "7", "12", "fifteen", "twenty", "twenty-one", "two hundred and five", "ninety", "three thousand", "1,250"]
MEASURES = ["km", "miles", "yards", "feet", "inches", "kilometres", "metres", "furlongs"]
MONEY = ["dollars", "euros", "yen", "rupees", "pounds", "kroner"]
ORDER = ["first", "third", "twelfth", "21st", "ninth"]
QUESTIONS = [
    "{a} drives {x} {u} to the old mill and then {y} {u} back. How far does {a} drive on the {o} day?",
    "A train leaves the town at noon. {a} walks {x} {u} along the river while {b} rides {y} {u} by the road. Who is ahead?",
    "{a} has {x} {m} and {b} has {y} {m}. They share all of it with a neighbour. How much does each of them get?",
    "{a} reads {x} pages on the {o} evening. {b} reads {y} pages more than {a}. How many pages do both read together?",
]


def test_items_with_other_values_of_every_type_are_found(spark):
    r = random.Random(11)

    def filled():
        a, b = r.sample(NAMES, 2)
        x, y = r.sample(AMOUNTS, 2)
        return {"a": a, "b": b, "x": x, "y": y, "u": r.choice(MEASURES), "m": r.choice(MONEY), "o": r.choice(ORDER)}

    items = [q.format(**filled()) for q in QUESTIONS]
    docs = [f"Some text of another kind goes here. {QUESTIONS[i % 4].format(**filled())} And more text goes on." for i in range(200)]
    held = _held(spark, items, docs)
    assert sum(held[i] == [i % 4] for i in range(200)) >= 190
    crossed = "Zoe drives 9 km to the old mill and then 4 miles back. How far does Eve drive on the ninth day?"
    assert _held(spark, items[:1], [crossed]) == {0: []}


def test_number_words_are_read_by_a_grammar():
    from ledgerlake.llm.measures import is_ordinal, number_class

    known = decontamination.Words()
    for text in ("two hundred and five", "twenty one", "seven", "3 million", "twelve hundred", "nineteen thousand and forty", "twenty-one"):
        assert len(decontamination.Templates([f"sold {text} apples"], known).hashes) == 3, text
    assert len(decontamination.Templates(["one two three"], known).hashes) == 3
    assert len(decontamination.Templates(["hundred and apples"], known).hashes) == 3
    assert number_class("ninety-nine") and not number_class("nine-ninety") and not number_class("well-known")
    assert is_ordinal("twenty-first") and is_ordinal("3rd") and is_ordinal("nineteenth") and not is_ordinal("north")


def test_units_are_read_after_numbers_and_long_names_everywhere():
    def plain(text):
        t = decontamination.Templates([text], decontamination.Words())
        return [bool(p) for p in t.plain]

    for unit in "km miles yards foot feet inches ounces gallons yen rupees µg kWh GB kilohertz milliamperes °C m/s in".split():
        assert plain(f"about 40 {unit} more") == [True, False, False, True], unit
        assert plain(f"about forty {unit} more") == [True, False, False, True], unit
    assert plain("a cup in the yard") == [True] * 5
    assert plain("many kilometres away") == [True, False, True]
    assert plain("60 km per hour now") == [False, False, True, False, True]
    assert plain("wait a second") == [True, True, False] and plain("sold 5kg more") == [True, False, True]


def test_windows_of_several_texts_are_those_of_each():
    import numpy as np

    texts = ["Tom has 3 apples and two hundred and five pears", "", "-- !! --", "a b c d e f", "and", "five", "per hundred and"]
    known = decontamination.Words()
    for kind, length in [(k, 5) for k in (0, 1, 2)] + [(k, n) for k in (3, 4) for n in (1, 2, 3)]:
        together = decontamination.Templates(texts, known)
        hashes, at = together.windows(kind, length)
        got = [(int(together.text[a]), int(a - together.first[together.text[a]]), int(h)) for h, a in zip(hashes, at)]
        want = []
        for i, text in enumerate(texts):
            one = decontamination.Templates([text], known)
            assert one.size[0] == together.size[i]
            want += [(i, int(a), int(h)) for h, a in zip(*one.windows(kind, length))]
        assert got == want and len(np.unique(hashes)) == len({h for *_, h in want})


def test_a_long_document_that_repeats_a_window_is_gathered_in_ranges(spark):
    item = "how many red apples does the farmer sell on the market of the town"
    docs = ["how many red apples does " * 3000, "how many red apples does " * 3000 + "the farmer sell on the market of the town"]
    assert _held(spark, [item], docs) == {0: [], 1: [0]}


def test_items_in_capitals_and_weak_items(spark):
    items = ["the cat sat on the mat at noon", "Tom 5 plus Ann 7 9 minus Eve 8 3"]
    docs = ["THE CAT SAT ON THE MAT AT NOON", "Rita 4 plus Paul 6 2 minus Mary 1 9", "Rita 4 plus Paul 6 2 and Mary 1 9"]
    assert _held(spark, items, docs) == {0: [0], 1: [1], 2: []}
