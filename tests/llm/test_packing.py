import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tellwatt.llm.packing import best_fit_packing, default_tokenizer, op7_packing, packed, plan, sequences, tokenized

ODD = ["it's.", "IT'S!", "don't,", "a<|endoftext|>b", "<|endoftext|>.", "É.", "x'", "'s'", "ﬁ.", "word's. next", "\xa0x.",
       "İ.", "ß!", "a\x1cb.", "9.", "a….", "Σ.", "''.", "we'LL.", "<|.", "a|>", "한글.", "é.", "́x"]


def pieces(rows, capacity=2048):
    model = Tokenizer.from_file(default_tokenizer())
    for doc, text in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            some = ids[at:at + capacity]
            yield doc, k, at, len(some), zlib.crc32(some.tobytes())


def gapless(rows, capacity=2048):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_query_is_brute_force(spark, odd, rows):
    got = op7_packing(spark, odd).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(pieces(rows))
    assert gapless(got) == -(-sum(r.length for r in got) // 2048)


def test_words_are_tokenized_as_in_their_text(spark):
    dice = random.Random(3)
    rows = list(enumerate([*ODD, *(" ".join(dice.choices(ODD, k=20)) for _ in range(60)), "y" * 3000, "x " * 5000]))
    got = tokenized(spark.createDataFrame(rows, "doc_id long, text string"), default_tokenizer(), keep_ids=False).collect()
    assert Counter(map(tuple, got)) == Counter(pieces(rows))


def best(sizes, capacity):
    """The fewest sequences, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    fewest = [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= fewest[0]:
            return
        if k == len(sizes):
            fewest[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[k]:
                left = list(rooms)
                left.remove(room)
                place(k + 1, (*left, room - sizes[k]))
        place(k + 1, (*rooms, capacity - sizes[k]))

    place(0, ())
    return fewest[0]


@pytest.mark.parametrize("seed", range(12))
def test_plan_fills_few_sequences(seed):
    dice = random.Random(seed)
    sizes = [dice.randint(1, 20) for _ in range(9)]
    made = plan(Counter(sizes), 20)
    assert Counter(s for group, n in made for s in group for _ in range(n)) == Counter(sizes)
    assert all(sum(group) <= 20 for group, _ in made)
    assert sum(n for _, n in made) <= best(sizes, 20) + 1


def test_plan_fixes_dominant_sets():
    assert plan({}, 10) == []
    assert sorted(plan({10: 3, 7: 2, 3: 1}, 10)) == [((7,), 1), ((7, 3), 1), ((10,), 3)]
    assert plan({5: 5}, 10) == [((5, 5), 2), ((5,), 1)]
    assert sum(n for _, n in plan({1: 10**9, 9: 10**9}, 10)) == 10**9


def test_one_length_has_many_places(spark):
    cut = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "IF(id % 3 = 0, 700L, id % 2000 + 1) AS length", "id AS ids_crc32")
    got = packed(cut).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 5000
    rooms = []  # the longest first, each where the least room is left
    for size in sorted((r.length for r in got), reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= size
        else:
            rooms.append(2048 - size)
    assert gapless(got) <= len(rooms)


def test_sequences_hold_the_ids(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    placed = packed(tokenized(docs, default_tokenizer()))
    ids = {r.sequence_id: r.ids for r in sequences(placed).collect()}
    for r in placed.collect():
        part = ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]
        assert zlib.crc32(part) == r.ids_crc32


def test_stage_and_empty(spark, odd, none):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    assert best_fit_packing(spark, docs, odd).count() == op7_packing(spark, odd).count()
    assert op7_packing(spark, none).collect() == []
