import hashlib
from collections import Counter

import pytest

from tellwatt.llm import substrings
from tellwatt.llm.common import packed, unpacked
from tellwatt.llm.substrings import _from_gaps, _from_load, _gaps, _hasher, _to_load, op4_substrings, remove_repeats, substring_dedup


def removed(rows, window=50):
    first = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    for doc, w in split:
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone |= set(range(i, i + window))
        yield doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_query_is_brute_force(spark, odd, rows):
    got = Counter(tuple(r) for r in op4_substrings(spark, odd).collect())
    want = Counter((d, n, g, hashlib.sha256(k).hexdigest()) for d, n, g, k in removed(rows))
    assert got == want
    assert any(r[2] for r in want) and any(0 < r[2] < r[1] for r in want)


@pytest.mark.parametrize("bits", [4, 12])
def test_a_full_sketch_changes_nothing(spark, rows, bits):
    """However crowded the counters are, only work is added."""
    docs = spark.createDataFrame([r for r in rows], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept.encode()) for r in remove_repeats(docs, 20, bits).collect())
    assert got == Counter(removed(rows, 20))


def test_rows_under_one_id_are_judged_by_their_own_words(spark):
    shared, other = " ".join(f"s{k}" for k in range(60)), " ".join(f"o{k}" for k in range(60))
    rows = [(1, shared), (2, "lead " + shared), (2, other), (3, other), (2, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept.encode()) for r in remove_repeats(docs).collect())
    assert got == Counter(removed(rows))


def test_long_texts_are_cut_without_loss(monkeypatch):
    windows = _hasher(50)
    text = b" ".join(b"w%d" % (k * k % 1009) for k in range(900_000))
    parts = [(t, w, h) for text_, word, h1, _ in windows([b"a b", text]) for t, w, h in zip(text_, word, h1)]
    assert [w for _, w, _ in parts] == list(range(900_000 - 49)) and {t for t, _, _ in parts} == {1}
    few = text.split()[500_000:500_060]
    again = [h for *_, h1, _ in windows([b"  ".join(few)]) for h in h1]
    assert again == [h for _, _, h in parts[500_000:500_011]]


def test_codes_round_trip():
    import numpy as np

    numbers = np.array([0, 1, 254, 255, 256, 510, 70_000, 1 << 20])
    assert (_from_gaps(_gaps(numbers)) == numbers).all() and len(_from_gaps(_gaps(numbers[:0]))) == 0
    columns = [np.array([3, -1], np.int64), np.array([7, 8], np.uint16), np.zeros(0, np.uint32)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, unpacked(packed(*columns))))


def test_loads_round_trip():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (1, 5, 3000):
        doc = np.sort(rng.integers(-9, 9, n)) * (1 << 40)
        mark = np.where(doc > 0, doc.astype(np.uint64), np.uint64(0))
        word = rng.integers(0, 1 << 20, n).astype(np.uint32)  # in any order
        h1, h2 = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 32, n).astype(np.uint32)
        for columns in ((doc, mark, word), (doc, mark, word, h1, h2)):
            again = _from_load(_to_load(*columns))
            assert len(again) == len(columns)
            assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, again))


def test_empty(spark, none):
    assert op4_substrings(spark, none).collect() == []


def test_stage_keeps_documents_and_clean_texts(spark, odd, rows):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    made = substring_dedup(spark, docs, odd)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = Counter(
        (d, kept.decode() if gone else text) for (d, text), (_, _, gone, kept) in zip(rows, removed(rows))
    )
    found = made.collect()
    assert Counter((r.doc_id, r.text) for r in found) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found if r.doc_id is not None)


def test_registered_sql():
    assert substrings.QUERIES["op4_substrings"][1]


def test_structured_letters_make_no_windows_equal(spark):
    """Thue-Morse words and the same with letters swapped, which polynomials over letters can't tell apart."""
    bits = [bin(k).count("1") % 2 for k in range(2048 * 50)]
    one = ["".join("ab"[b] for b in bits[k * 2048:(k + 1) * 2048]) + "c" * (k % 7) for k in range(50)]
    two = [w.translate(str.maketrans("ab", "ba")) for w in one]
    docs = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one))], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs, width_bits=16).collect()} == {1: 0, 2: 0, 3: 50}


def test_only_touched_documents_are_shuffled(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"own{k} " * 10 + (passage if k in (5, 6, 9) else "")) for k in range(200)] + [(None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs, width_bits=16)
    assert {r.doc_id: r.n_removed for r in got.collect() if r.n_removed} == {6: 60, 9: 60} and got.count() == 201
