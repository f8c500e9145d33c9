import hashlib
from collections import Counter

import pytest

from tellwatt.llm import phrases as module
from tellwatt.llm.phrases import Parse, _place, compare_edits, fingerprints, likeness, op6_phrases, written


def plainly(data: bytes):
    """The phrases themselves, each the shortest that is new."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


def signature(text):
    parse = Parse()
    parse.read((text or "").encode())
    return parse.signature()


@pytest.mark.parametrize("data", [b"", b"a", b"aaaaaaaaaa", b"abracadabra abracadabra", bytes(range(256)) * 3])
def test_parse(data):
    parse = Parse()
    parse.read(data[:7])
    node, phrases = parse.node, len(parse.log)
    parse.read(b"something else")
    parse.back_to(node, phrases)
    parse.read(data[7:])
    assert len(parse.log) == len(plainly(data)) == len(set(parse.hashes)) - 1


def test_query_is_brute_force(spark, odd, rows):
    hashed = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]), reverse=True)
    want = Counter()
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = signature(text), signature(edited), signature(after)
        want[doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c)] += 1
    for runs in ("4", "1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", runs)
        try:
            got = Counter(tuple(r) for r in op6_phrases(spark, odd).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert got == want


def test_fingerprints(spark, odd, rows):
    got = Counter(tuple(r) for r in fingerprints(spark.read.parquet(f"{odd}/documents.parquet")).collect())
    assert got == Counter((d, written(signature(t))) for d, t in rows)


def test_likeness_tells_edits_from_others():
    text = "the quick brown fox jumps over the lazy dog " * 3 + "and then some more words follow it until the end"
    other = "pack my box with five dozen liquor jugs, said the judge, who was known for odd wishes and long sentences"
    assert likeness(signature(text), signature(text)) == 1
    assert likeness(signature(text), signature(text[:100] + other[:40])) > 2 * likeness(signature(text), signature(other))
    assert likeness(signature(""), signature("")) == 1 and likeness(signature(""), signature("a")) == 0


def test_place(spark):
    got = spark.range(12).select(_place([2, 5, 5, 9], __import__("pyspark").sql.functions.col("id")).alias("p")).collect()
    assert [r.p for r in got] == [0, 0, 1, 1, 1, 3, 3, 3, 3, 4, 4, 4]


def test_empty_and_single(spark, none):
    assert op6_phrases(spark, none).collect() == []
    one = compare_edits(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_tasks_give_memory_back(spark, monkeypatch):
    wrapped, real = [], module.giving_back
    monkeypatch.setattr(module, "giving_back", lambda run: wrapped.append(run) or real(run))
    df = spark.createDataFrame([(1, "abcdef"), (2, "abc")], "doc_id long, text string")
    assert compare_edits(df).count() == fingerprints(df).count() == 2
    assert len(wrapped) == 2
