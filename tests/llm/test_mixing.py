import math

import pytest

import awkward
from tellwatt.llm.mixing import mix_sources, op2_mixing, targets


def filled(sizes):
    """Targets by handing the excess round until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return {**{s: 2 * sizes[s] for s in full}, **share}
        full |= set(over)
        left -= sum(2 * sizes[s] for s in over)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"b": 7, "a": 100, None: 40, "c": 0, "d": 900}, {"a": 5}, {"x": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(filled(sizes))


def test_query_on_odd_rows(spark, odd, rows):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    got = op2_mixing(spark, odd).collect()
    source = {}
    sizes = {}
    for doc, text, s in docs:
        n = len((text or "").encode().split())
        sizes[s] = sizes.get(s, 0) + n
        if doc is not None:
            source[doc] = s
    want = filled(sizes)
    assert len(got) == len(docs)
    taken = {}
    for r in got:
        assert r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert (r.source_size, r.target) == (sizes[s], pytest.approx(want[s]))
    for r in got:
        s = source.get(r.doc_id)
        taken[s] = taken.get(s, 0) + r.taken
    largest = {s: 1 for s in sizes}
    for doc, text, s in docs:
        largest[s] = max(largest[s], len((text or "").encode().split()) * sum(d == doc for d, _, _ in docs))
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, op2_mixing(spark, odd).collect()))


def test_chance_follows_size(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', IF(id % 2 = 0, 2, 8)) AS text", "'' AS lang", "IF(id < 3000, 'a', 'b') AS source", "1L AS n_chars")
    folder = awkward.saved(spark, str(tmp_path), documents=docs)
    rows = [r for r in op2_mixing(spark, folder).collect() if r.doc_id < 3000]
    share = {n: sum(r.taken > r.size * math.floor(r.target / r.source_size) for r in rows if r.size == n) / 1500 for n in (2, 8)}
    assert share[8] > share[2] + 0.05


def test_stage_and_empty(spark, odd, none):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    made = mix_sources(spark, docs, odd)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    words = sum(r.taken for r in op2_mixing(spark, odd).collect())
    assert sum(len((r.text or "").encode().split()) for r in made.collect()) == words
    assert op2_mixing(spark, none).collect() == []
    assert mix_sources(spark, spark.read.parquet(f"{none}/documents.parquet"), none).collect() == []
