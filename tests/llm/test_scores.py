import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tellwatt.llm import scores as module
from tellwatt.llm.common import ASCII_LOWER, ASCII_UPPER
from tellwatt.llm.scores import _lowest, _mean_counts, learn, op12_scores, scored


def tokens(text):
    lower = (text or "").translate(str.maketrans(ASCII_UPPER, ASCII_LOWER))
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def held(c):
    """What a filter without false answers would say of a count."""
    low = _lowest(float(max(c, 1)) * 4)
    return float(_mean_counts(np.array([np.searchsorted(low, c, side="right")]))[0])


def brute(rows, texts, weight, order):
    """Dictionaries in place of the filter."""
    c, grams = Counter(), Counter()
    for text in texts:
        words = tokens(text)
        c.update(words)
        padded = [None] * (order - 1) + words
        for n in range(1, order + 1):
            grams.update(tuple(padded[e - n:e]) for e in range(order, len(padded) + 1))
            if n < order:
                grams[(None,) * n] += 1
    total, distinct = sum(c.values()), len(c)
    for doc_id, text in rows:
        words = tokens(text)
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        padded, score = [None] * (order - 1) + words, 0
        for e in range(order, len(padded) + 1):
            p = min(1, (held(grams[(padded[e - 1],)]) + 0.5) / (total + 0.5 * (distinct + 1)))
            for n in range(2, order + 1):
                context = held(grams[tuple(padded[e - n:e - 1])])
                p = (min(held(grams[tuple(padded[e - n:e])]), context) + weight * p) / (context + weight)
            score += math.log10(p)
        yield doc_id, len(words), sum(c[w] > 0 for w in words), base, score


def corpus(seed, n=150):
    dice = random.Random(seed)
    follow = {k: [dice.randrange(60) for _ in range(4)] for k in range(60)}
    out = []
    for k in range(n):
        words, w = [], dice.randrange(60)
        for _ in range(dice.randrange(80)):
            words.append(f"w{w}" if dice.random() < 0.95 else f"rare{dice.randrange(10**6)}")
            w = dice.choice(follow[w])
        out.append((k, " ".join(words).title() if k % 5 else None if k % 10 else " \n"))
    return out


def close(got, want, exact_scores=0.9):
    got, want = sorted(map(tuple, got), key=repr), sorted(want, key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(a[3] == pytest.approx(b[3], abs=1e-9) for a, b in zip(got, want))
    same = sum(a[4] == pytest.approx(b[4], abs=1e-6) for a, b in zip(got, want))
    assert same >= exact_scores * len(want)  # the rest met a false answer of the filter
    assert all(a[4] == pytest.approx(b[4], rel=0.2, abs=0.5) for a, b in zip(got, want))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(module, "EVENT_BITS", 40)
    monkeypatch.setattr(module, "PROBES", 8)
    monkeypatch.setattr(module, "UNIT", 500)
    rows = corpus(order)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn(df.where("doc_id < 100"), order=order)
    got = scored(df, model).collect()
    close(got, brute(rows, [t for k, t in rows if k < 100], model.weight, order), 0.99)


def test_parts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(module, "PART_GRAMS", 100)
    monkeypatch.setattr(module, "UNIT", 300)
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn(df.where("doc_id % 3 > 0"))
    whole = sorted(map(tuple, scored(df, model).collect()))
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    assert learn(df.where("doc_id % 3 > 0")).weight == model.weight
    parts = sorted(map(tuple, scored(df, model).collect()))
    assert [r[:3] for r in parts] == [r[:3] for r in whole]
    assert np.allclose([r[3:] for r in parts], [r[3:] for r in whole], atol=1e-9)


def test_rare_words_go_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(module, "COMMON_SHARE", 0.05)
    monkeypatch.setattr(module, "EVENT_BITS", 40)
    monkeypatch.setattr(module, "PROBES", 8)
    rows = corpus(8) + [(1000, "x" * 100 + " " + "y" * 5000), (1001, "x" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn(df)
    close(scored(df, model).collect(), brute(rows, [t for _, t in rows], model.weight, 2), 0.99)


def test_filter_rarely_errs_and_never_says_less(spark):
    rows = corpus(9, 400)
    model = learn(spark.createDataFrame(rows, "doc_id long, text string"))
    bits, start, size = module._whole(model)
    unit, grams = module.Unit(2), Counter()
    for _, text in rows:
        unit.add((text or "").encode())
    for key in unit.keys().tolist():
        grams[key] += 1
    keys = np.array(list(grams), np.uint64)
    part = (keys % np.uint64(len(start))).astype(int)
    level = module._levels(keys, bits, start[part], size[part])
    true = np.array([np.searchsorted(_lowest(1e6), c, side="right") for c in grams.values()])
    assert (level >= true).all() and (level > true).mean() < 0.05
    other = np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64)
    part = (other % np.uint64(len(start))).astype(int)
    assert (module._levels(other, bits, start[part], size[part]) > 0).mean() < 0.05


def test_better_than_its_base_on_texts_not_learned(spark):
    rows = corpus(10, 600)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = scored(df.where("doc_id >= 500"), learn(df.where("doc_id < 500"))).collect()
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got)


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def test_awkward_rows(spark, odd, none, rows):
    got = op12_scores(spark, odd).collect()
    learned = [t for i, t in rows if fold(i) not in (1, None)]
    assert {(r.doc_id, r.held_out) for r in got} == {(i, fold(i) == 1) for i, _ in rows}
    assert {r.train_tokens for r in got} == {sum(len(tokens(t)) for t in learned)}
    mine = [(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got]
    weight = 1.0
    want = sorted(brute(rows, learned, weight, 2), key=repr)
    assert sorted((r[:3] for r in mine), key=repr) == [r[:3] for r in want]
    assert np.allclose(sorted(r[3] for r in mine), sorted(r[3] for r in want))
    assert op12_scores(spark, none).collect() == []


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = scored(df, learn(df.limit(0))).collect()
    assert sorted(map(tuple, got)) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]


def likeliest(some, texts):
    """The weight under which some texts are likeliest, by dictionaries of the bigrams of all texts."""
    c, contexts, pairs = Counter(), Counter(), Counter()
    for text in texts:
        words = tokens(text)
        c.update(words)
        contexts.update(["<", *words[:-1]])
        pairs.update(zip(["<", *words[:-1]], words))
    share = {w: (held(n) - 1 + 0.5) / (c.total() - 1 + 0.5 * (len(c) + 1)) for w, n in c.items()}
    times = Counter()
    for text in some:
        words = tokens(text)
        times.update(zip(["<", *words[:-1]], words))
    counts = [(n, held(pairs[p]) - 1, held(c.get(p[0], contexts[p[0]])) - 1, share[p[1]]) for p, n in times.items()]
    return max((sum(n * math.log10((min(x, y) + w * p) / (y + w)) for n, x, y, p in counts), w) for w in module.WEIGHTS)[1]


def test_weight_is_fitted_on_all_texts(spark):
    """The 2,000 texts of the smallest hashes are noise, on which a fit comes out otherwise than on all."""
    dice = random.Random(11)
    pairs = [" ".join(dice.choices([f"n{k}" for k in range(40)], k=6)) + f" {k}" for k in range(2600)]
    cycle = [f"c{k}" for k in range(50)]
    runs = [" ".join((cycle * 8)[k % 50:k % 50 + 300]) + f" {k}" for k in range(1500)]
    hashed = spark.createDataFrame([(t,) for t in pairs + runs], "t string").selectExpr("t", "xxhash64(t) AS h").collect()
    noise = sorted((r.h, r.t) for r in hashed if r.t in set(pairs))[:2000]
    rest = [r.t for r in hashed if r.t in set(runs) and r.h > noise[-1][0]]
    assert len(noise) == 2000 and len(rest) > 100
    texts = [t for _, t in noise] + rest + rest[:50]  # some twice
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = learn(df)
    assert model.weight == likeliest(set(texts), texts) != likeliest({t for _, t in noise}, texts)
    apart = sorted(map(tuple, scored(df, model).collect()))
    other = learn(df)
    together = sorted(map(tuple, scored(df, other, learned=F.lit(True)).collect()))
    assert other.weight == model.weight
    assert [r[:3] for r in together] == [r[:3] for r in apart]
    assert np.allclose([r[3:] for r in together], [r[3:] for r in apart])


def test_query_is_its_operators(spark, odd):
    df = spark.read.parquet(f"{odd}/documents.parquet")
    want = scored(df, learn(df.where(module.fold() != 1))).collect()
    got = op12_scores(spark, odd).collect()
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in got) == Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in want)


def test_texts_are_split_in_two_passes(spark, odd, monkeypatch):
    """One counts words and n-grams, one scores under every weight; each pass over texts costs what splitting them does."""
    frame, passes = type(spark.range(1)), []
    plain = frame.mapInArrow

    def counted(df, *args, **kwargs):
        passes.extend(c for c in df.columns if c == "text")
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    assert len(op12_scores(spark, odd).collect()) > 0
    assert len(passes) == 2


def test_words_are_counted_once_across_units(spark):
    """More words than a unit takes, in several tasks and parts, some of them odd."""
    dice = random.Random(12)
    odd_words = ["\x00", "a\x1cb", "\u2028", "\u00a0", "\u00c9", "\U0001f600", "A\u0130"]
    texts = [" ".join(dice.choices([*odd_words, *(f"w{k}" for k in range(5000))], k=100_000)) for _ in range(24)]
    texts += ["", None, " \n", "\x0b lead\x0cand\rtrail\t", "x " * 10]
    model = learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    want = Counter(w for t in texts for w in tokens(t))
    assert dict(map(tuple, model.words.collect())) == want
    assert (model.tokens, model.distinct) == (want.total(), len(want))


def test_probabilities_are_made_by_case():
    """A log for each case of levels, not for each token: the same sums."""
    unit, dice = module.Unit(3), random.Random(13)
    for _ in range(50):
        unit.add(" ".join(dice.choices("abcdefgh", k=dice.randrange(200))).encode())
    levels = np.random.default_rng(13).integers(0, 6, len(unit.keys()))
    case, cases = module._cases(unit, levels)
    assert len(cases) == 5 and len(case) == sum(unit.lengths)
    assert len({*zip(*cases)}) == len(cases[0]) == len(set(case.tolist()))
    real, at, by_length = unit.tokens[1], 0, []
    for _, holds in unit.held:
        by_length.append(dict(zip(np.flatnonzero(holds).tolist(), levels[at:].tolist())))
        at += int(holds.sum())
    for n, k in enumerate(np.flatnonzero(real).tolist()):
        one, two, three = by_length
        assert [c[case[n]] for c in cases] == [one[k], one[k - 1], two[k], two[k - 1], three[k]]
