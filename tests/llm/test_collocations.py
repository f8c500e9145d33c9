import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import both, connect
from pyspark.sql import functions as F
from tellwatt.llm import collocations as module
from tellwatt.llm.collocations import SQL, _lowered, _score, collocations, op11_collocations
from tellwatt.llm.common import ASCII_LOWER, ASCII_UPPER


def brute(rows, least=10, most=2000, within=50):
    """All phrases of up to three words, counted; no search."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans(ASCII_UPPER, ASCII_LOWER))
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(zip(*(words[i:] for i in range(size))))
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, b in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * b >= within * counts[q]}
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, l, r = min(  # noqa: E741
                    (1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
                )
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):  # noqa: E741
            yield lang, rank, phrase.decode(), -a, l, r, n[lang], -score


def corpus(seed, docs=120, vocabulary=40):
    dice = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "The", "日本", "x-y", "don't"]
    set_ = ["new york", "new york city", "as well as", "san francisco", "w1 w2 w3"]
    out = []
    for k in range(docs):
        parts = [dice.choice(set_) if dice.random() < 0.15 else dice.choice(words[: dice.choice((5, 45))]) for _ in range(dice.randrange(120))]
        text = "".join(p + dice.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for p in parts)
        out.append(((None, "en", "de", "und")[k % 4], None if k % 17 == 0 else text))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, most", [(1, 2000), (2, 5), (3, 1)])
def test_brute_force(spark, seed, most):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(collocations(df, least=3, most=most, set_bits=16)) == sorted(brute(rows, least=3, most=most))


def test_full_bitmaps_and_small_units_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "UNIT", 50)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    assert rows_of(collocations(df, least=3, most=10, set_bits=6)) == sorted(brute(rows, least=3, most=10))


def test_drops_make_more_rounds(spark, monkeypatch):
    """The best pairs all lie within longer phrases of low scores, so the limit has to fall."""
    rounds = []
    monkeypatch.setattr(module, "_lowered", lambda *a: (rounds.append(a[2]), _lowered(*a))[1])
    rows = [("en", " ".join(f"a{k} b{k} c, a{k} b{k}," for k in range(30)) + " ".join(f"p{k} q{k % 7}," for k in range(60)))] * 12
    df = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(collocations(df, most=10, set_bits=16)) == sorted(brute(rows, most=10))
    assert len(rounds) > 1


def test_long_texts_hold_together_where_parts_meet(spark):
    text = "one two three " * 200_000
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert rows_of(collocations(df)) == sorted(brute([("en", text)]))


def test_awkward_rows(spark, odd, none):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert rows_of(collocations(docs, least=2)) == sorted(brute(rows, least=2))
    assert rows_of(op11_collocations(spark, none)) == []
    blank = spark.createDataFrame([(None, " \t,.\n"), ("en", ""), ("en", None)], "lang string, text string")
    assert rows_of(collocations(blank, least=1)) == []


def test_products_beyond_64_bits(spark):
    numbers = [(10**14 + 7, 10**14 + 9, 10**14 + 13), (10**9, 10**9, 3 * 10**12), (3, 7, 11)]
    got = spark.createDataFrame(numbers, "a long, l long, r long").select("a", "l", "r", _score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 1000000 * r.a * r.a // (r.l * r.r) for r in got)


def test_bitmaps_hold_every_phrase(spark):
    df = spark.createDataFrame([("en", "a"), ("en", "a b"), ("de", "a b")], "lang string, phrase string")
    bits = module._bitmap(df, 12)
    assert sum(int(x).bit_count() for x in bits) == 3 and bits.dtype == np.uint64
    assert not module._bitmap(df.where(F.lit(False)), 12).any()


def test_sql(spark, odd):
    ours, theirs = both(spark, connect(odd), odd, lambda s, sf: collocations(s.read.parquet(f"{sf}/documents.parquet"), least=2), SQL.replace(">= 10", ">= 2"))
    assert ours == theirs
