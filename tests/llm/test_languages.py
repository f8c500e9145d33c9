import random
import zlib

import awkward
from tellwatt.llm.languages import fit, identify, op10_languages, predict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def labelled(n=400, seed=1):
    dice = random.Random(seed)
    parts = {"aa": ["ba", "do", "ri", "mu"], "bb": ["sch", "ver", "ung", "ein"], "cc": ["ção", "lh", "êz", "nho"]}
    rows = []
    for k in range(n):
        lang = dice.choice(list(parts))
        words = ["".join(dice.choices(parts[lang], k=dice.randint(1, 3))) for _ in range(dice.randint(3, 60))]
        rows.append((k, " ".join(words), lang if k % 10 else None, lang, 1))
    return rows


def test_held_out_accuracy(spark, tmp_path):
    rows = labelled()
    folder = awkward.saved(spark, str(tmp_path), documents=spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in op10_languages(spark, folder).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r.held_out} == {r[0] for r in held}
    assert sum(got[r[0]].lang_pred == r[3] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    again = {r.doc_id: (r.lang_pred, r.score) for r in op10_languages(spark, folder).collect()}
    assert again == {d: (r.lang_pred, r.score) for d, r in got.items()}


def test_only_the_text_decides(spark):
    docs = spark.createDataFrame(labelled(), SCHEMA)
    model = fit(docs)
    shown = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model).collect()}
    hidden = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs.selectExpr("doc_id", "text", "'bb' AS lang", "'bb' AS source"), model).collect()}
    assert shown == hidden


def test_odd_rows(spark, odd, rows):
    got = op10_languages(spark, odd).collect()
    assert len(got) == len(rows)
    no_letter = {d for d, t in rows if d is not None and not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und" and r.doc_id is not None} == no_letter
    assert all(not r.held_out for r in got if r.doc_id is None)


def test_empty_and_unlabelled(spark, none, tmp_path):
    assert op10_languages(spark, none).collect() == []
    docs = spark.createDataFrame([(1, "words", None, None, 5)], SCHEMA)
    folder = awkward.saved(spark, str(tmp_path), documents=docs)
    assert [(r.lang_pred, r.score) for r in op10_languages(spark, folder).collect()] == [("und", 0.0)]


def test_stage_rejects_what_has_no_letter(spark, odd, rows):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    made = identify(spark, docs, odd)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = made.collect()
    assert len(found) == sum(any(c.isalpha() for c in t or "") for _, t in rows)
    assert all(r.lang for r in found)


def test_hot_texts_neither_fill_the_sample_nor_hide_a_language(spark, monkeypatch):
    """A text in a third of the rows is one row of the sample; a language of copies of one text is learned."""
    from tellwatt.llm import languages

    rows = labelled(900) + [(5000 + k, "ba do ri mu", "aa", "x", 1) for k in range(500)] + [(7000 + k, "żółć się", "dd", "x", 1) for k in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit(docs, sample=20, landmarks=10)
    assert model["languages"] == ["aa", "bb", "cc", "dd"]
    got = {r.doc_id: r.lang_pred for r in predict(docs, model).collect()}
    assert got[7000] == "dd" and got[5000] == "aa"
    # The same, whether the sample is broadcast or joined, and whatever the parts.
    monkeypatch.setattr(languages, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(languages, "PARTS", 3)
    again = fit(docs, sample=20, landmarks=10)
    assert (again["weights"] == model["weights"]).all()
