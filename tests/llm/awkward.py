"""Small tables with everything that may be odd in them."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, kept string, fingerprint string"


def texts(seed: int = 1) -> list:
    """Texts that are null, empty, blank, tiny, long, repeated and nearly so, and share a passage."""
    dice = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["The", "ÉTÉ", "straße", "don't", "日本語"]

    def prose(n: int) -> str:
        return " ".join(dice.choices(vocabulary, k=n))

    passage = prose(70)
    long = prose(9000)
    near = prose(300)
    return [
        None, "", " \n\t ", "one", "one two", "One  TWO\nthree", "!!! ???", "12 34", "日本語",
        prose(49), prose(50), passage, prose(20) + " " + passage, passage + "\n" + prose(30), passage + " " + passage,
        long, long, near, near + " end", "start " + near, near.replace("w1", "w2", 1), prose(120), prose(120),
        "the license is: released under the MIT License, or the Apache License, Version 2.0; data under CC-BY-NC 4.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later", "a" * 5000, "x\x0by\x0cz",
    ]


def documents(spark, seed: int = 1):
    """Every text once; some rows twice, without an id, a language or a source, and columns with clashing names."""
    rows = []
    for k, text in enumerate(texts(seed)):
        lang = (None, "en", "de")[k % 3]
        source = (None, "a", "b", "b", "b")[k % 5]
        rows.append((k * 3, text, lang, source, None if text is None else len(text), "s", "s", "s", "s"))
    rows += [rows[12], rows[12], rows[4]]
    rows.append((None, rows[17][1], None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def saved(spark, folder: str, **tables) -> str:
    """Tables as a driver folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
