import re
from collections import Counter

import awkward
from tellwatt.llm.licences import BASE, GATE, NAMES, WORD, op9_licenses, rules, scan


def words(text):
    return re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def method(text):
    """All places of all rules, then those that lie in no place of an earlier rule."""
    whole, labels, score = f" {' '.join(words(text))} ", set(base(text)[4].split(",")) - {""}, 0.9 if base(text)[1] else 0.0
    found = [(m.start(), m.end(), k, label, worth) for k, (label, _, pattern, worth) in enumerate(rules())
             for m in re.finditer(f"(?<= )(?:{pattern})(?= )", whole)]
    for start, end, k, label, worth in found:
        if not any(s <= start and end <= e and j < k for s, e, j, *_ in found):
            labels.add(label)
            score = max(score, worth)
    return ",".join(sorted(labels)), score


TEXTS = [
    "Released under the MIT License. under the mit license, UNDER THE MIT LICENSE",
    "under the mit license under the mit license", "CC BY-NC 4.0 and cc by nc cc by nc", "Apache License, Version 2.0", "apache license version 20",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: BSD-3-Clause",
    "licensed under the GNU Lesser General Public License version 2.1 or CC BY-SA 4.0", "éunder the mit license", "xcc by nc", "mIT lİcense",
    "released into the public domain", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "no word of it", "", None, "-", "LICENCE: ISC licence", "under the terms of the Apache 2.0 license " * 50,
]


def test_query_is_brute_force(spark, odd, rows):
    got = Counter(tuple(r) for r in op9_licenses(spark, odd).collect())
    assert got == Counter((d, *base(t), *method(t)) for d, t in rows)
    assert any(r[2] for r in got)


def test_rules_and_base(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in scan(docs).collect()}
    assert got == {k: (*base(t), *method(t)) for k, t in enumerate(TEXTS)}
    labels = {k: r[5] for k, r in got.items()}
    assert labels[5] == "gpl-3" and labels[6] == "bsd-3" and labels[7] == "cc-by-sa,lgpl-2.1"
    assert labels[11] == "public-domain" and labels[12] == "mit" and labels[17] == "isc"


def test_rules_are_hundreds():
    made = rules()
    assert len(made) > 300
    assert all(re.compile(p) and 0 < w <= 1 for _, _, p, w in made)


def test_two_names_keep_both_labels(spark):
    """Whatever name stands beside another, both labels stay, but for names that the next words go on with."""
    one = {}
    for label, _, pattern in NAMES:
        one.setdefault(label, max(samples(pattern), key=len))
    pairs = [(f"{a}, {b}", x, y) for x, a in one.items() for y, b in one.items()]
    docs = spark.createDataFrame([(k, t) for k, (t, *_) in enumerate(pairs)], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in scan(docs).collect()}
    lost = [pairs[k] for k in got if not {pairs[k][1], pairs[k][2]} <= set(got[k])]
    assert not lost, lost[:20]
    texts = ["MIT License, BSD License", "BSD License, MIT License", "MIT License; ISC License", "MIT License / Apache License 2.0 / GPL-3.0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.labels for r in scan(docs).orderBy("doc_id").collect()]
    assert got == ["bsd,mit", "bsd,mit", "isc,mit", "apache-2,gpl-3,mit"]


def test_detections_that_overlap_in_part_stay(spark):
    signatures = [("first", "b", "a b", 0.9), ("second", "b", "b c", 0.5), ("inner", "b", "b", 0.4), ("wide", "b", "a b c d", 0.3)]
    docs = spark.createDataFrame([(1, "gpl a b c"), (2, "gpl " + "a b c d " * 1500), (3, "gpl b")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs, signatures).collect()}
    assert got == {1: ("first,second", 0.9), 2: ("first,second,wide", 0.9), 3: ("inner", 0.4)}


def test_first_rule_takes_what_lies_inside(spark):
    signatures = [("long", "b", "a b c", 0.9), ("short", "b", "b", 0.5), ("apart", "d", "d", 0.4)]
    docs = spark.createDataFrame([(1, "gpl: a b c d"), (2, "gpl b"), (3, "a b c")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs, signatures).collect()}
    assert got == {1: ("apart,long", 0.9), 2: ("short", 0.5), 3: ("", 0.0)}


def test_empty(spark, none):
    assert op9_licenses(spark, none).collect() == []


def test_no_python_in_the_plan(spark, odd):
    plan = op9_licenses(spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert awkward.SCHEMA


def samples(pattern):
    """Texts that a rule's pattern matches, each alternative and optional part at least once."""
    from re import _parser

    def made(parts):
        out = [""]
        for op, arg in parts:
            name = str(op)
            if name == "LITERAL":
                some = [chr(arg)]
            elif name == "ANY":
                some = ["x"]
            elif name == "IN":
                some = [chr(v if str(o) == "LITERAL" else v[0]) for o, v in arg]
            elif name == "MAX_REPEAT":
                some = ([""] if arg[0] == 0 else []) + made(arg[2])
            elif name == "SUBPATTERN":
                some = made(arg[3])
            else:
                assert name == "BRANCH", name
                some = [t for branch in arg[1] for t in made(branch)]
            out = [a + b for a in out for b in some] if len(out) * len(some) <= 64 else [a + some[k % len(some)] for k, a in enumerate(out * len(some))][:256]
        return out

    return made(_parser.parse(pattern))


def test_each_rule_finds_its_own_samples(spark):
    """Neither the gate nor a rule's keyword keeps a text from the rule."""
    texts = [(k, t) for k, (_, _, pattern, _) in enumerate(rules()) for t in dict.fromkeys(samples(pattern))]
    made = rules()
    for k, t in texts:
        assert re.search(f"(?<= )(?:{made[k][2]})(?= )", f" {t} ") and made[k][1] in t and any(g in t for g in GATE), (made[k], t)
    alone = [
        "Distributed under BSD-3-Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD", "Zero-Clause BSD", "WTFPL", "OpenRAIL-M",
        "All rights reserved. Proprietary and confidential", "Neither the name of it may be used to endorse or promote products",
    ]
    docs = spark.createDataFrame(list(enumerate(alone)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs).collect()}
    assert [got[k][0] for k in range(9)] == ["bsd-3", "bsd-2", "bsd-2", "bsd-2", "bsd-0", "wtfpl", "openrail", "proprietary", "bsd-3"]
    assert all(score > 0 for _, score in got.values())
