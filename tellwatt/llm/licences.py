"""License scans by ordered signature rules (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import ASCII_LOWER, ASCII_UPPER, table

#: A word, once ASCII letters are lower-cased, and the same before that.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels (fixed values of the query's contract).
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Without any of these a text holds no license; every rule's keyword and base phrase has one.
GATE = (
    "licen", "spdx", "commons", "gpl", "public", "hereby", "redistribut", "cc", "bsd", "wtfpl", "openrail", "endorse", "proprietary",
    "attribution", "acknowledg", "waived",
)

#: Names of licenses: label, a word that every match has, a pattern over lower-case words.
NAMES = (
    ("mit", "mit", r"mit x11 licen[cs]e|mit licen[cs]e|mit style licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("mit-0", "mit", r"mit no attribution( licen[cs]e)?|mit 0 licen[cs]e"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("isc", "internet", r"internet (systems|software) consortium licen[cs]e"),
    ("bsd-2", "bsd", r"(bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)( licen[cs]e)?"),
    ("bsd-3", "bsd", r"(bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)( licen[cs]e)?"),
    ("bsd-4", "bsd", r"(bsd 4 clause|4 clause bsd|four clause bsd|original bsd)( licen[cs]e)?"),
    ("bsd-0", "bsd", r"(zero clause bsd|0 clause bsd|bsd zero clause)( licen[cs]e)?"),
    ("bsd", "bsd", r"bsd( style)? licen[cs]e|berkeley bsd licen[cs]e"),
    ("apache-1", "apache", r"apache( software)? licen[cs]e (version |v)?1( [01])?"),
    ("apache-2", "apache", r"apache( software)? licen[cs]e (version |v )?2( 0)?|apache( software)? licen[cs]e v2( 0)?"),
    ("apache-2", "apache", r"apache 2( 0)? licen[cs]e"),
    ("apache", "apache", r"apache( software)? licen[cs]e"),
    ("gpl-1", "general", r"gnu general public licen[cs]e (version |v )?1( 0)?"),
    ("gpl-2", "general", r"gnu general public licen[cs]e (version |v )?2( 0)?|gnu general public licen[cs]e v2"),
    ("gpl-3", "general", r"gnu general public licen[cs]e (version |v )?3( 0)?|gnu general public licen[cs]e v3"),
    ("gpl-2", "gpl", r"(gnu )?gpl (version |v )?2( 0)?|(gnu )?gplv2|(gnu )?gpl v2"),
    ("gpl-3", "gpl", r"(gnu )?gpl (version |v )?3( 0)?|(gnu )?gplv3|(gnu )?gpl v3"),
    ("gpl", "general", r"gnu general public licen[cs]e"),
    ("gpl", "gpl", r"gnu gpl"),
    ("lgpl-2", "library", r"gnu library general public licen[cs]e( (version |v )?2( 0)?)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[cs]e (version |v )?2 1"),
    ("lgpl-3", "lesser", r"gnu lesser general public licen[cs]e (version |v )?3( 0)?"),
    ("lgpl", "lesser", r"gnu lesser general public licen[cs]e"),
    ("lgpl-2.1", "lgpl", r"(gnu )?lgpl (version |v )?2 1|(gnu )?lgplv2 1"),
    ("lgpl-3", "lgpl", r"(gnu )?lgpl (version |v )?3( 0)?|(gnu )?lgplv3"),
    ("lgpl", "lgpl", r"gnu lgpl"),
    ("agpl-3", "affero", r"(gnu )?affero general public licen[cs]e( (version |v )?3( 0)?)?"),
    ("agpl-3", "agpl", r"(gnu )?agpl( (version |v )?3( 0)?)?|(gnu )?agplv3"),
    ("gfdl", "documentation", r"gnu free documentation licen[cs]e( version 1( [123])?)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (version |v )?1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e (version |v )?2( 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e (version |v )?1( 0)?"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e (version |v )?2( 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e( (version |v )?1( [01])?)?"),
    ("cpl", "common", r"common public licen[cs]e( (version |v )?1( 0)?)?"),
    ("eupl", "union", r"european union public licen[cs]e( (version |v )?1( [0-2])?)?"),
    ("artistic-2", "artistic", r"artistic licen[cs]e (version |v )?2( 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e( (version |v )?1( 0)?)?"),
    ("boost", "boost", r"boost software licen[cs]e( (version |v )?1( 0)?)?"),
    ("zlib", "zlib", r"zlib( libpng)? licen[cs]e"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("python", "python", r"python software foundation licen[cs]e( (version |v )?2)?"),
    ("php", "php", r"php licen[cs]e( (version |v )?3( 01?)?)?"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("ofl", "font", r"sil open font licen[cs]e( (version |v )?1( [01])?)?|open font licen[cs]e"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl( licen[cs]e)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("odbl", "database", r"open database licen[cs]e( (version |v )?1( 0)?)?"),
    ("odc-by", "data", r"open data commons attribution licen[cs]e"),
    ("elastic-2", "elastic", r"elastic licen[cs]e( (version |v )?2( 0)?)?"),
    ("busl", "business", r"business source licen[cs]e( (version |v )?1( 1)?)?"),
    ("sspl", "server", r"server side public licen[cs]e( (version |v )?1)?"),
    ("openrail", "openrail", r"(creative ml |bigscience )?openrail( m)?( licen[cs]e)?"),
    ("cc0", "cc0", r"cc0( 1 0)?( universal)?( licen[cs]e)?"),
    ("cc0", "commons", r"creative commons zero( licen[cs]e)?( v?1 0)?( universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd( [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa( [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc( [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd( [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa( [1-4] [05])?"),
    ("cc-by", "cc", r"cc by( [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(ative)?s?( works)?( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc-by", "commons", r"creative commons attribution( [1-4] [05])?( international)?( licen[cs]e)?"),
    ("cc", "commons", r"creative commons licen[cs]e"),
)

#: Wordings of whole license texts and notices: label, keyword, pattern.
WORDINGS = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "hereby", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribut", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", r"neither the name of .{0,200} may be used to endorse or promote products"),
    ("apache-2", "licen", r"you may not use this file except in compliance with the license"),
    ("gpl", "redistribut", r"this program is free software you can redistribute it and or modify it"),
    ("mpl-2", "licen", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "redistribut", r"alter it and redistribute it freely subject to the following restrictions"),
    ("unlicense", "public", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "public", r"do what the fuck you want to public licen[cs]e"),
    ("public-domain", "public", r"(released|placed|dedicated) (in|into|to) the public domain"),
    ("proprietary", "proprietary", r"all rights reserved .{0,60}proprietary and confidential"),
    ("proprietary", "licen", r"commercial licen[cs]e required|not licensed for (redistribution|commercial use)"),
    ("bsd", "redistribut", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-4", "acknowledg", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2", "apache", r"licensed to the apache software foundation( asf)? under one or more contributor license agreements"),
    ("apache-2", "licen", r"software distributed under the license is distributed on an as is basis"),
    ("gpl", "general", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("agpl-3", "affero", r"you should have received a copy of the gnu affero general public licen[cs]e"),
    ("gfdl", "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("epl-2", "eclipse", r"made available under the terms of the eclipse public licen[cs]e v ?2 0"),
    ("cddl", "distribution", r"subject to the terms of the common development and distribution licen[cs]e"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("cc0", "waived", r"waived all copyright and related or neighbou?ring rights"),
)

#: Identifiers of tags: label and pattern of the identifier's words.
TAGS = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("x11", "x11"), ("isc", "isc"), ("bsd-2", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"),
    ("bsd-4", "bsd 4 clause"), ("bsd-0", "0bsd"), ("apache-1", "apache 1 [01]"), ("apache-2", "apache 2 0"),
    ("gpl-1", "gpl 1 0( only| or later)?"), ("gpl-2", "gpl 2 0( only| or later)?"), ("gpl-3", "gpl 3 0( only| or later)?"),
    ("lgpl-2", "lgpl 2 0( only| or later)?"), ("lgpl-2.1", "lgpl 2 1( only| or later)?"), ("lgpl-3", "lgpl 3 0( only| or later)?"),
    ("agpl-3", "agpl 3 0( only| or later)?"), ("gfdl", "gfdl 1 [123]( only| or later)?"), ("mpl-1.1", "mpl 1 1"), ("mpl-2", "mpl 2 0"),
    ("epl-1", "epl 1 0"), ("epl-2", "epl 2 0"), ("cddl", "cddl 1 [01]"), ("cpl", "cpl 1 0"), ("eupl", "eupl 1 [012]"),
    ("artistic-2", "artistic 2 0"), ("artistic", "artistic 1 0"), ("boost", "bsl 1 0"), ("zlib", "zlib"), ("libpng", "libpng( 2 0)?"),
    ("openssl", "openssl"), ("python", "psf 2 0|python 2 0"), ("php", "php 3 01?"), ("ruby", "ruby"), ("postgresql", "postgresql"),
    ("ofl", "ofl 1 [01]"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("ms-pl", "ms pl"), ("ms-rl", "ms rl"),
    ("odbl", "odbl 1 0"), ("odc-by", "odc by 1 0"), ("elastic-2", "elastic 2 0"), ("busl", "busl 1 1"), ("sspl", "sspl 1 0"),
    ("cc0", "cc0 1 0"), ("cc-by-nc-nd", "cc by nc nd [1-4] [05]"), ("cc-by-nc-sa", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc", "cc by nc [1-4] [05]"), ("cc-by-nd", "cc by nd [1-4] [05]"), ("cc-by-sa", "cc by sa [1-4] [05]"), ("cc-by", "cc by [1-4] [05]"),
)

#: What a kind of rule is worth as evidence; kinds come first in this order.
WORTH = {"tag": 1.0, "wording": 0.95, "notice": 0.9, "grant": 0.85, "name": 0.6}


def rules() -> list[tuple[str, str, str, float]]:
    """All rules in their order: label, keyword, pattern over words, worth.

    Tags come first, then wordings of whole texts, notices that a work stands under a
    license, and names alone; within a kind, as listed, the narrower before the wider.
    """
    made = [(label, "spdx", rf"spdx license identifier (?:{ids})", WORTH["tag"]) for label, ids in TAGS]
    made += [(label, key, pattern, WORTH["wording"]) for label, key, pattern in WORDINGS]
    under = r"(?:licen[cs]ed|released|distributed|published|available|provided|redistributed|covered|shared) under (?:the terms of )?(?:the |an? )?"
    made += [(label, key, f"{under}(?:{name})", WORTH["notice"]) for label, key, name in NAMES]
    granted = r"(?:licen[cs]e|licen[cs]ed|licen[cs]ing|terms of|subject to|under) (?:is |as |by |to )?(?:the |an? )?"
    made += [(label, key, f"{granted}(?:{name})", WORTH["grant"]) for label, key, name in NAMES]
    made += [(label, key, f"(?:{name})", WORTH["name"]) for label, key, name in NAMES]
    return made


def _places(phrase: str, words: str) -> tuple[Column, Column, Column]:
    """How often the phrase stands among the words, and where it first and last begins; null if nowhere."""
    parts = F.split(words, f"(?<= ){phrase}(?= )")
    times = F.size(parts) - 1
    first = F.regexp_count(F.get(parts, F.lit(0)), F.lit("[^ ]+"))
    after = F.regexp_count(F.element_at(parts, -1), F.lit("[^ ]+"))
    some = F.col(words).contains(f" {phrase} ")
    last = F.regexp_count(words, F.lit("[^ ]+")) - after - len(phrase.split())
    return F.when(some, times).otherwise(0), F.when(some, first), F.when(some, last)


#: So many detections of a rule are listed at a time, as adding to a list copies it.
LISTED = 256


def _detections(words: str, rule: Column) -> Column:
    """Where a rule matches the words: start, end less than zero, place of the rule, label and worth."""
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    between = F.split(words, rule["pattern"], -1)
    steps = F.zip_with(
        F.slice(between, 1, F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("size"))
    )
    kind = "array<struct<start:int,end:int,rule:int,label:string,worth:double>>"

    def add(now: Column, step: Column) -> Column:
        start = now["at"] + step["gap"]
        end = start + step["size"]
        one = F.array(F.struct(
            start.alias("start"), (-end).alias("end"), rule["place"].alias("rule"), rule["label"].alias("label"), rule["worth"].alias("worth")
        )).cast(kind)
        full = F.size(now["some"]) >= LISTED
        return F.struct(
            end.alias("at"),
            F.when(full, one).otherwise(F.concat(now["some"], one)).alias("some"),
            F.when(full, F.concat(now["lists"], F.array(now["some"]))).otherwise(now["lists"]).alias("lists"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("some"), F.array().cast(f"array<{kind}>").alias("lists"))
    return F.aggregate(steps, start, add, lambda now: F.concat(F.flatten(now["lists"]), now["some"]))


def _kept(detections: Column) -> Column:
    """Labels and best worth of the detections that don't lie within one of an earlier rule.

    In the order of starts, longer ones and earlier rules first, whatever holds a detection comes
    before it. A rule's own matches don't overlap, so no more than one a rule is open at a time.
    """
    kind = "array<struct<end:int,rule:int>>"

    def see(now: Column, one: Column) -> Column:
        open_ = F.filter(now["open"], lambda o: -o["end"] > one["start"])
        inside = F.exists(open_, lambda o: (o["end"] <= one["end"]) & (o["rule"] < one["rule"]))
        mine = F.array(F.struct(one["end"].alias("end"), one["rule"].alias("rule"))).cast(kind)
        return F.struct(
            F.when(inside, open_).otherwise(F.concat(open_, mine)).alias("open"),
            F.when(inside, now["labels"]).otherwise(F.array_union(now["labels"], F.array(one["label"]))).alias("labels"),
            F.when(inside, now["score"]).otherwise(F.greatest(now["score"], one["worth"])).alias("score"),
        )

    start = F.struct(
        F.array().cast(kind).alias("open"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score")
    )
    return F.aggregate(F.array_sort(detections), start, see)


def scan(docs: DataFrame, signatures: list[tuple[str, str, str, float]] | None = None, base: dict[str, str] = BASE) -> DataFrame:
    """``doc_id``, ``n_words``, the base phrases' places and labels, ``labels`` and ``score``.

    ASCII letters are lower-cased; words are runs of letters, digits and anything
    beyond ASCII. Only texts with a word of ``GATE`` in them are looked at closely,
    and in them only rules whose keyword they hold. Every rule is matched to the whole
    text; a detection that lies wholly within one of an earlier rule is dropped, while
    detections that overlap in part all stay. ``score`` is the worth of the best evidence, 0
    without any. Null and empty texts have no words; labels are empty then, and the
    first and last place null. Repeated rows are judged alike; no rows give none.
    All of it is one pass, text by text: no shuffle, whatever a text or line repeats.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    gated = docs.select(
        "doc_id", "text", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(RAW_WORD)).cast("long").alias("n_words"), low.alias("low_")
    )
    held = F.lit(False)
    for word in GATE:
        held = held | F.col("low_").contains(word)
    plain = F.translate("text", ASCII_UPPER, ASCII_LOWER)
    words = F.concat(F.lit(" "), F.regexp_replace(plain, GAP, " "), F.lit(" "))
    spaced = gated.withColumn("words_", F.when(held, F.regexp_replace(words, " +", " "))).drop("low_", "text")

    table_ = F.array(*[
        F.struct(
            F.lit(place).alias("place"), F.lit(label).alias("label"), F.lit(key).alias("key"),
            F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"), F.lit(worth).alias("worth"),
        )
        for place, (label, key, pattern, worth) in enumerate(rules() if signatures is None else signatures)
    ])
    matching = F.filter(
        table_, lambda r: F.when(F.col("words_").contains(r["key"]), F.regexp_like("words_", r["pattern"])).otherwise(False)
    )
    detections = F.flatten(F.transform(matching, lambda r: _detections("words_", r)))
    ruled = spaced.withColumn("found_", F.when(F.col("words_").isNotNull(), _kept(detections)))
    names = [f"base{k}_" for k in range(len(base))]
    for name, phrase in zip(names, base):
        times, first, last = _places(phrase, "words_")
        ruled = ruled.withColumn(name, F.struct(times.alias("times"), first.alias("first"), last.alias("last")))
    times = [F.coalesce(F.col(f"{n}.times"), F.lit(0)) for n in names]
    of_base = F.array_compact(F.array(*[F.when(t > 0, F.lit(label)) for t, label in zip(times, base.values())]))
    places = [F.col(f"{n}.{side}") for n in names for side in ("first", "last")]
    ours = F.coalesce(F.col("found_.labels"), F.array().cast("array<string>"))
    return ruled.select(
        "doc_id",
        "n_words",
        sum(times[1:], times[0]).cast("long").alias("n_base"),
        F.least(*places).cast("long").alias("first_word"),
        F.greatest(*places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(of_base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(of_base, ours))), ",").alias("labels"),
        F.greatest(F.coalesce(F.col("found_.score"), F.lit(0.0)), F.when(F.size(of_base) > 0, 0.9).otherwise(0.0)).alias("score"),
    )


def op9_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))


QUERIES = {"op9_licenses": (op9_licenses, None)}
