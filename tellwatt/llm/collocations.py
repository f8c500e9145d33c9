"""Collocations by best-first branch and bound (operator 11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import LOWER_BYTES, giving_back, pieces, stored, table, utf8

LEAST = 10
MOST = 2000
#: A phrase goes if a longer one around it has at least so many percent of its places.
WITHIN_PERCENT = 50
SCALE = 1_000_000
#: Bits of each set of phrases that tasks are told, as a power of two: 8 MB.
SET_BITS = 26
#: Words that a task gathers before it passes their counts on.
UNIT = 1 << 21


def collocations(
    docs: DataFrame, least: int = LEAST, most: int = MOST, within: int = WITHIN_PERCENT, set_bits: int = SET_BITS
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's best phrases.

    ASCII letters are lower-cased, texts are cut at stops and line breaks into pieces,
    these at spaces and tabs into words. A candidate has two or three words and ``a``
    places, at least ``least``. Its score is the smallest
    ``floor(1000000 * a * a / (l * r))`` of its cuts into two parts, found ``l`` and
    ``r`` times; equal ones go to the earlier cut. A candidate of two words is dropped
    if one of three words holds it and has ``within`` percent of its places. The first
    ``most`` of a language are given, by score, then ``a``, both descending, then the
    phrase's bytes; ``n`` counts the language's words. A null text has no words, a null
    language is ``und``, repeated rows count each time, no rows give none. Numbers are
    exact for counts below 10**15; others fail the job.

    The search grows phrases from their beginnings. A prefix with count f whose own
    first word has count g bounds all that begins with it: ``a <= f`` and what follows
    the first word occurs ``a`` times at least, so no score passes ``1000000 * f / g``.
    Each round takes the prefixes whose bound reaches their language's limit, and
    counts what they grow into in one pass over the texts. It also counts what the
    two-word phrases whose scores reach the limit grow into to the left, as that may
    drop them; their bounds reach it too, so growth to the right is counted anyway.
    Then every score from the limit on is settled, ties included. A language with
    ``most`` of them left is done; for the others the limit falls, to zero in the end,
    where no prefix is left out.

    Tasks know the prefixes as bitmaps of fixed size, which never change the result:
    what passes one for nothing is counted in whole, and is then a true phrase too.
    """
    texts = docs.where("text IS NOT NULL").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = stored(_counted(texts, 1, [], set_bits))
    frequent = words.where(F.col("f") >= least)
    pairs = stored(_pairs(_counted(texts, 2, [_bitmap(frequent, set_bits)], set_bits).where(F.col("f") >= least), frequent))
    steps = stored(_steps(pairs))
    known = _bitmap(pairs, set_bits)
    limits = pairs.select("lang").distinct().withColumns({"limit": F.lit(2 * SCALE).cast("long"), "last": F.lit(None).cast("long")})
    grown, depth = None, 2 * most
    while True:
        limits = stored(_lowered(limits, steps, depth))
        near = pairs.join(limits, "lang")
        new = "{0} >= `limit` AND {0} < `last`"
        sets = [known, _bitmap(near.where(new.format("bound")), set_bits), _bitmap(near.where(new.format("score")), set_bits)]
        more = stored(_triples(_counted(texts, 3, sets, set_bits).where(F.col("f") >= least), frequent, pairs))
        # A phrase that is counted again has the same counts.
        grown = more if grown is None else grown.union(more).distinct()
        left = _left(near, grown.join(limits, "lang"), within)
        enough = left.groupBy("lang").agg((F.count("*") >= most).alias("enough"))
        limits = stored(
            limits.join(enough, "lang", "left")
            .withColumn("done", F.coalesce("enough", F.lit(False)) | (F.col("limit") == 0)).drop("enough")
        )
        if limits.where("NOT done").isEmpty():
            break
        depth *= 4
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """``floor(1000000 * a * a / (l * r))`` in whole numbers of up to 38 digits."""
    return F.expr(
        f"(cast({SCALE} AS decimal(7)) * cast({a} AS decimal(15)) * cast({a} AS decimal(15)))"
        f" div (cast({l} AS decimal(15)) * cast({r} AS decimal(15)))"
    )


def _word(phrase: str, first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a phrase, from one."""
    return F.array_join(F.slice(F.split(phrase, " "), first, last - first + 1), " ")


def _counts(counted: DataFrame, phrase: str, f: str) -> DataFrame:
    return counted.select("lang", F.col("phrase").alias(phrase), F.col("a" if "a" in counted.columns else "f").alias(f))


def _pairs(counted: DataFrame, words: DataFrame) -> DataFrame:
    """Two-word candidates with their scores, and the bound of all that begins with them."""
    split = counted.select("lang", "phrase", F.col("f").alias("a"), _word("phrase", 1, 1).alias("x"), _word("phrase", 2, 2).alias("y"))
    both = split.join(_counts(words, "x", "l"), ["lang", "x"]).join(_counts(words, "y", "r"), ["lang", "y"])
    bound = F.expr(f"(cast({SCALE} AS decimal(7)) * cast(a AS decimal(15))) div cast(l AS decimal(15))")
    return both.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def _triples(counted: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Three-word candidates with the lower score of their two cuts."""
    split = counted.select(
        "lang", "phrase", F.col("f").alias("a"), _word("phrase", 1, 1).alias("x"), _word("phrase", 3, 3).alias("z"),
        _word("phrase", 1, 2).alias("xy"), _word("phrase", 2, 3).alias("yz"),
    )
    for part, f in (("x", "fx"), ("z", "fz")):
        split = split.join(_counts(words, part, f), ["lang", part])
    for part, f in (("xy", "fxy"), ("yz", "fyz")):
        split = split.join(_counts(pairs, part, f), ["lang", part])
    cuts = F.array_min(F.array(
        F.struct(_score("a", "fx", "fyz").alias("score"), F.lit(1).alias("k"), F.col("fx").alias("l"), F.col("fyz").alias("r")),
        F.struct(_score("a", "fxy", "fz").alias("score"), F.lit(2).alias("k"), F.col("fxy").alias("l"), F.col("fz").alias("r")),
    ))
    return split.withColumn("cut", cuts).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "xy", "yz")


def _steps(pairs: DataFrame) -> DataFrame:
    """Scores that limits may fall to: for each eighth of a doubling, the lowest there and how many reach it."""
    eighth = F.when(F.col("score") > 0, F.floor(8 * F.log2("score"))).otherwise(-1)
    rows = pairs.groupBy("lang", eighth.alias("eighth")).agg(F.count("*").alias("rows"), F.min("score").alias("edge"))
    reach = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("eighth")))  # some 160 rows a language at most
    return rows.select("lang", "edge", reach.alias("reach"))


def _lowered(limits: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    """Open languages' limits at the next step that ``depth`` pairs reach, or zero; others stay where they are."""
    state = limits if "done" in limits.columns else limits.withColumn("done", F.lit(False))
    lower = steps.where(F.col("reach") >= depth).join(state.select("lang", "limit"), "lang").where(F.col("edge") < F.col("limit"))
    least = lower.groupBy("lang").agg(F.max("edge").alias("edge"))
    now = F.when(F.col("done"), F.col("limit")).otherwise(F.coalesce("edge", F.lit(0)))
    return state.join(least, "lang", "left").select("lang", now.alias("limit"), F.col("limit").alias("last"))


def _left(near: DataFrame, grown: DataFrame, within: int) -> DataFrame:
    """Candidates whose scores reach their language's limit, without pairs that a longer phrase drops."""
    longer = (
        grown.select("lang", F.explode(F.array("xy", "yz")).alias("phrase"), F.col("a").alias("b"))
        .groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    )
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    two = near.where("score >= `limit`").select(*columns).join(longer, ["lang", "phrase"], "left")
    two = two.where(F.col("b").isNull() | (100 * F.col("b") < within * F.col("a")))
    return two.select(*columns).unionByName(grown.where("score >= `limit`").select(*columns))


def _bitmap(phrases: DataFrame, set_bits: int):
    """The set of these phrases of one or two words, as 64-bit words; its size is fixed."""
    import numpy as np

    cells = phrases.select("lang", "phrase").mapInArrow(_cells(set_bits), "cell long, bits long")
    got = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (set_bits - 6), np.uint64)
    out[got.column("cell").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _cells(set_bits: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for part in pieces(batches, 1 << 14):
            seeds = [_seed(lang) for lang in utf8(part.column(0))]
            split = [p.split(b" ") for p in utf8(part.column(1))]
            h = np.array([[xxh64_intdigest(w, s) for w in (p[0], p[-1])] for p, s in zip(split, seeds)], np.uint64)
            two = np.array([len(p) == 2 for p in split])
            place = np.where(two, _joint(h[:, 0], h[:, 1]), h[:, 0]) >> np.uint64(64 - set_bits)
            cell = (place >> np.uint64(6)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
            bits = np.bitwise_or.reduceat((np.uint64(1) << (place & np.uint64(63)))[order], starts)
            yield pa.RecordBatch.from_arrays([pa.array(cell[order][starts]), pa.array(bits.view(np.int64))], ["cell", "bits"])

    return giving_back(run)


def _seed(lang: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(lang)


def _joint(x, y):
    """A hash of two words from theirs."""
    import numpy as np

    h = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0xD1B54A32D192ED03))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _counted(texts: DataFrame, size: int, sets: list, set_bits: int) -> DataFrame:
    """``lang``, ``phrase`` and ``f``: phrases of ``size`` words and how often they occur.

    With ``sets``, only some phrases count: of two words, those made of words in the
    first set; of three, those whose beginning is in the second set and whose end is in
    the first, or whose end is in the third and whose beginning is in the first.
    """
    told = texts.sparkSession.sparkContext.broadcast(sets)
    parts = texts.mapInArrow(_phrases(size, told, set_bits), "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _phrases(size: int, told, set_bits: int):
    def run(batches):
        from collections import defaultdict
        from itertools import count

        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        stops = b".,;:!?\n\x0b\x0c\r"
        table_ = bytes.maketrans(stops, b"," * len(stops))
        sets = told.value

        class Gathered:
            """A language's words as numbers, in order; zero stands between pieces."""

            def __init__(self):
                self.number = defaultdict(count().__next__)
                self.number[b","]
                self.ids = []

        def read(text, of):
            text = text.translate(LOWER_BYTES).translate(table_)
            at, length = 0, len(text)
            while at < length:
                end = length
                if length - at > 1 << 20:  # a bounded part, up to a space or stop
                    end = min((x for x in (text.find(c, at + (1 << 20)) for c in (b" ", b"\t", b",")) if x >= 0), default=length)
                tokens = text[at:end].replace(b",", b" , ").split()
                of.ids.append(np.fromiter(map(of.number.__getitem__, tokens), np.int64, len(tokens)))
                at = end
            of.ids.append(np.zeros(1, np.int64))

        def member(k, h):
            place = h >> np.uint64(64 - set_bits)
            return (sets[k][place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

        def occurring(lang, of):
            """Phrases, each as the numbers of its words, and how often they occur."""
            ids, total = np.concatenate(of.ids), len(of.number)
            if size == 1:
                f = np.bincount(ids, minlength=total)[1:]
                return [np.arange(1, total)], f
            seed = _seed(lang)
            h = np.fromiter((xxh64_intdigest(w, seed) for w in of.number), np.uint64, total)
            here = ids > 0
            if size == 2:
                here &= member(0, h)[ids]
            both = np.flatnonzero(here[:-1] & here[1:])
            pair, place, f = np.unique(ids[both] * total + ids[both + 1], return_inverse=True, return_counts=True)
            x, y = pair // total, pair % total
            if size == 2:
                return [x, y], f
            joint = _joint(h[x], h[y])
            known, grows, suspect = (member(k, joint) for k in range(3))
            next_ = np.flatnonzero(both[1:] == both[:-1] + 1)  # where a pair follows a pair
            p, q = place[next_], place[next_ + 1]
            chosen = (grows[p] & known[q]) | (known[p] & suspect[q])
            triple, f = np.unique(p[chosen] * total + y[q[chosen]], return_counts=True)
            p = triple // total
            return [x[p], y[p], triple % total], f

        def sent(gathered):
            for lang, of in gathered.items():
                parts, f = occurring(lang, of)
                words = np.array(list(of.number), object)
                for at in range(0, len(f), 1 << 16):
                    rows = [words[p[at:at + (1 << 16)]] for p in parts]
                    phrases = list(map(b" ".join, zip(*rows)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(phrases), pa.binary()).cast(pa.string()),
                            pa.array(phrases, pa.binary()).cast(pa.string()),
                            pa.array(f[at:at + (1 << 16)], pa.int64()),
                        ],
                        ["lang", "phrase", "f"],
                    )

        gathered, held = defaultdict(Gathered), 0
        for part in pieces(batches):
            for lang, text in zip(*(utf8(c) for c in part.columns)):
                of = gathered[lang]
                before = len(of.ids)
                read(text, of)
                held += sum(map(len, of.ids[before:]))
                if held >= UNIT:
                    yield from sent(gathered)
                    gathered, held = defaultdict(Gathered), 0
        yield from sent(gathered)

    return giving_back(run)


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents").select("lang", "text"))


SQL = r"""
WITH pieces AS MATERIALIZED (
  SELECT lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
tokens AS MATERIALIZED (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces)),
ones AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM tokens GROUP BY ALL),
twos AS MATERIALIZED (SELECT lang, x, y, count(*) AS f FROM tokens WHERE y IS NOT NULL GROUP BY ALL),
threes AS (SELECT lang, x, y, z, count(*) AS f FROM tokens WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
scored AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, p.f AS l, q.f AS r, 1 AS k, NULL AS left_, NULL AS right_
  FROM twos t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN ones q ON q.lang = t.lang AND q.x = t.y WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, p.f, q.f, 1, t.x || ' ' || t.y, t.y || ' ' || t.z
  FROM threes t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN twos q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, p.f, q.f, 2, NULL, NULL
  FROM threes t JOIN twos p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN ones q ON q.lang = t.lang AND q.x = t.z),
cuts AS MATERIALIZED (
  SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM scored),
longer AS (
  SELECT lang, phrase, max(a) AS b FROM (
    SELECT lang, unnest([left_, right_]) AS phrase, a FROM cuts WHERE left_ IS NOT NULL) GROUP BY ALL),
best AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1) c
  LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM best JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

QUERIES = {"op11_collocations": (op11_collocations, SQL)}
