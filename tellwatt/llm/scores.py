"""Texts scored by a language model in a log-frequency Bloom filter (operator 12)."""

from __future__ import annotations

from collections import defaultdict
from functools import cached_property
from itertools import count, pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import giving_back, packed, pieces, stored, table, unpacked, utf8

ORDER = 2
#: A count c is held as ``1 + floor(log(c, BASE))``.
BASE = 1.5
#: Bits of the filter for each level of each n-gram, and how many of them it sets.
EVENT_BITS, PROBES = 10, 4
#: N-grams that a part of the filter holds, on average.
PART_GRAMS = 1 << 22
#: Bytes of text taken for a token when parts are planned, before tokens are counted.
TOKEN_BYTES = 6
#: Bytes of the filter that are broadcast; a larger one is asked part by part.
BROADCAST_BYTES = 128 << 20
#: Words with at least this share of all tokens are broadcast with their counts: no more than its inverse, 20 MB.
COMMON_SHARE = 1 / (1 << 20)
#: Weights of shorter contexts to choose from.
WEIGHTS = (1.0, 4.0, 16.0, 64.0, 256.0, 1024.0, 4096.0, 16384.0)
#: Words that a task gathers before it passes on what it found, and before it asks a filter that it has whole, for
#: which more are no use. Results don't depend on them, memory does.
UNIT, UNIT_HERE = 1 << 19, 1 << 17
#: N-grams looked up at a time, so that what is made of them stays in a core's cache.
BLOCK = 1 << 16
END, BEGIN = b"", b" "  # no words


class Model:
    """What scoring needs: totals, exact counts by word, the filter, and the weight of shorter contexts."""

    def __init__(self, texts: DataFrame, words: DataFrame, tokens: int, distinct: int, parts: DataFrame, count: int, order: int):
        self.texts, self.words, self.tokens, self.distinct = texts, words, tokens, distinct
        self.parts, self.count, self.order = parts, count, order

    @cached_property
    def weight(self) -> float:
        """Fitted on all texts when first asked for, unless ``scored`` has done it on its way."""
        return _weight(self)


def learn(docs: DataFrame, order: int = ORDER) -> Model:
    """Counts of the words and n-grams of all texts of ``docs``, which needs ``text``.

    ASCII letters are lower-cased, words are runs of anything but ASCII white space,
    and every text ends in one more token. Null texts are empty ones; repeated rows
    count each time; no rows make a model for which everything is equally likely.

    Tasks count words and n-grams unit by unit and deal them out by hash, so a common
    one is sent once a unit. A part adds up the words dealt to it, which no other part
    has, and holds some ``PART_GRAMS`` n-grams at any size: for every level of an
    n-gram's count, ``PROBES`` of ``EVENT_BITS`` bits.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + TOKEN_BYTES), F.lit(0))).first()[0]
    parts = max(partitions, -(-size * order // (TOKEN_BYTES * PART_GRAMS)))
    grams = texts.mapInArrow(_gram_counts(order, parts), "part int, load binary")
    filled = grams.repartition(min(parts, 8 * partitions), "part").sortWithinPartitions("part")
    made = stored(filled.mapInArrow(_filled(), "part int, size long, bits binary, word string, c long"))
    words = made.where("word IS NOT NULL").select("word", "c")
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return Model(texts, words, tokens, distinct, made.where("part IS NOT NULL").select("part", "size", "bits"), parts, order)


def scored(docs: DataFrame, model: Model, learned: Column | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row of ``docs``.

    Texts are read as by ``learn``. ``n_known`` counts tokens that the model has seen,
    ``base_score`` sums the logarithms of their smoothed shares, which are exact.
    ``score`` is the model's: the probability of a token after those before it is
    ``(c(context, token) + weight * p) / (c(context) + weight)``, where p is its
    probability under the shorter context, at last its smoothed share. Those counts
    come from the filter: an n-gram's levels are asked for one after another until a
    probe finds no bit, and the mean count of the last is taken. So they are never too
    low by more than a level's width, and too high only by a chance of a hundredth or
    so. Null texts are empty, all rows stay, other columns don't matter.

    A filter of at most ``BROADCAST_BYTES`` is broadcast. Beyond that, the distinct
    n-grams of each unit of texts are sent to the parts of the filter that know them,
    and their levels back to the unit; the result is the same. Counts of words come
    from a broadcast of the common ones, whose number is bounded, and from a join for
    the others, none of which is common enough to be a hot key.

    ``learned`` tells the rows that the model comes from, when all of them are among
    ``docs``. The weight is then fitted in the same pass, in which texts are scored
    under every weight, and not in one of its own; the result is the same.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.lit(None).cast("long") if learned is None else F.when(learned, F.xxhash64(text))
    rows = docs.select(F.struct("doc_id", key.alias("key")).alias("doc"), text.alias("text"))
    weights = (model.weight,) if learned is None else WEIGHTS
    common = docs.sparkSession.sparkContext.broadcast(_common(model))
    finish = _text_scores(model.tokens, model.distinct, weights, learned is not None, common)
    made = _with_levels(
        rows, model, finish,
        "doc_id long, n_tokens long, n_known long, base double, scores array<double>, "
        "rare array<struct<word: string, times: long>>, key long, likelihoods array<double>",
    )
    made = stored(made.withColumn("row", F.monotonically_increasing_id()))  # stored, so that numbers stay
    if learned is not None:
        model.weight = _likeliest(made.where("key IS NOT NULL"))
    rare = made.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times").join(model.words, "word", "left")
    share = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more"), F.sum(F.col("times") * share).alias("rest")
    )
    return made.join(sums, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        F.col("scores")[weights.index(model.weight)].alias("score"),
    )


def _common(model: Model) -> tuple:
    """Common words as two hashes each, in order, with their counts; a word that is missed here is a rare one."""
    import numpy as np

    rows = model.words.where(F.col("c") >= max(1.0, model.tokens * COMMON_SHARE)).select(F.encode("word", "utf-8").alias("word"), "c")
    got = rows.toArrow()
    first, second = _named(got.column("word").to_pylist())
    order = np.argsort(first)
    return first[order], second[order], got.column("c").to_numpy()[order]


def _hashes(words: list, seed: int = 0):
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _named(words: list) -> tuple:
    """128 bits of hash a word, by which it is told apart."""
    return _hashes(words), _hashes(words, 1)


class Unit:
    """Words of some texts, as numbers in order; every text begins and ends with a token of its own."""

    def __init__(self, order: int):
        self.order, self.size = order, 0
        self.texts, self.waiting = [], 0
        self.found, self.counts = [], []

    def add(self, text: bytes) -> None:
        self.texts.append(text)
        self.waiting += len(text)
        if self.waiting >= UNIT_HERE:
            self.split()

    def split(self) -> None:
        """Splits the texts added since the last time, all at once."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(self.texts, pa.large_string())))
        words = lists.flatten()
        some = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves empty ones
        before = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))]
        ends = before[np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]]
        self.found.append(words.filter(some))
        self.counts.append(np.diff(ends))
        self.size += int(ends[-1]) + len(self.texts)
        self.texts, self.waiting = [], 0

    @cached_property
    def coded(self) -> tuple:
        """Distinct words, the text's end and beginning first, as an Arrow array; and all words as numbers of them."""
        import pyarrow as pa

        if self.texts:
            self.split()
        found, self.found = self.found, []
        all_ = pa.chunked_array([pa.array([END, BEGIN], pa.large_string()), *found]).combine_chunks().dictionary_encode()
        return all_.dictionary, all_.indices.to_numpy()[2:]

    @cached_property
    def words(self) -> list:
        import pyarrow as pa

        return self.coded[0].cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()

    @cached_property
    def named(self):
        """Hashes of the distinct words."""
        return _hashes(self.words)

    @cached_property
    def lengths(self):
        """Tokens of each text."""
        import numpy as np

        self.coded
        return np.concatenate(self.counts) + 1

    @cached_property
    def tokens(self) -> tuple:
        """All numbers; which are tokens; and which of the others end a context."""
        import numpy as np

        words, lengths = self.coded[1], self.lengths
        ids = np.ones(int(lengths.sum()) + len(lengths) * (self.order - 1), np.int32)
        first = np.arange(len(lengths)) * self.order + self.order - 1
        ids[np.repeat(first, lengths - 1) + np.arange(len(words))] = words
        ids[np.cumsum(lengths - 1) + first] = 0
        real = ids != 1
        return ids, real, ~real & np.r_[real[1:], False]

    @cached_property
    def held(self) -> list:
        """Hashes of the n-grams that end at each place, by length, and whether they count there."""
        import numpy as np

        ids, real, last = self.tokens
        one = self.named[ids]
        h, out = one, []
        for length in range(1, self.order + 1):
            if length > 1:
                h = _joint(np.r_[np.uint64(0), h[:-1]], one)
            out.append((h, real | last if length < self.order else real))
        return out

    def keys(self):
        """The n-grams that count, by length and place."""
        import numpy as np

        return np.concatenate([h[holds] for h, holds in self.held])

    def longer(self):
        """Those of them that are no single words."""
        import numpy as np

        return np.concatenate([np.empty(0, np.uint64), *(h[holds] for h, holds in self.held[1:])])


def _joint(x, y):
    """A hash of an n-gram and the word after it."""
    import numpy as np

    return _mixed((x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0xD1B54A32D192ED03)))


def _mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _units(batches, order: int, column: int, done, size: int):
    """Gathers texts to units of a bounded number of words; ``done(unit, rows)`` makes batches of each."""
    unit, rows = Unit(order), []
    for part in pieces(batches):
        for k, text in enumerate(utf8(part.column(column))):
            unit.add(text)
            rows.append((part, k))
            if unit.size >= size:
                yield from done(unit, rows)
                unit, rows = Unit(order), []
    if rows:
        yield from done(unit, rows)


def _dealt(keys, parts: int):
    """Each part's places in ``keys``, which stay in order."""
    import numpy as np

    to = (keys % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)  # short ones are sorted faster
    by = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(to[by][1:] != to[by][:-1]) + 1
    return [(int(to[at[0]]), at) for at in np.split(by, cuts) if len(at)]


def _gram_counts(order: int, parts: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def done(unit, rows):
            keys, f = np.unique(unit.longer(), return_counts=True)
            ids, holds = unit.tokens[0], unit.held[0][1]
            c = np.bincount(ids[holds], minlength=len(unit.words))
            seen = np.flatnonzero(c)
            f, c = (x.astype(np.uint8 if x.max(initial=0) < 256 else np.int64) for x in (f, c[seen]))
            grams, words = dict(_dealt(keys, parts)), dict(_dealt(unit.named[seen], parts))
            to, none = sorted(grams.keys() | words.keys()), np.empty(0, np.int64)
            loads = []
            for p in to:
                mine, here = grams.get(p, none), words.get(p, none)
                joined = b"\n".join([unit.words[k] for k in seen[here].tolist()])  # no word has a line's end
                loads.append(packed(keys[mine], f[mine], np.frombuffer(joined, np.uint8), c[here]))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(loads, pa.binary())], ["part", "load"])

        yield from _units(batches, order, 0, done, UNIT)

    return giving_back(run)


def _places(keys, level: int, size):
    """The bits that a level of these n-grams sets in a part of so many bits."""
    import numpy as np

    h = _mixed(keys + np.uint64(level * 0xA0761D6478BD642F % (1 << 64)))
    step = _mixed(h) | np.uint64(1)
    half = np.uint64(32)
    for k in range(PROBES):
        yield (((h + np.uint64(k) * step) >> half) * size) >> half


def _summed(keys, f):
    """Distinct keys, and the sum of ``f`` for each."""
    import numpy as np

    by = np.argsort(keys)
    keys = keys[by]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.add.reduceat(f[by].astype(np.int64), first) if len(first) else f


def _filled():
    """A row for each part of the filter, and one for each word dealt to it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["part", "size", "bits", "word", "c"]
        types = pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64()

        def made(part, loads):
            keys, f, joined, c = zip(*map(unpacked, loads))
            keys, f = _summed(np.concatenate(keys), np.concatenate(f))
            number, ids = defaultdict(count().__next__), []
            for some, n in zip(joined, c):
                if len(n):
                    ids.append(np.fromiter(map(number.__getitem__, some.tobytes().split(b"\n")), np.int64, len(n)))
            words = list(number)
            c = np.bincount(np.concatenate(ids), np.concatenate(c)).astype(np.int64) if words else np.empty(0, np.int64)
            keys, f = np.r_[keys, _hashes(words)], np.r_[f, c]
            # In whole numbers: the highest level whose lowest count is not above f.
            level = np.searchsorted(_lowest(f.max()), f, side="right")
            size = max(64, -(-int(level.sum()) * EVENT_BITS // 64) * 64)
            bits = np.zeros(size, bool)
            for j in range(1, int(level.max()) + 1):
                here = keys[level >= j]
                for begin in range(0, len(here), BLOCK):
                    for place in _places(here[begin:begin + BLOCK], j, np.uint64(size)):
                        bits[place.view(np.int64)] = True
            row = part, size, np.packbits(bits, bitorder="little").tobytes(), None, None
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)
            tokens = [k for k, w in enumerate(words) if w != BEGIN]
            row = [pa.nulls(len(tokens), t) for t in types[:3]]
            row += [pa.array([words[k] for k in tokens], pa.binary()).cast(pa.string()), pa.array(c[tokens], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, names)

        now, loads = None, []
        for batch in pieces(batches, 16):
            for part, load in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now and loads:
                    yield from made(now, loads)
                    loads = []
                now = part
                loads.append(load)
        if loads:
            yield from made(now, loads)

    return giving_back(run)


def _lowest(most: float):
    """The lowest count of each level from the first on, up to ``most``."""
    import numpy as np

    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(np.ceil(BASE ** len(out)))))
    return np.array(out, np.float64)


def _mean_counts(levels):
    """The mean count of each level; zero for none."""
    import numpy as np

    low = _lowest(float(BASE) ** (int(levels.max(initial=0)) + 2))
    return np.r_[0.0, (low[:-1] + low[1:] - 1) / 2][levels]


def _levels(keys, bits, start, size):
    """Levels of n-grams, asked for in parts of ``bits`` that begin at ``start`` and have ``size`` bits."""
    import numpy as np

    level = np.zeros(len(keys), np.uint8)  # the 255th begins beyond 10^44
    at, now = np.arange(len(keys)), 0
    while len(at):
        now += 1
        found, clear = np.ones(len(at), bool), start[at]
        for place in _places(keys[at], now, size[at]):
            place = place + clear
            byte = bits[(place >> np.uint64(3)).view(np.int64)]  # signed, as numpy would convert it
            found &= ((byte >> (place & np.uint64(7)).astype(np.uint8)) & 1).view(bool)
        at = at[found]
        level[at] = now
    return level


def _whole_levels(keys, bits, start, size):
    """Levels of n-grams, asked for in the whole filter: where each of its parts begins and how many bits it has."""
    import numpy as np

    out = [np.empty(0, np.uint8)]
    for begin in range(0, len(keys), BLOCK):
        some = keys[begin:begin + BLOCK]
        part = (some % np.uint64(len(start))).astype(np.int64)
        out.append(_levels(some, bits, start[part], size[part]))
    return np.concatenate(out)


def _cases(unit: Unit, levels) -> tuple:
    """Each token's case, and the levels of every case, one array for each that a probability is made from.

    ``levels`` are those of the unit's keys. Cases are few, as levels are.
    """
    import numpy as np

    real = unit.tokens[1]
    places, at, by_length = np.flatnonzero(real), 0, []
    for _, holds in unit.held:
        c = np.zeros(len(real), levels.dtype)
        n = int(holds.sum())
        c[holds] = levels[at:at + n]
        at += n
        by_length.append(c)
    columns = [by_length[0][places]]
    for shorter, c in pairwise(by_length):
        columns += [shorter[places - 1], c[places]]
    case, cases, number = np.zeros(len(places), np.int64), [], 1
    for c in columns:
        wide = int(c.max()) + 1
        case = case * wide + c
        seen = np.zeros(number * wide, bool)
        seen[case] = True
        used = np.flatnonzero(seen)
        cases = [x[used // wide] for x in cases] + [used % wide]
        case, number = (np.cumsum(seen) - 1)[case], len(used)
    return case, cases


def _probabilities(cases: list, tokens: int, distinct: int, weights: tuple, without: int = 0):
    """The probability of each case's token by weight, from mean counts less ``without`` for the token's own place."""
    import numpy as np

    first, *rest = (np.maximum(_mean_counts(c) - without, 0) for c in cases)
    share = np.minimum((first + 0.5) / (tokens - without + 0.5 * (distinct + 1)), 1)
    for weight in weights:
        p = share
        for context, c in zip(rest[::2], rest[1::2]):
            p = (np.minimum(c, context) + weight * p) / (context + weight)
        yield p


#: What goes with a text: its id, and a key if the weight is fitted on it.
DOC = "doc struct<doc_id: long, key: long>"


def _with_levels(rows: DataFrame, model: Model, finish, schema: str) -> DataFrame:
    """``finish(unit, docs, levels)`` of each unit of texts: a batch made from the levels of its keys.

    ``rows`` has ``doc`` and ``text``.
    """
    spark = rows.sparkSession
    size = model.parts.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return rows.mapInArrow(_asked_here(model.order, spark.sparkContext.broadcast(_whole(model)), finish), schema)
    partitions = min(model.count, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = stored(rows.mapInArrow(_questions(model.order, model.count), f"unit string, part int, load binary, place int, {DOC}, text string"))
    nothing = F.lit(None)
    asked = sent.where("part IS NOT NULL").select("part", "unit", F.lit(0).cast("long").alias("size"), "load")
    held = model.parts.select("part", nothing.cast("string").alias("unit"), "size", F.col("bits").alias("load"))
    levels = (
        held.union(asked).repartition(partitions, "part").sortWithinPartitions("part", F.asc_nulls_first("unit"))
        .mapInArrow(_answers(), "unit string, load binary")
    )
    back = levels.select("unit", F.lit(-1).alias("place"), "load", nothing.cast(sent.schema["doc"].dataType).alias("doc"), nothing.cast("string").alias("text"))
    texts = sent.where("part IS NULL").select("unit", "place", "load", "doc", "text")
    return (
        back.union(texts).repartition(partitions, "unit").sortWithinPartitions("unit", "place")
        .mapInArrow(_answered(model.order, finish), schema)
    )


def _whole(model: Model) -> tuple:
    """The whole filter: its bits, and where each part begins and how many bits it has."""
    import numpy as np

    # Parts without n-grams share the 64 clear bits at the beginning.
    start, size = np.zeros(model.count, np.uint64), np.full(model.count, 64, np.uint64)
    bits, at = [bytes(8)], 64
    for part, length, data in model.parts.orderBy("part").toLocalIterator():
        start[part], size[part] = at, length
        bits.append(bytes(data))
        at += length
    return np.frombuffer(b"".join(bits), np.uint8), start, size


def _asked_here(order: int, told, finish):
    def run(batches):
        import numpy as np

        def done(unit, rows):
            of_words = _whole_levels(unit.named, *told.value)[unit.tokens[0][unit.held[0][1]]]
            of_longer = _whole_levels(unit.longer(), *told.value)  # few come twice
            yield finish(unit, [p.column(0)[k].as_py() for p, k in rows], np.concatenate([of_words, of_longer]))

        yield from _units(batches, order, 1, done, UNIT_HERE)

    return giving_back(run)


def _questions(order: int, parts: int):
    def run(batches):
        from uuid import uuid4

        import numpy as np
        import pyarrow as pa

        doc = pa.struct([("doc_id", pa.int64()), ("key", pa.int64())])
        types = pa.string(), pa.int32(), pa.binary(), pa.int32(), doc, pa.string()
        names = ["unit", "part", "load", "place", "doc", "text"]

        def done(unit, rows):
            name = uuid4().hex  # fixed when the table is stored
            keys = np.unique(unit.keys())
            out = [(name, p, packed(keys[at]), None, None, None) for p, at in _dealt(keys, parts)]
            out += [(name, None, None, n, p.column(0)[k].as_py(), p.column(1)[k].as_py()) for n, (p, k) in enumerate(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        yield from _units(batches, order, 1, done, UNIT)

    return giving_back(run)


def _answers():
    """Levels of the n-grams asked for, by the part that comes before the questions to it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        now, bits, size = None, np.zeros(8, np.uint8), 64
        for batch in pieces(batches, 16):
            out = []
            for part, unit, length, load in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    now, bits, size = part, np.zeros(8, np.uint8), 64
                if unit is None:
                    bits, size = np.frombuffer(load, np.uint8), length
                    continue
                (keys,) = unpacked(load)
                flat = np.zeros(len(keys), np.uint64)
                level = _levels(keys, bits, flat, flat + np.uint64(size))
                out.append((unit, packed(keys, level)))
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary())], ["unit", "load"])

    return giving_back(run)


def _answered(order: int, finish):
    def run(batches):
        import numpy as np

        def done(unit, ids, loads):
            keys, levels = (np.concatenate(c) for c in zip(*map(unpacked, loads)))
            by = np.argsort(keys)
            at = np.searchsorted(keys[by], unit.keys())
            return finish(unit, ids, levels[by][at])

        now, unit, ids, loads = None, None, [], []
        for batch in pieces(batches):
            for name, place, load, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                if name != now:
                    if ids:
                        yield done(unit, ids, loads)
                    now, unit, ids, loads = name, Unit(order), [], []
                if place < 0:
                    loads.append(load)
                else:
                    unit.add(text.encode())
                    ids.append(id_)
        if ids:
            yield done(unit, ids, loads)

    return giving_back(run)


def _weight(model: Model) -> float:
    """The model's weight by all texts that it has learned from."""
    rows = model.texts.select(F.struct(F.lit(None).cast("long").alias("doc_id"), F.xxhash64("text").alias("key")).alias("doc"), "text")
    return _likeliest(_with_levels(rows, model, _likelihoods(model.tokens, model.distinct), "key long, likelihoods array<double>"))


def _likeliest(texts: DataFrame) -> float:
    """The weight under which the texts are likeliest, each token without its own occurrence.

    Every text counts, repeated ones (of one ``key``) once; they are measured against
    the counts of all.
    """
    columns = [f"w{k}" for k in range(len(WEIGHTS))]
    by_text = texts.select("key", *(F.col("likelihoods")[k].alias(c) for k, c in enumerate(columns)))
    by_text = by_text.groupBy("key").agg(*(F.first(c).alias(c) for c in columns))
    sums = by_text.agg(*(F.round(F.sum(c), 3).alias(c) for c in columns)).first()
    return WEIGHTS[-1] if sums[0] is None else max(zip(sums, WEIGHTS))[1]


def _likelihoods(tokens: int, distinct: int):
    def finish(unit, docs, levels):
        import pyarrow as pa

        case, cases = _cases(unit, levels)
        sums = _text_sums(unit, case, _probabilities(cases, tokens, distinct, WEIGHTS, without=1))
        return pa.RecordBatch.from_arrays([pa.array([d["key"] for d in docs], pa.int64()), sums], ["key", "likelihoods"])

    return finish


def _text_sums(unit: Unit, case, probabilities):
    """For each text of a unit a list: the sum of its tokens' logarithms for each of the probabilities of their cases."""
    import numpy as np
    import pyarrow as pa

    first = np.cumsum(unit.lengths) - unit.lengths
    sums = np.stack([np.add.reduceat(np.log10(p)[case], first) for p in probabilities], axis=1)
    return pa.FixedSizeListArray.from_arrays(sums.ravel(), sums.shape[1]).cast(pa.list_(pa.float64()))


def _text_scores(tokens: int, distinct: int, weights: tuple, fit: bool, common):
    def finish(unit, docs, levels):
        import numpy as np
        import pyarrow as pa

        words, mine = unit.words, unit.named
        first_, second, held = common.value
        place = np.minimum(np.searchsorted(first_, mine), max(0, len(first_) - 1))
        c = np.zeros(len(words))
        if len(first_):
            c = np.where((first_[place] == mine) & (second[place] == _hashes(words, 1)), held[place], 0).astype(np.float64)
        share = np.where(c > 0, np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1))), 0)
        number, real, _ = unit.tokens
        number, lengths = number[real], unit.lengths
        first = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(lengths)), lengths)
        unknown = c[number] == 0
        pairs, times = np.unique(text[unknown] * len(words) + number[unknown], return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(lengths) + 1) * len(words)).astype(np.int32)
        names = unit.coded[0].take(pa.array(pairs % len(words))).cast(pa.string())
        rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([names, pa.array(times)], ["word", "times"]))
        case, cases = _cases(unit, levels)
        if fit:
            likelihoods = _text_sums(unit, case, _probabilities(cases, tokens, distinct, WEIGHTS, without=1))
        else:
            likelihoods = pa.nulls(len(docs), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d["doc_id"] for d in docs], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(np.add.reduceat((~unknown).astype(np.int64), first)),
                pa.array(np.add.reduceat(share[number], first)),
                _text_sums(unit, case, _probabilities(cases, tokens, distinct, weights)),
                rare,
                pa.array([d["key"] for d in docs], pa.int64()),
                likelihoods,
            ],
            ["doc_id", "n_tokens", "n_known", "base", "scores", "rare", "key", "likelihoods"],
        )

    return finish


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def op12_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A row without a doc_id is neither held out nor learned from."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = learn(docs.where(fold() != 1))
    return scored(docs, model, learned=fold() != 1).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


QUERIES = {"op12_scores": (op12_scores, None)}
