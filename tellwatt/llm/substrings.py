"""Removal of repeated word windows behind a count-min prefilter (operator 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import documents, give_back, giving_back, packed, pieces, stored, table, unpacked, utf8, word_lists

WINDOW = 50
#: Counters of each of the sketch's two rows, as a power of two: 32 MB of bits a row.
WIDTH_BITS = 28
#: Counters a piece of a row has, as a power of two.
PIECE_BITS = 20
#: Bytes of text whose windows one task settles, on average.
SHARD_BYTES = 1 << 26
#: Bits of a set of documents, as a power of two: 8 MB.
SET_BITS = 26
#: The same of one row's piece of that set.
SET_PIECE_BITS = 20
#: Windows that a task gathers before it passes them on.
UNIT = 1 << 20


def remove_repeats(docs: DataFrame, window: int = WINDOW, width_bits: int = WIDTH_BITS) -> DataFrame:
    """All columns of ``docs``, then ``n_words``, ``n_removed`` and ``kept``.

    Words are runs of anything but ASCII white space. A word goes if a window of
    ``window`` consecutive words covers it whose words also start somewhere in a
    document with a smaller doc_id. ``kept`` has the words left, joined by spaces.
    Null texts have no words and become empty; documents shorter than a window, and
    rows without a doc_id, lose nothing and take nothing from others. Rows that
    repeat a doc_id are judged alike. No rows give none. Columns named like an
    output or ``shard_`` aren't allowed.

    First pass: every task counts its windows in a count-min sketch of two rows and
    sends only the counters it has touched; merged, the counters over one are a
    bitmap of fixed size (``width_bits``), which is broadcast. A window that occurs
    twice always has both its counters above one, so the second pass groups just
    windows with that property, by 96 bits of hash, and loses none. The sketch never
    changes the result: where the corpus outgrows it, more windows take the exact way.

    A task first settles its windows among themselves and sends each only from its
    smallest document, so a passage in a third of all documents is sent once a task.
    Windows are sent in the order of their documents, each document once for all its
    windows in a row. Texts are told apart by a hash only under ids that repeat, or that
    a bitmap of fixed size takes for such. Only documents that lose words are shuffled,
    and the few that another such bitmap takes for them; others stay where they are.
    """
    spark = docs.sparkSession
    plain = docs.select("doc_id", "text")
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES)) | 1
    seen = spark.sparkContext.broadcast(_sketch(plain, window, width_bits))
    often = plain.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = spark.sparkContext.broadcast(_set_of(often, lambda ids: ids))
    sent = plain.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        _candidates(window, width_bits, shards, seen, repeated), "shard int, settled boolean, load binary"
    )
    found = stored(
        sent.repartitionById(shards, F.col("shard"))
        .mapInArrow(_settle(shards), "shard_ int, load binary")
    )
    touched = spark.sparkContext.broadcast(_set_of(found.select("load"), lambda load: _from_load(load)[0]))
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    result = f"{schema}, n_words long, n_removed long, kept string"
    at = docs.columns.index("doc_id"), docs.columns.index("text")
    whole = docs.mapInArrow(_whole(*at, touched), result)
    chosen = docs.mapInArrow(_chosen(at[0], touched), schema)
    shard = F.pmod(F.col("doc_id").bitwiseXOR(F.shiftright("doc_id", 13)), F.lit(shards)).cast("int")
    return whole.union(
        chosen.withColumn("shard_", shard).groupBy("shard_").cogroup(found.groupBy("shard_"))
        .applyInArrow(_remove(window, repeated), result)
    )


def _set_of(rows: DataFrame, ids_of):
    """A bitmap of fixed size that has every document that ``ids_of`` finds in a value, and few others."""
    import numpy as np

    pieces_ = (
        rows.mapInArrow(_marked(ids_of), "piece int, bits binary")
        .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "piece")
        .sortWithinPartitions("piece").mapInArrow(_united(), "piece int, bits binary")
    )
    size = 1 << (SET_PIECE_BITS - 3)
    bitmap = np.zeros(1 << (SET_BITS - 3), np.uint8)
    for piece, bits in pieces_.toLocalIterator():  # 8 MB in all
        bitmap[piece * size:(piece + 1) * size] = np.frombuffer(unpacked(bits)[0], np.uint8)
    return bitmap.view(np.uint64)


def _document_places(ids):
    import numpy as np

    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - SET_BITS)


def _marked(ids_of):
    """A task's documents as the pieces of its bitmap that have any, packed."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bitmap = np.zeros(1 << (SET_BITS - 6), np.uint64)
        for batch in pieces(batches, 1024):
            column = batch.column(0)
            found = [ids_of(x) for x in column.to_pylist()] if pa.types.is_binary(column.type) else [column.to_numpy()]
            for ids in found:
                places = _document_places(np.unique(ids))
                np.bitwise_or.at(bitmap, places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63)))
        rows = bitmap.reshape(-1, 1 << (SET_PIECE_BITS - 6))
        some = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([packed(rows[k].view(np.uint8)) for k in some], pa.binary())], ["piece", "bits"]
        )

    return giving_back(run)


def _united():
    """Unites the rows of a piece as they come by."""

    def run(batches):
        import pyarrow as pa

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed(bits)], pa.binary())], ["piece", "bits"])

        now, bits = None, None
        for batch in batches:
            for piece, data in zip(*(c.to_pylist() for c in batch.columns)):
                if piece != now:
                    if now is not None:
                        yield out()
                    now, bits = piece, unpacked(data)[0]
                else:
                    bits = bits | unpacked(data)[0]
        if now is not None:
            yield out()

    return giving_back(run)


def _in_bitmap(column, bitmap):
    """Which rows of a column of ids may be in a set; null is not."""
    import numpy as np

    places = _document_places(np.array(column.fill_null(0)))
    hit = (bitmap[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1
    return hit & ~np.array(column.is_null())


def _chosen(at: int, touched):
    """Rows of documents that may have windows to remove."""

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches):
            yield part.filter(pa.array(_in_bitmap(part.column(at), touched.value)))

    return giving_back(run)


def _whole(at: int, text: int, touched):
    """All other rows, which keep every word; they needn't move."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in pieces(batches):
            part = part.filter(pa.array(~_in_bitmap(part.column(at), touched.value)))
            n_words, kept = [], []
            for value in utf8(part.column(text)):
                lists = list(word_lists(value or b""))
                n_words.append(sum(map(len, lists)))
                kept.append(b" ".join(b" ".join(words) for words in lists if words))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(n_words, pa.int64()), pa.array(np.zeros(len(n_words), np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
                [*part.schema.names, "n_words", "n_removed", "kept"],
            )

    return giving_back(run)


def _sketch(docs: DataFrame, window: int, width_bits: int) -> list:
    """A packed bitmap of counters above one for each row of the count-min sketch."""
    piece_bits = min(PIECE_BITS, width_bits)
    merged = (
        docs.where("text IS NOT NULL").mapInArrow(_counters(window, width_bits, piece_bits), "piece int, once binary, often binary")
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "piece")
        .sortWithinPartitions("piece").mapInArrow(_merge(piece_bits), "piece int, bits binary")
    )
    import numpy as np

    rows = np.zeros((2, max(1, (1 << width_bits) >> 3)), np.uint8)
    per_row = 1 << (width_bits - piece_bits)
    for piece, bits in merged.toLocalIterator(prefetchPartitions=True):  # at most all counters, one bit each
        length = len(bits)
        rows[piece // per_row, (piece % per_row) * length:(piece % per_row + 1) * length] = np.frombuffer(bits, np.uint8)
    return [rows[0], rows[1]]


def _hasher(window: int, hashes: int = 2):
    """A function from texts to each window's text number, first word and hashes.

    Words are hashed by XXH64, with a seed for each hash, and a window's hashes are polynomials of
    its words' modulo 2**64, each the difference of two prefix sums divided by the power
    where the window begins. So white space doesn't count, no structure of letters makes
    windows equal, and windows cost no more than words.
    """
    import re
    from collections import defaultdict
    from itertools import chain, count

    import numpy as np
    from xxhash import xxh64_intdigest

    bases = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
    powers = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in bases]
    ahead = re.compile(rb"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){0,%d}[^\x20\x09-\x0D]*" % (window - 2))
    gap = re.compile(rb"[\x20\x09-\x0D]")
    most = 1 << 19

    def grown(k, length):
        if len(powers[k][0]) < length:
            for side, base in enumerate((bases[k], pow(bases[k], -1, 1 << 64))):
                steps = np.full(length * 3 // 2, base, np.uint64)
                steps[0] = 1
                powers[k][side] = np.cumprod(steps)
        return powers[k]

    def finish(h):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def parts(texts):
        """Texts cut to a bounded size: number, bytes, words before; cuts overlap by a window less a word."""
        for n, text in enumerate(texts):
            at = words = 0
            while len(text) - at > most and (cut := gap.search(text, at + most)):
                yield n, text[at:ahead.match(text, cut.start()).end()], words
                words += len(text[at:cut.start()].split())
                at = cut.start()
            yield n, text[at:], words

    def hashed(group):
        split = [p.split() for _, p, _ in group]
        length = np.array([len(words) for words in split])
        number = np.maximum(length - window + 1, 0)
        total = int(number.sum())
        if not total:
            return None
        named = defaultdict(count().__next__)
        ids = np.fromiter(map(named.__getitem__, chain.from_iterable(split)), np.int64, int(length.sum()))
        since = np.cumsum(length) - length
        begin = np.arange(total) + np.repeat(since - (np.cumsum(number) - number), number)
        made = []
        for k in range(hashes):
            power, inverse = grown(k, len(ids) + 1)
            word = np.fromiter((xxh64_intdigest(w, k) for w in named), np.uint64, len(named))
            sums = np.zeros(len(ids) + 1, np.uint64)
            np.cumsum(word[ids] * power[: len(ids)], out=sums[1:])
            made.append(finish((sums[begin + window] - sums[begin]) * inverse[begin]))
        text = np.repeat(np.array([n for n, _, _ in group]), number)
        before = np.array([w for _, _, w in group])
        return text, begin - np.repeat(since - before, number), *made

    def run(texts):
        group, size = [], 0
        for part in parts(texts):
            group.append(part)
            size += len(part[1])
            if size >= most:
                if (got := hashed(group)) is not None:
                    yield got
                group, size = [], 0
        if group and (got := hashed(group)) is not None:
            yield got

    return run


def _places(h, width_bits: int):
    """A window's counter in either row."""
    import numpy as np

    shift = np.uint64(64 - width_bits)
    return h >> shift, (h * np.uint64(0xA0761D6478BD642F)) >> shift


def _gaps(numbers) -> bytes:
    """Ascending numbers as gaps: their number, a byte of each, and what is above it in unary bits."""
    import numpy as np

    gaps = np.diff(numbers.astype(np.int64), prepend=0)
    ends = np.cumsum((gaps >> 8) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    return len(gaps).to_bytes(4, "little") + gaps.astype(np.uint8).tobytes() + np.packbits(unary).tobytes()


def _from_gaps(data: bytes):
    import numpy as np

    number = int.from_bytes(data[:4], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data[4 + number:], np.uint8)))
    return np.cumsum((np.diff(ends, prepend=-1) - 1 << 8) + np.frombuffer(data[4:4 + number], np.uint8))


#: What a load has of each run of windows of one text, and of each window.
OF_RUN, OF_WINDOW = ("<i8", "<u8", "<u4"), ("<u4", "<u8", "<u4")


def _to_load(doc, mark, word, *hashes) -> bytes:
    """Windows packed: id, mark and length of each run of one text; steps between first words; hashes.

    Each byte's place is a plane of its own: none if all are zero, else compressed or as it is.
    """
    import numpy as np
    import zstandard

    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])
    steps = np.diff(word, prepend=word[:1])
    steps[new] = word[new]
    columns = [doc[new], mark[new], np.diff(np.r_[new, len(doc)]), steps, *hashes]
    squeeze, lengths, planes = zstandard.ZstdCompressor(level=1), [len(new), len(doc)], []
    for column, kind in zip(columns, OF_RUN + OF_WINDOW):
        for plane in column.astype(kind).view(np.uint8).reshape(len(column), -1).T:
            raw = plane.tobytes() if plane.any() else b""
            small = squeeze.compress(raw)
            planes.append(small if len(small) < len(raw) else raw)
            lengths.append(len(planes[-1]))
    head = zstandard.ZstdCompressor(level=1).compress(np.array(lengths, "<u4").tobytes())
    return len(head).to_bytes(4, "little") + head + b"".join(planes)


def _from_load(data: bytes) -> list:
    """Id, mark and first word of each window of a load, and its hashes if it has any."""
    import numpy as np
    import zstandard

    spread, at = zstandard.ZstdDecompressor(), 4 + int.from_bytes(data[:4], "little")
    runs, windows, *lengths = np.frombuffer(spread.decompress(data[4:at]), "<u4").tolist()
    columns, lengths = [], iter(lengths)
    for kind, number in zip(OF_RUN + OF_WINDOW, [runs] * len(OF_RUN) + [windows] * len(OF_WINDOW)):
        planes = np.zeros((number, np.dtype(kind).itemsize), np.uint8)
        for k in range(planes.shape[1]):
            if (length := next(lengths, None)) is None:
                break
            if length:
                raw = data[at:at + length]
                planes[:, k] = np.frombuffer(raw if length == number else spread.decompress(raw), np.uint8)
                at += length
        else:
            columns.append(planes.view(kind).ravel())
    doc, mark, number, steps, *hashes = columns
    word = np.cumsum(steps, dtype=np.uint32)
    new = np.cumsum(number, dtype=np.int64) - number
    word -= np.repeat(word[new] - steps[new], number)
    return [np.repeat(doc, number), np.repeat(mark, number), word, *hashes]


def _counters(window: int, width_bits: int, piece_bits: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        windows = _hasher(window, 1)
        held, count = [], 0

        def sent():
            h = np.concatenate(held)
            pieces_, once, often = [], [], []
            for row, at in enumerate(_places(h, width_bits)):
                places, times = np.unique(at, return_counts=True)
                piece = (places >> np.uint64(piece_bits)).astype(np.int64)
                within = places & np.uint64((1 << piece_bits) - 1)
                starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
                for a, b in zip(starts, [*starts[1:], len(piece)]):
                    pieces_.append((row << (width_bits - piece_bits)) + int(piece[a]))
                    once.append(_gaps(within[a:b]))
                    often.append(_gaps(within[a:b][times[a:b] > 1]))
            return pa.RecordBatch.from_arrays(
                [pa.array(pieces_, pa.int32()), pa.array(once, pa.binary()), pa.array(often, pa.binary())],
                ["piece", "once", "often"],
            )

        for part in pieces(batches):
            for _, _, h in windows(utf8(part.column(1))):
                held.append(h)
                count += len(h)
                if count >= UNIT:
                    yield sent()
                    held, count = [], 0
        if held:
            yield sent()

    return giving_back(run)


def _merge(piece_bits: int):
    """Adds the counters of a piece as its rows come by, up to two."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(piece, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([np.packbits(counts > 1, bitorder="little").tobytes()], pa.binary())],
                ["piece", "bits"],
            )

        now, counts = None, None
        for batch in batches:
            for piece, once, often in zip(*(c.to_pylist() for c in batch.columns)):
                if piece != now:
                    if now is not None:
                        yield out(now, counts)
                    now, counts = piece, np.zeros(max(8, 1 << piece_bits), np.uint8)
                for data in (once, often):
                    at = _from_gaps(data)
                    counts[at] = np.minimum(counts[at] + 1, 2)
        if now is not None:
            yield out(now, counts)

    return giving_back(run)


def _text_marks(ids, texts: list, repeated) -> list[int]:
    """Tells apart texts under one doc_id; zero where no other row has the doc_id."""
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest(t or b"") if often else 0 for t, often in zip(texts, _in_bitmap(ids, repeated).tolist())]


def _first_doc(h1, h2, doc):
    """Order of windows by hash, where each hash begins, and its smallest document for each window in that order."""
    import numpy as np

    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = np.minimum.reduceat(doc[order], starts)
    return order, starts, np.repeat(least, np.diff(np.r_[starts, len(order)]))


def _candidates(window: int, width_bits: int, shards: int, sketch, repeated):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        windows = _hasher(window)
        rows = sketch.value
        held, count = [], 0

        def twice(h):
            ok = np.ones(len(h), bool)
            for row, at in zip(rows, _places(h, width_bits)):
                ok &= (row[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return ok

        def sent():
            doc, mark, word, h1, h2 = (np.concatenate(c) for c in zip(*held))
            order, _, least = _first_doc(h1, h2, doc)
            mine = doc[order] == least
            keep = np.sort(order[mine])  # by document and word again, which packs better
            shard, settled, load = [], [], []
            to = (h1[keep] % np.uint64(shards)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            for at in np.split(by, np.flatnonzero(np.diff(to[by])) + 1):
                at_ = keep[at]
                shard.append(int(to[at[0]]))
                settled.append(False)
                load.append(_to_load(doc[at_], mark[at_], word[at_], h1[at_] // np.uint64(shards), h2[at_]))
            gone = np.sort(order[~mine])
            if len(gone):
                for s, data in _by_shard(doc[gone], mark[gone], word[gone], shards):
                    shard.append(s)
                    settled.append(True)
                    load.append(data)
            return pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(settled), pa.array(load, pa.binary())], ["shard", "settled", "load"]
            )

        for part in pieces(batches):
            ids = part.column(0).to_numpy()
            texts = utf8(part.column(1))
            marks = np.array(_text_marks(part.column(0), texts, repeated.value), np.uint64)
            for text, word, h1, h2 in windows(texts):
                ok = twice(h1)
                text = text[ok]
                held.append((ids[text], marks[text], word[ok].astype(np.uint32), h1[ok], h2[ok].astype(np.uint32)))
                count += int(ok.sum())
                if count >= UNIT:
                    yield sent()
                    held, count = [], 0
        if count:
            yield sent()

    return giving_back(run)


def _by_shard(doc, mark, word, shards: int):
    """Windows to remove, packed for each shard of documents."""
    import numpy as np

    to = (doc ^ (doc >> 13)) % shards
    by = np.argsort(to, kind="stable")
    for at in np.split(by, np.flatnonzero(np.diff(to[by])) + 1):
        yield int(to[at[0]]), _to_load(doc[at], mark[at], word[at])


def _settle(shards: int):
    """Of all windows of a shard of hashes, those that a smaller document also has."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard_", "load"]
            )

        def settled(loads):
            doc, mark, word, h1, h2 = (np.concatenate(c) for c in zip(*map(_from_load, loads)))
            order, _, least = _first_doc(h1, h2, doc)
            gone = np.sort(order[doc[order] > least])
            return list(_by_shard(doc[gone], mark[gone], word[gone], shards)) if len(gone) else []

        now, loads = None, []
        for batch in batches:
            for shard, done, load in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    if loads and (rows := settled(loads)):
                        yield out(rows)
                    now, loads = shard, []
                if done:
                    yield out([(shard, load)])
                else:
                    loads.append(load)
        if loads and (rows := settled(loads)):
            yield out(rows)

    return giving_back(run)


def _remove(window: int, repeated):
    def run(docs, found):
        import numpy as np
        import pyarrow as pa

        docs = docs.drop_columns(["shard_"])
        loads = [_from_load(x) for x in found.column("load").to_pylist()]
        at: dict = {}
        if loads:
            doc, mark, word = (np.concatenate(c) for c in zip(*loads))
            order = np.lexsort((word, mark, doc))
            doc, mark, word = doc[order], mark[order], word[order].astype(np.int64)
            starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])
            for a, b in zip(starts, [*starts[1:], len(doc)]):
                at[int(doc[a]), int(mark[a])] = word[a:b]
        n_words, n_removed, kept = [], [], []
        ids, texts = docs.column("doc_id").combine_chunks(), utf8(docs.column("text"))
        for id_, text, mark in zip(ids.to_pylist(), texts, _text_marks(ids, texts, repeated.value)):
            text = text or b""
            first = at.get((id_, mark))
            total, gone, parts = 0, 0, []
            for words in word_lists(text):
                if first is not None:
                    edges = np.zeros(len(words) + 1, np.int64)
                    near = first[(first > total - window) & (first < total + len(words))] - total
                    np.add.at(edges, np.maximum(near, 0), 1)
                    np.add.at(edges, np.minimum(near + window, len(words)), -1)
                    free = np.cumsum(edges[:-1]) == 0
                    left = [w for w, ok in zip(words, free.tolist()) if ok]
                else:
                    left = words
                total += len(words)
                gone += len(words) - len(left)
                if left:
                    parts.append(b" ".join(left))
            n_words.append(total)
            n_removed.append(gone)
            kept.append(b" ".join(parts))
        out = docs.append_column("n_words", pa.array(n_words, pa.int64()))
        out = out.append_column("n_removed", pa.array(n_removed, pa.int64()))
        give_back()
        return out.append_column("kept", pa.array(kept, pa.binary()).cast(pa.string()))

    return run


def op4_substrings(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def substring_dedup(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Pipeline stage: repeated windows leave the texts; every document stays.

    A text that loses nothing stays as it is; one that loses words becomes the words
    left, joined by spaces, and its ``n_chars`` is counted anew.
    """
    cut = remove_repeats(documents(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return documents(cut.withColumn("n_chars", chars).withColumn("text", text))


SQL = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
firsts AS MATERIALIZED (SELECT h, min(doc_id) AS f FROM windows GROUP BY h HAVING count(*) > 1),
gone AS MATERIALIZED (
  SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE f < doc_id),
edges AS (
  SELECT doc_id, i AS spot, 1 AS d FROM gone UNION ALL SELECT doc_id, i + 50, -1 FROM gone),
depth AS (
  SELECT doc_id, spot, sum(sum(d)) OVER (PARTITION BY doc_id ORDER BY spot) AS open,
    lead(spot) OVER (PARTITION BY doc_id ORDER BY spot) AS until
  FROM edges GROUP BY doc_id, spot),
covered AS (
  SELECT doc_id, unnest(range(spot, until)) AS i FROM depth WHERE open > 0),
kept AS (
  SELECT p.doc_id, count(c.i) AS n_removed,
    coalesce(string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL), '') AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) p
  LEFT JOIN covered c ON c.doc_id = p.doc_id AND c.i = p.i
  GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

QUERIES = {"op4_substrings": (op4_substrings, SQL)}
