"""Packing documents into sequences of fixed length (operator 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import giving_back, pieces, stored, table, utf8, word_lists

CAPACITY = 2048
END_ID = 0
#: Parts that documents of one length are numbered in, so that no task numbers all of them.
PARTS = 64
#: Words whose ids a task remembers.
REMEMBERED = 300_000
#: Punctuation that is no part of a contraction.
CLOSING = b'.,;:!?$%&*#|()[]{}<>"+-=/@^_~`'


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Each text's ids and the closing one, in pieces of at most ``capacity``.

    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted,
    ``ids`` (unsigned 32-bit, little endian). A null or empty text has the closing id
    alone. The vocabulary drops white space and no token spans it, so words are
    looked up one by one and a task remembers those it has met. A word of letters
    with punctuation behind it, which are apart in the vocabulary's pattern too, is
    made of the ids of both; every other word goes through the whole tokenizer.
    """
    kept = ", ids binary" if keep_ids else ""
    return docs.select("doc_id", "text").mapInArrow(
        _tokens(tokenizer, capacity, end_id, keep_ids),
        f"doc_id long, piece int, start long, length long, ids_crc32 long{kept}",
    )


def _tokens(tokenizer: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches):
        import os
        import re
        import zlib
        from array import array

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        merges = model.model
        # Byte-level vocabularies write a byte as itself if it is a visible Latin-1 character, else from 256 on.
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = sorted(set(range(256)).difference(visible))
        letters = {b: chr(256 + k) for k, b in enumerate(hidden)}
        latin = re.compile("[a-zß-öø-ÿ]+").fullmatch
        known: dict[bytes, bytes] = {}  # a word's ids
        stems: dict[bytes, bytes] = {}  # those of the stems and the punctuation words are made of
        end, step = array("I", [end_id]).tobytes(), 4 * capacity

        def whole(word: bytes) -> bytes:
            return array("I", model.encode(word.decode(), add_special_tokens=False).ids).tobytes()

        def stem_ids(stem: bytes) -> bytes | None:
            """For Latin letters alone: one run of the pattern, whose lower case is plain to see."""
            if stem.isalpha():
                stem = stem.lower()
                if (found := stems.get(stem)) is None:
                    found = stems[stem] = array("I", [t.id for t in merges.tokenize(stem.decode())]).tobytes()
                return found
            low = stem.decode().lower()
            if latin(low) is None:
                return None
            stem = low.encode()
            if (found := stems.get(stem)) is None:
                spelled = stem.decode("latin-1").translate(letters)
                found = stems[stem] = array("I", [t.id for t in merges.tokenize(spelled)]).tobytes()
            return found

        def word_ids(word: bytes) -> bytes:
            stem = word.rstrip(CLOSING)
            if not stem or (made := stem_ids(stem)) is None:
                return whole(word)
            tail = word[len(stem):]
            if tail:
                if (closing := stems.get(tail)) is None:
                    closing = stems[tail] = whole(tail)
                return made + closing
            return made

        def learn(words) -> None:
            fresh = set(words).difference(known)
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
                stems.clear()
                fresh = set(words)
            for word in fresh:
                known[word] = word_ids(word)

        for part in pieces(batches):
            rows = [[] for _ in range(6)]
            for doc, text in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                held, piece = b"", 0

                def cut(data, piece=0, doc=doc):
                    row = doc, piece, piece * capacity, len(data) // 4, zlib.crc32(data), data
                    for column, value in zip(rows, row):
                        column.append(value)

                for words in word_lists(text or b""):
                    learn(words)
                    held += b"".join(map(known.__getitem__, words))
                    filled = (len(held) - 1) // step if held else 0
                    for k in range(filled):
                        cut(held[k * step:(k + 1) * step], piece)
                        piece += 1
                    held = held[filled * step:]
                held += end
                for k in range(0, len(held), step):
                    cut(held[k:k + step], piece)
                    piece += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)][: len(names)], names)

    return giving_back(run)


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """How to fill sequences, given how many pieces have each length: (lengths, how often).

    First Martello and Toth's dominance: a piece with which nothing else fits is alone
    in its sequence; a piece and its exact complement share one, for whatever else
    could stand beside it would fit in the complement's place; and where no two
    others fit beside a piece, the longest that fits does. These are fixed for good.
    What is left is placed longest first, each in the fullest sequence it fits.

    Pieces of one length are exchangeable, so whole groups of sequences are filled
    at a time: work and result depend on ``capacity``, not on how many pieces there are.
    """
    left = [0] * (capacity + 1)
    for length, count in lengths.items():
        left[length] = count
    made: list[tuple[tuple[int, ...], int]] = []

    def shortest_others(length: int) -> list[int]:
        """The two shortest besides one of that length."""
        found: list[int] = []
        left[length] -= 1
        for size in range(1, capacity + 1):
            found += [size] * min(2 - len(found), left[size])
            if len(found) == 2:
                break
        left[length] += 1
        return found

    def fix(sizes: tuple[int, ...], count: int) -> None:
        for size in sizes:
            left[size] -= count
        made.append((sizes, count))

    for size in range(capacity, 0, -1):
        while left[size]:
            others = shortest_others(size)
            rest = capacity - size
            if not others or others[0] > rest:
                fix((size,), left[size])
                continue
            if left[rest] > (rest == size):
                fix((size, rest), left[size] // 2 if rest == size else min(left[size], left[rest]))
                continue
            if len(others) == 2 and sum(others) <= rest:
                break
            beside = next(s for s in range(rest, 0, -1) if left[s] > (s == size))
            fix((size, beside), left[size] // 2 if beside == size else min(left[size], left[beside]))

    # Open sequences by room left: groups of (lengths, how many).
    room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for size in range(capacity, 0, -1):
        todo, at = left[size], size
        while todo:
            while at <= capacity and not room[at]:
                at += 1
            if at > capacity:
                each = capacity // size
                opened = -(-todo // each)
                room[capacity].append(((), opened))
                at = capacity
            sizes, count = room[at].pop()
            each = min(at // size, todo)
            full = min(count, todo // each)
            if count > full:
                room[at].append((sizes, count - full))
            room[at - each * size].append((sizes + (size,) * each, full))
            todo -= full * each
    return made + [group for groups in room for group in groups if group[0]]


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, in as few sequences as the plan needs.

    Only the number of pieces of each length and part reaches the driver, at most
    ``capacity * PARTS`` rows. Pieces of a length are numbered part by part, and
    their number tells their place. Rows that repeat each get a place; none give none.
    """
    import numpy as np

    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")
    parted = cut.withColumn("part_", part)
    counts = np.zeros((capacity + 1, PARTS), np.int64)
    for length, where, count in parted.groupBy("length", "part_").count().collect():
        counts[length, where] = count
    before = np.cumsum(counts, 1) - counts
    slots, sequence = [], 0
    taken = np.zeros(capacity + 1, np.int64)
    totals = counts.sum(1)
    for sizes, count in plan({n: int(totals[n]) for n in np.flatnonzero(totals)}, capacity):
        offset = 0
        for size in sizes:
            slots.append((size, int(taken[size]), sequence, offset))
            taken[size] += count
            offset += size
        sequence += count
    order = Window.partitionBy("length", "part_").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = parted.withColumn("number_", F.row_number().over(order) - 1)
    fields = [f for f in cut.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return numbered.mapInArrow(
        _places(np.array(sorted(slots), np.int64).reshape(-1, 4), before, len(fields)),
        f"{schema}, sequence_id long, offset long",
    )


def _places(slots, before, width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        # Numbers of a length run on from slot to slot, so length and number find the slot.
        far = np.int64(1) << 48
        starts = slots[:, 0] * far + slots[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number_").to_numpy() + before[length, batch.column("part_").to_numpy()]
            slot = np.searchsorted(starts, length * far + number, "right") - 1
            sequence = slots[slot, 2] + number - slots[slot, 1]
            names = batch.schema.names[:width]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(sequence), pa.array(slots[slot, 3])], [*names, "sequence_id", "offset"]
            )

    return giving_back(run)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids of every sequence, from packed pieces that carry their ``ids``."""
    row = F.struct("offset", "ids")
    return placed.groupBy("sequence_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda r: F.hex(r["ids"])), "").alias("ids")
    ).select("sequence_id", F.unhex("ids").alias("ids"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return _pack(table(spark, sf, "documents"))


def _pack(docs: DataFrame) -> DataFrame:
    return packed(stored(tokenized(docs, default_tokenizer(), keep_ids=False)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Pipeline stage: the place of every piece of every document it is given."""
    return _pack(docs)


QUERIES = {"op7_packing": (op7_packing, None)}
