"""Lempel-Ziv phrase fingerprints (operator 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import giving_back, pieces, table

#: Smallest phrase hashes that a fingerprint keeps.
KEPT = 64
PRIME = (1 << 61) - 1
BASE = 0x1B873593CC9E2D51 % PRIME


class Parse:
    """The phrases of a text: each the shortest that is new, as bytes are read on.

    Phrases are kept as a tree, so a step costs the same however long a phrase is,
    and what has been read since a mark can be taken back.
    """

    def __init__(self):
        self.known: dict[int, int] = {}
        self.hashes = [7]
        self.node = 0
        self.log: list[int] = []

    def read(self, data: bytes) -> None:
        known, hashes, log, node = self.known, self.hashes, self.log, self.node
        get = known.get
        for byte in data:
            key = node << 8 | byte
            after = get(key)
            if after is None:
                known[key] = len(hashes)
                hashes.append((hashes[node] * BASE + byte + 1) % PRIME)
                log.append(key)
                node = 0
            else:
                node = after
        self.node = node

    def back_to(self, node: int, phrases: int) -> None:
        for key in self.log[phrases:]:
            del self.known[key]
        del self.log[phrases:]
        del self.hashes[phrases + 1:]
        self.node = node

    def signature(self):
        """The smallest distinct hashes of the phrase set, in order."""
        import numpy as np

        h = np.array(self.hashes[1:], np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        h = (h >> np.uint64(32)).astype(np.uint32)
        if len(h) > 4 * KEPT:  # few are equal, so twice as many as needed will do
            few = np.unique(np.partition(h, 2 * KEPT)[: 2 * KEPT])
            if len(few) >= KEPT:
                return few[:KEPT]
        return np.unique(h)[:KEPT]


def likeness(a, b) -> float:
    """The Jaccard likeness of two phrase sets, estimated from the smallest hashes of both together."""
    import numpy as np

    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:KEPT]
    return float(np.isin(both, a).astype(int) @ np.isin(both, b).astype(int)) / len(both)


def written(signature) -> str:
    """Eight hex digits for each hash; none for a text without phrases."""
    return signature.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text; null counts as empty, which has no phrases."""

    def run(batches):
        import pyarrow as pa

        for part in pieces(batches):
            made = []
            for text in part.column(1).to_pylist():
                parse = Parse()
                parse.read((text or "").encode())
                made.append(written(parse.signature()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), "doc_id long, fingerprint string")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside those of an edited text and of the next document.

    The next document is the one after it in descending order of doc_id, null ids
    last, repeated ids by a hash of their texts; after the last comes the first. The
    edited text has its last third (code points, rounded down) replaced by as many
    code points from the start of the next document, or all it has. The only document
    is its own next; no documents give no rows.

    Documents are dealt out in runs of neighbouring ids and sorted; the first of each
    run also goes to the run before it. Only these first ids reach the driver, one a
    run. A run is read as a stream, two texts at a time, and what an edited text
    shares with its document is parsed once.
    """
    spark = docs.sparkSession
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    fractions = [k / runs for k in range(1, runs)]
    cuts = sorted(set(docs.select("doc_id").approxQuantile("doc_id", fractions, 1 / (8 * runs)) if runs > 1 else []))
    marked = marked.withColumn("run", _place([int(c) for c in cuts], F.col("doc_id")))
    heads = marked.groupBy("run").agg(F.max(F.struct("doc_id", "mark")).alias("head")).orderBy("run").collect()
    copies = _copies([(r["run"], r["head"]["doc_id"], r["head"]["mark"]) for r in heads])
    dealt = marked.select(
        "doc_id", "text", "mark", F.explode(F.concat(F.array(_row(F.col("run"), False)), copies)).alias("to")
    ).select("doc_id", "text", "mark", "to.run", "to.tail")
    ordered = dealt.repartition(runs, "run").sortWithinPartitions(
        "run", "tail", F.desc_nulls_last("doc_id"), F.desc_nulls_last("mark")
    )
    return ordered.select("doc_id", "text", "run", "tail").mapInArrow(
        giving_back(_compare),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _row(run: Column, tail: bool) -> Column:
    return F.struct(run.cast("int").alias("run"), F.lit(tail).alias("tail"))


def _place(cuts: list[int], value: Column) -> Column:
    """How many of the ascending cuts are at or below the value, by halving."""
    if not cuts:
        return F.lit(0)
    levels = len(cuts).bit_length()
    padded = F.array(*[F.lit(c).cast("long") for c in cuts], *[F.lit(None).cast("long")] * ((1 << levels) - 1 - len(cuts)))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(levels))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(padded, at + step - 1) <= value, at + step).otherwise(at)
    )


def _copies(heads: list[tuple]) -> Column:
    """The first document of a run also closes the run above it; the very first closes the lowest."""
    none = F.array().cast("array<struct<run:int,tail:boolean>>")
    if not heads:
        return none
    target = {doc: heads[(k + 1) % len(heads)][0] for k, (_, doc, _) in enumerate(heads)}
    lost = -(1 << 63)
    key = F.coalesce("doc_id", F.lit(lost))
    runs = F.create_map(*[x for doc, run in target.items() for x in (F.lit(lost if doc is None else doc).cast("long"), F.lit(run))])
    marks = [m for _, _, m in heads]
    return F.when(
        key.isin([lost if d is None else d for d in target]) & F.col("mark").isin(marks),
        F.array(_row(runs[key], True)),
    ).otherwise(none)


def _compare(batches):
    import hashlib

    import pyarrow as pa

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def parsed(text):
        """The parse as it stands where the edit begins, that place, and the whole text's signature."""
        parse, keep = Parse(), len(text) - len(text) // 3
        parse.read(text[:keep].encode())
        node, phrases = parse.node, len(parse.log)
        parse.read(text[keep:].encode())
        signature = parse.signature()
        parse.back_to(node, phrases)
        return parse, signature

    def finished(doc, text, parse, signature, after, after_signature):
        third = len(text) // 3
        put = after[:third]
        parse.read(put.encode())
        edited = parse.signature()
        digest = hashlib.sha256((text[: len(text) - third] + put).encode()).hexdigest()
        return (
            doc, len(text), digest, written(signature), written(edited),
            likeness(signature, edited), likeness(signature, after_signature),
        )

    run, last, closed, out = None, None, False, []
    for part in pieces(batches, 64):
        for doc, text, where, tail in zip(*(c.to_pylist() for c in part.columns)):
            if where != run:
                run, last, closed = where, None, False
            if closed:  # a row that repeats the one that closes the run
                continue
            text = text or ""
            now = (doc, text, *parsed(text))
            if last is not None:
                out.append(finished(*last, text, now[3]))
            last, closed = now, tail
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out = []


def op6_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return compare_edits(table(spark, sf, "documents"))


QUERIES = {"op6_phrases": (op6_phrases, None)}
