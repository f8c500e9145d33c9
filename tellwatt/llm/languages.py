"""Language identification by string kernels (operator 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import documents, giving_back, pieces, stored, table

#: Presence of n-grams of these lengths, in so many hashed places.
LENGTHS = (1, 2, 3, 4)
PLACES = 1 << 15
#: Texts a language gives to the fit at most, and how many of them become landmarks.
SAMPLE = 600
LANDMARKS = 64
RIDGE = 1e-3
#: A language's smallest hashes are found in so many parts first; so many rows at most are broadcast.
PARTS = 16
BROADCAST_ROWS = 1 << 20
UNKNOWN = "und"


def _letters():
    """For every code point, its letter in lower case, or a space: 4 MB."""
    import numpy as np

    def letter(code: int) -> int:
        if 0xD800 <= code < 0xE000 or not chr(code).isalpha():
            return 32
        low = chr(code).lower()
        return ord(low) if len(low) == 1 else code

    return np.fromiter(map(letter, range(0x110000)), np.uint32, 0x110000)


def _reader(lower):
    """A function from a text to the sorted places of its n-grams; None without a letter.

    Letters are lower-cased, and whatever else lies between them is one space.
    """
    import numpy as np

    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - PLACES.bit_length() + 1)

    def read(text):
        if not text:
            return None
        codes = lower[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
        blank = codes == 32
        if blank.all():
            return None
        codes = codes[np.r_[True, ~(blank[1:] & blank[:-1])]]
        codes = np.r_[np.uint64(32), codes, np.uint64(32)] if len(codes) else codes
        present = np.zeros(PLACES, bool)
        gram = np.zeros(len(codes), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            gram = gram[: len(codes) - n + 1] * np.uint64(0x110003) + codes[n - 1:]
            if n in LENGTHS and len(gram):
                mixed = (gram ^ np.uint64(n)) * factor
                present[((mixed ^ (mixed >> np.uint64(31))) * factor) >> shift] = True
        return np.flatnonzero(present)

    return read


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """One-versus-rest kernel ridge regression over Nystroem landmarks.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; rows without any of them, or
    without a letter, teach nothing. The kernel of two texts is the number of n-grams
    present in both, over the geometric mean of how many each has; n-grams are hashed to
    ``PLACES`` places. Of each language's different texts the ``sample`` with the smallest
    hashes are taken, or all, and the first of these are landmarks. Only the presence
    of their n-grams (4 KB a text) comes to the driver, ``sample`` texts a language at
    most, however often a text is repeated. Without rows the model knows no language.
    """
    import numpy as np

    labelled = docs.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    drawn = labelled.select("lang", "h").distinct().withColumn("part", F.pmod("h", F.lit(PARTS)))
    # First in parts, so that a language with most of the texts doesn't come to one task.
    for group in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("h"))
        drawn = drawn.withColumn("place", place).where(F.col("place") <= sample).drop("place")
    drawn = stored(drawn.drop("part"))
    once = labelled.join(F.broadcast(drawn) if drawn.count() <= BROADCAST_ROWS else drawn, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    letters = docs.sparkSession.sparkContext.broadcast(_letters())
    held = once.mapInArrow(_presence(letters), "lang string, h long, grams binary").collect()
    rows = [(lang, bytes(grams)) for lang, _, grams in sorted(held)]
    known = sorted({lang for lang, _ in rows})
    if not known:
        return {"languages": [], "weights": np.zeros((PLACES, 0), np.float32)}

    def presence(some) -> np.ndarray:
        seen = np.unpackbits(np.stack([np.frombuffer(rows[k][1], np.uint8) for k in some]), axis=1).astype(np.float32)
        return seen / np.sqrt(seen.sum(1, keepdims=True))

    names = np.array([known.index(lang) for lang, _ in rows])
    chosen = np.concatenate([np.flatnonzero(names == k)[:landmarks] for k in range(len(known))])
    marks = presence(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    places = np.array_split(np.arange(len(rows)), max(1, len(rows) // 128))
    mapped = np.concatenate([presence(some) @ marks.T for some in places]) @ root
    targets = np.where(names[:, None] == np.arange(len(known)), 1.0, -1.0)
    # Every language weighs the same, however many rows it gave.
    weight = 1 / np.bincount(names)[names][:, None]
    beta = np.linalg.solve(mapped.T @ (mapped * weight) + ridge * np.eye(mapped.shape[1]), mapped.T @ (targets * weight))
    # Kernels with the landmarks, mapped and weighed, are one product with the grams.
    return {"languages": known, "weights": (marks.T @ (root @ beta)).astype(np.float32)}


def _presence(letters):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        read = _reader(letters.value)
        for part in pieces(batches):
            rows = []
            for name, h, text in zip(*(c.to_pylist() for c in part.columns)):
                if (found := read(text)) is not None:
                    bits = np.zeros(PLACES, bool)
                    bits[found] = True
                    rows.append((name, h, np.packbits(bits).tobytes()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))], ["lang", "h", "grams"]
            )

    return giving_back(run)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of ``docs``, then ``lang_pred`` and ``score``; only ``text`` is looked at.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    under a model that knows no language. The score is the softmax of the languages'
    regressions, four times enlarged. Whole texts count, whatever their length.
    """
    names = [f"`{n}` {t}" for n, t in docs.dtypes]
    shared = docs.sparkSession.sparkContext.broadcast((_letters(), model["languages"], model["weights"]))
    return docs.mapInArrow(
        _predict(docs.columns.index("text"), shared), ", ".join([*names, "lang_pred string", "score double"])
    )


def _predict(at: int, shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        lower, languages, weights = shared.value
        read = _reader(lower)
        for part in pieces(batches, 64):
            found = [read(t) for t in part.column(at).to_pylist()]
            known = [k for k, f in enumerate(found) if f is not None and languages]
            lang, score = [UNKNOWN] * len(found), np.zeros(len(found))
            if known:
                grams = np.zeros((len(known), PLACES), np.float32)
                for row, k in enumerate(known):
                    grams[row, found[k]] = 1 / np.sqrt(len(found[k]))
                raw = 4 * (grams @ weights).astype(np.float64)
                likely = np.exp(raw - raw.max(1, keepdims=True))
                likely /= likely.sum(1, keepdims=True)
                for row, k in enumerate(known):
                    best = int(likely[row].argmax())
                    lang[k], score[k] = languages[best], likely[row, best]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lang, pa.string()), pa.array(score)], [*part.schema.names, "lang_pred", "score"]
            )

    return giving_back(run)


def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def op10_languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit(docs.where(fold() != 2))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def identify(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Pipeline stage: documents in no known language go; missing ``lang`` values are filled in."""
    known = documents(docs)
    told = predict(known, fit(known.where(fold() != 2))).where(F.col("lang_pred") != UNKNOWN)
    return documents(told.withColumn("lang", F.coalesce("lang", "lang_pred")))


QUERIES = {"op10_languages": (op10_languages, None)}
