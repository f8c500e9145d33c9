"""Hard negatives by slots of scores (operator 13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import giving_back, pieces, stored, table

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT = 30
HIGH_PERCENT = 90
#: Each component's number of steps a unit.
STEPS = 256
#: Components of the vectors that a task holds at a time, on average: 32 MB.
BLOCK_NUMBERS = 1 << 22
#: Scores that a task holds at a time.
UNIT = 1 << 21


def prepared(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """``vec_id``, ``label``, ``dims`` and ``vector``, the components as whole numbers of ``1 / steps``.

    Rows with a null vec_id, label or vector, or with a null or non-finite component,
    take no part. Rows that share a vec_id count once, as the one that is least by
    label, then by length, then by bytes.
    """
    whole = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").select(
        "vec_id", F.col("label").cast("int").alias("label"), "embedding"
    )
    least = F.min(F.struct("label", "dims", "vector")).alias("row")
    numbers = whole.mapInArrow(_whole_numbers(steps), "vec_id long, label int, dims int, vector binary")
    return numbers.groupBy("vec_id").agg(least).select("vec_id", "row.*")


def _whole_numbers(steps: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in pieces(batches, 4096):
            rows = []
            for id_, label, vector in zip(*(c.to_pylist() for c in part.columns)):
                values = np.array(vector, np.float64)  # a null becomes NaN
                if not np.isfinite(values).all():
                    continue
                values = np.floor(steps * values)
                # Two bytes a number where all fit, or else eight.
                small = not len(values) or np.abs(values).max() < 1 << 15
                rows.append((id_, label, len(values), values.astype("<i2" if small else "<f8").tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            types = pa.int64(), pa.int32(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["vec_id", "label", "dims", "vector"]
            )

    return giving_back(run)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW_PERCENT,
    high: int = HIGH_PERCENT,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vectors`` is what ``prepared`` gives, stored; ``anchors`` tells which of its rows
    ask. A score is the inner product with the anchor's numbers, exact; higher ones
    come first, ties by smaller vec_id. Only rows of the anchor's length meet it. An
    anchor's positives are its first other rows of its label. Negatives have another
    label and a score between ``low`` and ``high`` percent of the positive's; the
    first few of these are given for each positive, ranked from one. Anchors without
    positives, positives below zero and windows without rows give none; empty tables
    give none. Scores beyond 64 bits fail the job.

    The windows of an anchor's positives overlap, but their upper ends cut the scores
    into slots that don't. One pass keeps the first few of each slot, in each task and
    then in all. A window's first rows are those of its own slot and the lower ones in
    order, so merging slots downwards answers every window from at most
    ``positives * negatives`` rows an anchor.

    Vectors are dealt into blocks by their ids; each is sent once, the anchors to each
    block. A task holds one block and takes anchors as they come by.
    """
    spark = vectors.sparkSession
    numbers = vectors.agg(F.sum("dims")).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-numbers // BLOCK_NUMBERS))
    asking = vectors.where(anchors).withColumn("limits", F.array().cast("array<long>"))
    first = stored(_first(_met(vectors, asking, blocks, positives, _like), positives, "anchor_id"))
    # In parts of a hundred, as products of scores may pass 64 bits.
    bounded = first.where("score >= 0").withColumns({
        "upper": F.expr(f"{high} * (score div 100) + ({high} * (score % 100)) div 100"),
        "lower": F.expr(f"{low} * (score div 100) + ({low} * (score % 100) + 99) div 100"),
    })
    # Few positives an anchor, so few limits: slots lie between each and the next.
    windows = bounded.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("upper", "lower", F.col("vec_id").alias("id"), "score")).alias("windows"),
        F.concat(F.sort_array(F.collect_set("upper"), asc=False), F.array(F.min("lower") - 1)).alias("limits"),
    )
    limited = stored(asking.drop("limits").join(windows, "vec_id"))
    slots = _first(_met(vectors, limited.drop("windows"), blocks, negatives, _unlike), negatives, "anchor_id", "slot")
    # By score, then vec_id; slots descend with the scores.
    found = F.sort_array(F.collect_list(F.struct("score", F.bitwise_not("vec_id").alias("not_id"), "slot")), asc=False)
    merged = slots.groupBy("anchor_id").agg(found.alias("found"))
    asked = limited.select(F.col("vec_id").alias("anchor_id"), "limits", F.explode("windows").alias("w"))
    each = merged.join(asked, "anchor_id")
    slot = F.array_position("limits", F.col("w.upper")) - 1
    suffix = F.slice(F.filter("found", lambda x: x["slot"] >= slot), 1, negatives)
    taken = F.filter(suffix, lambda x: x["score"] >= F.col("w.lower"))
    return each.select("anchor_id", "w", F.posexplode(taken).alias("place", "n")).select(
        "anchor_id",
        F.col("w.id").alias("positive_id"),
        (F.col("place") + 1).alias("rank"),
        F.bitwise_not("n.not_id").alias("negative_id"),
        F.col("w.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )


def _first(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """The first rows by score of each group; a task passes on no more than these of what it has."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def _met(vectors: DataFrame, asking: DataFrame, blocks: int, most: int, choose) -> DataFrame:
    """What ``choose`` keeps of each block's rows for each anchor: ``anchor_id``, ``slot``, ``vec_id``, ``score``."""
    held = vectors.withColumn("limits", F.lit(None).cast("array<long>")).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    )
    sent = asking.select(*vectors.columns, "limits", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    order = F.col("limits").isNotNull().alias("asks")
    both = held.unionByName(sent).select("block", order, "vec_id", "label", "dims", "vector", "limits")
    return (
        both.repartition(blocks, "block").sortWithinPartitions("block", "asks", "vec_id")
        .mapInArrow(_compared(most, choose), "anchor_id long, slot int, vec_id long, score long")
    )


def _compared(most: int, choose):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def numbers(rows):
            """A matrix of vectors of one length."""
            made = np.empty((len(rows), rows[0][3]), np.float64)
            for k, (*_, dims, data, _) in enumerate(rows):
                made[k] = np.frombuffer(data, "<i2" if len(data) == 2 * dims else "<f8")
            return made

        def products(asked, held):
            most_ = np.abs(asked).max(initial=0) * np.abs(held).max(initial=0) * held.shape[1]
            if most_ < 1 << 53:  # all sums are whole numbers that a double holds
                return asked @ held.T
            whole = np.frompyfunc(int, 1, 1)
            return whole(asked) @ whole(held).T

        def block_of(rows):
            """Vectors by length: ids, labels, matrix."""
            by = {}
            for row in rows:
                by.setdefault(row[3], []).append(row)
            return {
                dims: (np.array([r[1] for r in of]), np.array([r[2] for r in of]), numbers(of)) for dims, of in by.items()
            }

        def answers(block, waiting):
            out = []
            by = {}
            for row in waiting:
                by.setdefault((row[3], row[2]), []).append(row)  # by length and label
            for (dims, label), rows in by.items():
                if dims not in block:
                    continue
                ids, labels, held = block[dims]
                at = np.flatnonzero(labels == label) if choose is _like else np.arange(len(ids))
                ids, labels, held = ids[at], labels[at], held[at] if choose is _like else held
                step = max(1, UNIT // max(1, len(ids)))
                for start in range(0, len(rows), step):
                    some = rows[start:start + step]
                    for row, scores in zip(some, products(numbers(some), held)):
                        for slot, places in choose(scores, ids, labels, row, most):
                            out += [(row[1], slot, int(ids[p]), int(scores[p])) for p in places]
            columns = list(zip(*out)) or [()] * 4
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["anchor_id", "slot", "vec_id", "score"]
            )

        now, rows, block = None, [], {}
        for part in pieces(batches, 1024):
            waiting = []
            for row in zip(part.column(0).to_pylist(), *(part.column(k).to_pylist() for k in range(2, 7))):
                if row[0] != now:
                    if waiting:
                        yield answers(block, waiting)
                    now, rows, block, waiting = row[0], [], None, []
                if row[5] is None:
                    rows.append(row)
                else:
                    if block is None:
                        block, rows = block_of(rows), []
                    waiting.append(row)
            if waiting:
                yield answers(block, waiting)

    return giving_back(run)


def _best(scores, ids, at, most: int):
    """The first places of ``at`` by score, then by id."""
    import numpy as np

    if len(at) > most:
        mine = scores[at]
        last = np.partition(mine, len(at) - most)[len(at) - most]
        sure, tied = at[mine > last], at[mine == last]
        at = np.concatenate([sure, tied[np.argsort(ids[tied], kind="stable")[: most - len(sure)]]])
    return at


def _like(scores, ids, labels, row, most: int):
    """The best others of rows that all have the anchor's label."""
    import numpy as np

    yield 0, _best(scores, ids, np.flatnonzero(ids != row[1]), most)


def _unlike(scores, ids, labels, row, most: int):
    """The best of each slot among rows of other labels."""
    import numpy as np

    limits = row[5]
    at = np.flatnonzero((labels != row[2]) & (scores <= limits[0]) & (scores > limits[-1]))
    for slot, (above, below) in enumerate(zip(limits, limits[1:])):
        yield slot, _best(scores, ids, at[(scores[at] <= above) & (scores[at] > below)], most)


def op13_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = stored(prepared(rows.withColumn("label", moved)))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT a, b AS p, score AS ps FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT a AS anchor_id, p AS positive_id, CAST(place AS INTEGER) AS rank, b AS negative_id,
  ps AS positive_score, score AS negative_score
FROM (
  SELECT p.a, p.p, p.ps, n.b, n.score, row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.b) AS place
  FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.alike AND 30 * ps <= 100 * n.score AND 100 * n.score <= 90 * ps)
WHERE place <= 10
"""

QUERIES = {"op13_negatives": (op13_negatives, SQL)}
