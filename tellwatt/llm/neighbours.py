"""Nearest neighbours by stable projections and a kd-tree (operator 5)."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import stored, table

DIMENSIONS = 8
#: Chance that a true neighbour passes the stopping test.
CONFIDENCE = 0.98
#: Rows the tree is fitted on, rows of a leaf, and of a part of a leaf.
SAMPLE = 20_000
LEAF_ROWS = 1024
PART_ROWS = 2048
MOST_LEAVES = 4096
#: Queries that meet a part of a leaf in one group.
QUERY_BLOCK = 4096
#: What rounding may do to a projection, so that equal vectors are at distance zero.
SLACK = 1e-9
FOUND = "query_id long, vec_id long, score double"


def chi_square_limit(dimensions: int, confidence: float) -> float:
    """Where the chi-square distribution function of an even number of degrees reaches ``confidence``."""

    def below(x: float) -> float:
        term = total = 1.0
        for k in range(1, dimensions // 2):
            term *= x / 2 / k
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < confidence else (low, middle)
    return high


@dataclass
class Tree:
    """A kd-tree over projections: each inner node splits one axis; leaves have boxes."""

    axis: list
    value: list
    child: list  # of inner nodes: the two nodes below; negative: leaf -1 - n
    low: object
    high: object

    def leaves(self, points):
        import numpy as np

        node = np.zeros(len(points), np.int64) if self.axis else np.full(len(points), -1)
        axis, value, child = np.array(self.axis, int), np.array(self.value), np.array(self.child, int).reshape(-1, 2)
        while (open_ := np.flatnonzero(node >= 0)).size:
            at = node[open_]
            right = points[open_, axis[at]] > value[at]
            node[open_] = child[at, right.astype(int)]
        return -1 - node

    def distances(self, points):
        """From each point to each leaf's box."""
        import numpy as np

        total = np.zeros((len(points), len(self.low)))
        for k in range(points.shape[1]):
            gap = np.maximum(self.low[:, k] - points[:, k:k + 1], points[:, k:k + 1] - self.high[:, k])
            total += np.maximum(gap, 0) ** 2
        return np.sqrt(total)


def grown(points, leaves: int) -> Tree:
    """Halves the widest axis at its median until there are so many leaves or a leaf has one point."""
    import numpy as np

    dims = points.shape[1]
    tree = Tree([], [], [], [], [])
    boxes = []

    def split(at, low, high, parts: int) -> int:
        sample = points[at]
        spread = np.ptp(sample, axis=0) if len(at) else np.zeros(dims)
        k = int(spread.argmax())
        if parts < 2 or not spread[k] > 0:
            boxes.append((low, high))
            return -len(boxes)
        value = float(np.median(sample[:, k]))
        if not (sample[:, k] > value).any():  # more than half at the top
            value = float(sample[sample[:, k] < value, k].max())
        node = len(tree.axis)
        tree.axis.append(k)
        tree.value.append(value)
        tree.child.append([0, 0])
        for side in (0, 1):
            below, above = low.copy(), high.copy()
            (above if side == 0 else below)[k] = value
            chosen = at[(sample[:, k] > value) == bool(side)]
            tree.child[node][side] = split(chosen, below, above, parts // 2 + (parts % 2 and side))
        return node

    split(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf), leaves)
    tree.low, tree.high = (np.array(side) for side in zip(*boxes))
    return tree


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part.

    Rows without an id and vectors that are null, zero or hold a null or non-finite
    component take none, nor do those of another length than most have.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, confidence: float = CONFIDENCE, seed: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: each query's nearest vectors, Euclidean.

    ``vectors`` and ``queries`` are as from :func:`usable`. Vectors are projected on a
    few axes with normal random coefficients, so a squared projected distance over the
    squared true one is chi-square distributed. A kd-tree over projections, fitted on
    ``SAMPLE`` rows at most, puts every vector in a leaf. A query first searches a part
    of its own leaf; the k-th distance found there and the chi-square limit bound how
    far a nearer vector's projection can be but for a chance of ``1 - confidence``. It
    then visits all leaves within that bound. In every leaf it goes through vectors by
    projected distance, verifies them on the originals and stops where the test holds
    for its k-th distance so far.

    A query's own id is no candidate; ties go to the smaller id; an id in several rows
    counts once, at its nearest. Fewer candidates than ``k`` are all returned. Leaves
    with many rows, such as equal vectors, are dealt out in parts, and queries in
    blocks. No vectors or queries give no rows.
    """
    import numpy as np

    spark = vectors.sparkSession
    first = vectors.first()
    if first is None or queries.first() is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    axes = np.random.default_rng(seed).standard_normal((len(first["vector"]), DIMENSIONS))
    n = vectors.count()
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "vec_id"), 11) / float(1 << 53)
    sample = vectors.where(share < 0.9 * SAMPLE / n).limit(SAMPLE).select("vector").collect()
    points = np.array([r["vector"] for r in sample], float).reshape(-1, len(axes)) @ axes
    tree = grown(points, min(MOST_LEAVES, max(1, n // LEAF_ROWS), max(1, len(points) // 4)))
    shared = spark.sparkContext.broadcast((axes, tree, chi_square_limit(DIMENSIONS, confidence) ** 0.5))

    index = stored(vectors.mapInPandas(_placed(shared), "vec_id long, vector array<double>, leaf int"))
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # a row a leaf
    parts = [-(-sizes.get(leaf, 0) // PART_ROWS) for leaf in range(len(tree.low))]
    number = F.get(F.array(*[F.lit(max(1, p)) for p in parts]), F.col("leaf"))
    index = index.withColumn("part", F.pmod(F.xxhash64("vec_id"), number).cast("int"))
    asked = stored(queries.select(F.col("vec_id").alias("query_id"), "vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))

    keys = ["leaf", "part", "block"]
    visit = "query_id long, vector array<double>, block int, bound double, leaf int, part int"
    home = asked.withColumn("bound", F.lit(float("inf"))).mapInPandas(_visits(shared, parts, True), visit)
    meet = _search(shared, k)
    begun = stored(index.groupBy(*keys).cogroup(home.groupBy(*keys)).applyInPandas(meet, FOUND))
    kth = begun.groupBy("query_id").agg(F.count("*").alias("n"), F.max("score").alias("bound")).where(f"n >= {k}").drop("n")
    bounded = asked.join(kth, "query_id", "left").select(
        "query_id", "vector", "block", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
    )
    rest = bounded.mapInPandas(_visits(shared, parts, False), visit)
    more = index.groupBy(*keys).cogroup(rest.groupBy(*keys)).applyInPandas(meet, FOUND)
    once = begun.union(more).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _placed(shared):
    def run(frames):
        import numpy as np

        axes, tree, _ = shared.value
        for frame in frames:
            if len(frame):
                frame["leaf"] = tree.leaves(np.stack(frame["vector"].to_numpy()) @ axes).astype(np.int32)
                yield frame[["vec_id", "vector", "leaf"]]

    return run


def _visits(shared, parts: list[int], home: bool):
    """The parts of leaves that a query goes to: one of its own leaf, then all others in reach."""

    def run(frames):
        import numpy as np
        import pandas as pd

        axes, tree, limit = shared.value
        number = np.array(parts)
        for frame in frames:
            for at in range(0, len(frame), 256):
                some = frame.iloc[at:at + 256]
                points = np.stack(some["vector"].to_numpy()) @ axes
                own = tree.leaves(points)
                if home:
                    row, leaf = np.arange(len(some)), own
                else:
                    reach = some["bound"].to_numpy() * limit + SLACK * np.abs(points).max(1)
                    row, leaf = np.nonzero(tree.distances(points) <= reach[:, None])
                times = np.full(len(row), 1) if home else number[leaf]
                row, leaf = np.repeat(row, times), np.repeat(leaf, times)
                part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                seen = (part == 0) & (leaf == own[row]) & (not home)
                row, leaf, part = row[~seen], leaf[~seen], part[~seen]
                made = some.iloc[row][["query_id", "vector", "block", "bound"]]
                yield pd.DataFrame({**{c: made[c].to_numpy() for c in made}, "leaf": leaf, "part": part})

    return run


def _search(shared, k: int):
    def run(rows, queries):
        import numpy as np
        import pandas as pd

        found = []
        if len(rows) and len(queries):
            axes, _, limit = shared.value
            vectors, ids = np.stack(rows["vector"].to_numpy()), rows["vec_id"].to_numpy()
            places = vectors @ axes
            for query, vector, bound in zip(queries["query_id"], queries["vector"], queries["bound"]):
                point = vector @ axes
                away = np.sqrt(((places - point) ** 2).sum(1)) - SLACK * np.abs(point).max()
                order = np.argsort(away)
                best: dict[int, float] = {}
                at, step = 0, 64
                while at < len(order) and away[order[at]] <= bound * limit:
                    some = order[at:at + step]
                    at, step = at + step, 256
                    true = np.sqrt(((vectors[some] - vector) ** 2).sum(1))
                    for score, vec in zip(true.tolist(), ids[some].tolist()):
                        if vec != query and score <= bound and score < best.get(vec, np.inf):
                            best[vec] = score
                    if len(best) >= k:
                        best = dict(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k])
                        bound = min(bound, max(best.values()))
                found += [(query, vec, score) for vec, score in best.items()]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return run


def op5_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = usable(table(spark, sf, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {"op5_neighbours": (op5_neighbours, None)}
