"""Mixing sources to target weights by Pareto order sampling (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellwatt.llm.common import WORD, documents, stored, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
#: Steps in which a source's ranks are first summed.
STEPS = 4096


def sizes(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key() -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``target`` words for each source of ``source``, ``source_size`` (a row per source).

    Weights go round the sources in code point order, null last. The targets are
    ``share`` of all words, by weight, but none is above ``most`` times its source's
    words. A source fills up at the level of words per weight where it reaches that;
    the sources that fill up before the words run out are found from running sums
    in the order of those levels, and the others share what is left. The window is
    over one row per source.
    """
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights))
    cap = F.col("source_size") * most
    rows = totals.withColumn("weight", weight).withColumn("level", cap / F.col("weight"))
    filling = Window.orderBy("level", F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    words = F.sum("source_size").over(whole) * F.lit(share)
    rows = rows.select(
        "*", words.alias("words"), F.sum(cap).over(filling).alias("filled"),
        (F.sum("weight").over(whole) - F.sum("weight").over(filling)).alias("open"),
    )
    rows = rows.withColumn("full", F.col("filled") + F.col("level") * F.col("open") <= F.col("words"))
    rest = F.col("words") - F.sum(F.when(F.col("full"), cap).otherwise(0)).over(whole)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("full"), cap.cast("double")).otherwise(F.col("weight") * rest / F.nullif(open_, F.lit(0)))
    return rows.withColumn("target", target).drop("weight", "level", "words", "filled", "open", "full")


def mix(sized: DataFrame, seed: int = 2, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """The columns of ``sized``, then ``source_size``, ``target`` and ``copies``.

    ``sized`` has ``doc_id``, ``source`` and ``size``. A source needs some number of
    copies of itself to meet its target. Every document is taken as often as the
    whole part of it says, for certain. The words still missing come from a Pareto
    sample: a document's chance of one more copy is the broken part, half of it alike
    for all and half in proportion to its size, and at most 1, which is certain too;
    documents are ranked by the odds of a random number over the odds of that chance,
    and the sample runs up the ranks to where its words come nearest the target. So
    a source misses its target by half a document at most.

    Random numbers are hashes of the doc_id (of the text, where that is null), so
    reruns agree. Rows that repeat one document have its rank and are all taken or
    all left. Sizes of zero, null sources and empty tables are fine; a source
    without words has target zero.

    No source is sorted as a whole: words are summed by source and step of the rank,
    the step that the sample ends in is found from those sums, and only its rows, one
    in ``STEPS``, are ordered.
    """
    keyed = sized.withColumn("key_", _key())
    drawn = stored(keyed.select("key_", "source", "doc_id", "size", "random_"))
    square = (F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")).cast("decimal(38,0)")
    totals = drawn.groupBy("key_", "source").agg(
        F.sum("size").alias("source_size"), F.sum(square).cast("double").alias("square")
    )
    per = stored(
        targets(totals, weights, share, most)
        .withColumn("needed", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
        .withColumn("certain", F.floor("needed"))
        .withColumn("part", F.col("needed") - F.col("certain"))
        .withColumn("missing", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("typical", F.coalesce(F.try_divide("square", "source_size"), F.lit(1.0)))
        .drop("source", "square", "needed")
    )
    ranked = _ranked(drawn, per).where("part > 0")
    order = ["rank_", "doc_id", "size"]
    steps = ranked.groupBy("key_", "step").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    upto = F.sum("words").over(Window.partitionBy("key_").orderBy("step"))
    ends = stored(
        steps.withColumn("before", upto - F.col("words"))
        .where((F.col("before") < F.col("missing")) & (F.col("before") + F.col("words") >= F.col("missing")))
        .select("key_", F.col("step").alias("end"), "before")
    )
    inside = ranked.join(ends, "key_").where("step = end")
    running = Window.partitionBy("key_").orderBy(*order)
    middle = F.col("before") + F.sum("size").over(running) - F.col("size") / 2
    last = (
        inside.withColumn("middle", middle).where("middle <= missing")
        .groupBy("key_").agg(F.max(F.struct(*order)).alias("last"))
    )
    limits = stored(per.join(ends, "key_", "left").join(last, "key_", "left"))
    step = F.col("step")
    extra = (
        F.when((F.col("part") <= 0) | (F.col("missing") <= 0), 0)
        .when(F.col("end").isNull(), 1)
        .when(step < F.col("end"), 1)
        .when((step == F.col("end")) & (F.struct(*order) <= F.col("last")), 1)
        .otherwise(0)
    )
    return _ranked(keyed, limits).select(
        *[F.col(f"`{c}`") for c in sized.columns if c != "random_"], "source_size", "target", (F.col("certain") + extra).alias("copies")
    )


def _ranked(rows: DataFrame, per: DataFrame) -> DataFrame:
    joined = rows.join(per, "key_")
    chance = F.least(F.lit(1.0), F.col("part") * (F.lit(0.5) + F.col("size") / F.col("typical") * 0.5))
    odds = F.col("random_") / (1 - F.col("random_"))
    rank = F.coalesce(F.try_divide(odds * (1 - chance), chance), F.lit(0.0))
    return joined.withColumn("rank_", rank).withColumn("step", F.floor(F.col("rank_") / (1 + F.col("rank_")) * STEPS))


def random(seed: int = 2) -> Column:
    """A number between 0 and 1 for a document, from 52 bits of a hash."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    sized = stored(docs.select("doc_id", "source", sizes().alias("size"), random().alias("random_")))
    return mix(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Pipeline stage: documents as often as the mix takes them; those taken no time go."""
    mixed = mix(documents(docs).withColumn("size", sizes()).withColumn("random_", random()))
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return documents(mixed.withColumn("copy", copies))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('2:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(CAST(size AS HUGEINT) * size) AS DOUBLE) AS square
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM totals),
leveled AS (
  SELECT *, (source_size * 2)::DOUBLE / weight AS level, sum(source_size) OVER () * 1.5::DOUBLE AS words FROM weighed),
filled AS (
  SELECT *, sum(source_size * 2) OVER (ORDER BY level, source NULLS LAST) AS filled,
    sum(weight) OVER () - sum(weight) OVER (ORDER BY level, source NULLS LAST) AS open FROM leveled),
judged AS (SELECT *, filled::DOUBLE + level * open <= words AS full_ FROM filled),
targets AS (
  SELECT source, source_size, square,
    CASE WHEN full_ THEN (source_size * 2)::DOUBLE
    ELSE weight * (words - sum(CASE WHEN full_ THEN source_size * 2 ELSE 0 END) OVER ())
      / nullif(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER (), 0)::DOUBLE END AS target FROM judged),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS needed,
    CASE WHEN source_size > 0 THEN square / source_size ELSE 1 END AS typical FROM targets),
per AS (
  SELECT *, floor(needed) AS certain, needed - floor(needed) AS part,
    target - floor(needed) * source_size AS missing FROM needs),
chances AS (
  SELECT s.*, source_size, target, certain, part, missing,
    least(1, part * (0.5::DOUBLE + s.size / typical * 0.5::DOUBLE)) AS chance
  FROM sized s JOIN per p ON s.source IS NOT DISTINCT FROM p.source),
ranked AS (
  SELECT *, CASE WHEN chance > 0 THEN u / (1 - u) * (1 - chance) / chance ELSE 0 END AS rank_ FROM chances),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank_, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM ranked)
SELECT doc_id, size, source_size, target,
  CAST(size * (certain + CASE WHEN part > 0 AND middle <= missing THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""

QUERIES = {"op2_mixing": (op2_mixing, SQL)}
