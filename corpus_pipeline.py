"""A training corpus from ``documents``: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellwatt.llm.common import stored, table
from tellwatt.llm.languages import identify
from tellwatt.llm.mixing import mix_sources
from tellwatt.llm.packing import best_fit_packing
from tellwatt.llm.simhash import near_dedup
from tellwatt.llm.substrings import substring_dedup

STAGES = [
    ("language ID", identify),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: Language ID and near-dedup are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of the corpus, from the documents to the packed sequences.

    Every stage's rows are written and read again, so each is done once and a lost
    executor costs at most one stage's tasks.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
