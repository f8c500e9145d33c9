"""All queries of this subpackage: name to query and SQL, or None where SQL can't express it."""

import corpus_pipeline
from tellwatt.llm import (
    chats,
    collocations,
    languages,
    licences,
    mixing,
    negatives,
    neighbours,
    packing,
    pages,
    phrases,
    scores,
    simhash,
    substrings,
)

QUERIES = {
    **simhash.QUERIES,
    **mixing.QUERIES,
    **chats.QUERIES,
    **substrings.QUERIES,
    **neighbours.QUERIES,
    **phrases.QUERIES,
    **packing.QUERIES,
    **pages.QUERIES,
    **licences.QUERIES,
    **languages.QUERIES,
    **collocations.QUERIES,
    **scores.QUERIES,
    **negatives.QUERIES,
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
