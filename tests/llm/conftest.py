import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import awkward  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """A driver folder with the awkward documents."""
    folder = str(tmp_path_factory.mktemp("odd"))
    return awkward.saved(spark, folder, documents=awkward.documents(spark).coalesce(3))


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    """A driver folder without documents."""
    return awkward.saved(spark, str(tmp_path_factory.mktemp("none")), documents=awkward.empty(spark))


@pytest.fixture(scope="session")
def rows(spark, odd):
    return [tuple(r) for r in spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()]
