import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from compare import both, connect
from tellwatt.llm.registered import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_registered():
    assert set(QUERIES) <= set(registered.queries())
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline"}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 14


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in QUERIES.items() if sql))
def test_same_rows_as_sql(spark, name):
    query, sql = QUERIES[name]
    ours, theirs = both(spark, connect(SF), SF, query, sql)
    assert ours == theirs and sum(ours[1].values()) > 0


@pytest.mark.parametrize("folder", ["odd", "none"])
def test_stages_hand_on_documents(spark, request, folder):
    folder = request.getfixturevalue(folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(map(str, corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect())) == sorted(
        str(r.__class__(**{k: v for k, v in r.asDict().items() if k not in ("sequence_id", "offset")})) for r in placed
    )


def test_library_does_without_these_parts(tmp_path):
    for name in ("tellwatt", "__spark_entry__.py"):
        source = ROOT / name
        target = tmp_path / name
        if source.is_file():
            target.write_text(source.read_text())
        else:
            for path in source.rglob("*.py"):
                if "llm" not in path.parts:
                    copy = tmp_path / path.relative_to(ROOT)
                    copy.parent.mkdir(parents=True, exist_ok=True)
                    copy.write_text(path.read_text())
    code = "import __spark_entry__ as e; assert len(e.queries()) > 60 and not any(q.startswith('op') for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)
