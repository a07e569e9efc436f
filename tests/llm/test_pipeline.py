import subprocess
import sys

import pytest

import corpus_pipeline
from feedloom.llm import queries
from feedloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_one_another(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    kept = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if number < 4:
            assert out.columns == COLUMNS and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(set(r.doc_id for r in docs.select("doc_id").collect()))
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] == kept[4]
    assert len(kept[0]) < 200 and len(kept[3]) < len(kept[0]) and len(kept[3]) > 100


def test_stages_take_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_every_number_has_one_query():
    names = [n.split("_")[0] for n in queries.queries()]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same(spark, name):
    import os
    import sys as s
    s.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from check import connect, rows_of

    df = queries.queries()[name](spark, FOLDER)
    cur = connect(FOLDER).execute(queries.oracle_sql()[name])
    got = rows_of(df.columns, df.collect())
    assert got == rows_of([c[0] for c in cur.description], cur.fetchall()) and got[1]


def test_nothing_else_imports_the_subpackage():
    code = "import feedloom.catalogue, feedloom.streaming.landing, sys; sys.exit(any(m.startswith('feedloom.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=corpus_pipeline.__file__.rpartition("/")[0]).returncode == 0
