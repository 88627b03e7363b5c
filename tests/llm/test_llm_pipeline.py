import random

import pytest
from rows import ODD, documents, words

import __spark_entry__ as registered
import corpus_pipeline
from trackside.llm import queries, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(registered.__file__), "tools"))
    import check

    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, con, name):
    import check

    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rng = random.Random(1)
    docs = documents(spark, [*ODD, *[(100 + k, " ".join(words(rng, 30)), "en", "a") for k in range(30)]])
    for some in (docs, documents(spark, [])):
        got = stage(spark, some, SF)
        assert got.schema.simpleString() == some.schema.simpleString()
        got.collect()


def test_stages_decide(spark):
    rng = random.Random(2)
    base = words(rng, 80)
    rows = [(1, " ".join(base)), (2, "  ".join(base)), (3, " ".join(base[:-1] + ["end"])), (4, "other " * 3), (5, None), (6, ""), (7, " ".join(words(rng, 80)))]
    docs = documents(spark, rows + [rows[0], (None, " ".join(base)), (None, "lonely text here"), (None, "lonely text here")])
    kept = stages.distinct(spark, docs, SF)
    assert sorted((r.doc_id or 0, (r.text or "")[:6]) for r in kept.collect()) == sorted([(0, "lonely"), (2, rows[1][1][:6]), (3, rows[2][1][:6]), (4, "other "), (5, ""), (7, rows[6][1][:6])])
    kept = stages.dissimilar(spark, kept, SF)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 5, 7]
    mixed = stages.mix(spark, kept, SF).collect()
    assert {r.doc_id for r in mixed} <= {None, 2, 4, 5, 7} and len(mixed) >= 3


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, SF)
    rows = got.collect()
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and {r.doc_id for r in rows} <= set(whole)
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert sum(fill.values()) > 0.9 * 1024 * (len(fill) - 8)
