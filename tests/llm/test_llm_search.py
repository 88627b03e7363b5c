import numpy as np
import pytest

from trackside.llm.knn import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, cell int, part string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, 2, "p") for i, e in rows], SCHEMA).repartition(3)


def brute(rows, k, every):
    usable = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for q, a in usable:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d))
    rows = [(int(i), (centres[i % 4] + 0.3 * rng.normal(size=d)).astype(float).tolist()) for i in range(n)]
    return rows + [(int(n + i), rows[2][1]) for i in range(n // 2)]  # a third are equal


@pytest.mark.parametrize("sizes", [dict(), dict(cells=6, block_rows=3, part_rows=25), dict(cells=1, block_rows=1, part_rows=1000)])
def test_against_all_pairs(spark, sizes):
    rows = vectors(1, 120, 5) + [(1000, None), (1001, [None, 1.0]), (1002, [float("nan")] * 5), (1100, [float("inf")] * 5), (None, [1.0] * 5), (1200, []), (1201, [1.0, 2.0])]
    got = top_k(table(spark, rows), k=4, every=10, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 10)


@pytest.mark.parametrize("sizes", [dict(cells=200), dict(cells=6, block_rows=3, part_rows=25)])
def test_queries_that_repeat_more_than_k_times(spark, sizes):
    """Rows of a query's own vec_id are no candidates: bounds may not rest on them."""
    rng = np.random.default_rng(3)
    rows = [(i, (10 * rng.normal(size=4)).tolist()) for i in range(1, 60) if i % 10]
    rows += [(q, (10 * rng.normal(size=4)).tolist()) for q in (10, 20)] * 12
    rows += [(7, rows[3][1])] * 9 + [(30, rows[3][1])]  # a candidate that repeats, with a query at its place
    got = sorted(map(tuple, top_k(table(spark, rows), k=4, every=10, **sizes).collect()))
    asked = {}
    for row in brute(rows, 4, 10):
        asked[row[:2]] = row  # they ask once
    assert got == sorted(asked.values())


def test_a_repeated_vec_id_is_dealt_to_all_parts(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.group import GroupedData

    seen, group = [], GroupedData.cogroup
    monkeypatch.setattr(GroupedData, "cogroup", lambda self, other: seen.append(other._df) or group(self, other))
    rows = [(7, [1.0, 2.0])] * 400 + [(i, [float(i), 1.0]) for i in range(100, 140)]
    top_k(table(spark, rows), k=3, every=100, cells=1, part_rows=40)
    counts = [r["count"] for r in seen[0].filter(F.col("vec_id") == 7).groupBy("part").count().collect()]
    assert sum(counts) == 400 and max(counts) < 100


def test_few_candidates_and_large_values(spark):
    rows = [(0, [3e9, -2.0]), (1, [1e9, 5.0]), (2, [-3e9, 1.0])]
    assert sorted(map(tuple, top_k(table(spark, rows), k=10).collect())) == [(0, 1, 1, 3 * 10**18 * 2**20 if 3 * 10**18 * 2**20 < 2**63 else 2**63 - 1), (0, 2, 2, -(2**63))]


def test_empty(spark):
    assert top_k(table(spark, [])).collect() == []
    assert top_k(table(spark, [(5, [1.0])])).collect() == []
    assert top_k(table(spark, [(0, [1.0])])).collect() == []


def test_few_copies_where_cells_are_apart(spark):
    """The bounds leave far cells out: vectors are not sent to every block."""
    from trackside.llm import knn

    rng = np.random.default_rng(2)
    centres = np.eye(8) * 10
    x = np.floor((np.repeat(centres, 50, 0) + 0.01 * rng.normal(size=(400, 8))) * 1024)
    plan = knn.Plan(np.floor(centres * 1024), np.full(8, 9.9e7), np.full((8, 8), 1e6) + np.eye(8) * 1.04e8, np.full(8, 10300.0), [(c,) for c in range(8)], [1] * 8)
    cell = np.repeat(np.arange(8), 50)
    dist = np.sqrt(((x - plan.pivots[cell]) ** 2).sum(1))
    assert (knn._needed(cell, dist, plan).sum(1) == 1).all()
