import math

import numpy as np

from tessera.llm import forest
from tessera.llm.queries import QUERIES

from .conftest import SF01

SF1 = SF01.replace("0.01", "0.1")


def _exact(ids, vectors, query_ids, k):
    out = {}
    for q in query_ids:
        s = (vectors * vectors[list(ids).index(q)]).sum(1)
        s[list(ids).index(q)] = -np.inf
        top = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), float(s[i])) for i in top]
    return out


def _found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_query_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = _found(QUERIES["op2_prefix_forest"](spark, SF01).collect())
    want = _exact(ids, vectors, [int(i) for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        for v, s in found:
            assert abs(s - math.fsum(vectors[v] * vectors[q])) < 1e-12


def test_uneven_lengths_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 8)) * rng.uniform(0.1, 10, 300)[:, None]
    vectors[100:160] = vectors[100]  # one vector many times
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [None] + [1.0] * 7), (1004, [float("nan")] + [1.0] * 7),
           (1005, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (1006, [1.0] * 5)]
    rows += [(i, v, "x", 1) for i, v in odd] + rows[:3]
    points = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, vector string, rank int").repartition(3)
    queries = points.where("vec_id % 10 = 0 or vec_id > 900 or vec_id is null")
    got = _found(forest.forest_search(points, queries, k=7).collect())
    want = _exact(np.arange(300), vectors, range(0, 300, 10), 7)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 7 for q in want]) >= 0.9
    equal = [v for v, _ in got[100] if 100 <= v < 160]  # of equal vectors the smallest ids
    assert equal and equal == list(range(101, 101 + len(equal)))


def test_few_and_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0])], "vec_id bigint, embedding array<float>")
    rows = forest.forest_search(one, one, k=20).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1, 20, 4.0), (20, 1, 0, 4.0)]
    none = one.where("vec_id < 0")
    assert forest.forest_search(none, none).collect() == []
    assert forest.forest_search(one, none).collect() == []


def test_blocks_of_a_hot_prefix(spark, monkeypatch):
    monkeypatch.setattr(forest, "POINT_BLOCK", 16)
    monkeypatch.setattr(forest, "STRING_BLOCK", 16)
    monkeypatch.setattr(forest, "PAIR_BLOCK", 64)
    monkeypatch.setattr(forest, "LIST_BLOCK", 100)
    points = spark.range(200).selectExpr("id as vec_id", "array(1f, 2f, if(id < 150, 3f, float(id))) as embedding")
    got = _found(forest.forest_search(points, points.where("vec_id % 20 = 0"), k=5).collect())
    vectors = np.array([[1, 2, 3 if i < 150 else i] for i in range(200)], float)
    assert got == _exact(np.arange(200), vectors, range(0, 200, 20), 5)


def _recall(found, want):
    return np.mean([len({v for v, _ in found[q]} & {v for v, _ in w}) / len(w) for q, w in want.items()])


def test_recall_beyond_the_fit_without_scanning(spark):
    """sf0.1: queries that the fit has not seen (it takes 20 of 400), on
    vectors close to random directions; none is compared with every point."""
    points = spark.read.parquet(f"{SF1}/embeddings.parquet").select("vec_id", "embedding")
    rows = points.orderBy("vec_id").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = forest.forest_search(points, points.where("vec_id % 5 = 0"), k=20, sample_queries=20, with_scored=True).collect()
    found, want = _found(out), _exact(ids, vectors, [int(i) for i in ids if i % 5 == 0], 20)
    assert set(found) == set(want) and _recall(found, want) >= 0.9
    scored = {r["query_id"]: r["scored"] for r in out}
    assert max(scored.values()) < 0.8 * len(ids) and np.mean(list(scored.values())) < 0.55 * len(ids)


def test_clusters_are_pruned_and_small_cells_go_up(spark, monkeypatch):
    """50 clusters of uneven size, with cells of a few strings, so that queries
    ascend through several rounds of cells; few points are looked at."""
    monkeypatch.setattr(forest, "CELL_STRINGS", 16)
    monkeypatch.setattr(forest, "ROUND_BITS", 3)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((50, 24))
    which = np.minimum(rng.geometric(0.06, 4000) - 1, 49)
    vectors = centre[which] + 0.25 * rng.standard_normal((4000, 24))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>").repartition(4)
    out = forest.forest_search(points, points.where("vec_id % 20 = 0"), k=10, with_scored=True).collect()
    found, want = _found(out), _exact(np.arange(4000), vectors, range(0, 4000, 20), 10)
    assert set(found) == set(want) and _recall(found, want) >= 0.9
    assert np.mean([r["scored"] for r in out]) < 0.2 * 4000


def test_long_vectors_and_many_copies(spark):
    """3000 components; a third of the rows are one vector."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((90, 3000))
    vectors[::3] = vectors[0]
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>").repartition(3)
    out = forest.forest_search(points, points.where("vec_id % 10 = 0"), k=4, with_scored=True).collect()
    found = _found(out)
    assert set(found) == set(range(0, 90, 10))
    assert [v for v, _ in found[0]] == [3, 6, 9, 12] and [v for v, _ in found[30]] == [0, 3, 6, 9]
    assert max(r["scored"] for r in out) <= 60 + 5  # of the copies only the five smallest ids are strings
