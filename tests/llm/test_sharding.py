import numpy as np
import pytest

from tessera.llm import sharding


def _check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s, slots in by.items():
        assert sorted(slots) == list(range(len(slots)))


def test_exact_sizes_and_whole_rows(edges):
    rows = sharding.shard_rows(edges, 4, block_rows=3).collect()
    _check(rows, edges.count(), 4)
    key = lambda r: tuple(str(r[c]) for c in ("doc_id", "text", "lang", "ids", "n.lines", "rid"))
    assert sorted(map(key, rows)) == sorted(map(key, edges.collect()))


def test_more_shards_than_rows_and_empty(spark, nothing):
    _check(sharding.shard_rows(spark.range(3), 8).collect(), 3, 8)
    assert sharding.shard_rows(nothing, 8).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(nothing, 0)


def test_order_is_uniform(spark):
    """Where each of 12 rows in 3 partitions lands, over many seeds."""
    base = spark.range(0, 12, 1, 3)
    seen = np.zeros((12, 4))
    for seed in range(60):
        for r in sharding.shard_rows(base, 4, seed=seed, block_rows=2, materialise=False).collect():
            seen[r["id"], r["shard"]] += 1
    assert abs(seen - 15).max() < 15  # 60 draws of probability 1/4: 4.4 standard deviations


def test_same_seed_same_result(spark):
    base = spark.range(0, 500, 1, 5)
    a, b = (sharding.shard_rows(base, 8, seed=3, materialise=False).collect() for _ in range(2))
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(sharding.shard_rows(base, 8, seed=4, materialise=False).collect())


def test_matrix_rows_and_columns_add_up():
    sizes, cells = np.array([5, 0, 7, 1, 9, 3]), np.array([4, 6, 8, 7])
    matrix = np.array([sharding.draw_row(sizes, cells, p, 11) for p in range(6)])
    assert (matrix.sum(1) == sizes).all() and (matrix.sum(0) == cells).all() and (matrix >= 0).all()


def test_hypergeometric_beyond_numpy():
    rng = np.random.default_rng(0)
    good, bad, n = 3 * 10**10, 7 * 10**10, 10**6
    draws = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(400)])
    sd = (n * 0.3 * 0.7) ** 0.5
    assert abs(draws.mean() - 0.3 * n) < 5 * sd / 20 and 0.8 * sd < draws.std() < 1.2 * sd
    small = np.array([sharding.hypergeometric(rng, 2, 10**9, 10**9) for _ in range(200)])
    assert set(small) <= {0, 1, 2} and abs(small.mean() - 2) < 0.1


def test_sizes_of_shards():
    assert sharding.shard_sizes(100, 3).tolist() == [34, 33, 33] and sharding.shard_sizes(0, 2).tolist() == [0, 0]


def test_slots_over_many_ranges_are_uniform(spark):
    """Rows of one partition, in ranges of about 8 rows: slots are gapless, and
    where a row lands in its shard says nothing about where it stood."""
    base = spark.range(0, 4000, 1, 4)
    rows = sharding.shard_rows(base, 2, block_rows=8, seed=5, materialise=False).collect()
    _check(rows, 4000, 2)
    assert abs(np.corrcoef([r["id"] for r in rows], [r["slot"] for r in rows])[0, 1]) < 0.06
