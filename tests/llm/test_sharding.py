import random
from collections import Counter

import pytest

from dispatchlens.llm.sharding import communication_matrix, hypergeometric, shuffle_into_shards


@pytest.mark.parametrize("rows,task_rows", [(0, 10), (5, 10), (1000, 37), (2400, 10_000)])
def test_exact_sizes_and_slots(spark, rows, task_rows):
    frame = spark.range(0, rows, 1, 3).withColumnRenamed("id", "doc_id")
    found = shuffle_into_shards(frame, 24, task_rows=task_rows).collect()
    assert sorted(r.doc_id for r in found) == list(range(rows))
    sizes = Counter(r.shard for r in found)
    counts = [sizes[s] for s in range(24)]
    assert max(counts) - min(counts) <= 1
    for s in range(24):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))


def test_equal_rows_nulls_and_clashing_columns(spark):
    frame = spark.createDataFrame([(None, 1)] * 50 + [(1, 2)] * 3, "doc_id long, SHARD int")
    found = shuffle_into_shards(frame, 4)
    assert found.columns == ["doc_id", "shard", "slot"]
    assert Counter(r.shard for r in found.collect()) == Counter({0: 14, 1: 13, 2: 13, 3: 13})


def test_matrix_margins():
    sizes, cells = [100, 0, 7, 893], [400, 1, 599]
    matrix = communication_matrix(sizes, cells, 3)
    assert [sum(r) for r in matrix] == sizes
    assert [sum(c) for c in zip(*matrix)] == cells


def test_hypergeometric_law():
    rng, n = random.Random(5), 40_000
    found = Counter(hypergeometric(rng, 5, 7, 4) for _ in range(n))
    ways = {0: 35, 1: 175, 2: 210, 3: 70, 4: 5}  # of 495
    for k, w in ways.items():
        assert found[k] / n == pytest.approx(w / 495, abs=0.012)


def test_every_row_is_as_likely_in_every_shard(spark):
    frame = spark.range(0, 60, 1, 4)
    seen = Counter()
    for seed in range(12):
        for r in shuffle_into_shards(frame, 3, seed=seed, task_rows=8).collect():
            seen[r.id // 20, r.shard] += 1
    # 9 cells of 80 expected rows each
    assert sum((seen[i, s] - 80) ** 2 / 80 for i in range(3) for s in range(3)) < 26
