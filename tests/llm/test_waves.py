"""Vector searches whose shards are met in several waves."""

import numpy as np
import pytest

from stratus.llm import block_ann, block_topk, vectors


def test_waves_cover_all_shards_once():
    for shards in (1, 2, 8, 9, 100):
        met = [s for first, last in vectors.waves(shards) for s in range(first, last)]
        assert met == list(range(shards))


def test_heaps_keep_smaller_ids_of_ties_and_return_only_new_ones():
    best = vectors.Best(np.array([10, 20]), 2, [{"query_id": 10, "vec_id": 3, "score": 5}, {"query_id": 10, "vec_id": 9, "score": 4}])
    assert best.floor(0) == 4 and best.floor(1) is None
    best.offer(0, np.array([4, 4, 3, 4]), np.array([8, 7, 1, 11]))
    best.offer(1, np.array([1]), np.array([5]))
    assert sorted(best.found(0, np.array([10, 20]))) == [(0, 10, 7, 4), (0, 20, 5, 1)]


@pytest.mark.parametrize("search, score", [
    (block_topk.top_k, lambda a, b: np.floor(256 * b) @ np.floor(256 * a)),
    (block_ann.nearest, lambda a, b: (b @ a) / np.sqrt((a @ a) * (b * b).sum(axis=1)))])
def test_waves_lose_nothing(spark, monkeypatch, search, score):
    monkeypatch.setattr(vectors, "SHARD_BLOCKS", 1)
    monkeypatch.setattr(vectors, "GROWTH", 2)
    data = np.random.default_rng(8).normal(size=(400, 8)).astype(np.float32).astype(np.float64)
    data[100:250] = data[100]  # a common vector: ties go to the smaller id
    rows = [(i, v.tolist(), "x", 1.5) for i, v in enumerate(data)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string, score double").repartition(8)
    got = {}
    for r in search(table, "vec_id % 50 = 0").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 400, 50):
        s = np.round(score(data[q], data), 9)
        assert got[q] == [d for d in np.lexsort((np.arange(400), -s)).tolist() if d != q][:5]


def test_huge_components_wrap(spark):
    table = spark.createDataFrame([(0, [2.0 ** 60, 1.0]), (1, [2.0 ** 58, 0.5]), (2, [1e300, 3.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in block_topk.top_k(table, "vec_id = 0").collect()}
    assert got == {1: 256 * 128, 2: 256 * 768}  # the first products are multiples of 2**64
