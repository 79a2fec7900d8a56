import math
import random

import numpy as np
import pytest
from tests_support import differences, oracle_connection

from shelfcast.llm import topk
from shelfcast.llm.queries import ORACLE_SQL
from shelfcast.llm.topk import Best, CoverTree, dual_search, op2_topk, top_k


def brute(rows, every=20, k=20):
    """(query, rank, id, score) by comparing every query with every row; rows: (id, integer vector)."""
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        best = {}
        for i, v in rows:
            if i != q:
                score = max(sum(a * b for a, b in zip(u, v)) for j, u in rows if j == q)
                best[i] = max(best.get(i, -10**18), score)
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(top)]
    return out


def check_tree(tree, data):
    for node, kids in enumerate(tree.children):
        rows = tree.rows[tree.start[node] : tree.stop[node]]
        assert np.linalg.norm(rows - tree.center[node], axis=1).max() <= tree.radius[node] + 1e-9
        if kids:
            assert tree.start[kids[0]] == tree.start[node] and tree.stop[kids[-1]] == tree.stop[node]
    assert sorted(map(tuple, tree.rows.tolist())) == sorted(map(tuple, data.tolist()))


@pytest.mark.parametrize("seed", range(6))
def test_dual_search(seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 40, (6, 5))
    data = np.floor(centers[rng.integers(0, 6, 500)] + rng.normal(0, 1 + seed, (500, 5))).astype(np.int64)
    data[:30] = data[0]
    ids = rng.permutation(500)
    tree = CoverTree(ids, data)
    check_tree(tree, data)
    pick = ids % 7 == 0
    queries = CoverTree(ids[pick], data[pick])
    best = dual_search(queries, tree, Best(queries, 9))
    for n, q in enumerate(queries.ids):
        scores = [(-int(queries.rows[n] @ v), int(i)) for i, v in zip(ids, data) if i != q]
        expected = sorted(scores)[:9]
        assert list(zip((-best.score[n]).astype(int).tolist(), best.id[n].tolist())) == expected


def test_a_held_id_that_comes_again_takes_one_place():
    queries = CoverTree(np.array([0]), np.array([[1]]))
    best = Best(queries, 2)
    best.take(0, 1, np.array([1, 2]), np.array([[5.0, 4.0]]))
    best.take(0, 1, np.array([1, 3]), np.array([[6.0, 1.0]]))
    assert best.id.tolist() == [[1, 2]] and best.score.tolist() == [[6.0, 4.0]]


@pytest.mark.parametrize("seed", range(4))
def test_ids_with_many_vectors_over_many_leaves(seed):
    rng = np.random.default_rng(seed)
    data = np.unique(np.floor(rng.normal(0, 60, (900, 3))).astype(np.int64), axis=0)
    ids = rng.integers(0, 60, len(data))
    ids[rng.random(len(data)) < 0.3] = 7  # a hot id
    tree = CoverTree(ids, data)
    queries = CoverTree(np.arange(1000, 1020), np.floor(rng.normal(0, 60, (20, 3))).astype(np.int64))
    best = dual_search(queries, tree, Best(queries, 9))
    for n in range(20):
        scores = {}
        for i, v in zip(ids.tolist(), data):
            scores[i] = max(scores.get(i, -10**18), int(queries.rows[n] @ v))
        expected = sorted((-s, i) for i, s in scores.items())[:9]
        assert list(zip((-best.score[n]).astype(int).tolist(), best.id[n].tolist())) == expected


def test_pruning_happens():
    rng = np.random.default_rng(0)
    far = np.concatenate([rng.normal(0, 1, (300, 3)) + c for c in ([900, 0, 0], [-900, 0, 0])]).astype(np.int64)
    tree = CoverTree(np.arange(600), far)
    queries = CoverTree(np.arange(1000, 1010), np.tile([[10, 0, 0]], (10, 1)))
    seen = []
    best = Best(queries, 5)
    take = best.take
    best.take = lambda lo, hi, ids, scores: (seen.append(len(ids)), take(lo, hi, ids, scores))
    dual_search(queries, tree, best)
    assert sum(seen) < 600


def test_messy_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)], 1, 2) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5], 1, 2) for i in range(150, 260)]  # ties
    rows += [(20, rows[20][1], 1, 2), (20, rows[20][1], 3, 4), (40, [9.0, -9.0], 1, 2)]  # repeated, and another vector
    bad = [(300, None, 1, 2), (320, [1.0, None], 1, 2), (340, [float("nan")], 1, 2), (360, [float("inf")], 1, 2),
           (None, [1.0, 1.0, 1.0], 1, 2)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, score int, rank int")
    integers = [(i, tuple(math.floor(64 * x) for x in v)) for i, v, *_ in rows]
    integers = [(i, (*v, 0, 0)[:3]) for i, v in dict.fromkeys(integers)]
    got = sorted(tuple(r) for r in top_k(frame).collect())
    assert got == brute(integers)


def test_few_candidates_and_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "GROUP_ROWS", 3)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 5)
    rows = [(i, [1.0 if i % 3 else 0.25, float(i % 5)]) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    integers = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows]
    assert sorted(tuple(r) for r in top_k(frame, every=9).collect()) == brute(integers, every=9)
    few = frame.where("vec_id < 4")
    assert sorted(tuple(r) for r in top_k(few).collect()) == brute(integers[:4])


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert top_k(frame).count() == 0


def test_query_against_sql(spark, small):
    assert differences(op2_topk(spark, small), oracle_connection(small), ORACLE_SQL["op2_topk"]) == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [2e7, i / 64]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    integers = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows]
    assert sorted(tuple(r) for r in top_k(frame, k=5).collect()) == brute(integers, k=5)


@pytest.mark.parametrize("large", [1e9, 1e300])
def test_scores_that_fit_no_long_are_refused(spark, large):
    frame = spark.createDataFrame([(i, [large, 1.0]) for i in range(3)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        top_k(frame).collect()
