import hashlib
import math

import numpy as np
import pytest
from tests_support import differences, oracle_connection

from shelfcast.llm.queries import ORACLE_SQL
from shelfcast.llm.vectorcodes import Gnat, compress, encode, nearest_entries, op12_vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, id int, v int, kept int"


def brute_codes(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks by the rules, in Python integers; vectors: [(vec_id, integer tuple)]."""
    width = max(len(v) for _, v in vectors)
    length = -(-width // parts)
    rows = [tuple(v) + (0,) * (parts * length - len(v)) for _, v in vectors]
    order = sorted(range(len(rows)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, vectors[i][1]))[:entries]
    out = [[] for _ in rows]
    books = []
    for p in range(parts):
        cut = [r[p * length : (p + 1) * length] for r in rows]
        book = [cut[i] for i in order]
        for turn in range(rounds + 1):
            near = []
            for c in cut:
                away = [sum((a - b) ** 2 for a, b in zip(c, e)) for e in book]
                near.append((away.index(min(away)), min(away)))
            if turn < rounds:
                for e in range(len(book)):
                    mine = [c for c, n in zip(cut, near) if n[0] == e]
                    if mine:
                        book[e] = tuple(sum(x) // len(mine) for x in zip(*mine))
        for i, n in enumerate(near):
            out[i].append(n)
        books.append(book)
    return ["".join(f"{i:02x}" for i, _ in o) for o in out], [sum(d for _, d in o) for o in out], books


@pytest.mark.parametrize("seed", range(12))
def test_gnat_finds_the_nearest(seed):
    rng = np.random.default_rng(seed)
    spread = (3, 40, 100_000)[seed % 3]  # small numbers make ties
    entries = rng.integers(-spread, spread, (60, 3))
    entries[20:30] = entries[5]
    rows = np.concatenate([rng.integers(-spread, spread, (400, 3)), entries])
    tree = Gnat(entries)
    index, best = nearest_entries(tree, rows)
    away = ((rows[:, None] - entries) ** 2).sum(axis=2)
    assert index.tolist() == away.argmin(axis=1).tolist()
    assert best.tolist() == away.min(axis=1).tolist()


def test_subtrees_are_left_out():
    rng = np.random.default_rng(1)
    entries = np.concatenate([rng.integers(0, 20, (30, 4)) + c for c in (0, 5000, 10_000, 90_000)])
    rows = entries + rng.integers(-2, 3, entries.shape)
    best, index = np.full(len(rows), np.iinfo(np.int64).max), np.full(len(rows), len(entries))
    assert Gnat(entries).search(rows, np.arange(len(rows)), best, index) < 0.5 * len(rows) * len(entries)


def test_too_large_components_are_refused():
    book = np.zeros((1, 1, 2), np.int64)
    with pytest.raises(OverflowError):
        encode(np.array([[1 << 31, 0]]), book, [Gnat(b) for b in book])


def check(frame, rows):
    found, books = compress(frame, keep=("label",))
    usable = [(i, tuple(math.floor(4096 * x) for x in v)) for i, v, *_ in rows]
    codes, errors, expected = brute_codes(usable)
    assert [[tuple(e) for e in b] for b in books.tolist()] == [[tuple(e) for e in b] for b in expected]
    got = sorted((str(r["id"]), r["code"], r["error"], r["kept"]["label"]) for r in found.collect())
    assert got == sorted((str(i), c, e, label) for (i, _, label, *_), c, e in zip(rows, codes, errors))


def test_messy_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 20).tolist(), i % 3, "x", 1, 2, 3) for i in range(120)]
    rows += [(i, rows[5][1], None, "x", 1, 2, 3) for i in range(120, 200)]  # copies
    rows += [rows[7], (7, [0.25] * 20, 1, "x", 1, 2, 3), (None, [1.0] * 20, None, "x", 1, 2, 3),
             (300, [], 2, "x", 1, 2, 3), (301, [-0.5, 0.5], 2, "x", 1, 2, 3)]
    bad = [(-1, None, 1, "x", 1, 2, 3), (-2, [1.0, None], 1, "x", 1, 2, 3), (-3, [float("nan")] * 20, 1, "x", 1, 2, 3),
           (-4, [float("-inf")] * 20, 1, "x", 1, 2, 3)]
    check(spark.createDataFrame(rows + bad, SCHEMA).repartition(5), rows)


def test_fewer_vectors_than_entries_and_equal_ones(spark):
    rows = [(i, [1.5, -2.0, 0.0, 0.25], 1, "x", 1, 2, 3) for i in range(5)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_empty_table(spark):
    found, books = compress(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and books is None


def test_query_columns_and_label_errors(spark, small):
    got = op12_vector_codes(spark, small).collect()
    labels = {r["vec_id"]: r["label"] for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    sums = {}
    for r in got:
        sums[labels[r["vec_id"]]] = sums.get(labels[r["vec_id"]], 0) + r["error"]
    assert all(r["label_error"] == sums[labels[r["vec_id"]]] for r in got)
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    usable = sorted((r["vec_id"], tuple(math.floor(4096 * float(x)) for x in r["embedding"])) for r in rows)
    codes, errors, books = brute_codes(usable)
    flat = ",".join(str(x) for b in books for e in b for x in e)
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(flat.encode()).hexdigest()}
    expected = sorted(zip([i for i, _ in usable], codes, errors))
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == expected


def test_query_against_sql(spark, small):
    assert differences(op12_vector_codes(spark, small), oracle_connection(small), ORACLE_SQL["op12_vector_codes"]) == []
