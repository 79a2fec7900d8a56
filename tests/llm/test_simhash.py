import random
import re

import numpy as np
import pytest
from tests_support import sentence
from pyspark.sql import functions as F
from xxhash import xxh64

from shelfcast.llm import simhash
from shelfcast.llm.components import components
from shelfcast.llm.simhash import divided, fingerprint, grid, links, near_duplicates, op6_simhash, shingle_hashes

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs_of):
    parent = list(range(len(pairs_of)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs_of)):
        for b in range(a):
            if pairs_of[a][b]:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(pairs_of))]


@pytest.mark.parametrize("text", ["", " \n", "one", "Two Words", "É É é a\x0bb c  d", sentence(1, 300), "a b c " * 99])
def test_fingerprint(text):
    assert fingerprint(shingle_hashes(text.encode(), 3)) == brute_fingerprint(text)


def close_fingerprints(seed, n=400):
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randrange(0, 6)):
            base ^= 1 << b
        out.append(base)
    return sorted(set(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_is_close(spark, seed, monkeypatch):
    fps = close_fingerprints(seed)
    frame = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp bigint")
    stars = {r["u"]: r["v"] for r in components(links(frame)).collect()}
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    close = [[(a ^ b).bit_count() <= 3 for b in fps] for a in fps]
    parts = brute_components(close)
    groups = {}
    for s, p in zip(signed, parts):
        groups.setdefault(p, []).append(s)
    expected = {s: min(groups[p]) for s, p in zip(signed, parts)}
    assert {s: stars.get(s, s) for s in signed} == expected


def test_small_comparison_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 7)
    fps = np.array(sorted([0, 1, 3, 7, 15, 31, 1 << 40, 3 << 40]), np.uint64)
    (a, b), = simhash.cell_links(fps, np.zeros(8, np.int64), np.zeros(8, bool), 1)
    assert sorted(zip(a.tolist(), b.tolist())) == [(1, 0), (3, 0), (7, 0), (15, 0), (31, 0), (1 << 40, 0), (3 << 40, 0)]


def test_grid_rows_are_bounded(spark):
    assert grid(spark.createDataFrame([(5,), (-1,)], "fp bigint")).groupBy("fp").count().agg(F.max("count")).first()[0] <= 18


def test_every_close_pair_meets_in_a_divided_cell(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = b = rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = [tuple(int(np.array(f, np.uint64).view(np.int64)) for f in p) for p in pairs]
    placed = divided(grid(spark.createDataFrame([(f,) for f in {f for p in signed for f in p}], "fp bigint")))
    cells = {}
    for r in placed.collect():
        cells.setdefault(r["fp"], set()).add((r["cell"], r["visitor"]))
    for a, b in signed:
        met = {(c, u and v) for c, u in cells[a] for d, v in cells[b] if c == d}
        assert any(not both_visit for _, both_visit in met)


def test_random_fingerprints_crowd_no_cell(spark):
    rows = spark.range(1_000_000).select(F.xxhash64("id").alias("fp"))
    residents = divided(grid(rows).where("not visitor")).groupBy("cell").count()
    coarse = grid(rows).where("not visitor").groupBy("cell").count()
    assert coarse.agg(F.max("count")).first()[0] > 300
    assert residents.agg(F.max("count")).first()[0] <= 20


@pytest.mark.parametrize("edges", [
    [], [(2, 1)], [(i + 1, i) for i in range(60)], [(100, i) for i in range(40)] + [(200, 100), (9, 8)],
    [(i, 0) for i in range(1, 300)],
])
def test_components(spark, edges):
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    nodes = sorted({x for e in edges for x in e})
    near = [[(a, b) in edges or (b, a) in edges for b in nodes] for a in nodes]
    expected = {nodes[i]: nodes[p] for i, p in enumerate(brute_components(near)) if i != p}
    assert got == expected


def test_messy_rows_and_empty_tables(spark, messy, empty):
    rows = near_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["component"] == by[3]["component"] == by[4]["component"] == 2 and by[2]["fp"] == 0
    assert by[6]["component"] == 1 and by[5]["component"] == 5 and by[None]["component"] is None
    assert near_duplicates(empty).count() == 0


def test_query_against_brute_force(spark, small):
    rows = {r["doc_id"]: r for r in op6_simhash(spark, small).collect()}
    texts = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r["text"]) for r in texts]
    parts = brute_components([[(a ^ b).bit_count() <= 3 for b in fps] for a in fps])
    for i, r in enumerate(texts):
        assert rows[r["doc_id"]]["fingerprint"] == f"{fps[i]:016x}"
        assert rows[r["doc_id"]]["component_id"] == texts[parts[i]]["doc_id"]
