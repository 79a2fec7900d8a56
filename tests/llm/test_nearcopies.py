import random

import numpy as np
import pytest
from tests_support import SCHEMA, rows_of, sentence

from shelfcast.llm import nearcopies
from shelfcast.llm.nearcopies import LANES, bit_counts, cell_pairs, closest_forest, forests, near_copies, radius, signature


def test_bit_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 100):
        rows = rng.integers(0, 1 << 63, (n, 2), np.uint64)
        bits = [[(int(r[k // 64]) >> (k % 64)) & 1 for k in range(128)] for r in rows]
        assert bit_counts(rows).tolist() == np.array(bits).reshape(n, 128).sum(axis=0).tolist()


def jaccard(a, b):
    cut = lambda t: {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))}
    x, y = cut(a.lower().split()), cut(b.lower().split())
    return len(x & y) / len(x | y)


def test_groups_on_clear_cases(spark):
    rng = random.Random(5)
    texts = [sentence(i, rng.randrange(40, 400)) for i in range(60)]
    rows, expected = [], {}
    for i, t in enumerate(texts):
        rows.append((10 * i, t, "en"))
        words = t.split()
        near = words[:]
        near[rng.randrange(len(near))] = "changed"
        rows.append((10 * i + 1, " ".join(near), "en"))
        rows.append((10 * i + 2, t.upper().replace(" ", "  "), "en"))
        far = [w if k % 8 else "other" + w for k, w in enumerate(words)]
        rows.append((10 * i + 3, " ".join(far), "en"))
        expected |= {10 * i: 10 * i, 10 * i + 2: 10 * i, 10 * i + 3: 10 * i + 3}
        if jaccard(t, " ".join(near)) >= 0.86:
            expected[10 * i + 1] = 10 * i
    got = {r["doc_id"]: r["component"] for r in near_copies(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert {k: got[k] for k in expected} == expected


def groups_by_force(texts, similarity=0.8):
    """Smallest number of each text's component, by comparing all pairs."""
    cut = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in cut]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-12:
                links += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], links


def pairs_at_the_border(seed, sizes):
    """Texts with one to several words added, dropped or changed, near a similarity of 0.8."""
    rng = random.Random(seed)
    out = []
    for k, n in enumerate(sizes):
        words = sentence(1000 * seed + k, n).split()
        other = words[:]
        for _ in range(max(1, round(n / rng.choice([20, 45, 60])))):
            way = rng.randrange(4)
            if way == 0:
                other.append(f"more{rng.randrange(99)}")
            elif way == 1 and len(other) > 5:
                other.pop(rng.choice([0, -1]))
            elif way == 2:
                other.insert(0, f"less{rng.randrange(99)}")
            else:
                other[rng.randrange(len(other))] = f"new{rng.randrange(99)}"
        out += [" ".join(words), " ".join(other)]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_no_link_is_lost_and_none_is_made_up(spark, seed):
    rng = random.Random(seed)
    texts = pairs_at_the_border(seed, [rng.choice([5, 6, 7, 9, 10, 11, 15, 25, 50, 60, 120, 400]) for _ in range(150)])
    texts += [" ".join([f"w{seed}{k}x{i}" for i in range(n)] + ["end"] * e) for k, n in enumerate(range(5, 30)) for e in (0, 1)]
    expected, links = groups_by_force(texts)
    assert links > 60
    frame = spark.createDataFrame(rows_of([(i, t, "en") for i, t in enumerate(texts)]), SCHEMA).repartition(5)
    got = {r["doc_id"]: r["component"] for r in near_copies(frame).collect()}
    assert [got[i] for i in range(len(texts))] == expected


@pytest.mark.parametrize("crowd", [None, 10])
def test_a_large_group_around_a_template(spark, monkeypatch, crowd):
    """Near copies of one text, hundreds of them, whose pairs are linked or just not; and a crowded cell."""
    if crowd:
        monkeypatch.setattr(nearcopies, "CROWD", crowd)
    rng = random.Random(8)
    template = sentence(31, 90).split()
    texts = []
    for i in range(330):
        words = template[:]
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(90)] = f"n{rng.randrange(10_000)}"
        texts.append(" ".join(words))
    texts += [sentence(600 + i, 60) for i in range(20)]
    expected, _ = groups_by_force(texts)
    frame = spark.createDataFrame(rows_of([(i, t, "en") for i, t in enumerate(texts)]), SCHEMA)
    got = {r["doc_id"]: r["component"] for r in near_copies(frame).collect()}
    assert [got[i] for i in range(len(texts))] == expected


@pytest.mark.parametrize("seed", range(5))
def test_closest_forests(seed):
    rng = np.random.default_rng(seed)
    n = 40
    pairs = np.array([(i, j) for i in range(n) for j in range(i) if rng.random() < 0.2])
    a, b, away = pairs[:, 0], pairs[:, 1], rng.integers(0, 12, len(pairs))
    used = closest_forest(a, b, away, n)
    parent, expected = list(range(n)), np.zeros(len(a), bool)
    find = lambda x: x if parent[x] == x else find(parent[x])
    for k in np.lexsort((np.arange(len(a)), away)):
        x, y = find(int(a[k])), find(int(b[k]))
        if x != y:
            parent[x], expected[k] = y, True
    assert used.tolist() == expected.tolist()
    kept = forests(a, b, away, n, 2)
    assert len(kept) == len(set(kept.tolist())) and set(np.flatnonzero(used)) <= set(kept.tolist())


@pytest.mark.parametrize("small, large", [(1000, 10_000), (0, 10_000), (0, 1)])
def test_cells_of_any_size_connect_the_same(monkeypatch, small, large):
    monkeypatch.setattr(nearcopies, "SMALL_CELL", small)
    monkeypatch.setattr(nearcopies, "LARGE_CELL", large)
    monkeypatch.setattr(nearcopies, "PAIRS", 50)
    monkeypatch.setattr(nearcopies, "HELD", 200)
    rng = random.Random(3)
    bits = 64 * LANES
    rows = []
    for _ in range(80):
        base = rng.choice(rows) if rows and rng.random() < 0.8 else rng.getrandbits(bits)
        for b in rng.sample(range(bits), rng.randrange(1, 60)):
            base ^= 1 << b
        rows.append(base)
    wide = np.frombuffer(b"".join(r.to_bytes(bits // 8, "little") for r in rows), np.uint64).reshape(80, -1)
    u, v = cell_pairs(np.arange(80) * 3, wide, 50)
    assert (u > v).all()

    def label(pairs):
        parent = list(range(80))
        find = lambda x: x if parent[x] == x else find(parent[x])
        for i, j in pairs:
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
        return [find(i) for i in range(80)]

    close = [(i, j) for i in range(80) for j in range(i) if (rows[i] ^ rows[j]).bit_count() <= 50]
    assert label(zip((u // 3).tolist(), (v // 3).tolist())) == label(close)
    if small == 1000:
        assert sorted(zip(u.tolist(), v.tolist())) == sorted((3 * i, 3 * j) for i, j in close)


def test_fingerprints_of_similar_texts_are_within_the_radius():
    """Texts of any length, one word more at an end: within the radius wherever the similarity is 0.8 or more."""
    worst = 0
    for n in range(8, 60):
        for seed in range(12):
            words = sentence(50 * n + seed, n + 1).split()
            a, b = (np.frombuffer(signature(" ".join(w).encode())[3], np.uint64) for w in (words, words[1:]))
            worst = max(worst, int(np.bitwise_count(a ^ b).sum()))
    assert worst <= radius(0.8)


def test_radius_falls_with_similarity():
    assert radius(1.0) == 0 < radius(0.9) < radius(0.8) < 64 * LANES // 2


def test_messy_rows_and_empty_tables(messy, empty):
    rows = near_copies(messy).collect()
    assert len(rows) == messy.count()
    by = {r["doc_id"]: r["component"] for r in rows}
    assert by[2] == by[3] == by[4] == 2 and by[6] == 1 and by[5] == 5 and by[None] is None
    assert near_copies(empty).count() == 0


def close_texts(count):
    """Pairs of texts, one word changed, with similar shingles and fingerprints within 3 bits."""
    out, seed = [], 0
    while len(out) < 2 * count:
        seed += 1
        words = sentence(20_000 + seed, 150).split()
        other = [*words[:-1], "changed"]
        a, b = (signature(" ".join(w).encode())[4] for w in (words, other))
        if 0 < (a ^ b).bit_count() <= 3:
            out += [" ".join(words), " ".join(other)]
    return out


def test_the_grid_finds_pairs_and_bands_complete_its_groups(spark, monkeypatch):
    """Without a band the grid's range-join still links what is within 3 bits; bands never meet that again."""
    texts = close_texts(12) + pairs_at_the_border(4, [60] * 30)
    expected, _ = groups_by_force(texts)
    frame = spark.createDataFrame(rows_of([(i, t, "en") for i, t in enumerate(texts)]), SCHEMA)
    asked = []
    banded = nearcopies.band_candidates

    def seen(classes, similarity):
        pairs = banded(classes, similarity)
        joined = {r["id"]: r["joined"] for r in classes.collect()}
        asked.extend((joined[r["u"]], joined[r["v"]]) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(nearcopies, "band_candidates", seen)
    got = {r["doc_id"]: r["component"] for r in near_copies(frame).collect()}
    assert [got[i] for i in range(len(texts))] == expected
    assert asked and not any(a is not None and a == b for a, b in asked)

    monkeypatch.setattr(nearcopies, "band_candidates", lambda classes, similarity: banded(classes, similarity).limit(0))
    got = {r["doc_id"]: r["component"] for r in near_copies(frame).collect()}
    assert [got[i] for i in range(24)] == [i - i % 2 for i in range(24)] == expected[:24]


def test_the_grid_keeps_only_similar_texts(spark):
    """One fingerprint, or fingerprints within 3 bits, is no link without the similarity."""
    rows = [(i, i % 3, sentence(i, 50)) for i in range(12)]
    frame = spark.createDataFrame([(i, fp << 40) for i, fp, _ in rows], "id bigint, fp bigint")
    found = sorted((r["u"], r["v"]) for r in nearcopies.grid_candidates(frame).collect())
    linked = [(a, b) for a, b in found if a < 3]
    assert linked == [(1, 0), (2, 0), (2, 1)] and [p for p in found if p[0] >= 3] == [(i, i % 3) for i in range(3, 12)]
    sets = nearcopies.shingle_sets(
        spark.createDataFrame(rows, "id bigint, fp bigint, text string"), ("id",)
    ).select("id", "shingles.hashes")
    pairs = spark.createDataFrame(found, "u bigint, v bigint")
    assert nearcopies.similar_pairs(pairs, sets, 0.8).count() == 0


def test_links_of_a_tight_group_are_thinned_and_connect_the_same():
    rng = np.random.default_rng(2)
    nodes = np.unique(rng.integers(0, 1 << 12, 200))
    i, j = np.triu_indices(len(nodes), 1)
    a, b = nearcopies.close_pairs(np.concatenate([nodes[i], nodes[j]]), np.concatenate([nodes[j], nodes[i]]))
    assert (a > b).all() and len(set(zip(a, b))) == len(a) <= nearcopies.FORESTS * (len(nodes) - 1)
    reached = {int(nodes[0])}
    for _ in range(len(nodes)):
        reached |= {int(x) for p in zip(a, b) if reached & set(map(int, p)) for x in p}
    assert reached == set(map(int, nodes))
    few = nearcopies.close_pairs(np.array([5, 1, 5]), np.array([1, 5, 9]))
    assert sorted(zip(*few)) == [(5, 1), (9, 5)]


@pytest.mark.parametrize("seed", [6098, 33728, 36729])
def test_a_pair_that_shares_no_band_is_linked(spark, seed):
    """Similarity 0.8 just so; no band in common, and fingerprints more than 3 bits apart."""
    words = [f"w{seed}x{i}" for i in range(14)]
    pair = [" ".join(words[:13]), " ".join(words[1:])]
    a, b = (signature(t.encode()) for t in pair)
    assert jaccard(*pair) == 0.8 and not any(p == q for p, q in zip(a[2], b[2])) and (a[4] ^ b[4]).bit_count() > 3
    rows = [(1, pair[0], "en"), (2, pair[1], "en"), (3, sentence(1, 40), "en"), (None, pair[1], "en")]
    frame = spark.createDataFrame(rows_of(rows), SCHEMA)
    assert {r["doc_id"]: r["component"] for r in near_copies(frame).collect()} == {1: 1, 2: 1, 3: 3, None: 1}


@pytest.mark.parametrize("size", [300, 3])
def test_no_link_rests_on_the_grid_or_the_bands(spark, monkeypatch, size):
    """Shared shingles alone name every pair, also within a large group, whatever a slice of documents holds."""
    monkeypatch.setattr(nearcopies, "OWNERS", size)
    for name in ("grid_candidates", "band_candidates"):
        monkeypatch.setattr(nearcopies, name, lambda classes, *rest, f=getattr(nearcopies, name): f(classes, *rest).limit(0))
    rng = random.Random(6)
    texts = pairs_at_the_border(9, [rng.choice([5, 6, 9, 11, 25, 60, 120]) for _ in range(80)])
    template = sentence(77, 60).split()
    for i in range(60):
        words = template[:]
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(60)] = f"n{rng.randrange(10_000)}"
        texts.append(" ".join(words))
    texts += ["a " * n for n in range(1, 9)] + ["", "b", texts[0], texts[3].upper()]
    expected, links = groups_by_force(texts)
    assert links > 60
    frame = spark.createDataFrame(rows_of([(i, t, "en") for i, t in enumerate(texts)]), SCHEMA).repartition(3)
    got = {r["doc_id"]: r["component"] for r in near_copies(frame).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_pairs_that_meet_hold_all_similar_ones_and_none_of_one_group(spark):
    rng = random.Random(12)
    sets = []
    for _ in range(12):
        base = rng.sample(range(60), rng.randrange(1, 14))
        sets += [sorted({*rng.sample(base, max(1, len(base) - rng.randrange(3))), *rng.sample(range(60), rng.randrange(2))}) for _ in range(6)]
    group = [i % 12 // 3 if i % 5 == 0 else i for i in range(len(sets))]
    similar = {
        (j, i) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 5 * len({*sets[i]} & {*sets[j]}) >= 4 * len({*sets[i]} | {*sets[j]})
    }
    assert len(similar) > 30
    frame = spark.createDataFrame(list(enumerate(sets)), "id bigint, hashes array<bigint>")
    named = spark.createDataFrame([(i, g) for i, g in enumerate(group) if g != i], "id bigint, joined bigint")
    got = {(r["u"], r["v"]) for r in nearcopies.meeting(frame, named).collect()}
    assert {(u, v) for u, v in similar if group[u] != group[v]} <= got
    assert all(group[u] != group[v] for u, v in got)
    one = spark.createDataFrame([(i, 0) for i in range(len(sets))], "id bigint, joined bigint")
    assert nearcopies.meeting(frame, one).count() == 0
