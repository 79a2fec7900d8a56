"""Near copies: documents whose five-word shingles have a similarity (Jaccard) of 0.8 or more.

First the method of ``simhash``: fingerprints of 64 bits, segment popcounts, the grid's range-join under Manhattan
distance, and every pair within 3 bits verified, here by the similarity of its shingle sets. That groups texts.

At a similarity of 0.8 two such fingerprints differ in about ten bits, far beyond what the grid can search. So a search
that completes the groups follows, and what the grid has joined is not compared again. Its fingerprints have 512 bits,
and who meets whom is settled by 24 bands of five shingle minima (a pair at 0.8 shares one with probability 0.9999). In
a band's cell fingerprints of different groups are compared bit by bit, with a radius so wide that no pair at 0.8 is
outside it; that only names candidates. A candidate pair is a link if its shingle sets, joined to it, have the
similarity exactly.

Neither search is sure to name every pair. So a third one follows that is: of two texts with that similarity, each has
so many shingles in common with the other that, in any one order of all shingles, the two meet among its first ones
(``least_shared`` tells how many). The order is by the number of classes that have a shingle, so first come shingles of
one class alone, which meet nothing; few texts have any other among their first. What meets there and is not in one
group yet is compared exactly, all pairs of it. The searches before leave little to it: a large group is one by then.

A small cell names all its candidate pairs. In a larger one the closest pairs that connect it are named, in several
forests without a common pair (so a pair that fails has stand-ins); leaders first gather what is all but equal to them,
and only rows of different gatherings are compared then. Neither cells nor pairs are all emitted for a large group.
A cell of more than CROWD rows is dealt out anew, each row to one cell for each of its other bands.

Texts of the same words are one class and are compared once. Defined results: null, empty and wordless texts are
copies of each other; a text of fewer words is one shingle; repeated ids give a row each, and different texts under
one id are not linked by it; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, fresh, give_back, raw_texts, slices, stored
from shelfcast.llm.components import components
from shelfcast.llm.simhash import LOWER, fingerprint, shingle_hashes
from shelfcast.llm.simhash import links as grid_links

WORDS = 5
SIMILARITY = 0.8
LANES = 8  # of 64 bits
BANDS, ROWS = 24, 5
#: Rows up to which a cell names all its candidate pairs; from which leaders gather first; from which it is dealt anew.
SMALL_CELL, LARGE_CELL, CROWD = 32, 256, 20_000
#: Differing bits within which a leader gathers (far fewer than a pair at 0.8 has), and forests that a cell names.
GATHER_BITS = 30
FORESTS = 3
#: Comparisons held at once, and candidate pairs held before they are reduced to forests.
PAIRS = 100_000
HELD = 1_000_000
#: First bits of a shingle's hash by which shingles are dealt out, and documents whose shingles are dealt at once.
DEAL_BITS = 10
OWNERS = 4096


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


LANE_FACTORS = _odd(LANES, 11)
MIN_FACTORS = _odd(BANDS * ROWS, 13)
TIES = np.arange(LANES * 64) % 2 == 0


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many of the rows (n, lanes) of 64-bit numbers have each bit set, by carry-save addition."""
    counts = np.zeros(rows.shape[1] * 64, np.int64)
    weight = 1
    while len(rows):
        carries = []
        while len(rows) >= 3:
            m = len(rows) // 3
            a, b, c = rows[:m], rows[m : 2 * m], rows[2 * m : 3 * m]
            x = a ^ b
            carries.append((a & b) | (x & c))
            rows = np.concatenate([x ^ c, rows[3 * m :]])
        bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8), axis=1, bitorder="little")
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        rows = np.concatenate(carries) if carries else rows[:0]
        weight *= 2
    return counts


def signature(text: bytes) -> tuple[int, int, list[int], bytes, int]:
    """Two hashes of the words, band keys, wide fingerprint of the set of shingles, fingerprint of ``simhash``."""
    from xxhash import xxh64_intdigest as digest

    words = b" ".join(text.translate(LOWER).split())
    every = shingle_hashes(text, WORDS)
    fp = int(np.uint64(fingerprint(every)).view(np.int64))
    hashes = np.unique(every)
    if not len(hashes):
        hashes = np.zeros(1, np.uint64)
    counts = np.zeros(LANES * 64, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 8192):
        part = mixed(hashes[at : at + 8192])
        counts += bit_counts(mixed(part[:, None] * LANE_FACTORS))
        turned = part[:, None] * MIN_FACTORS
        least = np.minimum(least, (turned ^ (turned >> np.uint64(32))).min(axis=0))
    # Bits that are set in just half the shingles follow a pattern that favours neither value.
    wide = np.packbits((2 * counts > len(hashes)) | ((2 * counts == len(hashes)) & TIES), bitorder="little").tobytes()
    bands = [digest(b.tobytes(), i) >> 1 for i, b in enumerate(least.reshape(BANDS, ROWS))]
    return digest(words, 1) >> 1, digest(words, 2) >> 1, bands, wide, fp


def radius(similarity: float, bits: int = LANES * 64) -> int:
    """Differing bits that no pair of that similarity exceeds: the angle of sets of equal size, which is the widest,
    and eight standard deviations."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(np.ceil(bits * share + 8 * np.sqrt(bits * share * (1 - share))))


def signatures(documents: DataFrame, text_column: str, keep: tuple[str, ...], name: str = "copy") -> DataFrame:
    def make():
        return lambda texts: list(zip(*map(signature, raw_texts(texts)))) if len(texts) else [[], [], [], [], []]

    fields = "first bigint, second bigint, bands array<bigint>, wide binary, fp bigint"
    return annotate(documents, text_column, make, fields, list(keep), name)


def closest_forest(a: np.ndarray, b: np.ndarray, away: np.ndarray, n: int) -> np.ndarray:
    """Which of the pairs a-b of n nodes connect all that the pairs connect, by the closest ones (ties to the first)."""
    m = len(a)
    used = np.zeros(m, bool)
    label = np.arange(n)
    order = away.astype(np.int64) * m + np.arange(m)
    none = np.iinfo(np.int64).max
    left = np.arange(m)
    while len(left):
        x, y = label[a[left]], label[b[left]]
        crossing = x != y
        left, x, y = left[crossing], x[crossing], y[crossing]
        best = np.full(n, none)
        np.minimum.at(best, x, order[left])
        np.minimum.at(best, y, order[left])
        chosen = np.unique(best[best < none]) % m
        used[chosen] = True
        parent = list(range(n))
        for i, j in zip(label[a[chosen]].tolist(), label[b[chosen]].tolist()):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            while parent[j] != j:
                parent[j] = j = parent[parent[j]]
            parent[max(i, j)] = min(i, j)
        for i in range(n):
            parent[i] = parent[parent[i]]  # a parent is a smaller number, settled before
        label = np.array(parent)[label]
    return used


def forests(a: np.ndarray, b: np.ndarray, away: np.ndarray, n: int, many: int = FORESTS) -> np.ndarray:
    """Numbers of the pairs in ``many`` forests without a common pair, each the closest that is left."""
    left = np.arange(len(a))
    kept = []
    for _ in range(many):
        used = closest_forest(a[left], b[left], away[left], n)
        kept.append(left[used])
        left = left[~used]
    return np.concatenate(kept)


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b of the grid (longs) as pairs (larger, smaller): all, but of nodes with very many links only forests."""
    nodes, ends = np.unique(np.concatenate([np.maximum(a, b), np.minimum(a, b)]), return_inverse=True)
    pairs = np.unique(ends[: len(a)] * len(nodes) + ends[len(a) :])  # a pair may meet in several cells
    x, y = np.divmod(pairs, len(nodes))
    a, b = nodes[x], nodes[y]
    times = np.bincount(np.concatenate([x, y]))
    many = np.minimum(times[x], times[y]) >= SMALL_CELL
    if many.any():
        many[forests(x, y, np.bitwise_count((a ^ b).view(np.uint64)), len(nodes))] = False
        a, b = a[~many], b[~many]
    return a, b


def cell_pairs(
    ids: np.ndarray, wide: np.ndarray, most: int, joined: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (larger, smaller id) of a cell: those within ``most`` bits, or forests of them; wide (rows, lanes).

    Rows with the same number in ``joined`` are in one group already and are no pair.
    """
    n = len(ids)
    joined = np.arange(n) if joined is None else joined
    lead = np.arange(n)
    a_held, b_held, far_held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if n > LARGE_CELL:
        free = np.ones(n, bool)
        while free.any():
            first = int(free.argmax())
            rows = np.flatnonzero(free)
            away = np.bitwise_count(wide[rows] ^ wide[first]).sum(axis=1, dtype=np.int64)
            close = away <= GATHER_BITS
            lead[rows[close]] = first
            free[rows[close]] = False
            other = close & (joined[rows] != joined[first])
            a_held.append(rows[other])
            b_held.append(np.full(int(other.sum()), first))
            far_held.append(away[other])
    order = np.argsort(lead, kind="stable")
    ends = np.searchsorted(lead[order], lead[order], "right")  # rows of other gatherings come after
    count = n - ends
    total = np.concatenate([[0], np.cumsum(count)])
    at, held = 0, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        k = count[at:to]
        i = np.repeat(np.arange(at, to), k)
        j = np.repeat(ends[at:to], k) + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
        i, j = order[i], order[j]
        apart = joined[i] != joined[j]
        i, j = i[apart], j[apart]
        away = np.bitwise_count(wide[i] ^ wide[j]).sum(axis=1, dtype=np.int64)
        close = away <= most
        a_held.append(i[close])
        b_held.append(j[close])
        far_held.append(away[close])
        held += int(close.sum())
        if held > HELD:  # forests of forests are forests of the whole
            a, b, far = np.concatenate(a_held), np.concatenate(b_held), np.concatenate(far_held)
            keep = forests(a, b, far, n)
            a_held, b_held, far_held, held = [a[keep]], [b[keep]], [far[keep]], 0
        at = to
    a, b = np.concatenate(a_held), np.concatenate(b_held)
    if n > SMALL_CELL and len(a):
        keep = forests(a, b, np.concatenate(far_held), n)
        a, b = a[keep], b[keep]
    return np.maximum(ids[a], ids[b]), np.minimum(ids[a], ids[b])


def _met(placed: DataFrame, most: int, crowd: int | None) -> DataFrame:
    """u, v: candidate pairs of the rows (id, wide, joined, cell), no pair of one group ``joined`` among them; rows of a
    cell beyond ``crowd`` come back as u with the cell."""
    together = placed.repartition("cell").sortWithinPartitions("cell", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        wide: list[bytes] = []
        groups: list[int] = []
        cell, crowded = None, False

        def result(u, v, cells) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(cells, pa.int64())], ["u", "v", "cell"]
            )

        def flush() -> Iterator[pa.RecordBatch]:
            if crowded:
                yield result(ids, [None] * len(ids), [cell] * len(ids))
            elif len(ids) > 1:
                data = np.frombuffer(b"".join(wide), np.uint64).reshape(-1, LANES)
                u, v = cell_pairs(np.array(ids, np.int64), data, most, np.array(groups, np.int64))
                if len(u):
                    yield result(u, v, [None] * len(u))

        for batch in batches:
            for i, w, g, c in zip(*(batch.column(k).to_pylist() for k in ("id", "wide", "joined", "cell"))):
                if c != cell:
                    yield from flush()
                    ids, wide, groups, cell, crowded = [], [], [], c, False
                ids.append(i)
                wide.append(w)
                groups.append(i if g is None else g)
                if crowd is not None and len(ids) > crowd:
                    crowded = True
                    yield from flush()
                    ids, wide, groups = [], [], []
        yield from flush()

    return together.mapInArrow(run, "u bigint, v bigint, cell bigint")


def grid_candidates(classes: DataFrame) -> DataFrame:
    """(u, v), u > v: pairs of classes (id, fp) with fingerprints within 3 bits, by the grid of ``simhash``."""
    distinct = stored(classes.groupBy("fp").agg(F.min("id").alias("least")), "copies-fingerprints")
    left, right = (distinct.select(F.col("fp").alias(end), F.col("least").alias(f"{end}_id")) for end in ("u", "v"))
    met = grid_links(distinct.select("fp"), reduced=close_pairs).distinct().join(left, "u").join(right, "v")
    across = met.select(F.greatest("u_id", "v_id").alias("u"), F.least("u_id", "v_id").alias("v"))
    same = classes.select("id", "fp").join(distinct, "fp").where("id <> least")
    return across.unionByName(same.select(F.col("id").alias("u"), F.col("least").alias("v")))


def band_candidates(classes: DataFrame, similarity: float = SIMILARITY, crowd: int | None = None) -> DataFrame:
    """(u, v), u > v: candidate pairs of the classes (id, bands, wide, joined), none within a group ``joined``."""
    most = radius(similarity)
    placed = classes.select("id", "wide", "joined", F.explode("bands").alias("cell"))
    met = stored(_met(placed, most, CROWD if crowd is None else crowd), "copies-met")
    spread = (
        met.where("cell is not null").select(F.col("u").alias("id"), F.col("cell").alias("crowded"))
        .join(classes.select("id", "wide", "joined", "bands"), "id")
        .select("id", "wide", "joined", "crowded", F.explode("bands").alias("band")).where("band <> crowded")
        .select("id", "wide", "joined", F.xxhash64("crowded", "band").alias("cell"))
    )
    return met.where("cell is null").unionByName(_met(spread, most, None)).select("u", "v").distinct()


def shingle_set(text: bytes) -> np.ndarray:
    found = np.unique(shingle_hashes(text, WORDS))
    return found if len(found) else np.zeros(1, np.uint64)


def shingle_sets(texts: DataFrame, keep: tuple[str, ...], text_column: str = "text", name: str = "shingles") -> DataFrame:
    """The columns ``keep`` and a struct ``name``: the different shingle hashes of each text."""

    def make():
        return lambda part: [[shingle_set(t).view(np.int64) for t in raw_texts(part)]]

    return annotate(texts, text_column, make, "hashes array<bigint>", list(keep), name)


def class_sets(
    documents: DataFrame, classes: DataFrame, ids: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """id, hashes: the shingle sets of the classes in ``ids``; one text of each is read again, and none held together."""
    chosen = classes.join(ids, "id").select("id", F.col("best.id").alias("doc"), F.col("best.row_key").alias("row"))
    rows = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc"), row_key(documents).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    texts = rows.join(chosen, ["doc", "row"]).groupBy("id").agg(F.first("text").alias("text"))  # whole rows may repeat
    return stored(shingle_sets(texts, ("id",)).select("id", "shingles.hashes"), "copies-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets are that similar, exactly."""
    left, right = (
        sets.select(F.col("id").alias(end), F.col("hashes").alias(f"{end}_set"), F.size("hashes").alias(f"{end}_size"))
        for end in ("u", "v")
    )
    share = round(similarity * 10_000)
    fits = F.least("u_size", "v_size") * 10_000 >= F.greatest("u_size", "v_size") * share
    common = F.size(F.array_intersect("u_set", "v_set"))
    similar = common * (10_000 + share) >= (F.col("u_size") + F.col("v_size")) * share
    return pairs.join(left, "u").join(right, "v").where(F.when(fits, similar).otherwise(F.lit(False))).select("u", "v")


def _named(stars: DataFrame) -> DataFrame:
    """id, joined: the members of groups and the least of each, which is named by the others only."""
    return stars.select(F.col("u").alias("id"), F.col("v").alias("joined")).unionByName(
        stars.select(F.col("v").alias("id"), F.col("v").alias("joined")).distinct()
    )


def sharing(documents: DataFrame, id_column: str, text_column: str, similarity: float = SIMILARITY) -> DataFrame:
    """doc, row: documents of which so many shingles stand in other rows, too, that one of these may be as similar.

    Shingles are dealt out by the first bits of their hash; of the rest, 32 bits are told apart, so that a shingle
    may seem shared that is not, but never the other way. A slice of documents goes by a number until its documents'
    shared shingles, which come back from each deal, are counted.
    """
    share = round(similarity * 10_000)
    source = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc"), row_key(documents).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    ).where("doc is not null")
    names = ["deal", "part", "codes", "owners", "doc", "row", "sizes"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_memory_pool(pa.system_memory_pool())
        part = TaskContext.get().partitionId() << 36
        for batch in slices((b.slice(at, OWNERS) for b in batches for at in range(0, b.num_rows, OWNERS)), "text"):
            sets = [shingle_set(t) for t in raw_texts(batch.column("text"))]
            sizes = np.array([len(x) for x in sets], np.int64)
            hashes = np.concatenate(sets)
            order = np.argsort(hashes, kind="stable")
            hashes, owners = hashes[order], np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)[order]
            deals, first = np.unique(hashes >> np.uint64(64 - DEAL_BITS), return_index=True)
            ends = [*first[1:].tolist(), len(hashes)]
            codes = (hashes >> np.uint64(32 - DEAL_BITS)).astype(np.uint32)
            doc, row = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for k in ("doc", "row"))
            rows = [(part % (1 << DEAL_BITS), part, None, None, doc, row, sizes.tobytes())]
            rows += [
                (d, part, codes[a:b].tobytes(), owners[a:b].tobytes(), None, None, None)
                for d, a, b in zip(deals.tolist(), first.tolist(), ends)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)
            part += 1
        give_back()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            codes = np.concatenate([np.frombuffer(c, np.uint32) for _, c, _ in held])
            _, at, times = np.unique(codes, return_inverse=True, return_counts=True)
            often = times[at] > 1
            start, parts, found = 0, [], []
            for part, _, owners in held:
                owners = np.frombuffer(owners, np.uint16)
                these = owners[often[start : start + len(owners)]]
                start += len(owners)
                if len(these):
                    parts.append(part)
                    found.append(these.tobytes())
            none = [None] * len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip((parts, found, none, none, none), [pa.int64(), *[pa.binary()] * 4])],
                ["part", "shared", "doc", "row", "sizes"],
            )

        for batch in batches:
            heads = batch.filter(pc.is_null(batch.column("codes")))
            if heads.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [heads.column("part"), pa.nulls(heads.num_rows, pa.binary()),
                     *(heads.column(k).cast(pa.binary()) for k in ("doc", "row", "sizes"))],
                    ["part", "shared", "doc", "row", "sizes"],
                )
            batch = batch.filter(pc.is_valid(batch.column("codes")))
            for d, p, c, o in zip(*(batch.column(k).to_pylist() for k in ("deal", "part", "codes", "owners"))):
                if d != deal:
                    yield from flush()
                    deal, held = d, []
                held.append((p, c, o))
        yield from flush()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, head = None, [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if head is None:
                return
            doc, row, sizes = (np.frombuffer(x, np.int64) for x in head)
            total = np.bincount(np.frombuffer(b"".join(held), np.uint16), minlength=len(doc))
            enough = total * 10_000 >= sizes * share
            yield pa.RecordBatch.from_arrays([pa.array(doc[enough]), pa.array(row[enough])], ["doc", "row"])

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("part", "shared", "doc", "row", "sizes"))
            for p, owners, *rest in zip(*columns):
                if p != part:
                    yield from flush()
                    part, held, head = p, [], None
                if owners is None:
                    head = rest
                else:
                    held.append(owners)
        yield from flush()

    rows = source.mapInArrow(dealt, "deal int, part bigint, codes binary, owners binary, doc binary, row binary, sizes binary")
    gathered = rows.repartition("deal").sortWithinPartitions("deal")
    counts = gathered.mapInArrow(counted, "part bigint, shared binary, doc binary, row binary, sizes binary")
    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(added, "doc bigint, row bigint").distinct()


def least_shared(size: F.Column, similarity: float) -> F.Column:
    """Shingles that a set of that size has in common with any set as similar, at least."""
    return F.ceil(size * round(similarity * 10_000) / F.lit(10_000.0))


def meeting(sets: DataFrame, named: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v), u > v: every pair of the sets (id, hashes) that may be as similar, and is not in one group of ``named``.

    If two sets have m shingles in common, each has one of these among its first size - m + 1 in any order, and the
    first of all that they have in common is among the first ones of both. Shingles of one set alone are left out: they
    come first, and so count as if they stood there. At their first common shingle, what is left of either set must
    hold all that they have in common; else the pair is not named there.
    """
    share = round(similarity * 10_000)
    postings = sets.select("id", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
    often = postings.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    shared = postings.join(often, "hash").groupBy("id", "size").agg(
        F.sort_array(F.collect_list(F.struct("times", "hash"))).alias("shared")
    )
    first = (F.size("shared") - least_shared(F.col("size"), similarity) + 1).cast("int")
    entries = (
        shared.withColumn("first", first).where("first > 0")
        .select(
            "id", "size", F.size("shared").alias("many"),
            F.posexplode(F.slice("shared", F.lit(1), F.col("first"))["hash"]).alias("at", "hash"),
        )
        .join(named, "id", "left")
        .select(
            "id", "size", (F.col("many") - F.col("at")).alias("rest"), "hash",
            F.coalesce("joined", "id").alias("joined"),
        )
    )
    entries = stored(entries, "copies-entries")
    # A shingle of one group only names no pair, however many have it.
    ends = entries.groupBy("hash").agg(F.min("joined").alias("low"), F.max("joined").alias("high"))
    mixed = entries.join(ends.where("low <> high").select("hash"), "hash", "left_semi")
    one, other = (
        mixed.select("hash", *(F.col(c).alias(f"{end}_{c}") for c in ("id", "size", "rest", "joined")))
        for end in ("a", "b")
    )
    fits = F.least("a_rest", "b_rest").cast("bigint") * (10_000 + share) >= (F.col("a_size") + F.col("b_size")) * share
    met = one.join(other, "hash").where((F.col("a_joined") < F.col("b_joined")) & fits)
    return met.select(F.greatest("a_id", "b_id").alias("u"), F.least("a_id", "b_id").alias("v")).distinct()


def links(
    documents: DataFrame, classes: DataFrame, id_column: str, text_column: str, similarity: float = SIMILARITY
) -> DataFrame:
    """(u, v), u > v: edges that connect the classes (id, best, bands, wide, fp) whose shingle sets are that similar.

    The grid comes first; pairs from bands complete its groups, and those that meet by a shared shingle make them whole.
    """
    close = stored(grid_candidates(classes), "copies-close")
    sets = class_sets(documents, classes, _ends(close), id_column, text_column)
    stars = components(similar_pairs(close, sets, similarity), "copies-joined")
    grouped = stored(classes.select("id", "bands", "wide").join(_named(stars), "id", "left"), "copies-grouped")
    pairs = stored(band_candidates(grouped, similarity), "copies-pairs")
    missing = _ends(pairs).join(sets.select("id"), "id", "left_anti")
    sets = sets.unionByName(class_sets(documents, classes, missing, id_column, text_column))
    stars = components(stars.unionByName(similar_pairs(pairs, sets, similarity)), "copies-banded")
    shared = sharing(documents, id_column, text_column, similarity)
    best = classes.select("id", F.col("best.id").alias("doc"), F.col("best.row_key").alias("row"))
    able = stored(best.join(shared, ["doc", "row"], "left_semi").select("id"), "copies-able")
    missing = able.join(sets.select("id"), "id", "left_anti")
    sets = sets.unionByName(class_sets(documents, classes, missing, id_column, text_column))
    left = meeting(sets.join(able, "id", "left_semi"), _named(stars), similarity)
    left = stored(left.join(close.unionByName(pairs), ["u", "v"], "left_anti"), "copies-left")
    return stars.unionByName(similar_pairs(left, sets, similarity))


def row_key(documents: DataFrame) -> F.Column:
    """A hash of the whole row, nulls told apart; columns that hold maps cannot be hashed and are left out."""
    columns = [F.col(f"`{name}`") for name, kind in documents.dtypes if "map<" not in kind]
    return F.xxhash64(*[x for c in columns for x in (c.isNull(), c)])


def _groups(documents: DataFrame, id_column: str, text_column: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Rows (id, first, second, row_key); classes (first, second, group, best), best: the least (id, first, second, row key)
    of the class, null where all its ids are.

    Classes are numbered as they are stored. A class, not an id, is a node: texts that share an id stay apart.
    """
    key = fresh(documents, "row_key")
    found = signatures(documents.withColumn(key, row_key(documents)), text_column, (id_column, key))
    marked = stored(
        found.select(F.col(id_column).cast("bigint").alias("id"), F.col(key).alias("row_key"), "copy.*"), "copies"
    )
    best = F.when(F.col("id").isNotNull(), F.struct("id", "first", "second", "row_key"))
    classes = stored(
        marked.groupBy("first", "second").agg(
            F.min(best).alias("best"), F.first("bands").alias("bands"), F.first("wide").alias("wide"),
            F.first("fp").alias("fp"),
        ).withColumn("id", F.monotonically_increasing_id()), "copies-classes",
    )
    linked = links(documents, classes.where("best is not null"), id_column, text_column, similarity)
    stars = components(linked, "copies-links")
    named = classes.join(stars, classes["id"] == stars["u"], "left").select(
        "first", "second", F.coalesce("v", "id").alias("group"), "best"
    )
    return marked.select("id", "first", "second", "row_key"), stored(named, "copies-groups")


def near_copies(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """id, component: the smallest id among a document's near copies, and theirs, itself included."""
    marked, named = _groups(documents, id_column, text_column, similarity)
    least = named.groupBy("group").agg(F.min("best.id").alias("component"))
    classes = named.join(least, "group").select("first", "second", "component")
    return marked.join(classes, ["first", "second"]).select(F.col("id").alias(id_column), "component")


def survivors(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """id, key, repeated: one row for each group of near copies, that of the smallest id, then text hash, then row key;
    ``repeated`` tells that this whole row stands several times in the documents."""
    marked, named = _groups(documents, id_column, text_column, similarity)
    best = named.where("best is not null").groupBy("group").agg(F.min("best").alias("best"))
    times = (
        marked.where("id is not null").groupBy("id", "row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("id").alias("many_id"), F.col("row_key").alias("many_key"))
    )
    stays = best.select(F.col("best.id").alias("id"), F.col("best.row_key").alias("key"))
    same = (F.col("id") == F.col("many_id")) & (F.col("key") == F.col("many_key"))
    return stays.join(times, same, "left").select("id", "key", F.col("many_id").isNotNull().alias("repeated"))
