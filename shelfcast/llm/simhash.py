"""SimHash near-duplicates: segment popcounts, a grid range-join under Manhattan distance, exact verification.

A fingerprint has a bit for each bit position that is set in over half of the shingles' hashes. It is mapped to the
bit counts of its 16 segments of four bits; their Manhattan distance never exceeds the Hamming distance. Two
fingerprints within 3 bits thus have counts within 3, and within 1 on one half of the segments. So each distinct
fingerprint lies in the grid cell of its counts, once for each half, and visits the cells that are one higher in one
coordinate; pairs of a cell are then compared bit by bit.

A grid of 2 * 5^8 cells grows crowded, so each cell is divided by the counts of a second segmentation of the
same half, whose segments cross those of the first: on that half the two fingerprints differ in at most one bit, so
here, too, they are at most one step apart, and the bit that makes a step in both grids is known. No cell of both grids
holds more than 90^2 = 8100 of the 2^32 values of a half (the 4 x 4 bit matrices with given sums, twice).

Work is on distinct fingerprints, so copies never meet each other; a cell returns a spanning forest of its links and
not the pairs. Links within a cell are found in blocks of PAIRS comparisons. The cells of a tight group are bounded
by the number of different fingerprints within a few bits of each other, not by its documents.

Defined results: a null, empty or wordless text has fingerprint zero, linked like any other; of repeated ids each row
is returned; a null id never names a component unless it is alone; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, raw_texts, stored, table
from shelfcast.llm.components import components

BITS = 3
SEED = 42
SEGMENTS = 16
PAIRS = 1_000_000
LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, lower-cased in A-Z, joined by spaces; fewer words are one run."""
    from xxhash import xxh64_intdigest as digest

    found = text.translate(LOWER).split()  # bytes: exactly \x20 and \x09-\x0D divide
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: len(found) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority of each bit; no hashes give zero."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = 3,
    name: str = "simhash",
) -> DataFrame:
    """The columns ``keep`` and a struct ``name``: fingerprint (its 64 bits as a long)."""

    def make():
        def compute(texts: pa.Array) -> list:
            found = [fingerprint(shingle_hashes(t, words)) for t in raw_texts(texts)]
            return [np.array(found, np.uint64).view(np.int64).tolist()]

        return compute

    return annotate(documents, text_column, make, "fingerprint bigint", list(keep), name)


def grid(distinct: DataFrame, column: str = "fp") -> DataFrame:
    """cell, visitor, segment, fp: each fingerprint's own cells, and those it visits, by the segment that is higher."""
    per_half = SEGMENTS // 2
    width = 64 // SEGMENTS
    counts = [
        F.bit_count(F.shiftrightunsigned(F.col(column), width * s).bitwiseAND(F.lit((1 << width) - 1)))
        for s in range(SEGMENTS)
    ]
    named = distinct.select(
        F.col(column).alias("fp"), F.array(*[c.cast("bigint") for c in counts]).alias("n")
    )
    places = []
    for half in range(2):
        own = F.lit(half).cast("bigint") * F.lit(1 << 3 * per_half)
        for s in range(per_half):
            own = own + F.col("n")[half * per_half + s] * F.lit(1 << 3 * s)
        places.append(F.struct(own.alias("cell"), F.lit(False).alias("visitor"), F.lit(half * per_half).alias("segment")))
        for s in range(per_half):
            higher = F.when(F.col("n")[half * per_half + s] < width, own + F.lit(1 << 3 * s))
            segment = F.lit(half * per_half + s).alias("segment")
            places.append(F.struct(higher.alias("cell"), F.lit(True).alias("visitor"), segment))
    return (
        named.select("fp", F.explode(F.array(*places)).alias("p"))
        .where("p.cell is not null").select("p.cell", "p.visitor", "p.segment", "fp")
    )


def divided(placed: DataFrame) -> DataFrame:
    """cell, visitor, fp: the cells of ``grid``, each divided by the counts of the crossing segments of its half.

    Crossing segment t of a half holds its bits t, t + 8, t + 16 and t + 24. It shares one bit at most with a segment
    of the grid, so a visitor goes where that bit, if it is not set, would lead: to four places at most.
    """
    width = 64 // SEGMENTS
    per_half = SEGMENTS // 2
    half = F.shiftrightunsigned("fp", 32)
    bits = F.when(F.col("segment") < per_half, F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))).otherwise(half)
    counts = F.lit(0).cast("bigint")
    for t in range(per_half):
        mask = sum(1 << b for b in range(t, 32, per_half))
        counts = counts + F.bit_count(F.col("bits").bitwiseAND(F.lit(mask))) * F.lit(1 << 3 * t)
    fine = placed.withColumn("bits", bits).withColumn("fine", counts)
    steps = []
    for j in range(width):
        bit = (F.col("segment") % per_half) * width + j
        unset = F.getbit("bits", bit) == 0
        place = F.col("fine") + F.pow(F.lit(8.0), bit % per_half).cast("bigint")
        steps.append(F.when(unset, place))
    at = F.when(F.col("visitor"), F.array(*steps)).otherwise(F.array("fine"))
    return (
        fine.select("cell", "visitor", "fp", F.explode(at).alias("place")).where("place is not null")
        .select((F.col("cell") * F.lit(1 << 3 * per_half) + F.col("place")).alias("cell"), "visitor", "fp")
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (larger, smallest) of stars that connect the same nodes as the links a-b do."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def cell_links(
    fps: np.ndarray, cells: np.ndarray, visitors: np.ndarray, bits: int, reduced: Callable = forest
) -> Iterator[tuple]:
    """Links of whole cells, ``reduced`` to forests as a rule; rows come sorted by cell, residents first."""
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    size = np.diff(np.append(first, len(cells)))
    residents = np.add.reduceat((~visitors).astype(np.int64), first)
    use = (residents > 0) & (size > 1)
    first, size, residents = first[use], size[use], residents[use]
    # Each resident meets the rows of its cell that come after it.
    owner = np.repeat(np.arange(len(first)), residents)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(residents) - residents, residents)
    left = first[owner] + nth
    count = size[owner] - nth - 1
    a_held, b_held, held = [], [], 0
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        n = count[at:to]
        i = np.repeat(left[at:to], n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        close = np.bitwise_count(fps[i] ^ fps[j]) <= bits
        if close.any():
            a, b = reduced(fps[i[close]].view(np.int64), fps[j[close]].view(np.int64))
            a_held.append(a)
            b_held.append(b)
            held += len(a)
            if held > PAIRS:
                a, b = reduced(np.concatenate(a_held), np.concatenate(b_held))
                a_held, b_held, held = [a], [b], len(a)
        at = to
    if a_held:
        yield reduced(np.concatenate(a_held), np.concatenate(b_held))


def links(distinct: DataFrame, bits: int = BITS, reduced: Callable = forest) -> DataFrame:
    """(u, v), u > v: edges that connect every two fingerprints within ``bits`` <= 3 bits; column fp.

    ``reduced`` maps the links of some cells (two arrays of fingerprints as longs) to the edges that stand for them.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the grid covers distances up to 3")
    placed = divided(grid(distinct)).repartition("cell").sortWithinPartitions("cell", "visitor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(keep_last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            whole = pa.Table.from_batches(held).combine_chunks()
            cells = whole["cell"].to_numpy()
            cut = int(np.searchsorted(cells, cells[-1])) if keep_last else len(cells)
            held = whole.slice(cut).to_batches() if cut < len(cells) else []
            rows = len(cells) - cut
            if cut:
                part = whole.slice(0, cut)
                fps = part["fp"].to_numpy().view(np.uint64)
                visitors = part["visitor"].to_pandas().to_numpy(bool)
                for a, b in cell_links(fps, cells[:cut], visitors, bits, reduced):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

        least = 50_000
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= least:
                yield from flush(True)
                least = max(50_000, 2 * rows)  # a cell longer than this is joined seldom
        if rows:
            yield from flush(False)

    return placed.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, bits: int = BITS
) -> DataFrame:
    """id, fp (long), component: the smallest id that links can reach."""
    found = fingerprints(documents, text_column, (id_column,), words)
    marked = stored(found.select(F.col(id_column).alias("id"), F.col("simhash.fingerprint").alias("fp")), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    stars = components(links(distinct.select("fp"), bits), "simhash-links")
    placed = distinct.join(stars, distinct["fp"] == stars["u"], "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    named = placed.join(
        placed.groupBy("root").agg(F.min("least").alias("component")), "root"
    ).select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(id_column), "fp", "component")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )
