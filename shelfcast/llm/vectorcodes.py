"""Vector code compression: product codes whose nearest entries are found through a GNAT over the entries.

A vector is cut into equal parts, and each part is replaced by the index of the nearest entry of that part's codebook.
The tree of a codebook picks split points among its entries; every other entry goes to its nearest split point, and
for each pair (split i, child j) the least and greatest distance from split i to anything in child j are kept. A query
measures its distances to the split points; a child whose range the ball of the best distance so far cannot touch, by
any split point, is left out with all that is in it. Only children strictly out of reach are left out, ranges and
balls are rounded outwards, and the entries met are compared by exact integer distance, ties to the lower index.

Codebooks learn in a fixed number of rounds on Spark: each task assigns its parts and passes on one sum for each entry
and position; the driver holds codebooks alone, whose size the parameters set.

Defined results: null vectors and those that hold null or non-finite components are dropped; a shorter vector counts as
padded with zeros to the longest one, and that to a multiple of the number of parts; repeated rows count each; entries
start at the smallest ids (of equal ids, the smaller vector first; null ids last); with fewer vectors than entries there
are as many entries as vectors; entries that are equal or unused stay; other columns are ignored; an empty table gives
no rows. Components so large that a distance would not fit a long are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_batches, stored, table
from shelfcast.llm.vectors import largest, matrix, scaled_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096.0
SPLITS = 4
#: Ranges and balls are widened by this share, far more than the rounding of a square root.
SLACK = 1e-9
EXACT = 1 << 62


def squared(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    away = rows - entry
    return (away * away).sum(axis=1)


class Gnat:
    """A node: entries that split it, ranges of distances to its children, and the children, None where empty."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None, splits: int = SPLITS):
        if numbers is None:  # of equal entries the lowest index stands for all
            numbers = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        self.entries = entries
        own = entries[numbers]
        chosen = [0]
        away = squared(own, own[0])
        while len(chosen) < min(splits, len(numbers)):  # the farthest from those chosen is next
            chosen.append(int(away.argmax()))
            away = np.minimum(away, squared(own, own[chosen[-1]]))
        self.splits = numbers[chosen]
        rest = np.setdiff1d(np.arange(len(numbers)), chosen)
        distance = np.sqrt(np.stack([squared(own, own[c]) for c in chosen]).astype(np.float64))  # split, member
        nearest = distance[:, rest].argmin(axis=0)
        self.children: list[Gnat | None] = [None] * len(chosen)
        self.low = np.full((len(chosen), len(chosen)), np.inf)
        self.high = np.full((len(chosen), len(chosen)), -np.inf)
        for j in np.unique(nearest).tolist():
            members = rest[nearest == j]
            self.low[:, j] = distance[:, members].min(axis=1) * (1 - SLACK)
            self.high[:, j] = distance[:, members].max(axis=1) * (1 + SLACK)
            self.children[j] = Gnat(entries, numbers[members], splits)

    def search(self, rows: np.ndarray, which: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Improve best (exact squared distance) and index of the rows ``which``; returns distances computed."""
        own = rows[which]
        exact = np.stack([squared(own, self.entries[s]) for s in self.splits])
        done = exact.size
        for s, d in zip(self.splits.tolist(), exact):
            better = (d < best[which]) | ((d == best[which]) & (s < index[which]))
            best[which[better]], index[which[better]] = d[better], s
        far = np.sqrt(exact.astype(np.float64))
        for j, child in enumerate(self.children):
            if child is None:
                continue
            reach = np.sqrt(best[which].astype(np.float64))
            inner, outer = (far - reach) - SLACK * (far + reach), (far + reach) * (1 + SLACK)
            out = ((outer < self.low[:, j, None]) | (inner > self.high[:, j, None])).any(axis=0)
            if not out.all():
                done += child.search(rows, which[~out], best, index)
        return done


def nearest_entries(tree: Gnat, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, ties to the lower index, and the exact squared distance."""
    best = np.full(len(rows), np.iinfo(np.int64).max, np.int64)
    index = np.full(len(rows), len(tree.entries), np.int64)
    if len(rows):
        tree.search(rows, np.arange(len(rows)), best, index)
    return index, best


def _checked(rows: np.ndarray, codebooks: np.ndarray) -> None:
    if (largest(rows) + largest(codebooks)) ** 2 * rows.shape[1] >= EXACT:
        raise OverflowError("vector components too large for exact distances in 64 bits")


def encode(rows: np.ndarray, codebooks: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (rows, parts) and squared distances (rows, parts); codebooks (parts, entries, length)."""
    _checked(rows, codebooks)
    parts, _, length = codebooks.shape
    found = [
        nearest_entries(tree, np.ascontiguousarray(rows[:, p * length : (p + 1) * length]))
        for p, tree in enumerate(trees)
    ]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def one_round(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Assign every part, and move each used entry to the floor of the mean of its parts."""
    parts, entries, length = codebooks.shape
    width = parts * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in codebooks]
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, length), object)
        for batch in batches:
            rows = matrix(batch.column("v"), width)
            index, _ = encode(rows, codebooks, trees)
            for p in range(parts):
                part = np.zeros((entries, length), np.int64)  # ``encode`` bounds components far below overflow
                np.add.at(part, index[:, p], rows[:, p * length : (p + 1) * length])
                sums[p] += part
                counts[p] += np.bincount(index[:, p], minlength=entries)
        place = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), pa.array(counts.ravel()[place], pa.int64()),
             pa.array([[int(x) for x in s] for s in sums.reshape(-1, length)[place]], pa.list_(pa.int64()))],
            ["place", "n", "sums"],
        )

    partial = vectors.select("v").mapInArrow(run, "place bigint, n bigint, sums array<bigint>")
    added = partial.groupBy("place").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(28,0)")).alias(f"s{i}") for i in range(length)]
    )
    moved = codebooks.copy()
    for r in added.collect():  # one row for each entry
        p, e = divmod(r["place"], entries)
        moved[p, e] = [int(r[f"s{i}"]) // r["n"] for i in range(length)]
    return moved


def fit_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray | None:
    """Codebooks (parts, entries, length) of all rows of ``vectors`` (id, v); None where there are no rows."""
    first = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    if not first:
        return None
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    length = max(1, -(-width // parts))
    start = matrix(pa.array([r["v"] for r in first], pa.list_(pa.int64())), parts * length)
    codebooks = np.ascontiguousarray(start.reshape(len(first), parts, length).transpose(1, 0, 2))
    for _ in range(rounds):
        codebooks = one_round(vectors, codebooks)
    return codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", keep: tuple[str, ...] = (),
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """id, code (two hex digits a part), error, and a struct ``kept`` of the columns ``keep``; and the codebooks."""
    kept = F.struct(F.lit(None).cast("int").alias("none"), *[F.col(f"`{c}`") for c in keep])
    carried = {"id": F.col(f"`{id_column}`"), "kept": kept}
    vectors = stored(scaled_vectors(df, vector_column, scale, carried), "codes-vectors")
    codebooks = fit_codebooks(vectors, parts, entries, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if codebooks is None:
            return
        trees = [Gnat(book) for book in codebooks]
        digits = "{:02x}" * parts
        for batch in batches:
            index, away = encode(matrix(batch.column("v"), codebooks.shape[0] * codebooks.shape[2]), codebooks, trees)
            codes = [digits.format(*row) for row in index.tolist()]
            error = [sum(row) for row in away.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(codes, pa.string()), pa.array(error, pa.int64()), batch.column("kept")],
                ["id", "code", "error", "kept"],
            )

    kind, kept_kind = (vectors.schema[c].dataType.simpleString() for c in ("id", "kept"))
    return vectors.mapInArrow(run, f"id {kind}, code string, error bigint, kept {kept_kind}"), codebooks


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256; errors are added by label before they are joined."""
    bounded_batches(spark)
    found, codebooks = compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    rows = stored(found.select(F.col("id").alias("vec_id"), "code", "error", "kept.label"), "codes")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = codebooks_digest(np.zeros((0,), np.int64) if codebooks is None else codebooks)
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _sql(rounds: int = ROUNDS) -> str:
    """The rounds unrolled; a row is a component (part, pos) of a vector, an entry likewise."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} as materialized (
  select rid, part, min({{'away': away, 'entry': entry}}) as best from (
    select p.rid, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) as away
    from p join b{k} b on p.part = b.part and p.pos = b.pos group by all
  ) group by all
)""")
        if k < rounds:
            steps.append(f"""b{k + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce((m.s - ((m.s % m.c) + m.c) % m.c) // m.c, b.x) as x
  from b{k} b left join (
    select p.part, a.best.entry as entry, p.pos, sum(p.x) as s, count(*) as c
    from p join a{k} a on p.rid = a.rid and p.part = a.part group by all
  ) m on b.part = m.part and b.entry = m.entry and b.pos = m.pos
)""")
    unrolled = ",\n".join(steps)
    return f"""
with v as materialized (
  select row_number() over (order by vec_id) as rid, vec_id, label,
    list_transform(embedding, lambda c: cast(floor(4096 * cast(c as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), p as materialized (
  select rid, (i - 1) // (len(v) // 8) as part, (i - 1) % (len(v) // 8) as pos, v[i] as x
  from (select rid, v, unnest(range(1, len(v) + 1)) as i from v)
), b0 as materialized (
  select part, rid - 1 as entry, pos, x from p where rid <= 16
), {unrolled}, e as (
  select v.vec_id, v.label, string_agg(printf('%02x', best.entry), '' order by part) as code,
    cast(sum(best.away) as bigint) as error
  from a{rounds} a join v on a.rid = v.rid group by v.rid, v.vec_id, v.label
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) from b{rounds}) as codebooks_sha256
from e
"""


OP12_SQL = _sql()
