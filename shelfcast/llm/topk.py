"""Exact top-k search by inner product: cover trees over queries and data, searched together.

The index: a bounded sample gives at most CELLS pivots; every vector goes to its nearest pivot's cell; cells are dealt
out by hash into blocks of about BLOCK_ROWS vectors, so a cell (or one vector) that holds much of the data makes many
blocks. A cover tree is built in each block, and likewise over each group of queries. For a query node and a data
node the covering radii bound every score between them: <q, p> <= <cq, cp> + |cq| rp + |cp| rq + rq rp. A pair of
nodes is dropped when this is below the worst kth score of the queries in its node. The sample's scores give each
query its first kth score, so whole cells go before any vector moves. Survivors meet in a stream sorted by block that
holds one data tree and one query group at a time.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors of other lengths
count as padded with zeros; rows that repeat (id and vector) count once, an id with several vectors competes with its
best; rows with a null id take no part; ties go to the smaller id; fewer than k candidates give all; empty tables give
no rows. Other columns are ignored. Scores are exact integers; vectors whose scores might not fit a long are an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_batches, stored, table
from shelfcast.llm.samples import hash_sample
from shelfcast.llm.vectors import largest, scaled_vectors

K = 20
#: Bounds on the sample that places pivots and first thresholds, and on the pivots.
SAMPLE_ROWS = 2048
CELLS = 64
BLOCK_ROWS = 1024
GROUP_ROWS = 256
LEAF = 32
#: Integers up to here are exact in double precision; below LONGS scores fit a long. NONE: no score.
EXACT, LONGS = 1 << 53, 1 << 63
NONE = np.iinfo(np.int64).min
SLACK = 1e-6


class CoverTree:
    """Nodes of halving radius; each holds a range of the reordered rows, its centre is one of them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.order: list[np.ndarray] = []
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.start: list[int] = []
        self.stop: list[int] = []
        self.children: list[list[int]] = []
        data = rows.astype(np.float64)
        self.placed = 0
        middle = int(np.linalg.norm(data - data.mean(axis=0), axis=1).argmin())
        rest = np.arange(len(data))
        self._node(data, np.concatenate([[middle], rest[rest != middle]]), None)
        order = np.concatenate(self.order)
        self.ids, self.rows = ids[order], rows[order]
        self.center = np.array(self.center)
        self.norm = np.linalg.norm(self.center, axis=1)
        self.radius = np.array(self.radius)
        del self.order

    def _node(self, data: np.ndarray, members: np.ndarray, scale: float | None) -> int:
        """members[0] is the centre; its children cover it at half the scale and lie more than that apart."""
        me = len(self.children)
        away = np.linalg.norm(data[members] - data[members[0]], axis=1)
        radius = float(away.max())
        scale = radius if scale is None else scale
        self.center.append(data[members[0]])
        self.radius.append(radius)
        self.start.append(self.placed)
        self.stop.append(self.placed + len(members))
        self.children.append([])
        groups: list[np.ndarray] = []
        if len(members) > LEAF and radius > 0:
            while scale / 2 >= radius:
                scale /= 2
            left = members
            while len(left) and len(groups) <= len(members) // 4:
                near = np.linalg.norm(data[left] - data[left[0]], axis=1) <= scale / 2
                groups.append(left[near])
                left = left[~near]
            if len(left):
                groups = []  # mostly lone points: more levels would not separate anything
        if groups:
            self.children[me] = [self._node(data, g, scale / 2) for g in groups]
        else:
            self.order.append(members)
            self.placed += len(members)
        return me


class Best:
    """The k best (score, id) found for each query of a tree, and a bound that the kth reaches."""

    def __init__(self, tree: CoverTree, k: int, floor: np.ndarray | None = None):
        n = len(tree.ids)
        self.k, self.own = k, tree.ids
        self.score = np.full((n, k), NONE, np.int64)
        self.id = np.full((n, k), -1, np.int64)
        self.floor = np.full(n, NONE, np.int64) if floor is None else floor.copy()

    def take(self, lo: int, hi: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores[self.own[lo:hi, None] == ids[None]] = NONE
        scores[scores < self.floor[lo:hi, None]] = NONE
        if not (scores > NONE).any():
            return
        k = self.k
        counts = np.unique(ids, return_counts=True)[1]
        # An id may have several vectors: it is held once at most, and stands in ``ids`` so many times.
        wide = k * (int(counts.max()) + 1)
        both = np.concatenate([self.score[lo:hi], scores], axis=1)
        ids = np.concatenate([self.id[lo:hi], np.broadcast_to(ids, scores.shape)], axis=1)
        last = max(0, both.shape[1] - wide)
        kth = np.partition(both, last, axis=1)[:, last]
        row, col = np.nonzero((both >= kth[:, None]) & (both > NONE))
        s, i = both[row, col], ids[row, col]
        order = np.lexsort((i, -s, row))
        row, s, i = row[order], s[order], i[order]
        same = np.zeros(len(row), bool)  # an id with several vectors: its best comes first
        seen = np.lexsort((-s, i, row))
        same[seen[1:]] = (i[seen[1:]] == i[seen[:-1]]) & (row[seen[1:]] == row[seen[:-1]])
        row, s, i = row[~same], s[~same], i[~same]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        use = nth < k
        self.score[lo:hi], self.id[lo:hi] = NONE, -1
        self.score[lo + row[use], nth[use]] = s[use]
        self.id[lo + row[use], nth[use]] = i[use]
        self.floor[lo:hi] = np.maximum(self.floor[lo:hi], self.score[lo:hi, k - 1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; an error where they might not fit a long."""
    top = largest(a) * largest(b) * max(1, a.shape[1])
    if top < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top >= LONGS:
        raise OverflowError("vector components too large for scores in 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def bound(center, norm, radius, centers, norms, radii) -> np.ndarray:
    """No score between the balls exceeds this."""
    return centers @ center + norm * radii + norms * radius + radius * radii + SLACK * (1 + norm * norms)


def dual_search(queries: CoverTree, data: CoverTree, best: Best) -> Best:
    stack = [(0, 0)]
    while stack:
        q, d = stack.pop()
        lo, hi = queries.start[q], queries.stop[q]
        high = bound(
            queries.center[q], queries.norm[q], queries.radius[q], data.center[d], data.norm[d], data.radius[d]
        )
        if high < best.floor[lo:hi].min():
            continue
        q_kids, d_kids = queries.children[q], data.children[d]
        if not q_kids and not d_kids:
            a, b = data.start[d], data.stop[d]
            best.take(lo, hi, data.ids[a:b], products(queries.rows[lo:hi], data.rows[a:b]))
        elif d_kids and (not q_kids or data.radius[d] >= queries.radius[q]):
            kids = np.array(d_kids)
            likely = np.argsort(bound(
                queries.center[q], queries.norm[q], queries.radius[q],
                data.center[kids], data.norm[kids], data.radius[kids],
            ))
            stack += [(q, int(kids[i])) for i in likely]  # the likeliest is searched first
        else:
            stack += [(kid, d) for kid in q_kids]
    return best


def farthest_first(rows: np.ndarray, most: int) -> np.ndarray:
    """Rows that cover the others: each next one is the farthest from those chosen."""
    chosen = [0]
    away = np.linalg.norm(rows - rows[0], axis=1)
    while len(chosen) < min(most, len(rows)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(rows - rows[chosen[-1]], axis=1))
    return rows[chosen]


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """id, v: floor(scale * x) of every usable vector; equal rows once."""
    named = {"id": F.col(f"`{id_column}`").cast("bigint")}
    return scaled_vectors(df.where(F.col(f"`{id_column}`").isNotNull()), vector_column, scale, named).distinct()


def _matrix(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def top_k(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = 20, k: int = K,
    scale: float = 64.0,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each id divisible by ``every``."""
    vectors = stored(integer_vectors(df, id_column, vector_column, scale), "topk-vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    sample = hash_sample(vectors, "id", SAMPLE_ROWS).collect()
    sample_ids = np.array([r["id"] for r in sample], np.int64)
    sample_rows = _matrix([r["v"] for r in sample], width)
    pivots = farthest_first(sample_rows.astype(np.float64), CELLS) if len(sample) else np.zeros((1, width))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v").to_pylist(), width).astype(np.float64)
            square = (rows**2).sum(axis=1)[:, None] - 2 * rows @ pivots.T + (pivots**2).sum(axis=1)
            cell = square.argmin(axis=1)
            away = np.linalg.norm(rows - pivots[cell], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int64()), pa.array(away, pa.float64())], ["id", "v", "cell", "away"]
            )

    points = stored(
        vectors.mapInArrow(assign, "id bigint, v array<bigint>, cell bigint, away double"), "topk-points"
    )
    is_query = F.col("id") % every == 0
    cells = points.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max("away").alias("radius")
    ).collect()  # CELLS rows at most
    blocks_of = {r["cell"]: -(-r["n"] // BLOCK_ROWS) for r in cells}
    groups_of = {r["cell"]: max(1, -(-r["q"] // GROUP_ROWS)) for r in cells}
    radius_of = {r["cell"]: r["radius"] for r in cells}

    def salted(parts: dict[int, int]) -> F.Column:
        entries = [x for c, n in parts.items() for x in (F.lit(c), F.lit(n))]
        many = F.create_map(*entries)[F.col("cell")] if entries else F.lit(1)
        return F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("id", "v"), many.cast("bigint"))

    def data_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = CoverTree(pdf["id"].to_numpy(), _matrix(pdf["v"].tolist(), width))
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "kind": [0], "part": [0], "tree": [pickle.dumps(tree)]})

    def query_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        """The group's tree with first thresholds, once for each block of a cell that may hold better scores."""
        tree = CoverTree(pdf["id"].to_numpy(), _matrix(pdf["v"].tolist(), width))
        known = dual_search(tree, CoverTree(sample_ids, sample_rows), Best(tree, k))
        packed = pickle.dumps((tree, known.floor))
        numbers = np.array(sorted(radius_of))
        centers = pivots[numbers]
        high = bound(
            tree.center[0], tree.norm[0], tree.radius[0], centers, np.linalg.norm(centers, axis=1),
            np.array([radius_of[c] for c in numbers.tolist()]),
        )
        targets = [
            c * (1 << 32) + s for c in numbers[high >= known.floor.min()].tolist() for s in range(blocks_of[c])
        ]
        return pd.DataFrame({"block": targets, "kind": 1, "part": pdf["part"].iloc[0], "tree": packed})

    schema = "block bigint, kind int, part bigint, tree binary"
    blocks = points.select("id", "v", salted(blocks_of).alias("block")).groupBy("block").applyInPandas(data_tree, schema)
    groups = (
        points.where(is_query).select("id", "v", salted(groups_of).alias("part"))
        .groupBy("part").applyInPandas(query_tree, schema)
    )
    meet = blocks.unionByName(groups).repartition("block").sortWithinPartitions("block", "kind", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, data = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                block, kind = batch.column("block")[n].as_py(), batch.column("kind")[n].as_py()
                loaded = pickle.loads(batch.column("tree")[n].as_py())  # written by the two functions above
                if kind == 0:
                    at, data = block, loaded
                    continue
                if at != block:
                    continue
                tree, floor = loaded
                best = dual_search(tree, data, Best(tree, k, floor))
                row, col = np.nonzero(best.score > NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.ids[row], pa.int64()), pa.array(best.id[row, col], pa.int64()),
                     pa.array(best.score[row, col], pa.int64())], ["query_id", "vec_id", "score"]
                )

    found = meet.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
with v as (
  select distinct cast(vec_id as bigint) as id,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.id as query_id, p.id as vec_id,
    max(cast(list_inner_product(cast(q.v as double[]), cast(p.v as double[])) as bigint)) as score
  from v q join v p on q.id % 20 = 0 and q.id <> p.id group by all
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""
