"""Benchmark decontamination: Wu-Manber multi-pattern search for benchmark windows in whole texts.

Texts and items are lower-cased in A-Z and reduced to words, each between single spaces. A pattern is a window of
13 consecutive item words (all words of a shorter item) with its surrounding spaces. Patterns of similar length share
tables: a shift table, by hash of the block of bytes under the cursor, says how far the search can jump; where it
says zero, buckets by suffix and prefix block select patterns, and direct comparison of the bytes confirms. Many
cursors walk through a slice of texts together, as array operations.

The benchmark goes to the tasks in shards of about ``shard_bytes`` of text, dealt by hash; each further shard is a
further pass, which adds its findings to the earlier ones, so no size of it is cut. A pass is written to the shared
folder before the next one begins: the driver and a task hold one shard at a time, however many there are. Only a
single item text that is longer than a shard makes one larger.

Defined results: null or wordless texts have no words, no hits and are not contaminated; null or wordless items
give no window; an item id that repeats counts once, a null one as an empty string; rows that repeat give a row
each; without a benchmark nothing is hit; other columns are ignored or, if asked for, kept.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, fresh, raw_texts, stored, table

WINDOW = 13
#: Bytes of benchmark text that a task holds at once.
SHARD_BYTES = 16_000_000
BLOCK = 8
TABLE_BITS = 18
LANES = 4096
#: Lower bounds of the pattern lengths that share tables.
LENGTH_CLASSES = (64, 32, 16, 8, 1)
MIX = np.uint64(0x9E3779B97F4A7C15)
SEPARATOR = 0xFF  # never in UTF-8

NORMAL = np.full(256, 0x20, np.uint8)
NORMAL[0x30:0x3A] = np.arange(0x30, 0x3A)
NORMAL[0x61:0x7B] = np.arange(0x61, 0x7B)
NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)
NORMAL[0x80:] = np.arange(0x80, 0x100)
NORMAL[SEPARATOR] = 0


def normalised(texts: list[bytes]) -> np.ndarray:
    """One array: a zero, then for each text ``' w1 w2 '`` (or one space) and a zero; eight zeros in front."""
    raw = np.frombuffer(b"\xff " + b" \xff ".join(texts) + b" \xff", np.uint8)
    flat = NORMAL[raw]
    space = flat == 0x20
    space[1:] &= space[:-1].copy()
    space[0] = False
    return np.concatenate([np.zeros(BLOCK, np.uint8), flat[~space]])


def words_of(text: bytes) -> list[bytes]:
    return normalised([text]).tobytes().strip(b"\0").split()


def windows_of(text: bytes, window: int = WINDOW) -> list[bytes]:
    words = words_of(text)
    if not words:
        return []
    return [b" %b " % b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def blocks_at(data: np.ndarray) -> np.ndarray:
    """View: the eight bytes from each position as one number."""
    return np.ndarray((len(data) - BLOCK + 1,), "<u8", data, 0, (1,))


class Tables:
    """Shift table and buckets of patterns whose shortest has ``m`` bytes."""

    def __init__(self, patterns: list[bytes], first: int):
        self.patterns, self.first = patterns, first
        self.m = m = min(map(len, patterns))
        self.width = width = min(BLOCK, m)
        self.drop = np.uint64(8 * (BLOCK - width))
        heads = np.frombuffer(b"".join(b"\0" * BLOCK + p[:m] for p in patterns), np.uint8).reshape(len(patterns), -1)
        self.shift = np.full(1 << TABLE_BITS, m - width + 1, np.int64)
        for end in range(width - 1, m):  # later ends give smaller shifts
            block = np.ascontiguousarray(heads[:, end + 1 : end + 1 + BLOCK]).view("<u8").ravel()
            slot = self.slot(block)
            self.shift[slot] = np.minimum(self.shift[slot], m - 1 - end)
        suffix = np.ascontiguousarray(heads[:, m : m + BLOCK]).view("<u8").ravel()
        prefix = np.ascontiguousarray(heads[:, width : width + BLOCK]).view("<u8").ravel()
        key = self.key(suffix, prefix)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def slot(self, block: np.ndarray) -> np.ndarray:
        return ((block >> self.drop) * MIX) >> np.uint64(64 - TABLE_BITS)

    def key(self, suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return (suffix >> self.drop) * MIX + (prefix >> self.drop)

    def candidates(self, blocks: np.ndarray) -> np.ndarray:
        """Ends of the first m bytes where the shift is zero; blocks: by position of their first byte."""
        size = len(blocks) + BLOCK - 1
        lanes = max(1, min(LANES, size // (4 * self.m)))
        bounds = np.linspace(BLOCK + self.m - 1, size, lanes + 1).astype(np.int64)
        at, end, found = bounds[:-1].copy(), bounds[1:].copy(), []
        while len(at):
            inside = at < end
            if not inside.all():
                at, end = at[inside], end[inside]
                if not len(at):
                    break
            step = self.shift[self.slot(blocks[at - (BLOCK - 1)])]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at += np.maximum(step, 1)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def matches(self, data: np.ndarray, whole: bytes) -> list[tuple[int, int]]:
        """(start, number of the pattern) of every occurrence."""
        blocks = blocks_at(data)
        ends = self.candidates(blocks)
        if not len(ends):
            return []
        starts = ends - self.m + 1
        key = self.key(blocks[ends - (BLOCK - 1)], blocks[starts + self.width - BLOCK])
        low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right")
        out = []
        for i in np.flatnonzero(high > low):
            start = int(starts[i])
            for k in self.order[low[i] : high[i]]:
                pattern = self.patterns[k]
                if whole.startswith(pattern, start):
                    out.append((start, self.first + int(k)))
        return out


class Searcher:
    """All windows of a benchmark shard, [(item id, text)], in tables by length class."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            for pattern in windows_of(text, window):
                owners[pattern].add(item)
        classes = defaultdict(list)
        for pattern in owners:
            classes[next(c for c in LENGTH_CLASSES if len(pattern) >= c)].append(pattern)
        self.tables, self.owners, self.n_words = [], [], []
        for _, patterns in sorted(classes.items()):
            self.tables.append(Tables(patterns, len(self.owners)))
            self.owners += [sorted(owners[p]) for p in patterns]
            self.n_words += [p.count(b" ") - 1 for p in patterns]

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, list[set[str]], list[list[tuple[int, int]]]]:
        """Of each text: words, items that occur, ranges of word numbers (end exclusive) that are hit."""
        data = normalised(texts)
        word = data >= 0x30
        begins = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        edges = np.flatnonzero(data[BLOCK:] == 0) + BLOCK  # one before each text, one at the end
        first = np.searchsorted(begins, edges)
        items: list[set[str]] = [set() for _ in texts]
        change = np.zeros(len(begins) + 1, np.int64)
        whole = data.tobytes()
        for t in self.tables:
            found = t.matches(data, whole)
            if not found:
                continue
            starts = np.array([s for s, _ in found])
            lengths = np.array([self.n_words[k] for _, k in found])
            number = np.searchsorted(begins, starts + 1)
            np.add.at(change, number, 1)
            np.add.at(change, number + lengths, -1)
            for d, (_, k) in zip((np.searchsorted(edges, starts, "right") - 1).tolist(), found):
                items[d].update(self.owners[k])
        hit = (np.cumsum(change[:-1]) > 0).astype(np.int8)
        ranges: list[list[tuple[int, int]]] = [[] for _ in texts]
        for d in [i for i, x in enumerate(items) if x]:
            own = hit[first[d] : first[d + 1]]
            edge = np.flatnonzero(np.diff(own, prepend=np.int8(0), append=np.int8(0)))
            ranges[d] = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        return np.diff(first), items, ranges


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _maker(items: list[tuple[str, bytes]], window: int):
    def make():
        searcher = Searcher(items, window)

        def compute(texts: pa.Array) -> list:
            counts, found, ranges = searcher.search(raw_texts(texts))
            spans = [[{"first": a, "end": b} for a, b in r] for r in ranges]
            hit = [sum(b - a for a, b in r) for r in ranges]
            return [counts.tolist(), hit, [sorted(x) for x in found], spans]

        return compute

    return make


FIELDS = "n_words bigint, n_hit bigint, items array<string>, ranges array<struct<first: bigint, end: bigint>>"


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
    item_column: str = "item_id", item_text: str = "text", name: str = "found", window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The columns ``keep`` and a struct ``name`` (none of them): n_words, n_hit, items, ranges of word numbers."""
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"),
        F.col(item_text).cast("string").alias("text"),
    ).where(F.col("text").isNotNull())
    shards = _shards(items, shard_bytes)
    if shards > 1:  # rows that repeat would all be dealt to one shard
        items = stored(items.distinct(), "benchmark")
        shards = _shards(items, shard_bytes)
    keep = list(keep)
    passes: list[str] = []
    out = documents
    for shard in range(shards):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard) if shards > 1 else items
        held = [(r["item"], r["text"].encode()) for r in rows.collect()]
        last = shard == shards - 1
        carried = [*keep, *([] if last or text_column in keep else [text_column]), *passes]
        passes.append(name if shards == 1 else fresh(out, f"{name}_{shard}"))
        out = annotate(out, text_column, _maker(held, window), FIELDS, carried, passes[-1])
        if not last:
            out = stored(out, "benchmark-pass")
    if shards > 1:
        out = _merge(out, passes, keep, name)
    return out


def _shards(items: DataFrame, shard_bytes: int) -> int:
    return int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes) + 1


def _merge(df: DataFrame, passes: list[str], keep: list[str], name: str) -> DataFrame:
    """Findings of several passes as one struct; overlapping or touching ranges are joined."""
    ranges = F.array_sort(F.flatten(F.array(*[F.col(f"{p}.ranges") for p in passes])))
    kind = "array<struct<first: bigint, end: bigint>>"
    joined = F.aggregate(
        ranges, F.array().cast(kind),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["first"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(
                    F.element_at(acc, -1)["first"].alias("first"),
                    F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.items") for p in passes]))))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"{passes[0]}.n_words").alias("n_words_"),
                     items.alias("items_"), joined.alias("ranges_"))
    n_hit = F.aggregate("ranges_", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["first"])
    return rows.select(*[F.col(f"`{c}`") for c in keep], F.struct(
        F.col("n_words_").alias("n_words"), n_hit.alias("n_hit"), F.col("items_").alias("items"),
        F.col("ranges_").alias("ranges"),
    ).alias(name))


def contaminated(found: F.Column) -> F.Column:
    """The rule: some word is hit, and at least a twentieth of all words."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    f = F.col("found")
    return found.select(
        "doc_id", f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"),
        F.size(f["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", f["items"]), 256).alias("items_sha256"), contaminated(f).alias("contaminated"),
    )


OP10_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), bw as (
  select distinct item, list_slice(w, i, i + n - 1) as win, n
  from (select item, w, least(len(w), 13) as n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)
), dw as (
  select r, i, n, list_slice(w, i, i + n - 1) as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw) where len(w) >= n)
), m as (
  select r, i, bw.n, item from dw join bw on dw.win = bw.win
), h as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from m) group by r
), t as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from m group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (r) left join t using (r)
"""
