"""Bounded training samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import held_out

#: UTF-8 bytes of training texts (or one text, if longer) that the driver unpacks at once.
UNPACK_BYTES = 500_000


def unpacked(texts: list[bytes], limit: int = UNPACK_BYTES) -> Iterator[slice]:
    """Places of consecutive texts of at most ``limit`` bytes together."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > limit:
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those whose key hashes lowest; a row's place depends on its key alone.

    Rows are first thinned by hash to a little more than ``rows`` in all, so however many tasks there are, together
    they pass on about as much as is asked for.
    """
    share = (1.2 * rows + 100) / max(df.count(), 1)
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    thin = df if share >= 1 else df.where(place < share)
    return thin.orderBy(place, key).limit(rows)


def labelled_texts(
    documents: DataFrame, labels: DataFrame, label: str, rows: dict[int, int] | int, id_column: str = "doc_id",
    text_column: str = "text",
) -> list[tuple[str, int]]:
    """Whole training texts and labels, at most ``rows`` of them (of each label value, if a dict says so).

    Held-out documents give none. Which rows are taken depends on the hash of the id alone; of an id with several
    labels the smallest counts, of repeated documents one text.
    """
    known = (
        labels.where(~held_out(id_column) & F.col(label).isNotNull())
        .groupBy(F.col(id_column).alias("id")).agg(F.min(label).cast("int").alias("label"))
    )
    picks = (
        [hash_sample(known.where(F.col("label") == k), "id", n) for k, n in rows.items()]
        if isinstance(rows, dict)
        else [hash_sample(known, "id", rows)]
    )
    chosen = picks[0]
    for more in picks[1:]:
        chosen = chosen.unionByName(more)
    texts = (
        documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")  # bounded by rows
        .groupBy("id", "label").agg(F.min("text").alias("text"))
    )
    found = sorted((r["id"], r["text"] or "", r["label"]) for r in texts.collect())
    return [(text, y) for _, text, y in found]
