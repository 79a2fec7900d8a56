"""Token counts: batch encoding in Arrow functions that return lengths only.

A byte-level BPE splits text before it merges, and always between a non-space character and a single space that
precedes another non-space character. Texts, long ones above all, are cut at those safe boundaries; the pieces'
lengths add up to the whole text's. Equal pieces of a slice are encoded once, in batches of about equal bytes, and
a bounded memory of piece lengths spans the slices of a task.

Defined results: a null text counts as empty (0 tokens); rows that repeat give a row each; other columns are
ignored, so names may clash; a text without safe boundaries is encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_batches, slices, table, texts_of

#: Pieces whose lengths a task remembers, and the longest piece it remembers.
MEMORY_PIECES = 400_000
MEMORY_CHARS = 64
#: UTF-8 bytes of one encoding batch.
BATCH_BYTES = 1 << 20
# Python's \s holds every Unicode space, so both neighbours of a cut are non-space for the tokenizer as well.
SAFE = re.compile(r"(?<=\S)(?= \S)")


def pieces(text: str) -> list[str]:
    """Cut at every safe boundary; joined, the pieces are the text."""
    parts = text.split(" ")
    if all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
        return [parts[0], *[" " + p for p in parts[1:]]]
    return SAFE.split(text)


def byte_balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about ``limit`` bytes; a longer text is a batch of its own."""
    batch, held = [], 0
    for text in sorted(texts, key=len):
        size = len(text.encode("utf-8", "surrogatepass"))
        if batch and held + size > limit:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += size
    if batch:
        yield batch


class PieceLengths:
    """Token counts of texts, from the lengths of their pieces."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        cut = [pieces(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known) if cut else set()
        if len(self.known) + len(new) > MEMORY_PIECES:
            self.known, new = {}, set().union(*cut)
        lengths = self.known
        for batch in byte_balanced(list(new)):
            encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            lengths.update(zip(batch, map(len, encoded)))
        counts = [sum(map(lengths.__getitem__, c)) for c in cut]
        for piece in [p for p in new if len(p) > MEMORY_CHARS]:
            del lengths[piece]
        return counts


def load_tokenizer(path: str):
    """A tokenizers file that neither truncates nor pads, one thread for each task slot."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def public_tokenizer(name: str) -> str:
    """Where this machine keeps a public vocabulary file; asked on the executor that uses it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024,
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row."""
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceLengths(load_tokenizer(public_tokenizer(tokenizer)))
        for part in slices(batches, "text"):
            counted = pa.array(counter.count(texts_of(part, "text")), pa.int64())
            size = pa.compute.fill_null(pa.compute.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), size, counted], ["id", "n_bytes", "n_tokens"])

    kind = source.schema["id"].dataType.simpleString()
    counted = source.mapInArrow(lengths, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return count_tokens(table(spark, sf_dir, "documents"))
