"""Shared helpers: table reading, byte-bounded Arrow slices, stored intermediates, checks of inputs."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch between the JVM and Python: bounds memory when texts are long.
ARROW_ROWS = 256
#: UTF-8 bytes of text that a Python function holds unpacked at once (or one text, if longer).
SLICE_BYTES = 500_000


def bounded_batches(spark: SparkSession) -> None:
    """Lower Arrow batches to ARROW_ROWS rows in this session; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of ``column`` in each hold ``limit`` bytes, or are a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts as Python strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def held_out(id_column: str) -> F.Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def store_folder(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir. Where it is unset (tests), one under the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "intermediate")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{store_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the machine: Python workers wait for other tasks, beside an executor that needs it."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def annotate(
    df: DataFrame, text_column: str, make: Callable[[], Callable[[pa.Array], list]], fields: str, keep: list[str],
    name: str,
) -> DataFrame:
    """The columns ``keep``, and a struct column ``name`` of ``fields`` computed from the text of each row.

    ``make`` runs once in each task; what it returns maps the text column of a byte-bounded slice to an array for
    each field. Rows are neither shuffled nor joined, and columns that are not kept never reach Python's output.
    """
    text = text_column if text_column in keep else fresh(df, "text")
    columns = [F.col(f"`{c}`") for c in keep]
    if text_column not in keep:
        columns.append(F.col(f"`{text_column}`").cast("string").alias(text))
    source = df.select(*columns)
    result = T.StructType.fromDDL(fields)
    kept = [source.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField(name, result)])
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in result]
    names = result.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        compute = make()
        for part in slices(batches, text):
            arrays = [
                a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(compute(part.column(text)), kinds)
            ]
            packed = pa.StructArray.from_arrays(arrays, names)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], packed], [*keep, name])
        del compute
        give_back()

    return source.mapInArrow(run, schema)


def raw_texts(texts: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
