"""Usable vectors of a table, and their batches as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components beyond this are refused: they would not fit a long together with an offset.
LARGEST = float(1 << 61)


def usable(vector_column: str) -> F.Column:
    """Vectors that are not null and hold no null or non-finite component."""
    x = F.col(f"`{vector_column}`")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return x.isNotNull() & ~bad


def scaled_vectors(
    df: DataFrame, vector_column: str, scale: float, carried: dict[str, F.Column], name: str = "v", offset: int = 0
) -> DataFrame:
    """The carried columns and ``name``: floor(scale * x) + offset of every usable vector, as array<bigint>.

    A component too large for a long is an error, never a wrong number.
    """
    def whole(c: F.Column) -> F.Column:
        y = F.lit(float(scale)) * c.cast("double")
        fits = F.abs(y) < LARGEST
        told = F.raise_error(F.concat(F.lit("vector component too large: "), c.cast("string"))).cast("bigint")
        return F.when(fits, F.floor(y).cast("bigint") + F.lit(offset).cast("bigint")).otherwise(told)

    v = F.transform(F.col(f"`{vector_column}`"), whole).alias(name)
    return df.where(usable(vector_column)).select(*[c.alias(n) for n, c in carried.items()], v)


def matrix(column: pa.Array, width: int, pad: int = 0) -> np.ndarray:
    """Rows of a list column without nulls; shorter ones end in ``pad``."""
    sizes = np.asarray(pc.list_value_length(column), np.int64)
    values = np.asarray(column.flatten(), np.int64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.full((len(sizes), width), pad, np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def largest(rows: np.ndarray) -> int:
    return max(int(rows.max(initial=0)), -int(rows.min(initial=0)))
