"""Fitted parameters as frames instead of driver-side numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.keys import null_safe_join


def attach_params(df: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds the parameter columns: by key, or as a scalar subquery when there is one row.

    The keyed join carries no broadcast hint; parameters grow with the keys.
    """
    if keys:
        return null_safe_join(df, params, list(keys))
    one_row = params.select(F.struct("*")).scalar()
    return df.withColumns({name: one_row[name] for name in params.columns})
