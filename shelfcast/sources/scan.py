"""Typed scans and the schemas of the test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns of the test tables that the warehouse reads.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def scan_typed(
    spark: SparkSession,
    path: str,
    schema: str,
    date_cols: Sequence[str] = (),
    file_format: str = "parquet",
    corrupt: str | None = None,
) -> DataFrame:
    """Scan with a declared schema (no inference job); ``date_cols`` become DATE.

    A CSV line that does not fit the schema keeps what could be read; ``corrupt`` names a
    column for the whole line, NULL where it did fit, so bad lines can be kept and counted.

    NaN in a numeric CSV column is read as NULL, since Spark's aggregates would spread it.
    """
    reader = spark.read.schema(schema if corrupt is None else f"{schema}, `{corrupt}` string")
    if file_format == "csv":
        if corrupt is not None:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        df = reader.option("header", True).option("nullValue", "").csv(path)
        df = df.withColumns(
            {name: F.when(~F.isnan(name), F.col(name)) for name, kind in df.dtypes if kind in ("double", "float")}
        )
    else:
        df = reader.format(file_format).load(path)
    return df.withColumns({name: F.to_date(name) for name in date_cols}) if date_cols else df


def test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan_typed(spark, f"{folder}/{name}.parquet", TABLE_SCHEMAS[name])
