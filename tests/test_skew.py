"""One order, product, customer and visitor each hold a third of the rows."""

import shutil
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from oracle_compare import TABLES, differences, oracle_connection
from shelfcast.oracle import ORACLE_SQL
from shelfcast.plans.queries import run

QUERIES = (
    "sales_reconciliation", "seasonal_forecast", "seasonal_forecast_by_key", "clean_dedup", "clean_link_check",
    "quality_report", "fact_sales_item", "fact_orders", "fact_inventory_snapshot", "fact_web_traffic",
    "mart_sales_overview", "mart_product_performance", "mart_customer_insight", "mart_promotion_effectiveness",
    "mart_return_diagnostics", "mart_shipping_service", "mart_operations", "report_profit_diagnostic",
    "report_segment_insight", "feat_traffic", "feat_expected_mean", "order_line_shares",
)


def with_hot_value(table, column, value, seed):
    values = table.column(column).to_numpy().copy()
    values[np.random.default_rng(seed).random(len(values)) < 1 / 3] = value
    return table.set_column(
        table.schema.get_field_index(column), column, pa.array(values, table.schema.field(column).type)
    )


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        shutil.copy(Path(small) / f"{name}.parquet", folder)
        (folder / f"{name}.parquet").chmod(0o644)
    for name, hot in {
        "lineitem": {"l_orderkey": 7, "l_partkey": 3},
        "orders": {"o_custkey": 5},
        "events": {"user_id": 1},
    }.items():
        table = pq.read_table(folder / f"{name}.parquet")
        for seed, (column, value) in enumerate(hot.items()):
            table = with_hot_value(table, column, value, seed)
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=500)
    return str(folder)


@pytest.fixture
def split_small_partitions(spark):
    """Thresholds low enough that adaptive execution splits even these partitions."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "1KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables_give_the_same_result(spark, skewed, split_small_partitions, name):
    assert differences(run(name, spark, skewed), oracle_connection(skewed), ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", ["fact_sales_item", "mart_sales_overview"])
def test_hot_join_is_split(spark, skewed, split_small_partitions, name):
    """Also where the next aggregation could have reused the join's partitioning."""
    df = run(name, spark, skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
