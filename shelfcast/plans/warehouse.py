"""The layered warehouse: which table is built from which, and how it is published."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from threading import Lock

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfcast.functions.calendar import month_start
from shelfcast.functions.exact import Scaled
from shelfcast.operators import cleaning, dims, facts, features, model, quality, sketches
from shelfcast.operators.seasonal import ForecastWindow, forecast_horizon
from shelfcast.operators.sessions import web_sessions
from shelfcast.plans import marts
from shelfcast.session import durable, shuffles_cleared
from shelfcast.sources import roles
from shelfcast.sources.publish import publish_table
from shelfcast.sources.scan import test_table

FORECAST_WINDOW = ForecastWindow()

LAYERS: dict[str, tuple[str, ...]] = {
    "processed": (
        "customers", "geography", "products", "promotions", "orders", "order_items", "payments", "shipments",
        "returns", "reviews", "inventory", "web_traffic", "sales",
    ),
    "dim": (
        "dim_date", "dim_customer", "dim_product", "dim_geography", "dim_promotion", "dim_return_reason",
        "dim_traffic_source",
    ),
    "fact": (
        "fact_sales_item", "fact_orders", "fact_shipments", "fact_returns", "fact_reviews",
        "fact_inventory_snapshot", "fact_sales_series", "fact_web_traffic",
    ),
    "mart": (
        "mart_sales_overview", "mart_product_performance", "mart_customer_insight", "mart_promotion_effectiveness",
        "mart_return_diagnostics", "mart_shipping_service", "mart_inventory_risk", "mart_operations",
        "mart_sales_forecast_ready",
    ),
    "validation": ("sales_reconciliation", "rejected_lines"),
    "metadata": ("quality_report", "processed_table_summary", "table_inventory"),
}

# Date column that gives the year partition of a published table.
YEAR_OF = {
    "orders": "order_date",
    "order_items": "ship_date",
    "shipments": "ship_date",
    "inventory": "month",
    "web_traffic": "event_date",
    "sales": "date",
    "fact_sales_item": "order_date",
    "fact_orders": "order_date",
    "fact_shipments": "ship_date",
    "fact_returns": "order_date",
    "fact_inventory_snapshot": "month",
    "fact_sales_series": "date",
    "fact_web_traffic": "date",
    "mart_sales_overview": "order_date",
    "mart_product_performance": "month",
    "mart_return_diagnostics": "month",
    "mart_shipping_service": "month",
    "mart_inventory_risk": "month",
    "mart_operations": "month",
}

# The layers that ``open`` reads.
DATA_LAYERS = ("processed", "dim", "fact", "mart")

# Tables of YEAR_OF with a year column of their own.
HAS_YEAR = ("fact_sales_series",)

TABLE_DATES = {
    "promotions": "start_date",
    "orders": "order_date",
    "order_items": "ship_date",
    "shipments": "ship_date",
    "inventory": "month",
    "web_traffic": "event_date",
    "sales": "date",
}


# Where a warehouse keeps its fitted hybrid, and the trend of it.
MODEL_PATH = ("model", "hybrid")
MODEL_TREND = "ridge"

# Where a warehouse keeps the counts of its tables, and their columns.
COUNTS_PATH = ("metadata", "table_counts")
COUNTS = "row_count bigint, column_count int, first_date date, last_date date, layer string, table_name string"

# Tables of one layer written at the same time.
WRITERS = 8

# Tables that are as long as lines, orders or events, or move them; only one at a time is written, since the shuffle
# files of a job lie on the disks until it ends.
LONG = {*YEAR_OF, "payments", "sales_reconciliation", "rejected_lines", "mart_customer_insight"}


class Warehouse:
    """Tables by name. A table is a lazy plan over its inputs unless it was published;
    then its files are read, and everything above it builds on them. The session should
    have the skew settings of ``shelfcast.session`` (``build_session`` sets them)."""

    def __init__(self, spark: SparkSession, source: str, window: ForecastWindow = FORECAST_WINDOW):
        self.spark = spark
        self.source = source
        self.window = window
        self._tables: dict[str, DataFrame] = {}
        self._published: set[str] = set()
        self._model_path: str | None = None
        self._counts: DataFrame | None = None
        self._counted: set[str] = set()

    @classmethod
    def open(cls, spark: SparkSession, source: str, root: str, window: ForecastWindow = FORECAST_WINDOW) -> Warehouse:
        """A warehouse that reads the processed, dim, fact and mart tables published under
        ``root``. Reports, the inventory and checks then scan those files; only what was not
        published is built from ``source``."""
        warehouse = cls(spark, source, window)
        for layer in DATA_LAYERS:
            for name in LAYERS[layer]:
                df = spark.read.parquet(os.path.join(root, layer, name))
                added = name in YEAR_OF and name not in HAS_YEAR
                warehouse._tables[name] = df.drop("year") if added else df
                warehouse._published.add(name)
        warehouse._model_path = os.path.join(root, *MODEL_PATH)
        warehouse._read_counts(root)
        return warehouse

    def raw(self, name: str) -> DataFrame:
        return test_table(self.spark, self.source, name)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = BUILDERS[name](self)
        return self._tables[name]

    def sales_lines(self) -> DataFrame:
        """Lines with order date and customer, for plans that need no region or payment."""
        if "fact_sales_item" in self._published:
            return self.table("fact_sales_item")
        return facts.sales_lines(self.table("order_items"), self.table("orders"))

    def line_amounts(self) -> DataFrame:
        """order_id, line_no and net of the lines of ``order_items``; a scan, where no product repeats."""
        if "order_items" in self._published:
            return self.table("order_items").select("order_id", "line_no", "net")
        products = durable(facts.repeated_keys(self.table("products"), "product_id"), "repeated-products")
        lines = self.table("lines").select(
            "order_id", "line_no", "product_id", roles.net_of(self.table("lines")).decimal().alias("net")
        )
        return lines.join(products, "product_id", "left").select("order_id", "line_no", "net")

    def order_headers(self) -> DataFrame:
        """order_id and status of the orders, each as often as a line of it meets the rows of ``fact_sales_item``'s
        header and of ``fact_orders``."""
        customers = self.table("customers").join(self.table("geography").select("nation_id"), "nation_id", "left")
        orders = self.table("orders").select("order_id", "customer_id", "status")
        often = durable(facts.repeated_keys(customers.select("customer_id"), "customer_id"), "repeated-customers")
        twice = durable(facts.repeated_keys(orders.select("order_id"), "order_id"), "repeated-orders")
        headers = orders.join(often, "customer_id", "left").join(twice, "order_id", "left")
        return headers.select("order_id", "status")

    def stored(self, name: str) -> DataFrame:
        """A table that the caller scans several times, computed once."""
        if name not in self._published:
            self._tables[name] = durable(self.table(name), name)
            self._published.add(name)
        return self._tables[name]

    def stored_together(self, names: Sequence[str]) -> list[DataFrame]:
        """Tables computed once each, side by side."""
        with ThreadPoolExecutor(WRITERS) as writers:
            return list(writers.map(self.stored, names))

    def publish_layer(self, layer: str, names: Sequence[str], root: str) -> list[tuple[str, str, DataFrame]]:
        """Write the tables of one layer side by side; later layers read the files."""
        frames = {name: self.table(name) for name in names}
        paths = {name: os.path.join(root, layer, name) for name in names}

        one = Lock()

        def write(name: str) -> dict:
            with one if name in LONG else nullcontext():
                return publish_table(frames[name], paths[name], YEAR_OF.get(name), TABLE_DATES.get(name))

        # The short ones first: a thread that waits for its turn writes nothing.
        with shuffles_cleared(self.spark), ThreadPoolExecutor(WRITERS) as writers:
            written = {name: writers.submit(write, name) for name in sorted(names, key=LONG.__contains__)}
            seen = {name: written[name].result() for name in names}
        for name, df in frames.items():
            self.use(name, self.files(name, df.schema, paths[name]).select(*df.columns))
        self.keep_counts(root, layer, {name: (len(frames[name].columns), seen[name]) for name in names})
        return [(layer, name, self._tables[name]) for name in names]

    def files(self, name: str, columns: T.StructType, path: str) -> DataFrame:
        """The files of a published table, with the year of their partitions."""
        if name in YEAR_OF and "year" not in columns.names:
            columns = T.StructType([*columns.fields, T.StructField("year", T.IntegerType())])
        return self.spark.read.schema(columns).parquet(path)

    def use(self, name: str, df: DataFrame, published: bool = True) -> None:
        """Read a table from this frame, instead of building it."""
        self._tables[name] = df
        if published:
            self._published.add(name)

    def keep_counts(self, root: str, layer: str, seen: dict[str, tuple[int, dict]]) -> None:
        """Write what the publishing jobs observed; a table that is published again has its counts replaced."""
        rows = [
            (n["row_count"], columns, n["first_date"], n["last_date"], layer, name) for name, (columns, n) in seen.items()
        ]
        path = os.path.join(root, *COUNTS_PATH)
        kept = self.spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("overwrite")
        kept.option("partitionOverwriteMode", "dynamic").partitionBy("layer", "table_name").parquet(path)
        self._read_counts(root)

    def _read_counts(self, root: str) -> None:
        self._counts = self.spark.read.schema(COUNTS).parquet(os.path.join(root, *COUNTS_PATH))
        self._counted = {r["table_name"] for r in self._counts.select("table_name").collect()}

    def kept_counts(self, *layers: str) -> DataFrame | None:
        """Rows, columns and date span of all tables of the layers, if they were published."""
        if self._counts is None or not self._counted.issuperset(n for layer in layers for n in LAYERS[layer]):
            return None
        return self._counts.where(F.col("layer").isin(*layers))

    def publish_all(self, root: str) -> DataFrame:
        """Every layer in build order. A layer builds on the files of the layers before it. Returns the inventory of
        all layers, from the counts of the jobs that wrote them."""
        with shuffles_cleared(self.spark):
            for layer, names in LAYERS.items():
                self.publish_layer(layer, names, root)
        return quality.counted_inventory(self._counts)

    def model_condition(self) -> dict[str, str]:
        """What the kept model was fitted under."""
        return {"train_end": self.window.train_end, "trend": MODEL_TREND}

    def hybrid_model(self) -> PipelineModel:
        """The published model; without one, a model fitted on the training days."""
        if self._model_path is not None:
            return model.load_model(self.spark, self._model_path, self.model_condition())
        mart = self.stored("mart_sales_forecast_ready")
        return model.fit_hybrid(mart, self.is_train(), self.window.train_end, MODEL_TREND)

    def publish_model(self, root: str) -> None:
        """Fit the hybrid and keep it under ``root``, where ``open`` finds it."""
        path = os.path.join(root, *MODEL_PATH)
        model.save_model(self.spark, self.hybrid_model(), path, self.model_condition())
        self._model_path = path

    def is_train(self, date: str = "date") -> Column:
        return self.window.is_train(date)

    def horizon(self) -> DataFrame:
        return forecast_horizon(self.table("sales"), self.window)


def _web_role(w: Warehouse) -> DataFrame:
    return roles.stg_web(w.raw("events")).withColumn("event_date", F.to_date("ts"))


def _links(w: Warehouse) -> list[cleaning.Link]:
    orders, lines, products, customers = (w.table(n) for n in ("orders", "lines", "products", "customers"))
    return [
        cleaning.Link("order_items.order_id", lines, "order_id", orders, "order_id"),
        cleaning.Link("order_items.product_id", lines, "product_id", products, "product_id"),
        cleaning.Link("orders.customer_id", orders, "customer_id", customers, "customer_id"),
        cleaning.Link("customers.nation_id", customers, "nation_id", w.table("geography"), "nation_id"),
        cleaning.Link("reviews.product_id", w.table("reviews"), "product_id", products, "product_id"),
        cleaning.Link("returns.product_id", w.table("returns"), "product_id", products, "product_id"),
        cleaning.Link("payments.order_id", w.table("payments"), "order_id", orders, "order_id"),
        cleaning.Link("inventory.product_id", w.table("inventory"), "product_id", products, "product_id"),
        cleaning.Link("web_traffic.visitor", w.table("web_traffic"), "visitor", customers, "customer_id"),
    ]


def _quality_report(w: Warehouse) -> DataFrame:
    """Each table is passed over once: its key counts are stored, and duplicates, missing cells, bad dates and both
    sides of every reference are read from them. Lines are read twice, once with their product and once with their
    order."""
    t = w.table
    keys = quality.KeySet

    def counted(df: DataFrame, *sets: quality.KeySet) -> DataFrame:
        return durable(quality.key_counts(df, sets), "key-counts")

    def named(counts: DataFrame, name: str) -> DataFrame:
        return counts.where(F.col("set_name") == name)

    def plain(name: str, key: str, bad: Column | None = None, *more: quality.KeySet) -> DataFrame:
        return counted(t(name), keys(name, [key], [key], t(name).columns, bad=bad), *more)

    # A product that is there twice repeats its lines in order_items, and nowhere else.
    first = F.row_number().over(Window.partitionBy("product_id").orderBy("name")) == 1
    items = roles.stg_items(t("lines"), t("products").withColumn("is_first", first), ["is_first", "units_n"]).withColumns(
        {"month": month_start("ship_date"), "is_line": F.coalesce("is_first", F.lit(True))}
    )
    line, returned = F.col("is_line").cast("int"), (F.col("is_line") & F.col("is_returned")).cast("int")
    jobs = {
        "items": lambda: counted(
            items,
            keys("order_items", ["order_id", "line_no"], ["order_id"], t("order_items").columns,
                 bad=F.col("ship_date").isNull(), sums={"lines": line}),
            keys("returns", ["order_id", "product_id"], ["order_id"],
                 ["order_id", "product_id", "units", "return_amount", "return_reason"], when=returned == 1),
            keys("stock", ["product_id", "month"], ["product_id", "month"], when=F.col("is_line"),
                 sums={"lines": line, "returned": returned, "units_n": F.col("units_n")}),
        ),
        "shipments": lambda: counted(
            t("shipments"), keys("shipments", ["order_id", "line_no"], (), t("shipments").columns, bad=~F.col("is_valid"))
        ),
        "orders": lambda: plain("orders", "order_id", F.col("order_date").isNull(),
                                keys("of_customers", ["customer_id"], ["customer_id"])),
        "payments": lambda: plain("payments", "order_id"),
        "customers": lambda: plain("customers", "customer_id", None, keys("of_nations", ["nation_id"], ["nation_id"])),
        "geography": lambda: plain("geography", "nation_id"),
        "products": lambda: plain("products", "product_id"),
        "promotions": lambda: plain("promotions", "promo_id", F.col("end_date") < F.col("start_date")),
        "reviews": lambda: counted(
            t("reviews"), keys("reviews", ["review_id"], (), t("reviews").columns),
            keys("of_products", ["product_id"], ["product_id"]),
        ),
        "web_traffic": lambda: counted(
            t("web_traffic"), keys("web_traffic", ["event_id"], (), t("web_traffic").columns, bad=F.col("ts").isNull())
        ),
        # The cost of a day is never missing (it is zero without lines), so no line is read for it.
        "sales": lambda: counted(
            t("sales").select("date", "revenue"),
            keys("sales", ["date"], (), ["date", "revenue"], bad=F.col("date").isNull()),
        ),
    }
    with ThreadPoolExecutor(WRITERS) as writers:
        found = dict(zip(jobs, writers.map(lambda job: job(), jobs.values())))
    stock = named(found["items"], "stock")
    units = Scaled(F.col("units_n"), Scaled.of(t("lines"), "units_n").digits)
    inventory = roles.stock_of(stock.select("product_id", "month", units.decimal().alias("demand")), t("products"))
    stock_counts = quality.key_counts(
        inventory, [keys("inventory", ["product_id", "month"], (), t("inventory").columns, bad=F.col("month").isNull())]
    )

    def rows(counts: DataFrame, name: str, key: str, amount: str = "row_count") -> DataFrame:
        return named(counts, name).select(F.col(key).alias("key"), F.col(amount).alias("rows"))

    references = [
        quality.Reference(["customers"], rows(found["customers"], "of_nations", "nation_id"), "geography"),
        quality.Reference(["orders"], rows(found["orders"], "of_customers", "customer_id"), "customers"),
        # The shipments themselves hold only lines with an order.
        quality.Reference(
            ["order_items", "shipments"], rows(found["items"], "order_items", "order_id", "lines"), "orders"
        ),
        quality.Reference(["order_items"], rows(stock, "stock", "product_id", "lines"), "products"),
        quality.Reference(["payments"], rows(found["payments"], "payments", "order_id"), "orders"),
        quality.Reference(["returns"], rows(found["items"], "returns", "order_id"), "orders"),
        quality.Reference(["returns"], rows(stock, "stock", "product_id", "returned"), "products"),
        quality.Reference(["reviews"], rows(found["reviews"], "of_products", "product_id"), "products"),
        quality.Reference(["inventory"], rows(stock, "stock", "product_id"), "products"),
    ]
    parents = {
        name: named(found[name], name).select(F.col(key).alias("key"))
        for name, key in (("geography", "nation_id"), ("customers", "customer_id"), ("orders", "order_id"),
                          ("products", "product_id"))
    }
    return quality.quality_report(LAYERS["processed"], [*found.values(), stock_counts], references, parents)


def _processed_summary(w: Warehouse) -> DataFrame:
    kept = w.kept_counts("processed")
    if kept is not None:
        return quality.counted_summary(kept)
    return quality.processed_table_summary([(n, w.table(n), TABLE_DATES.get(n)) for n in LAYERS["processed"]])


def _inventory(w: Warehouse) -> DataFrame:
    """From the counts of a published warehouse; else counted."""
    layers = ("dim", "fact", "mart")
    kept = w.kept_counts(*layers)
    if kept is not None:
        return quality.counted_inventory(kept)
    return quality.table_inventory([(layer, name, w.table(name)) for layer in layers for name in LAYERS[layer]])


def _forecast_ready(w: Warehouse) -> DataFrame:
    return features.mart_sales_forecast_ready(
        w.table("fact_sales_series"), w.table("promotions"), w.table("daily_operations"),
        w.table("daily_inventory"), w.table("daily_traffic"), w.is_train(), w.horizon(),
    )


BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "customers": lambda w: roles.stg_customers(w.raw("customer")),
    "geography": lambda w: roles.stg_geography(w.raw("nation"), w.raw("region")),
    "products": lambda w: roles.stg_products(w.raw("part")),
    "promotions": lambda w: roles.stg_promotions(w.raw("orders"), w.raw("part")),
    "orders": lambda w: roles.stg_orders(w.raw("orders")),
    "lines": lambda w: roles.stg_lines(w.raw("lineitem")),
    "order_items": lambda w: roles.stg_items(w.table("lines"), w.table("products")),
    "payments": lambda w: roles.stg_payments(w.raw("orders")),
    "shipments": lambda w: roles.stg_shipments(w.table("lines"), w.table("orders")),
    "returns": lambda w: roles.stg_returns(w.table("lines")),
    "reviews": lambda w: roles.stg_reviews(w.raw("documents"), w.raw("labels"), w.raw("part")),
    "inventory": lambda w: roles.stg_inventory(w.table("lines"), w.table("products")),
    "web_traffic": _web_role,
    "sales": lambda w: roles.stg_sales(w.raw("orders"), w.table("order_items")),
    "sessions": lambda w: web_sessions(w.table("web_traffic")),
    "dim_date": lambda w: dims.dim_date(w.table("orders"), w.table("web_traffic")),
    "dim_customer": lambda w: dims.dim_customer(w.table("customers")),
    "dim_product": lambda w: dims.dim_product(w.table("products")),
    "dim_geography": lambda w: dims.dim_geography(w.table("geography")),
    "dim_promotion": lambda w: dims.dim_promotion(w.table("promotions")),
    "dim_return_reason": lambda w: dims.dim_return_reason(w.table("returns")),
    "dim_traffic_source": lambda w: dims.dim_traffic_source(w.table("web_traffic")),
    "fact_sales_item": lambda w: facts.fact_sales_item(
        w.table("order_items"), w.table("orders"), w.table("payments"), w.table("customers"), w.table("geography")
    ),
    "fact_orders": lambda w: facts.fact_orders(w.table("orders"), w.table("order_items"), w.table("payments")),
    "fact_shipments": lambda w: facts.fact_shipments(w.table("shipments")),
    "fact_returns": lambda w: facts.fact_returns(
        w.table("returns"), w.table("orders"), w.table("dim_return_reason")
    ),
    "fact_reviews": lambda w: facts.fact_reviews(w.table("reviews"), w.table("products")),
    "fact_inventory_snapshot": lambda w: facts.fact_inventory_snapshot(w.table("inventory")),
    "fact_sales_series": lambda w: facts.fact_sales_series(w.table("sales")),
    "fact_web_traffic": lambda w: facts.fact_web_traffic(w.table("sessions"), w.table("dim_traffic_source")),
    "mart_sales_overview": lambda w: marts.mart_sales_overview(w.table("fact_sales_item")),
    "product_month": lambda w: marts.product_month(w.sales_lines()),
    "mart_product_performance": lambda w: marts.mart_product_performance(
        w.stored("product_month"), w.table("fact_reviews")
    ),
    "mart_customer_insight": lambda w: marts.mart_customer_insight(
        w.table("fact_orders"), w.table("dim_customer"), w.table("dim_geography")
    ),
    "category_day": lambda w: marts.category_day(w.sales_lines()),
    "mart_promotion_effectiveness": lambda w: marts.mart_promotion_effectiveness(
        w.stored("category_day"), w.stored("dim_promotion")
    ),
    "mart_return_diagnostics": lambda w: marts.mart_return_diagnostics(w.table("fact_sales_item")),
    "mart_shipping_service": lambda w: marts.mart_shipping_service(w.table("fact_sales_item")),
    "mart_inventory_risk": lambda w: marts.mart_inventory_risk(w.table("fact_inventory_snapshot")),
    "mart_operations": lambda w: marts.mart_operations(
        w.table("fact_orders"), w.sales_lines(), w.table("fact_inventory_snapshot")
    ),
    "mart_sales_forecast_ready": _forecast_ready,
    "keyed_series": lambda w: w.table("fact_sales_item")
    .groupBy("category", "region", F.col("order_date").alias("date"))
    .agg(F.sum("net").alias("revenue"), F.sum("cogs").alias("cogs")),
    "daily_operations": lambda w: features.daily_operations(w.table("fact_orders"), w.table("dim_customer")),
    "daily_inventory": lambda w: features.daily_inventory(
        w.table("dim_date"), marts.monthly_inventory(w.table("fact_inventory_snapshot"))
    ),
    "daily_traffic": lambda w: features.daily_traffic(w.table("sessions")),
    "sales_reconciliation": lambda w: quality.sales_reconciliation(w.table("sales"), w.sales_lines()),
    "visitor_sketches": lambda w: sketches.distinct_sketches(
        w.table("sessions"), ["date", F.col("source").alias("traffic_source")], "visitor"
    ),
    "customer_sketches": lambda w: sketches.distinct_sketches(
        w.sales_lines(), [F.col("order_date").alias("date"), "category"], "customer_id"
    ),
    "visitors_by_month": lambda w: sketches.against_exact(
        w.table("sessions").select(month_start("date").alias("month"), F.col("source").alias("traffic_source"), "visitor"),
        w.stored("visitor_sketches").withColumn("month", month_start("date")),
        ["month", "traffic_source"], "visitor", "unique_visitors",
    ),
    "customers_by_month": lambda w: sketches.against_exact(
        w.sales_lines().select(month_start("order_date").alias("month"), "category", "customer_id"),
        w.stored("customer_sketches").withColumn("month", month_start("date")),
        ["month", "category"], "customer_id", "customers",
    ),
    "rejected_lines": lambda w: facts.rejected_lines(w.table("order_items"), w.table("orders")),
    "quality_report": _quality_report,
    "link_check": lambda w: cleaning.clean_link_check(_links(w)),
    "processed_table_summary": _processed_summary,
    "table_inventory": _inventory,
}
