"""Incremental publishing: rewrite the years that new rows touch, and leave the files of all others."""

from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.operators import quality
from shelfcast.operators.sessions import web_sessions
from shelfcast.plans.warehouse import DATA_LAYERS, LAYERS, TABLE_DATES, WRITERS, YEAR_OF, Warehouse
from shelfcast.sources.publish import publish_years

# Yearly tables whose date is, or may be, a ship date.
BY_SHIP_DATE = {"order_items", "shipments", "inventory", "fact_shipments", "fact_inventory_snapshot"} | {
    name for name in LAYERS["mart"] if name in YEAR_OF
}
BY_SESSION = {"fact_web_traffic"}


@dataclass(frozen=True)
class Touched:
    """Years to rewrite: from ``first`` on; ``early``: ship years before it; sessions from ``web`` on."""

    first: int
    early: tuple[int, ...]
    web: int

    def _start(self, name: str) -> int:
        return self.web if name in BY_SESSION else self.first

    def _early(self, name: str) -> tuple[int, ...]:
        return self.early if name in BY_SHIP_DATE else ()

    def years(self, name: str) -> Column:
        """Condition on the partitions of a table; rows without a date always belong to it."""
        year = F.col("year")
        hit = (year >= self._start(name)) | year.isNull()
        return hit | year.isin(*self._early(name)) if self._early(name) else hit

    def dates(self, name: str, date: str) -> Column:
        """The same condition on the date, as ranges that scans can use."""
        day = F.col(date)
        hit = day.isNull() | (day >= F.lit(dt.date(self._start(name), 1, 1)))
        for year in self._early(name):
            hit = hit | ((day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1))))
        return hit


def touched_years(w: Warehouse, old: Warehouse, since: dt.date) -> Touched:
    """Years of rows that depend on orders of the year of ``since`` or later, or on events from ``since`` on, now or
    when ``old`` was published. Only years come to the driver."""
    first = since.year
    recent = F.col("order_date").isNull() | (F.col("order_date") >= F.lit(dt.date(first, 1, 1)))
    shipped = [
        shop.table("shipments").where(recent).select(F.year("ship_date").alias("year")) for shop in (w, old)
    ]
    early = shipped[0].unionAll(shipped[1]).where(F.col("year") < first).distinct().collect()

    def session_start(events: DataFrame) -> DataFrame:
        new = events.where(F.col("event_date") >= F.lit(since)).select(F.col("visitor").alias("active")).distinct()
        theirs = events.join(new, F.col("visitor").eqNullSafe(F.col("active")), "left_semi")
        return web_sessions(theirs).where(F.to_date("end_ts") >= F.lit(since)).agg(F.year(F.min("date")).alias("year"))

    starts = [r["year"] for shop in (w, old) for r in session_start(shop.table("web_traffic")).collect()]
    return Touched(first, tuple(sorted(r["year"] for r in early)), min([first, *[y for y in starts if y is not None]]))


def publish_since(w: Warehouse, root: str, since: dt.date) -> Touched:
    """Bring the processed, dim, fact and mart tables under ``root`` up to the source of ``w``, which has new, changed
    or deleted rows from the day ``since`` on. Gives what publishing all of it again would give.

    Orders dated ``since`` or later, their lines, and events from then on may differ from what was published; to correct an
    older order, pass its day. Tables of ``YEAR_OF`` are rewritten for the years which those rows lie or lay in, and
    are built from these years alone. A line shipped before its order, or a session begun in an earlier year, brings
    that year in; a line without an order counts by its ship date. Other years keep their files. Dimensions, tables
    without a date and marts over all time are rewritten whole, and sessions are cut again from all events.

    Attributes copied from customers, products and reviews into facts and marts of older years stay as they were
    published. A run that broke off can be repeated: years are replaced, never added to.
    """
    old = Warehouse.open(w.spark, w.source, root, w.window)
    touched = touched_years(w, old, since)
    # What the yearly tables are built from: touched years of yearly tables, all of the others.
    inputs = {"lines": w.table("lines").where(touched.dates("order_items", "ship_date"))}
    for layer in DATA_LAYERS:
        w.publish_layer(layer, [name for name in LAYERS[layer] if name not in YEAR_OF], root)
        part = Warehouse(w.spark, w.source, w.window)
        for name, df in inputs.items():
            part.use(name, df, published=layer == "mart")
        yearly = [name for name in LAYERS[layer] if name in YEAR_OF]
        frames = {name: part.table(name).where(touched.dates(name, YEAR_OF[name])) for name in yearly}
        files = _replace(w, root, layer, frames, touched)
        for name in LAYERS[layer]:
            if name in files:
                w.use(name, files[name].select(*frames[name].columns))
            inputs[name] = w.table(name)
            if name in files and name != "web_traffic":  # a session is cut from all events of its visitor
                # Marts read facts of their own years, which ship dates widen.
                rule = "mart_operations" if layer == "fact" else name
                inputs[name] = files[name].where(touched.years(rule)).select(*frames[name].columns)
    return touched


def _replace(
    w: Warehouse, root: str, layer: str, frames: dict[str, DataFrame], touched: Touched
) -> dict[str, DataFrame]:
    """Write the touched years of the tables side by side; their files, and new counts of the whole tables."""
    if not frames:
        return {}

    def write(name: str) -> DataFrame:
        df, path = frames[name], os.path.join(root, layer, name)
        held = w.files(name, df.schema, path).where(touched.years(name)).select("year").distinct().collect()
        publish_years(df, path, YEAR_OF[name], [r["year"] for r in held])
        return w.files(name, df.schema, path)

    with ThreadPoolExecutor(WRITERS) as writers:
        files = dict(zip(frames, writers.map(write, frames)))
    summary = quality.processed_table_summary([(n, files[n], TABLE_DATES.get(n)) for n in files])
    seen = {
        r["table_name"]: (
            len(frames[r["table_name"]].columns),
            {k: r[k] for k in ("row_count", "first_date", "last_date")},
        )
        for r in summary.collect()
    }
    w.keep_counts(root, layer, seen)
    return files
