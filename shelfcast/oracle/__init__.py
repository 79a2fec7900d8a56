"""SQL twins that DuckDB runs on the same tables. Models fitted by iteration have none."""

from __future__ import annotations

from shelfcast.oracle.ctes import CTES, with_ctes
from shelfcast.oracle.queries import BODIES, CHECKS, EXTRA_CTES, TABLE_COLUMNS

CTES.update(EXTRA_CTES)


def _statement(body: str) -> str:
    """A body may open with its own blocks (``with_x as (...)``) before its SELECT."""
    text = body.strip()
    if not text.startswith("with_"):
        return with_ctes(text)
    shared = with_ctes(text)
    return shared.replace("\n" + text, ",\n" + text) if shared != text else "with " + text


def _counts(layer: str, name: str, rows_from: str, columns: int) -> str:
    return (
        f"select '{layer}' as layer, '{name}' as table_name, (select count(*) from {rows_from}) as row_count,"
        f" cast({columns} as int) as column_count"
    )


ORACLE_SQL = {name: _statement(body) for name, body in BODIES.items()}

_warehouse = [
    _counts(layer, name, f"({ORACLE_SQL[name]})", columns)
    for layer, tables in TABLE_COLUMNS.items()
    for name, columns in tables.items()
]
ORACLE_SQL["table_inventory"] = "\nunion all\n".join(_warehouse)

_processed = [
    _counts("processed", table, f"({with_ctes('select * from ' + source)})", len(columns.split()))
    for table, source, _, columns, _, _ in CHECKS
]
_others = [
    _counts("validation", "sales_reconciliation", f"({ORACLE_SQL['sales_reconciliation']})", 6),
    _counts("validation", "rejected_lines", f"({ORACLE_SQL['rejected_lines']})", 13),
    _counts("metadata", "quality_report", f"({ORACLE_SQL['quality_report']})", 6),
    _counts("metadata", "processed_table_summary", f"({ORACLE_SQL['processed_table_summary']})", 5),
    _counts("metadata", "table_inventory", f"({ORACLE_SQL['table_inventory']})", 4),
]
ORACLE_SQL["layer_publish"] = "\nunion all\n".join([*_processed, *_warehouse, *_others])
