"""The same queries as ANSI SQL over the given tables, for checking results.

Built from common table expressions: derived sheets, then collapsed, rounded,
flagged and cleaned lines, then the star tables.
"""

from __future__ import annotations

from pathlib import Path

from tallymart import derived
from tallymart.functions import export_name, publish_path, snake_case
from tallymart.plans.queries import LOOKED_UP_ORDER, RUN_DAY, SCRIPTS
from tallymart.schemas import (
    CUSTOMER_ADDRESS,
    CUSTOMER_ID,
    CUSTOMERS_COLUMNS,
    DUPLICATE_KEYS,
    LINE_KEYS,
    NA_TOKENS,
    ORDERS_COLUMNS,
    ORDERS_RENAMES,
    ORDERS_SHEET,
    PEOPLE_RENAMES,
    PEOPLE_SHEET,
    PRODUCT_ID,
    PRODUCTS_COLUMNS,
    RETURNS_SHEET,
    SUMMED,
)
from tallymart.sources.inference import ISO_TIMESTAMP, NUMBER, WHOLE_NUMBER

# Name -> declared type of the order lines, in sheet order.
LINES = {ORDERS_RENAMES.get(h, snake_case(h)): t for h, t in ORDERS_SHEET.items()}
TEXTS = [c for c, t in LINES.items() if t == "string"]


def _inline(sql: str) -> str:
    return sql.format(**{t: t for t in derived.TABLES})


SHEETS = {
    "fx_orders": _inline(derived.ORDERS_SQL),
    "fx_returns": _inline(derived.RETURNS_SQL),
    "fx_returns_bad": _inline(derived.RETURNS_BAD_SQL),
    "fx_people": _inline(derived.PEOPLE_SQL),
}


def _collapsed(source: str) -> str:
    def aggregate(c: str) -> str:
        if c in LINE_KEYS:
            return c
        if c in SUMMED:
            return f"CAST(coalesce(sum({c}), 0) AS {LINES[c].upper()}) AS {c}"
        return f"last({c} ORDER BY row_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"

    return (
        f"SELECT {', '.join(aggregate(c) for c in LINES)} FROM {source} "
        "WHERE order_id IS NOT NULL AND product_id IS NOT NULL GROUP BY order_id, product_id"
    )


def _clean(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ('null', '') THEN trim({c}) END AS {c}"


def _chain(source: str = "fx_orders", prefix: str = "") -> dict[str, str]:
    rounded = [f"round_even({c}, 2) AS {c}" for c in ("sales", "discount", "profit")]
    return {
        f"{prefix}collapsed": _collapsed(source),
        f"{prefix}lines": f"SELECT * REPLACE ({', '.join(rounded)}) FROM {prefix}collapsed",
        f"{prefix}flagged": (
            "SELECT *, CASE WHEN order_id IN (SELECT order_id FROM fx_returns) THEN 'Yes' "
            f"ELSE 'No' END AS returned FROM {prefix}lines"
        ),
        f"{prefix}cleaned": (
            f"SELECT * REPLACE ({', '.join(_clean(c) for c in TEXTS)}) FROM {prefix}flagged"
        ),
    }


def _keep_first(source: str, columns, subset) -> str:
    return (
        f"SELECT {', '.join(columns)} FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(subset)} ORDER BY order_id, product_id) = 1"
    )


def _star(prefix: str = "") -> dict[str, str]:
    cleaned = f"{prefix}cleaned"
    return {
        f"{prefix}star_orders": f"SELECT {', '.join(ORDERS_COLUMNS)} FROM {cleaned}",
        f"{prefix}star_customers": _keep_first(cleaned, CUSTOMERS_COLUMNS, CUSTOMER_ADDRESS),
        f"{prefix}star_customers_by_id": _keep_first(cleaned, CUSTOMERS_COLUMNS, CUSTOMER_ID),
        f"{prefix}star_products": _keep_first(cleaned, PRODUCTS_COLUMNS, PRODUCT_ID),
    }


PEOPLE = {
    "star_regions": (
        f"SELECT {_clean('region')}, {_clean('manager')} FROM (SELECT DISTINCT * FROM fx_people) t"
    )
}

BATCHES = {
    "batch_1": f"SELECT * FROM fx_orders WHERE order_date < {derived.BATCH_SPLIT}",
    "batch_2": f"SELECT * FROM fx_orders WHERE order_date >= {derived.BATCH_SPLIT}",
    "gap_orders": f"SELECT * REPLACE ({derived.GAPS_SQL} AS customer_id) FROM fx_orders",
    "gap_1": f"SELECT * FROM gap_orders WHERE order_date < {derived.BATCH_SPLIT}",
    "gap_2": f"SELECT * FROM gap_orders WHERE order_date >= {derived.BATCH_SPLIT}",
}

ALL = (
    SHEETS
    | _chain()
    | _star()
    | PEOPLE
    | BATCHES
    | _chain("batch_1", "b1_")
    | _chain("batch_2", "b2_")
    | _star("b1_")
    | _star("b2_")
    | _chain("gap_1", "g1_")
    | _chain("gap_2", "g2_")
    | _star("g1_")
    | _star("g2_")
)


def _query(body: str) -> str:
    """``body`` below the expressions it needs, directly or through others."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
        for name in ALL:
            if name in words and name not in needed:
                visit(ALL[name])
                needed.append(name)

    visit(body)
    ctes = ", ".join(f"{name} AS ({ALL[name].strip()})" for name in needed)
    return f"WITH {ctes} {body}" if needed else body


def _table(name: str) -> str:
    return _query(f"SELECT * FROM {name}")


def _merged(name: str, keys, first: str = "b1_", second: str = "b2_") -> str:
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return _query(
        f"SELECT * FROM {first}{name} UNION ALL SELECT * FROM {second}{name} AS s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {first}{name} AS t WHERE {match})"
    )


def _script(name: str) -> str:
    text = (Path(SCRIPTS) / f"{name}.sql").read_text(encoding="utf-8")
    return _query(
        text.format(orders="star_orders", customers="star_customers_by_id", regions="star_regions")
    )


def _as_text(c: str) -> str:
    if c in ("order_date", "ship_date"):
        return f"strftime({c}, '%Y-%m-%d') AS {c}"
    return f"CAST({c} AS VARCHAR) AS {c}"


def _null_counts(source: str, columns) -> str:
    each = [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {source}" for c in columns
    ]
    return _query(" UNION ALL ".join(each))


def _profile(source: str) -> str:
    each = [
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS type, "
        f"count({c}) AS non_null, count(*) AS \"rows\" FROM {source}"
        for i, (c, t) in enumerate(LINES.items())
    ]
    return _query(" UNION ALL ".join(each))


def _dup_count(source: str, subset) -> str:
    keys = ", ".join(subset)
    return (
        f"SELECT '{keys}' AS subset, CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS duplicates "
        f"FROM (SELECT count(*) AS copies FROM {source} GROUP BY {keys}) t"
    )


def _distinct_count(source: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(DISTINCT {column}) "
        f"+ coalesce(max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0) AS distinct_values "
        f"FROM {source}"
    )


def _contract(output: str, table: str, demanded: str, columns: int) -> str:
    rows = f"(SELECT count(*) FROM {table})"
    expected = f"(SELECT {demanded} FROM cleaned)"
    return (
        f"SELECT '{output}' AS output, {rows} AS \"rows\", {expected} AS expected_rows, "
        f"CAST({columns} AS BIGINT) AS columns, {rows} = {expected} AS holds"
    )


def _inferred(sheet: str, source: str, headers: dict[str, str]) -> str:
    """Types of the columns of a sheet, ``headers`` naming the column of each header."""
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)

    def one(position: int, header: str, column: str) -> str:
        whole = f"regexp_matches(x, '{WHOLE_NUMBER}')"
        fits = "try_cast(x AS BIGINT) IS NOT NULL"
        return (
            f"SELECT '{sheet}' AS sheet, CAST({position} AS BIGINT) AS position, '{header}' AS \"column\", "
            "CASE WHEN count(x) = 0 THEN 'string' "
            "WHEN bool_and(lower(x) IN ('true', 'false')) THEN 'boolean' "
            f"WHEN bool_and({whole} AND {fits}) THEN 'bigint' "
            f"WHEN bool_and(regexp_matches(x, '{NUMBER}') AND (NOT {whole} OR {fits})) THEN 'double' "
            f"WHEN bool_and(regexp_matches(x, '{ISO_TIMESTAMP}')) THEN 'timestamp_ntz' ELSE 'string' END AS type, "
            f"count(x) AS present, count(*) AS \"rows\" FROM (SELECT CASE WHEN CAST({column} AS VARCHAR) "
            f"NOT IN ({tokens}) THEN CAST({column} AS VARCHAR) END AS x FROM {source}) t"
        )

    return " UNION ALL ".join(one(i, h, c) for i, (h, c) in enumerate(headers.items()))


RECONCILED = """
SELECT o.order_id, o.orders_oid_count, r.returns_oid_count
FROM (SELECT order_id, count(*) AS orders_oid_count FROM lines GROUP BY order_id) AS o
JOIN (SELECT order_id, count(*) AS returns_oid_count FROM {returns} GROUP BY order_id) AS r
  ON o.order_id = r.order_id
"""

_VALUE_COUNTS = (
    'SELECT order_id, count(*) AS "count" FROM {source} WHERE order_id IS NOT NULL GROUP BY order_id'
)
_PUBLISHED = publish_path(export_name("products", RUN_DAY), RUN_DAY)

MONTHLY = ("order_year", "order_month", "order_lines", "quantity", "sales", "profit")

ORACLES: dict[str, str] = {
    "scan_sheets": _table("fx_orders"),
    "scan_sheets_people": _table("fx_people"),
    "scan_sheets_returns": _table("fx_returns"),
    "infer_sheet_types": _query(
        " UNION ALL ".join(
            [
                _inferred("orders", "fx_orders", {h: ORDERS_RENAMES.get(h, snake_case(h)) for h in ORDERS_SHEET}),
                _inferred("people", "fx_people", {h: PEOPLE_RENAMES[h] for h in PEOPLE_SHEET}),
                _inferred("returns", "fx_returns", {h: snake_case(h) for h in RETURNS_SHEET}),
            ]
        )
    ),
    "scan_table": _table("star_customers"),
    "run_sql_script": _script("monthly_sales"),
    "run_sql_script_join": _script("returns_by_manager"),
    "load_overwrite": _table("star_orders"),
    "load_overwrite_products": _table("star_products"),
    "load_overwrite_regions": _table("star_regions"),
    "merge_orders": _merged("star_orders", LINE_KEYS),
    "merge_customers": _merged("star_customers", CUSTOMER_ID),
    "merge_products": _merged("star_products", PRODUCT_ID),
    "merge_regions": _query(
        "SELECT * FROM star_regions WHERE manager IS NOT NULL UNION ALL "
        "SELECT * FROM star_regions AS s WHERE NOT EXISTS (SELECT 1 FROM star_regions AS t "
        "WHERE t.manager IS NOT NULL AND t.region = s.region)"
    ),
    "export_pipe_csv": _query(
        f"SELECT {', '.join(_as_text(c) for c in ORDERS_COLUMNS)} FROM star_orders"
    ),
    "export_name": (
        "SELECT DISTINCT concat('monthly_sales_', strftime(o_orderdate, '%Y-%m-%d'), '.csv') AS name, "
        "concat(strftime(o_orderdate, '%Y/%B'), '/monthly_sales_', "
        "strftime(o_orderdate, '%Y-%m-%d'), '.csv') AS path FROM orders"
    ),
    "export_partition": _query(f"SELECT *, '{_PUBLISHED}' AS published_as FROM star_products"),
    "export_one_file": _query(f"SELECT *, '{_PUBLISHED}' AS published_as FROM star_products"),
    "export_double_text": _query(
        "SELECT CAST(row_id AS VARCHAR) AS row_id, "
        + ", ".join(f"CAST({of} AS VARCHAR) AS {name}" for name, of in derived.DOUBLES_SQL.items())
        + " FROM fx_orders"
    ),
    "publish_scripts_monthly": _query(
        f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in MONTHLY)}) "
        f"FROM ({_script('monthly_sales')}) t"
    ),
    "publish_scripts": _query(
        "SELECT region, manager, returned, CAST(order_lines AS VARCHAR) AS order_lines, "
        f"CAST(sales AS VARCHAR) AS sales FROM ({_script('returns_by_manager')}) t"
    ),
    "rename_headers": _table("fx_orders"),
    "clean_people": _table("star_regions"),
    "star_orders": _table("star_orders"),
    "star_customers": _table("star_customers"),
    "star_customers_by_id": _table("star_customers_by_id"),
    "star_products": _table("star_products"),
    "star_regions": _table("star_regions"),
    "flag_returned": _query("SELECT order_id, product_id, returned FROM flagged"),
    "filter_project": _query(
        "SELECT order_id, order_date, ship_date, product_id, customer_id FROM lines "
        f"WHERE order_id = '{LOOKED_UP_ORDER}'"
    ),
    "filter_rows": _query(f"SELECT * FROM flagged WHERE order_id = '{LOOKED_UP_ORDER}'"),
    "count_not_yes": _query(
        "SELECT count(*) AS \"rows\" FROM fx_returns WHERE returned IS DISTINCT FROM 'Yes'"
    ),
    "reconcile_counts": _query(RECONCILED.format(returns="fx_returns")),
    "reconcile_mismatches": _query(
        RECONCILED.format(returns="fx_returns_bad")
        + "WHERE o.orders_oid_count <> r.returns_oid_count"
    ),
    "collapse_order_lines": _table("lines"),
    "round_measures": _query(
        "SELECT order_id, product_id, sales, quantity, discount, profit FROM lines"
    ),
    "value_counts": _query(_VALUE_COUNTS.format(source="lines")),
    "value_counts_returns": _query(_VALUE_COUNTS.format(source="fx_returns")),
    "profile_table": _profile("fx_orders"),
    "null_counts": _null_counts("fx_orders", LINES),
    "null_counts_returns": _null_counts("fx_returns", ("order_id", "returned")),
    "dup_count": _query(" UNION ALL ".join(_dup_count("fx_orders", k) for k in DUPLICATE_KEYS)),
    "dup_count_full": _query(_dup_count("fx_returns", ("order_id", "returned"))),
    "distinct_count": _query(
        " UNION ALL ".join(_distinct_count("lines", c) for c in ("customer_id", "product_id"))
    ),
    "contract_checks": _query(
        " UNION ALL ".join(
            [
                _contract("orders", "star_orders", "count(*)", 11),
                _contract("customers", "star_customers_by_id", "count(DISTINCT customer_id)", 8),
                _contract("products", "star_products", "count(DISTINCT product_id)", 4),
            ]
        )
    ),
    "dup_rows_all": _query(
        "SELECT * FROM fx_orders QUALIFY count(*) OVER (PARTITION BY order_id, product_id) > 1"
    ),
    "dup_rows_later": _query(
        "SELECT * FROM fx_returns QUALIFY row_number() OVER (PARTITION BY order_id, returned) > 1"
    ),
    "head_rows": _query("SELECT * FROM fx_orders ORDER BY order_id, product_id, row_id LIMIT 5"),
    "tail_rows": _query(
        "SELECT * FROM fx_orders ORDER BY order_id DESC, product_id DESC, row_id DESC LIMIT 5"
    ),
    "std_null": _table("cleaned"),
    "parse_dates": _query(
        "SELECT order_id, product_id, row_id, date_trunc('day', order_date) AS order_date, "
        "date_trunc('second', ship_date) AS ship_date FROM fx_orders"
    ),
    "detect_date_formats": _query(
        "SELECT order_id, product_id, row_id, date_trunc('day', order_date) AS order_date, "
        "date_trunc('second', ship_date) AS ship_date, 'dmy' AS order_date_order, "
        "'mdy' AS ship_date_order FROM fx_orders"
    ),
    "incremental_two_batches": _merged("star_orders", LINE_KEYS),
    "incremental_stream": _merged("star_customers", CUSTOMER_ID),
    "incremental_ledger": _merged("star_customers", CUSTOMER_ID, "g1_", "g2_"),
}
