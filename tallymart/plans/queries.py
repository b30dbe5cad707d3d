"""Registered queries: every operator run over the whole given tables.

Each takes (spark, folder of the input tables) and returns a DataFrame.
Queries about writing do the write under the shared folder and return what
they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import derived
from tallymart.functions import (
    detect_orders,
    export_name,
    parse_datetime,
    parse_detected,
    publish_path,
    rename_headers,
)
from tallymart.operators import (
    contract_checks,
    count_not_equal,
    distinct_count,
    duplicate_count,
    duplicate_rows_all,
    duplicate_rows_later,
    flag_membership,
    head_rows,
    mismatches,
    null_counts,
    profile_table,
    reconcile_counts,
    star_customers,
    star_orders,
    star_products,
    star_regions,
    tail_rows,
    value_counts,
)
from tallymart.plans.batch import (
    clean_lines,
    load,
    prepare_orders,
    prepare_people,
    run,
    standardise_lines,
)
from tallymart.schemas import (
    CUSTOMER_ID,
    CUSTOMERS_COLUMNS,
    DUPLICATE_KEYS,
    LINE_KEYS,
    ORDERS_COLUMNS,
    ORDERS_RENAMES,
    ORDERS_SHEET,
    PEOPLE_RENAMES,
    PEOPLE_SHEET,
    PRODUCTS_COLUMNS,
    RETURNS_SHEET,
    ROW_ORDER,
)
from tallymart.session import fresh_path
from tallymart.sinks import create_schema, export_delimited, publish
from tallymart.sinks.exports import CSV_OPTIONS, publish_scripts
from tallymart.sources import (
    Sheets,
    infer_types,
    read_cells,
    read_scripts,
    read_sheet,
    run_script,
    scan_table,
)
from tallymart.streaming import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

SCRIPTS = str(Path(__file__).parents[2] / "examples" / "sql")
RUN_DAY = date(2025, 3, 11)
LOOKED_UP_ORDER = "O-1"
LINE_SORT = (*LINE_KEYS, ROW_ORDER)
DIMENSIONS = {
    "customers": (star_customers, CUSTOMERS_COLUMNS),
    "products": (star_products, PRODUCTS_COLUMNS),
}


# Inputs shared by the queries -----------------------------------------------


def _lines(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return prepare_orders(derived.orders(spark, sf_dir), columns)


def _cleaned(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return clean_lines(_lines(spark, sf_dir, columns), derived.returns(spark, sf_dir))


def _unflagged(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """The dimensions do not need the returned flag, so no join either."""
    return standardise_lines(_lines(spark, sf_dir, columns))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_people(derived.people(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "orders":
        return star_orders(_cleaned(spark, sf_dir, ORDERS_COLUMNS))
    if name == "regions":
        return star_regions(_people(spark, sf_dir))
    split, columns = DIMENSIONS[name]
    return split(_unflagged(spark, sf_dir, columns))


def _customers_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_customers(_unflagged(spark, sf_dir, CUSTOMERS_COLUMNS), CUSTOMER_ID)


def _staged(df: DataFrame) -> DataFrame:
    """``df`` written once, for queries that use it several times."""
    path = fresh_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fresh_schema(spark: SparkSession) -> str:
    schema = f"sales_{uuid.uuid4().hex[:12]}"
    create_schema(spark, schema, fresh_path(spark, schema))
    return schema


def _sheets(spark: SparkSession, sf_dir: str) -> Sheets:
    return derived.sheets(
        derived.orders(spark, sf_dir),
        derived.people(spark, sf_dir),
        derived.returns(spark, sf_dir),
    )


# Sources --------------------------------------------------------------------


def _scan_sheet(name: str) -> Query:
    declared, renames = {
        "orders": (ORDERS_SHEET, ORDERS_RENAMES),
        "people": (PEOPLE_SHEET, PEOPLE_RENAMES),
        "returns": (RETURNS_SHEET, None),
    }[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, "batch")
        batch = derived.write_batch(_sheets(spark, sf_dir), path, [name])
        return rename_headers(read_sheet(spark, f"{batch}/{name}", declared), renames)

    return query


def infer_sheet_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of all columns of the three sheets, read off all of their cells."""
    batch = derived.write_batch(_sheets(spark, sf_dir), fresh_path(spark, "batch"))
    found = [
        infer_types(read_cells(spark, f"{batch}/{name}")).withColumn("sheet", F.lit(name))
        for name in derived.SHEETS
    ]
    return reduce(DataFrame.unionByName, found)


def _load_overwrite(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = _fresh_schema(spark)
        load(spark, {name: _star(spark, sf_dir, name)}, schema, mode="overwrite")
        return scan_table(spark, f"{schema}.{name}")

    return query


def _script_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": _star(spark, sf_dir, "orders"),
        "customers": _customers_by_id(spark, sf_dir),
        "regions": _star(spark, sf_dir, "regions"),
    }


def _run_script(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = read_scripts(spark, SCRIPTS)[name]
        tables = _script_tables(spark, sf_dir)
        return run_script(spark, text, **{t: df for t, df in tables.items() if f"{{{t}}}" in text})

    return query


# Sinks ----------------------------------------------------------------------


def _read_export(spark: SparkSession, path: str, columns) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def export_pipe_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export_delimited(
        _star(spark, sf_dir, "orders"),
        fresh_path(spark, "export"),
        resolutions={"order_date": "day", "ship_date": "day"},
    )
    return _read_export(spark, path, ORDERS_COLUMNS)


def export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    days = derived.table(spark, sf_dir, "orders").select(day.alias("day")).distinct()
    return days.select("day", export_name("monthly_sales", F.col("day")).alias("name")).select(
        "name", publish_path(F.col("name"), F.col("day")).alias("path")
    )


def export_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _staged(_star(spark, sf_dir, "products"))
    root = fresh_path(spark, "published")
    # Published twice: the second export replaces the first.
    publish(products, root, "products", RUN_DAY)
    path = publish(products, root, "products", RUN_DAY)
    published_as = F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1)
    return _read_export(spark, path, PRODUCTS_COLUMNS).withColumn("published_as", published_as)


def export_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as one file, published twice: the path is the file that the second one replaced."""
    products = _staged(_star(spark, sf_dir, "products"))
    root = fresh_path(spark, "published")
    publish(products.limit(1), root, "products", RUN_DAY, single_file=True)
    path = publish(products, root, "products", RUN_DAY, single_file=True)
    published_as = F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+/[^/]+)$", 1)
    return _read_export(spark, path, PRODUCTS_COLUMNS).withColumn("published_as", published_as)


def export_double_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles of many digits and all sizes, exported and read back as the text that stands in the file."""
    lines = derived.orders(spark, sf_dir).select(
        F.col("row_id").cast("string").alias("row_id"),
        *[F.expr(of).alias(name) for name, of in derived.DOUBLES_SQL.items()],
    )
    path = export_delimited(lines, fresh_path(spark, "export"))
    return _read_export(spark, path, lines.columns)


def _publish_script(name: str, columns: tuple[str, ...]) -> Query:
    """All scripts are published; what one of them published is read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = fresh_path(spark, "published")
        schema = _fresh_schema(spark)
        tables = _script_tables(spark, sf_dir)
        load(spark, tables, schema, mode="overwrite")
        loaded = {name: scan_table(spark, f"{schema}.{name}") for name in tables}
        paths = publish_scripts(spark, SCRIPTS, root, RUN_DAY, loaded, single_file=True)
        return _read_export(spark, paths[name], columns)

    return query


def _merge(name: str) -> Query:
    """The first batch overwrites the table, the second is merged into it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = derived.orders(spark, sf_dir)
        schema = _fresh_schema(spark)

        def star(part: DataFrame) -> dict[str, DataFrame]:
            if name == "orders":
                lines = prepare_orders(part, ORDERS_COLUMNS)
                return {name: star_orders(clean_lines(lines, derived.returns(spark, sf_dir)))}
            split, columns = DIMENSIONS[name]
            return {name: split(standardise_lines(prepare_orders(part, columns)))}

        load(spark, star(derived.first_batch(orders)), schema, mode="overwrite")
        staged = ("orders", "customers", "products")
        load(spark, star(derived.second_batch(orders)), schema, restage=staged)
        return scan_table(spark, f"{schema}.{name}")

    return query


def merge_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with a manager are loaded first, then all are merged."""
    regions = _star(spark, sf_dir, "regions")
    schema = _fresh_schema(spark)
    load(spark, {"regions": regions.where("manager IS NOT NULL")}, schema, mode="overwrite")
    load(spark, {"regions": regions}, schema)
    return scan_table(spark, f"{schema}.regions")


# Projections and filters ----------------------------------------------------


def rename_all_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_headers(_sheets(spark, sf_dir).orders, ORDERS_RENAMES)


def flag_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, LINE_KEYS)
    return flag_membership(lines, derived.returns(spark, sf_dir))


def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("order_id", "order_date", "ship_date", "product_id", "customer_id")
    lines = _lines(spark, sf_dir, columns)
    return lines.where(F.col("order_id") == LOOKED_UP_ORDER).select(*columns)


def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_membership(_lines(spark, sf_dir), derived.returns(spark, sf_dir))
    return flagged.where(F.col("order_id") == LOOKED_UP_ORDER)


def count_not_yes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_not_equal(derived.returns(spark, sf_dir), "returned", "Yes")


# Aggregation and quality ----------------------------------------------------


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_counts(_lines(spark, sf_dir, LINE_KEYS), derived.returns(spark, sf_dir))


def reconcile_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = reconcile_counts(_lines(spark, sf_dir, LINE_KEYS), derived.returns_bad(spark, sf_dir))
    return mismatches(counted)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, ("sales", "quantity", "discount", "profit"))


def dup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.orders(spark, sf_dir)
    return reduce(DataFrame.unionByName, [duplicate_count(lines, keys) for keys in DUPLICATE_KEYS])


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, CUSTOMER_ID)
    return distinct_count(lines, "customer_id").unionByName(distinct_count(lines, "product_id"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (*ORDERS_COLUMNS, *CUSTOMERS_COLUMNS, *PRODUCTS_COLUMNS)
    lines = _staged(_cleaned(spark, sf_dir, tuple(dict.fromkeys(columns))))
    return contract_checks(
        {
            "orders": (star_orders(lines), lines, None),
            "customers": (star_customers(lines, CUSTOMER_ID), lines, "customer_id"),
            "products": (star_products(lines), lines, "product_id"),
        }
    )


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = derived.orders(spark, sf_dir).select(
        *LINE_SORT,
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.date_format("ship_date", "yyyy-MM-dd HH:mm:ss").alias("ship_date"),
    )
    return text.withColumns({c: parse_datetime(F.col(c)) for c in ("order_date", "ship_date")})


def detect_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates day first or ISO from cell to cell, ship dates month first; nothing says which."""
    text = derived.orders(spark, sf_dir).select(
        *LINE_SORT,
        F.when(F.col("quantity") % 2 == 0, F.date_format("order_date", "dd/MM/yyyy"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
        .alias("order_date"),
        F.date_format("ship_date", "M/d/yyyy H:mm:ss").alias("ship_date"),
    )
    dates = ("order_date", "ship_date")
    orders = detect_orders(text, dates)
    found = {f"{c}_order": F.lit(orders[c]) for c in dates}
    return parse_detected(text, dates, orders=orders).withColumns(found)


# Interval ingestion ---------------------------------------------------------


def _two_batches(spark: SparkSession, sf_dir: str) -> str:
    """The folder of two batches that wait for their delivery."""
    parts = {"batch-1": derived.FIRST, "batch-2": derived.SECOND}
    orders, people = derived.orders(spark, sf_dir), derived.people(spark, sf_dir)
    returns = [(derived.returns(spark, sf_dir), list(parts))]
    return derived.write_batches(orders, people, returns, parts, fresh_path(spark, "batches"))


def incremental_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second one delivered twice."""
    schema, landing = _fresh_schema(spark), fresh_path(spark, "landing")
    batches = _two_batches(spark, sf_dir)
    first, second = [derived.deliver(spark, batches, f"batch-{n}", landing) for n in (1, 2)]
    for batch in (first, second, second):
        run(spark, batch, schema)
    return scan_table(spark, f"{schema}.orders")


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches picked up as they arrive, by a stream that is resumed."""
    schema, landing = _fresh_schema(spark), fresh_path(spark, "landing")
    checkpoint, batches = fresh_path(spark, "stream"), _two_batches(spark, sf_dir)
    for number in (1, 2):
        derived.deliver(spark, batches, f"batch-{number}", landing)
        ingest_available(spark, landing, schema, checkpoint)
    return scan_table(spark, f"{schema}.customers")


def incremental_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with missing merge keys and a bad one between them, all delivered again under a new checkpoint."""
    schema, landing = _fresh_schema(spark), fresh_path(spark, "landing")
    orders = derived.with_gaps(derived.orders(spark, sf_dir))
    people, returns = derived.people(spark, sf_dir), derived.returns(spark, sf_dir)
    unlike = derived.returns_bad(spark, sf_dir)
    parts = {"batch-1": derived.FIRST, "batch-2": derived.WHOLE, "batch-3": derived.SECOND}
    of = [(returns, ["batch-1", "batch-3"]), (unlike, ["batch-2"])]
    batches = derived.write_batches(orders, people, of, parts, fresh_path(spark, "batches"))
    for batch in parts:
        derived.deliver(spark, batches, batch, landing)
    for _ in range(2):
        ingest_available(spark, landing, schema, fresh_path(spark, "stream"))
    return scan_table(spark, f"{schema}.customers")


QUERIES: dict[str, Query] = {
    "scan_sheets": _scan_sheet("orders"),
    "scan_sheets_people": _scan_sheet("people"),
    "scan_sheets_returns": _scan_sheet("returns"),
    "infer_sheet_types": infer_sheet_types,
    "scan_table": _load_overwrite("customers"),
    "run_sql_script": _run_script("monthly_sales"),
    "run_sql_script_join": _run_script("returns_by_manager"),
    "load_overwrite": _load_overwrite("orders"),
    "load_overwrite_products": _load_overwrite("products"),
    "load_overwrite_regions": _load_overwrite("regions"),
    "merge_orders": _merge("orders"),
    "merge_customers": _merge("customers"),
    "merge_products": _merge("products"),
    "merge_regions": merge_regions,
    "export_pipe_csv": export_pipe_csv,
    "export_name": export_names,
    "export_partition": export_partition,
    "export_one_file": export_one_file,
    "export_double_text": export_double_text,
    "publish_scripts": _publish_script(
        "returns_by_manager", ("region", "manager", "returned", "order_lines", "sales")
    ),
    "publish_scripts_monthly": _publish_script(
        "monthly_sales",
        ("order_year", "order_month", "returned", "order_lines", "quantity", "sales", "profit"),
    ),
    "rename_headers": rename_all_headers,
    "clean_people": _people,
    "star_orders": lambda s, d: _star(s, d, "orders"),
    "star_customers": lambda s, d: _star(s, d, "customers"),
    "star_customers_by_id": _customers_by_id,
    "star_products": lambda s, d: _star(s, d, "products"),
    "star_regions": lambda s, d: _star(s, d, "regions"),
    "flag_returned": flag_returned,
    "filter_project": filter_project,
    "filter_rows": filter_rows,
    "count_not_yes": count_not_yes,
    "reconcile_counts": reconcile,
    "reconcile_mismatches": reconcile_mismatches,
    "collapse_order_lines": _lines,
    "round_measures": measures,
    "value_counts": lambda s, d: value_counts(_lines(s, d, LINE_KEYS), "order_id"),
    "value_counts_returns": lambda s, d: value_counts(derived.returns(s, d), "order_id"),
    "profile_table": lambda s, d: profile_table(rename_all_headers(s, d)),
    "null_counts": lambda s, d: null_counts(derived.orders(s, d)),
    "null_counts_returns": lambda s, d: null_counts(derived.returns(s, d)),
    "dup_count": dup_count,
    "dup_count_full": lambda s, d: duplicate_count(derived.returns(s, d)),
    "distinct_count": distinct_counts,
    "contract_checks": contracts,
    "dup_rows_all": lambda s, d: duplicate_rows_all(derived.orders(s, d), LINE_KEYS),
    "dup_rows_later": lambda s, d: duplicate_rows_later(derived.returns(s, d)),
    "head_rows": lambda s, d: head_rows(derived.orders(s, d), LINE_SORT),
    "tail_rows": lambda s, d: tail_rows(derived.orders(s, d), LINE_SORT),
    "std_null": lambda s, d: _cleaned(s, d).drop("grouped_order_id", "grouped_product_id"),
    "parse_dates": parse_dates,
    "detect_date_formats": detect_date_formats,
    "incremental_two_batches": incremental_two_batches,
    "incremental_stream": incremental_stream,
    "incremental_ledger": incremental_ledger,
}
