"""One batch: clean, collapse, reconcile, flag, split and load."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import rename_headers, round_measures, std_null
from tallymart.operators import (
    collapse,
    distinct_rows,
    flag_membership,
    require_reconciled,
    star_customers,
    star_orders,
    star_products,
    star_regions,
)
from tallymart.schemas import (
    CUSTOMER_ADDRESS,
    GROUPED_KEYS,
    LINE_KEYS,
    MERGE_KEYS,
    MONEY,
    ORDERS_RENAMES,
    PEOPLE_RENAMES,
    ROW_ORDER,
    WHOLE,
)
from tallymart.session import WIDE_STEPS, drop_shuffles, steps
from tallymart.sinks.tables import Layout, drop_stage, merge_insert_only, overwrite, stage
from tallymart.sources.sheets import Sheets, read_sheets

Mode = Literal["merge", "overwrite"]


@dataclass
class Measures:
    """Rows and missing cells per column of what a load writes, counted by the write itself.

    Each table is observed on its way to storage, so nothing is read once more.
    """

    observed: dict[str, Observation] = field(default_factory=dict)

    def of(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, measured under ``name`` by the first action that runs it."""
        self.observed[name] = Observation()
        missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing {c}") for c in df.columns]
        return df.observe(self.observed[name], F.count(F.lit(1)).alias("rows"), *missing)

    def report(self) -> LoadReport:
        found = {name: seen.get for name, seen in self.observed.items()}
        return LoadReport(
            {name: counts["rows"] for name, counts in found.items()},
            {
                name: {c.removeprefix("missing "): n for c, n in counts.items() if c != "rows"}
                for name, counts in found.items()
            },
        )


@dataclass(frozen=True)
class LoadReport:
    """What a batch brought: rows and missing cells of its cleaned lines (``lines``) and of each table.

    The fact table of a bucketed merge is not measured; its rows are those of the lines.
    """

    rows: dict[str, int]
    missing: dict[str, dict[str, int]]

    @property
    def checks(self) -> dict[str, bool]:
        """Contracts of the outputs: the fact table has the rows of the lines, a dimension at most as many and no row
        that lost its key on the way."""
        lines = self.rows["lines"]
        found = {"orders": self.rows["orders"] == lines} if "orders" in self.rows else {}
        for name in {"customers", "products"} & set(self.rows):
            keys = MERGE_KEYS[name]
            lost = any(self.missing[name][k] and not self.missing["lines"][k] for k in keys)
            found[name] = (self.rows[name] > 0) == (lines > 0) and self.rows[name] <= lines and not lost
        return found


OnMismatch = Literal["raise", "flag"]


def prepare_orders(sheet: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order lines with standard headers, collapsed and rounded.

    ``columns`` limits the result to the line keys and these columns, and with
    it what is read and shuffled; the default is the whole line.
    """
    lines = rename_headers(sheet, ORDERS_RENAMES)
    kept = lines.columns
    if columns is not None:
        kept = [c for c in kept if c in columns or c in LINE_KEYS]
        lines = lines.select(*dict.fromkeys([*kept, ROW_ORDER]))
    money, whole = [c for c in MONEY if c in kept], [c for c in WHOLE if c in kept]
    return round_measures(collapse(lines), money, whole).select(*kept)


def prepare_people(sheet: DataFrame) -> DataFrame:
    """Distinct people. Cells are cleaned after the distinct step, so rows that
    differ only by padding both stay."""
    return std_null(distinct_rows(rename_headers(sheet, PEOPLE_RENAMES, snake=False)))


def prepare_returns(sheet: DataFrame) -> DataFrame:
    return rename_headers(sheet)


def standardise_lines(lines: DataFrame) -> DataFrame:
    """Lines with standard missing values. The keys as grouped are kept beside
    the cleaned ones, because keep-first follows their order."""
    grouped = lines.withColumns({kept: F.col(key) for key, kept in GROUPED_KEYS.items()})
    return std_null(grouped, lines.columns)


def clean_lines(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """Standardised lines with the returned flag. One returned line flags its
    whole order. The lines are those of ``prepare_orders``, which have an order id."""
    return standardise_lines(flag_membership(lines, returns, missing=False))


def load(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    target: str,
    mode: Mode = "merge",
    buckets: int = 0,
    restage: Collection[str] = ("customers", "products", "regions"),
    token: str | None = None,
    done: Collection[str] = (),
    loaded: Callable[[str], None] = lambda name: None,
) -> None:
    """Load the star tables into schema ``target``, but those in ``done``.

    The four loads are independent and submitted together, so small tables do
    not wait for large ones. A merge into a bucketed table reads its source
    twice; there the sources in ``restage``, small results of larger work, go
    through a staging table. ``token`` makes merges repeatable; ``loaded`` is told each
    table that is loaded.
    """

    def one(name: str) -> None:
        if name not in done:
            write(name)
            loaded(name)

    def write(name: str) -> None:
        table, keys = f"{target}.{name}", MERGE_KEYS[name]
        layout = Layout(keys, buckets)
        if mode == "overwrite":
            overwrite(sources[name], table, layout)
            return
        if name not in restage or not buckets:
            merge_insert_only(spark, sources[name], table, keys, layout, token)
            return
        staged = stage(sources[name], table)
        try:
            merge_insert_only(spark, spark.table(staged), table, keys, layout, token)
        finally:
            drop_stage(spark, staged)

    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        for load_of in [pool.submit(one, name) for name in sources]:
            load_of.result()


def run_sheets(
    spark: SparkSession,
    sheets: Sheets,
    target: str,
    mode: Mode = "merge",
    on_mismatch: OnMismatch = "raise",
    customer_key: Sequence[str] = CUSTOMER_ADDRESS,
    buckets: int = 0,
    **progress,
) -> LoadReport:
    """Clean, check and load one batch into the tables of schema ``target``.

    The cleaned lines feed the check and three tables. They are written once
    to a staging table and read back column-pruned, which bounds memory and
    lets a lost executor cost a re-read, not a recomputation. The staging
    table is dropped at the end, whatever happens. ``progress`` goes to ``load``. The
    report counts what was written.
    """
    with steps(spark, WIDE_STEPS):
        returns, measures = prepare_returns(sheets.returns), Measures()
        cleaned = clean_lines(prepare_orders(sheets.orders), returns)
        lines_table = stage(measures.of("lines", cleaned), f"{target}.lines")
        try:
            lines = spark.table(lines_table)
            if on_mismatch == "raise":
                counted = lines.select(F.col(GROUPED_KEYS["order_id"]).alias("order_id"))
                require_reconciled(counted, returns)
            star = {
                "orders": star_orders(lines),
                "customers": star_customers(lines, customer_key),
                "products": star_products(lines),
                "regions": star_regions(prepare_people(sheets.people)),
            }
            star = {n: df for n, df in star.items() if n not in progress.get("done", ())}
            # a bucketed merge reads the fact rows twice, and a measure counts one reading
            once = [n for n in star if n != "orders" or not buckets or mode == "overwrite"]
            load(spark, star | {n: measures.of(n, star[n]) for n in once}, target, mode, buckets, **progress)
            return measures.report()
        finally:
            drop_stage(spark, lines_table)
            drop_shuffles(spark)


def run(
    spark: SparkSession,
    batch: str,
    target: str,
    fmt: str = "csv",
    *,
    date_format: str | None = None,
    multi_line: bool = False,
    **options,
) -> LoadReport:
    """Load the batch at path ``batch`` into schema ``target``."""
    sheets = read_sheets(spark, batch, fmt, date_format=date_format, multi_line=multi_line)
    return run_sheets(spark, sheets, target, **options)
