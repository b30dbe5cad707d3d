"""Order, people and returns sheets derived from order-line tables.

The same SQL runs on Spark and on an ANSI SQL engine; ``{table}`` marks an
input table. Defects the operators must handle are built in: padded and
"null" text, missing discounts, leading-zero post codes and repeated
(order, product) lines.

On Spark the orders sheet is the same joins in another order. The lines meet parts and suppliers while
they are narrow, since these joins are shuffles where the dimensions are large, and their orders last. That
join goes by the order id as the sheet spells it, so the lines are dealt by it, and what goes by order or by order
and product afterwards (the collapse, the returned flag) needs no shuffle of whole lines. The tasks
of that step follow the number of lines. The hint keeps it a sort-merge join: the size of a
join result is estimated far too high, and the lines themselves would be taken for the smaller side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import snake_case
from tallymart.schemas import (
    ORDERS_RENAMES,
    ORDERS_SHEET,
    PEOPLE_RENAMES,
    PEOPLE_SHEET,
    RETURNS_SHEET,
)
from tallymart.session import SIDE_BY_SIDE, steps
from tallymart.sinks import files
from tallymart.sources.sheets import CSV_OPTIONS, Sheets

# The input tables with their declared columns, so no read has to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

# How the sheet spells the key of an order, and the order lines of a task that joins them with their orders.
ORDER_ID = "concat('O-', CAST({} AS STRING))"
TASK_LINES = 500_000

# The cells of an order line.
ORDERS_CELLS = """\
       (CAST(l_linenumber AS BIGINT)*1000000 + l_suppkey)*100000000
         + CAST(round(l_extendedprice*100) AS BIGINT) AS row_id,
       concat('O-', CAST(l_orderkey AS STRING)) AS order_id,
       o_orderdate AS order_date, l_shipdate AS ship_date,
       CASE WHEN l_linestatus='O' THEN 'Second Class' ELSE ' Standard Class ' END AS ship_mode,
       concat('C-', CAST(o_custkey AS STRING)) AS customer_id, c_name AS customer_name,
       CASE WHEN c_mktsegment='MACHINERY' THEN ' Null ' ELSE c_mktsegment END AS segment,
       n_name AS country, concat('CITY_', CAST(s_nationkey AS STRING)) AS city,
       concat('PROV_', CAST(n_regionkey AS STRING)) AS province,
       lpad(CAST(s_nationkey AS STRING),5,'0') AS post_code, r_name AS region,
       concat('P-', CAST(l_partkey AS STRING)) AS product_id,
       p_type AS category, p_brand AS sub_category, p_name AS product_name,
       CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END AS discount,
       l_extendedprice AS sales, CAST(l_quantity AS BIGINT) AS quantity,
       l_extendedprice*(1-l_discount) - l_quantity*p_retailprice*0.5 AS profit
"""

ORDERS_SQL = f"""
SELECT /*+ MERGE(header) */
{ORDERS_CELLS}FROM {{lineitem}}
JOIN (SELECT o_orderkey, o_orderdate, o_custkey, c_name, c_mktsegment
      FROM {{orders}}
      JOIN {{customer}} ON o_custkey = c_custkey) AS header ON l_orderkey = o_orderkey
JOIN {{supplier}} ON l_suppkey = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey
JOIN {{region}} ON n_regionkey = r_regionkey
JOIN {{part}} ON l_partkey = p_partkey
"""

# One row per product of every returned order: the per-order counts agree.
RETURNS_SQL = """
SELECT order_id, returned FROM (
  SELECT DISTINCT concat('O-', CAST(l_orderkey AS STRING)) AS order_id, 'Yes' AS returned, l_partkey
  FROM {lineitem}
  WHERE l_orderkey IN (SELECT l_orderkey FROM {lineitem}
                       WHERE l_returnflag='R' AND l_linenumber=1)) AS t
"""

# Returned lines only: the per-order counts disagree.
RETURNS_BAD_SQL = """
SELECT concat('O-', CAST(l_orderkey AS STRING)) AS order_id, 'Yes' AS returned
FROM {lineitem} WHERE l_returnflag='R'
"""

PEOPLE_SQL = """
SELECT r_name AS region,
       CASE WHEN r_regionkey=0 THEN ' null ' ELSE concat(' Manager ', r_name, ' ') END AS manager
FROM {region}
UNION ALL
SELECT r_name, CASE WHEN r_regionkey=0 THEN ' null ' ELSE concat(' Manager ', r_name, ' ') END
FROM {region}
"""

# Orders before this instant form the first batch, the others the second.
BATCH_SPLIT = "TIMESTAMP '1998-01-01'"
FIRST, SECOND, WHOLE = f"order_date < {BATCH_SPLIT}", f"order_date >= {BATCH_SPLIT}", "true"


# Doubles with digits and exponents of all kinds.
DOUBLES_SQL = {
    "third": "sales / 3",
    "large": "sales * 1e13 / 7",
    "small": "profit / 7e9",
    "huge": "sales * sales * 1e200",
    "plain": "sales",
}

# Lines whose customer is a padded null text, which is a missing merge key once cleaned.
GAPS_SQL = "CASE WHEN quantity % 10 = 0 THEN ' null ' ELSE customer_id END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [name for name in TABLES if "{" + name + "}" in sql]
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in used})


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``ORDERS_SQL``, dealt by ``order_id``."""
    of = {name: table(spark, sf_dir, name) for name in TABLES}
    tasks = max(spark.sparkContext.defaultParallelism, of["lineitem"].count() // TASK_LINES)
    header = (
        of["orders"]
        .join(of["customer"], F.expr("o_custkey = c_custkey"))
        .select(F.expr(ORDER_ID.format("o_orderkey")).alias("order_id"), "o_orderdate", "o_custkey", "c_name", "c_mktsegment")
    )
    lines = (
        of["lineitem"]
        .join(of["part"], F.expr("l_partkey = p_partkey"))
        .join(of["supplier"], F.expr("l_suppkey = s_suppkey"))
        .withColumn("order_id", F.expr(ORDER_ID.format("l_orderkey")))
        .repartition(tasks, "order_id")
        .join(header.hint("merge"), "order_id")
        .join(of["nation"], F.expr("s_nationkey = n_nationkey"))
        .join(of["region"], F.expr("n_regionkey = r_regionkey"))
    )
    cells = ORDERS_CELLS.replace(ORDER_ID.format("l_orderkey") + " AS order_id", "order_id")
    return spark.sql(f"SELECT {cells} FROM {{lines}}", lines=lines)


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RETURNS_SQL)


def returns_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RETURNS_BAD_SQL)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PEOPLE_SQL)


def first_batch(orders: DataFrame) -> DataFrame:
    return orders.where(FIRST)


def second_batch(orders: DataFrame) -> DataFrame:
    return orders.where(SECOND)


def with_gaps(orders: DataFrame) -> DataFrame:
    return orders.withColumn("customer_id", F.expr(GAPS_SQL))


def _headed(sheet: dict[str, str], renames: dict[str, str]) -> list[Column]:
    """The columns of a derived table under the raw headers of its sheet."""
    names = {header: renames.get(header, snake_case(header)) for header in sheet}
    return [F.col(name).alias(header) for header, name in names.items()]


def sheets(orders: DataFrame, people: DataFrame, returns: DataFrame) -> Sheets:
    return Sheets(
        orders=orders.select(*_headed(ORDERS_SHEET, ORDERS_RENAMES)),
        people=people.select(*_headed(PEOPLE_SHEET, PEOPLE_RENAMES)),
        returns=returns.select(*_headed(RETURNS_SHEET, {})),
    )


SHEETS = ("orders", "people", "returns")


# The files are compressed, as exports of this size are; each is then read by one task.
WRITTEN = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"} | {"nullValue": "", "compression": "gzip"}


def write_batch(batch: Sheets, path: str, names: Sequence[str] = SHEETS) -> str:
    """Write the (named) sheets as a batch folder of CSV exports; a whole batch gets its READY marker last."""
    for name in names:
        getattr(batch, name).write.options(**WRITTEN).csv(f"{path}/{name}")
    if tuple(names) == SHEETS:
        _mark(batch.orders.sparkSession, path)
    return path


def _mark(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([("ready",)], "value string").coalesce(1).write.text(f"{path}/READY")


_BATCH = "__batch"


def _write_dealt(df: DataFrame, columns: list[Column], parts: Mapping[str, str], path: str, name: str) -> None:
    """Write the rows of a sheet to ``<path>/<batch>/<name>`` for every batch whose condition they meet, in one pass."""
    spark, dealt = df.sparkSession, f"{path}/{name}-of-{'-'.join(parts)}"
    batches = F.array_compact(F.array(*[F.when(F.expr(met), F.lit(batch)) for batch, met in parts.items()]))
    rows = df.select(*columns, F.explode(batches).alias(_BATCH))
    rows.write.options(**WRITTEN).partitionBy(_BATCH).csv(dealt)
    for batch in parts:
        files.make_folder(spark, f"{path}/{batch}")
        if files.exists(spark, f"{dealt}/{_BATCH}={batch}"):
            files.move(spark, f"{dealt}/{_BATCH}={batch}", f"{path}/{batch}/{name}")
        else:  # no rows, but headers
            df.limit(0).select(*columns).write.options(**WRITTEN).csv(f"{path}/{batch}/{name}")


def write_batches(
    orders: DataFrame, people: DataFrame, returns: Sequence[tuple[DataFrame, Sequence[str]]], parts: Mapping[str, str], path: str
) -> str:
    """The batches of ``parts``, not yet marked as ready, below ``path``. Each batch has the orders that meet its
    condition, all people, and the returns beside its name. What several batches share is derived once."""
    with steps(orders.sparkSession, SIDE_BY_SIDE):
        _write_dealt(orders, _headed(ORDERS_SHEET, ORDERS_RENAMES), parts, path, "orders")
        _write_dealt(people, _headed(PEOPLE_SHEET, PEOPLE_RENAMES), dict.fromkeys(parts, WHOLE), path, "people")
        for df, batches in returns:
            _write_dealt(df, _headed(RETURNS_SHEET, {}), dict.fromkeys(batches, WHOLE), path, "returns")
    return path


def deliver(spark: SparkSession, path: str, batch: str, landing: str) -> str:
    """A batch of ``write_batches`` arrives in the landing folder, its READY marker last."""
    files.make_folder(spark, landing)
    files.move(spark, f"{path}/{batch}", f"{landing}/{batch}")
    _mark(spark, f"{landing}/{batch}")
    return f"{landing}/{batch}"
