"""Whole batches: check, load, rerun and pick up as they arrive."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime

import pytest

from tallymart import derived
from tallymart.operators import ReconciliationError
from tallymart.plans import queries
from tallymart.plans import clean_lines, prepare_orders, prepare_people, run, run_sheets
from tallymart.operators import star_customers
from tallymart.schemas import CUSTOMER_ID, ORDERS_SHEET, PEOPLE_SHEET, RETURNS_SHEET
from tallymart.sinks import publish
from tallymart.sources import Sheets, read_sheets
from tallymart.streaming import ingest_available, ingest_batches

TABLES = ("orders", "customers", "products", "regions")
DEFAULTS = {
    "Row ID": 1, "Order ID": "O-1", "Order Date": datetime(2021, 1, 2),
    "Ship Date": datetime(2021, 1, 3), "Ship Mode": "First", "Customer ID": "C-1",
    "Customer Name": "Ann", "Segment": "Home", "Country/Region": "X", "City": "Y",
    "State/Province": "Z", "Postal Code": "01810", "Region": "East", "Product ID": "P-1",
    "Category": "Cat", "Sub-Category": "Sub", "Product Name": "Pen", "Sales": 1.0, "Quantity": 1,
    "Discount": 0.1, "Profit": 0.5,
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def frame(spark, sheet, data):
    schema = ", ".join(f"`{h}` {t}" for h, t in sheet.items())
    return spark.createDataFrame(data, schema)


def batch(spark, lines, returned=(), people=(("Bob", "East"),)):
    """Sheets from order-line overrides, returned order ids and (manager, region)."""
    orders = [tuple((DEFAULTS | {"Row ID": i} | line).values()) for i, line in enumerate(lines)]
    return Sheets(
        orders=frame(spark, ORDERS_SHEET, orders),
        people=frame(spark, PEOPLE_SHEET, list(people)),
        returns=frame(spark, RETURNS_SHEET, [("Yes", o) for o in returned]),
    )


def loaded(spark, schema):
    return {t: rows(spark.table(f"{schema}.{t}")) for t in TABLES}


FIRST = [
    {"Sales": 1.004}, {"Sales": 2.004, "Discount": None}, {"Product ID": "P-2", "Segment": " NULL "},
    {"Order ID": "O-2", "City": "Other"}, {"Order ID": None},
]


def test_run_sheets_loads_the_star(spark, schema):
    run_sheets(spark, batch(spark, FIRST, ["O-1", "O-1"]), schema)
    tables = loaded(spark, schema)
    day, ship = datetime(2021, 1, 2), datetime(2021, 1, 3)
    assert tables["orders"] == [
        ("O-1", day, ship, "First", "C-1", "P-1", 3.01, 2, 0.1, 1.0, "Yes"),
        ("O-1", day, ship, "First", "C-1", "P-2", 1.0, 1, 0.1, 0.5, "Yes"),
        ("O-2", day, ship, "First", "C-1", "P-1", 1.0, 1, 0.1, 0.5, "No"),
    ]
    assert tables["customers"] == [
        ("C-1", "Ann", "Home", "X", "Other", "Z", "01810", "East"),
        ("C-1", "Ann", "Home", "X", "Y", "Z", "01810", "East"),
    ]
    assert [p[0] for p in tables["products"]] == ["P-1", "P-2"]
    assert tables["regions"] == [("East", "Bob")]
    assert sorted(t.name for t in spark.catalog.listTables(schema)) == sorted(TABLES)


def test_rerun_and_second_batch_only_insert(spark, schema):
    first = batch(spark, FIRST, ["O-1", "O-1"])
    run_sheets(spark, first, schema)
    once = loaded(spark, schema)
    run_sheets(spark, first, schema)
    assert loaded(spark, schema) == once
    second = batch(
        spark, [{"Sales": 99.0}, {"Order ID": "O-3", "Customer ID": "C-2"}, {"Order ID": "O-3", "Customer ID": "C-2", "City": "New"}],
        people=[("Changed", "East"), ("Eve", "West")],
    )
    run_sheets(spark, second, schema)
    after = loaded(spark, schema)
    assert set(after["orders"]) - set(once["orders"]) == {
        r for r in after["orders"] if r[0] == "O-3"
    } and len(after["orders"]) == len(once["orders"]) + 1
    assert [r[0] for r in after["customers"]] == ["C-1", "C-1", "C-2"]
    assert after["regions"] == [("East", "Bob"), ("West", "Eve")]


def test_overwrite_mode_and_customer_key(spark, schema):
    run_sheets(spark, batch(spark, [{"Order ID": "old"}]), schema)
    run_sheets(spark, batch(spark, FIRST), schema, mode="overwrite", customer_key=CUSTOMER_ID)
    tables = loaded(spark, schema)
    assert {r[0] for r in tables["orders"]} == {"O-1", "O-2"}
    assert [r[:5] for r in tables["customers"]] == [("C-1", "Ann", "Home", "X", "Y")]


def test_bucketed_targets_give_the_same_tables(spark, schema):
    sheets = batch(spark, FIRST, ["O-1", "O-1"])
    run_sheets(spark, sheets, schema)
    plain = loaded(spark, schema)
    for table in TABLES:
        spark.sql(f"DROP TABLE {schema}.{table}")
    for _ in range(2):
        run_sheets(spark, sheets, schema, buckets=4)
    assert loaded(spark, schema) == plain


def test_mismatch_raises_and_loads_nothing(spark, schema):
    sheets = batch(spark, FIRST, ["O-1"])
    with pytest.raises(ReconciliationError, match="1 shared order_id"):
        run_sheets(spark, sheets, schema)
    assert spark.catalog.listTables(schema) == []
    run_sheets(spark, sheets, schema, on_mismatch="flag")
    assert {(r[0], r[-1]) for r in loaded(spark, schema)["orders"]} == {("O-1", "Yes"), ("O-2", "No")}


def test_padded_null_text_can_win_last(spark):
    lines = clean_lines(
        prepare_orders(batch(spark, [{"Segment": "Home"}, {"Segment": " null "}]).orders.toDF(*[
            c for c in ORDERS_SHEET
        ])),
        batch(spark, FIRST).returns.withColumnRenamed("Order ID", "order_id"),
    )
    assert [r["segment"] for r in lines.collect()] == [None]


def test_people_are_distinct_before_cleaning(spark):
    people = batch(spark, FIRST, people=[("A", "East"), ("A", " East"), ("A", "East"), (" null ", "W")]).people
    assert rows(prepare_people(people)) == [("A", "East"), ("A", "East"), (None, "W")]


def test_keep_first_follows_the_keys_as_grouped(spark):
    """' Z' sorts before 'A' as grouped, although 'Z' sorts after it cleaned."""
    sheets = batch(spark, [{"Order ID": "A", "Customer Name": "second"}, {"Order ID": " Z", "Customer Name": "first"}])
    lines = clean_lines(prepare_orders(sheets.orders), sheets.returns.withColumnRenamed("Order ID", "order_id"))
    assert [r["customer_name"] for r in star_customers(lines, CUSTOMER_ID).collect()] == ["first"]


def test_csv_batches_and_stream_agree(spark, schema, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "stream")
    first = batch(spark, FIRST, ["O-1", "O-1"])
    second = batch(spark, [{"Order ID": "O-9", "Sales": 5.555}], people=[(" null ", "North")])
    derived.write_batch(first, f"{landing}/b1")
    ingest_available(spark, landing, schema, checkpoint)
    alone = loaded(spark, schema)
    ingest_available(spark, landing, schema, checkpoint)
    assert loaded(spark, schema) == alone
    derived.write_batch(second, f"{landing}/b2")
    ingest_available(spark, landing, schema, checkpoint)
    streamed = loaded(spark, schema)
    assert ("North", None) in streamed["regions"] and len(streamed["orders"]) == 4

    for table in TABLES:
        spark.sql(f"DROP TABLE {schema}.{table}")
    ingest_batches(spark, [f"{landing}/b1", f"{landing}/b2", f"{landing}/b2"], schema)
    assert loaded(spark, schema) == streamed


def test_written_sheets_read_back_the_same(spark, tmp_path):
    sheets = batch(spark, FIRST, ["O-1", "O-1"], people=[(" null ", " East "), (None, 'a "b", c')])
    back = read_sheets(spark, derived.write_batch(sheets, str(tmp_path / "b")))
    for name in ("orders", "people", "returns"):
        assert rows(getattr(back, name)) == rows(getattr(sheets, name))
        assert getattr(back, name).dtypes == getattr(sheets, name).dtypes


def test_run_takes_a_parquet_batch(spark, schema, tmp_path):
    sheets = batch(spark, FIRST, ["O-1", "O-1"])
    for name in ("orders", "people", "returns"):
        getattr(sheets, name).write.parquet(f"{tmp_path}/b/{name}")
    run(spark, f"{tmp_path}/b", schema, fmt="parquet")
    assert len(loaded(spark, schema)["orders"]) == 3


def test_only_whole_batches_are_ingested_whatever_their_age(spark, schema, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "stream")
    derived.write_batch(batch(spark, FIRST, ["O-1", "O-1"]), str(landing / "b1"))
    ingest_available(spark, str(landing), schema, checkpoint)
    before = loaded(spark, schema)
    late = batch(spark, [{"Order ID": "O-9", "Sales": 5.555}])
    for name in derived.SHEETS:
        derived.write_batch(late, str(landing / "b2"), [name])
        ingest_available(spark, str(landing), schema, checkpoint)
        assert loaded(spark, schema) == before
    (landing / "b2" / "READY").write_text("ready")
    month = 30 * 24 * 3600
    for path in [p for p in (landing / "b2").rglob("*") if p.is_file()]:
        os.utime(path, (path.stat().st_mtime - month,) * 2)
    ingest_available(spark, str(landing), schema, checkpoint)
    assert len(loaded(spark, schema)["orders"]) == len(before["orders"]) + 1


@pytest.mark.parametrize("options", [{}, {"mode": "overwrite"}, {"buckets": 2}])
def test_a_load_reports_what_it_wrote(spark, schema, options):
    sheets = batch(spark, [*FIRST, {"Order ID": "O-4", "Customer ID": " null ", "Discount": None}], ["O-1", "O-1"])
    for _ in range(2):
        report = run_sheets(spark, sheets, schema, **options)
        tables = {"lines": 4, "orders": 4, "customers": 3, "products": 2, "regions": 1}
        assert report.rows == {n: c for n, c in tables.items() if n != "orders" or not options.get("buckets")}
        assert report.missing["lines"]["discount"] == 1 and report.missing["lines"]["segment"] == 1
        assert report.missing["customers"]["customer_id"] == 1
        assert all(report.checks.values()) and {"customers", "products"} <= set(report.checks)


ODD_TABLES = {
    "region": [(0, "AFRICA"), (1, "ASIA"), (None, "NOWHERE")],
    "nation": [(k, f"NATION_{k}", k % 2) for k in range(4)] + [(4, "LOST", None)],
    "customer": [(k, f"Customer {k}", k % 4, 1.0, "MACHINERY" if k % 3 else "AUTO") for k in range(9)] + [(3, "Twice", 1, 1.0, None)],
    "supplier": [(k, f"Supplier {k}", k % 5, 1.0) for k in range(7)] + [(None, "None", 1, 1.0), (8, "No nation", None, 1.0)],
    "part": [(k, f"Part {k}", f"Brand {k % 3}", "TIN", 1, 10.0 + k) for k in range(12)] + [(2, "Twice", "Brand", "TIN", 1, 3.0)],
    "orders": [(k, k % 10 or None, "O", 1.0, datetime(1998, 1, 1 + k % 28), "1-URGENT") for k in range(60)]
    + [(7, 1, "O", 1.0, None, "LOW"), (None, 2, "O", 1.0, None, "LOW")],
    "lineitem": [
        (k % 65, k % 13, k % 9, k % 7, 1.0 + k % 50, 100.0 + k, k % 4 / 100, 0.0, "RN"[k % 2], "OF"[k % 3 > 0], datetime(1998, 2, 1 + k % 28))
        for k in range(600)
    ]
    + [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "O", None), (5, None, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "O", None)],
}


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, rows in ODD_TABLES.items():
        spark.createDataFrame(rows, derived.TABLES[name]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_the_orders_sheet_is_that_of_its_sql(spark, odd_tables):
    found = derived.orders(spark, odd_tables)
    expected = derived.derive(spark, odd_tables, derived.ORDERS_SQL)
    assert found.schema.simpleString() == expected.schema.simpleString()
    was, now = (Counter(map(tuple, df.collect())) for df in (expected, found))
    assert now == was and len(now) > 300


def test_whole_lines_are_dealt_once(spark, conf, odd_tables):
    # only what is as small as nations is broadcast
    nations = sum(os.path.getsize(f"{odd_tables}/nation.parquet/{f}") for f in os.listdir(f"{odd_tables}/nation.parquet"))
    conf(spark__sql__autoBroadcastJoinThreshold=str(nations), spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    cleaned = clean_lines(prepare_orders(derived.orders(spark, odd_tables)), derived.returns(spark, odd_tables))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange" in line and "order_id" in line]
    assert "REPARTITION_BY_NUM" in plan
    assert not [line for line in dealt if "product_id" in line or "coalesce(order_id" in line], dealt
    assert cleaned.where("returned = 'Yes'").count() and cleaned.where("returned = 'No'").count()


def test_contracts_and_exports_make_the_lines_once(spark, odd_tables, monkeypatch):
    made, published, sheet = [], [], derived.orders
    monkeypatch.setattr(derived, "orders", lambda *args: made.append(args) or sheet(*args))
    checks = {r.output: r for r in queries.contracts(spark, odd_tables).collect()}
    assert len(made) == 1
    assert all(r.holds and r.rows for r in checks.values()) and set(checks) == {"orders", "customers", "products"}
    monkeypatch.setattr(queries, "publish", lambda df, *args, **options: published.append(df) or publish(df, *args, **options))
    products = queries.export_one_file(spark, odd_tables).count()
    assert products == checks["products"].rows == queries.export_partition(spark, odd_tables).count()
    assert len(published) == 4 and all("/staged-" in f for df in published for f in df.inputFiles())
