"""Tables, merges, exports, scripts and sheet reads, written and read back."""

from __future__ import annotations

import csv
import io
from datetime import date, datetime
from pathlib import Path

import pandas as pd
import pytest

from tallymart.functions.export_text import as_export_text
from tallymart.schemas import ORDERS_SHEET, RETURNS_SHEET
from tallymart.session import build_session, fresh_path, shared_folder
from tallymart.sinks import (
    Layout,
    create_schema,
    drop_stage,
    export_delimited,
    merge_insert_only,
    overwrite,
    publish,
    publish_scripts,
    stage,
)
from tallymart.sources import conform, read_scripts, read_sheet, run_script, scan_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def frame(spark, *data, schema="k string, v int"):
    return spark.createDataFrame(list(data), schema)


def text_of(path) -> str:
    parts = [Path(path)] if Path(path).is_file() else sorted(Path(path).glob("part-*.csv"))
    return "".join(p.read_text(encoding="utf-8") for p in parts)


# Tables ----------------------------------------------------------------------


def test_create_schema_twice(spark, tmp_path):
    for _ in range(2):
        create_schema(spark, "t_twice", str(tmp_path / "it's here"))
    assert spark.catalog.databaseExists("t_twice")
    spark.sql("DROP SCHEMA t_twice")


def test_overwrite_replaces_rows_and_schema(spark, schema):
    overwrite(frame(spark, ("a", 1), ("b", 2)), f"{schema}.t")
    assert rows(scan_table(spark, f"{schema}.t")) == [("a", 1), ("b", 2)]
    overwrite(frame(spark, (1.5,), schema="x double"), f"{schema}.t")
    assert rows(scan_table(spark, f"{schema}.t")) == [(1.5,)]


def test_stage_and_drop(spark, schema):
    name = stage(frame(spark, ("a", 1)), f"{schema}.t")
    assert name == f"{schema}.t_tmp" and rows(spark.table(name)) == [("a", 1)]
    assert rows(spark.table(stage(frame(spark, ("b", 2)), f"{schema}.t"))) == [("b", 2)]
    for _ in range(2):
        drop_stage(spark, name)
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("buckets", [0, 4])
def test_merge_insert_only(spark, schema, buckets):
    table, layout = f"{schema}.t", Layout(("k",), buckets)
    overwrite(frame(spark, ("a", 1), (None, 0)), table, layout)
    batch = frame(spark, ("a", 9), ("b", 2), ("b", 3), (None, 4))
    merge_insert_only(spark, batch, table, ("k",), layout)
    once = [("a", 1), ("b", 2), ("b", 3), (None, 0), (None, 4)]
    assert rows(spark.table(table)) == once
    merge_insert_only(spark, batch.where("k IS NOT NULL"), table, ("k",), layout)
    assert rows(spark.table(table)) == once


@pytest.mark.parametrize("buckets", [0, 4])
def test_merge_into_absent_table_inserts_all(spark, schema, buckets):
    table, layout = f"{schema}.t", Layout(("k",), buckets)
    merge_insert_only(spark, frame(spark, ("a", 1), ("b", 2)), table, ("k",), layout)
    assert rows(spark.table(table)) == [("a", 1), ("b", 2)]


def test_merge_matches_columns_by_name(spark, schema):
    overwrite(frame(spark, ("a", 1, 1.0), schema="k string, v int, w double"), f"{schema}.t")
    batch = frame(spark, (7, "b"), schema="v int, k string")
    merge_insert_only(spark, batch, f"{schema}.t", ("k",))
    assert rows(spark.table(f"{schema}.t")) == [("a", 1, 1.0), ("b", 7, None)]


def test_bucketed_target_is_not_shuffled(spark, schema, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    table, layout = f"{schema}.t", Layout(("k",), 4)
    overwrite(spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS v"), table, layout)
    from tallymart.operators import rows_to_insert

    source = spark.range(500, 1500).selectExpr("CAST(id AS string) AS k", "id AS v")
    new = rows_to_insert(source, spark.table(table), ("k",))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert new.count() == 500


def test_bucketed_overwrite_writes_one_file_per_bucket(spark, schema):
    table = f"{schema}.t"
    df = spark.range(0, 1000, 1, 8).selectExpr("CAST(id AS string) AS k", "id AS v")
    overwrite(df, table, Layout(("k",), 4))
    assert len(spark.table(table).inputFiles()) == 4


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark) + "/x-")


# Exports ---------------------------------------------------------------------


def test_export_equals_pandas_csv(spark, tmp_path):
    data = [
        ("x|y", 1.5, True, datetime(2021, 1, 2)),
        ('q"z', 317364757.31, False, datetime(2021, 1, 3)),
        ("  padded ", -0.25, True, None),
        (None, None, None, datetime(2021, 1, 4)),
        ("", 100.0, False, datetime(2021, 1, 5)),
        ("é é", 1e20, True, datetime(2021, 1, 6)),
        ("line\nbreak", 0.0, True, datetime(2021, 1, 6)),
    ]
    df = spark.createDataFrame(data, "t string, x double, b boolean, d timestamp_ntz").coalesce(1)
    path = export_delimited(df, str(tmp_path / "out"))
    expected = pd.DataFrame(data, columns=["t", "x", "b", "d"]).to_csv(
        sep="|", encoding="utf-8", index=False, header=True
    )
    assert text_of(path) == expected


def test_export_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    export_delimited(frame(spark, ("a", 1), ("b", 2)), path)
    export_delimited(frame(spark, ("c", 3)), path, single_file=True)
    assert text_of(path) == "k|v\nc|3\n"


def test_publish_under_year_and_month(spark, tmp_path):
    root = str(tmp_path / "root")
    path = publish(frame(spark, ("a", 1)), root, "report", date(2025, 3, 11), single_file=True)
    assert path == f"{root}/2025/March/report_2025-03-11.csv"
    assert text_of(path) == "k|v\na|1\n"


def test_publish_scripts_runs_each_sql_file(spark, schema, tmp_path):
    folder = tmp_path / "scripts"
    folder.mkdir()
    overwrite(frame(spark, ("a", 1), ("a", 2)), f"{schema}.t")
    (folder / "total.sql").write_text(f"SELECT k, sum(v) AS v\nFROM {schema}.t\nGROUP BY k;\n")
    (folder / "given.sql").write_text("SELECT k FROM {mine}")
    (folder / "notes.txt").write_text("not a script")
    for place in (str(folder), folder.as_uri()):
        assert list(read_scripts(spark, place)) == ["given", "total"]
    (folder / "given.sql").write_text(f"SELECT max(v) AS m FROM {schema}.t")
    paths = publish_scripts(spark, str(folder), str(tmp_path / "out"), date(2024, 12, 1), single_file=True)
    assert paths["total"].endswith("/2024/December/total_2024-12-01.csv")
    assert text_of(paths["total"]) == "k|v\na|3\n"
    assert text_of(paths["given"]) == "m\n2\n"


def test_run_script_with_given_tables(spark):
    out = run_script(spark, "SELECT k FROM {mine} WHERE v > 1", mine=frame(spark, ("a", 1), ("b", 2)))
    assert rows(out) == [("b",)]


# Sheets ----------------------------------------------------------------------


def write_csv(path: Path, header, *lines):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([header, *lines])
    path.mkdir(parents=True)
    (path / "part.csv").write_text(out.getvalue(), encoding="utf-8")
    return str(path)


ORDER_LINE = {
    "Row ID": "1", "Order ID": "O-1", "Order Date": "2021-01-02", "Ship Date": "2021-01-03 04:05:06",
    "Ship Mode": " First ", "Customer ID": "C-1", "Customer Name": 'A "B" C', "Segment": " null ",
    "Country/Region": "X, Y", "City": "N/A", "State/Province": "", "Postal Code": "01810",
    "Region": "East", "Product ID": "P-1", "Category": "None", "Sub-Category": "Null",
    "Product Name": "é|x", "Sales": "1.25", "Quantity": "2", "Discount": "NaN", "Profit": "-1e-3",
}


def test_read_sheet_types_tokens_and_padding(spark, tmp_path):
    path = write_csv(tmp_path / "orders", ORDER_LINE, ORDER_LINE.values())
    df = read_sheet(spark, path, ORDERS_SHEET)
    assert {c: t for c, t in df.dtypes} == ORDERS_SHEET
    assert df.first().asDict() == ORDER_LINE | {
        "Row ID": 1, "Order Date": datetime(2021, 1, 2), "Ship Date": datetime(2021, 1, 3, 4, 5, 6),
        "City": None, "State/Province": None, "Category": None, "Sales": 1.25, "Quantity": 2,
        "Discount": None, "Profit": -0.001,
    }


def test_read_sheet_fails_on_a_cell_that_does_not_fit(spark, tmp_path):
    path = write_csv(tmp_path / "orders", ORDER_LINE, (ORDER_LINE | {"Quantity": "two"}).values())
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_sheet(spark, path, ORDERS_SHEET).collect()


def test_read_sheet_finds_columns_by_name(spark, tmp_path):
    path = write_csv(tmp_path / "returns", ["note", " Order-ID", "RETURNED "], ["x", "O-1", "Yes"])
    df = read_sheet(spark, path, RETURNS_SHEET)
    assert df.columns == list(RETURNS_SHEET) and rows(df) == [("Yes", "O-1")]


@pytest.mark.parametrize("header", [["Order ID", "note"], ["Order ID", "Returned", "returned"]])
def test_read_sheet_names_an_absent_or_doubled_column(spark, tmp_path, header):
    path = write_csv(tmp_path / "returns", header, ["x"] * len(header))
    with pytest.raises(ValueError, match="needs one column 'Returned'"):
        read_sheet(spark, path, RETURNS_SHEET)


def test_read_sheet_rejects_files_with_unlike_headers(spark, tmp_path):
    path = Path(write_csv(tmp_path / "returns", ["Order ID", "Returned"], ["O-1", "Yes"]))
    (path / "more.csv").write_text("Returned,Order ID\nYes,O-2\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        read_sheet(spark, str(path), RETURNS_SHEET).collect()


def test_read_sheet_with_line_breaks_in_cells(spark, tmp_path):
    path = write_csv(tmp_path / "returns", RETURNS_SHEET, ["Yes", "O\n1"], ["No", "O-2"])
    assert rows(read_sheet(spark, path, RETURNS_SHEET, multi_line=True)) == [("No", "O-2"), ("Yes", "O\n1")]


def test_read_sheet_with_a_date_format(spark, tmp_path):
    line = ORDER_LINE | {"Order Date": "1/2/2021", "Ship Date": "N/A"}
    path = write_csv(tmp_path / "orders", ORDER_LINE, line.values())
    first = read_sheet(spark, path, ORDERS_SHEET, date_format="M/d/yyyy").first()
    assert (first["Order Date"], first["Ship Date"]) == (datetime(2021, 1, 2), None)


def test_read_sheet_from_parquet(spark, tmp_path):
    path = str(tmp_path / "returns")
    spark.createDataFrame([("Yes", "O-1"), ("NA", "O-2")], list(RETURNS_SHEET)).write.parquet(path)
    assert rows(read_sheet(spark, path, RETURNS_SHEET, "parquet")) == [("Yes", "O-1"), (None, "O-2")]


def test_conform_casts_typed_columns(spark):
    df = spark.createDataFrame([(1, "x")], "n int, t string")
    assert dict(conform(df, {"n": "bigint", "t": "string"}).dtypes) == {"n": "bigint", "t": "string"}


def test_build_session_reuses_the_session(spark):
    assert build_session("again", "local[8]").sparkContext.applicationId == spark.sparkContext.applicationId


@pytest.mark.parametrize("buckets", [0, 2])
def test_a_failing_overwrite_leaves_the_old_rows(spark, schema, buckets):
    table, layout = f"{schema}.kept", Layout(("id",), buckets)
    overwrite(spark.range(5), table, layout)
    failing = spark.range(3).selectExpr("if(id = 2, raise_error('bad cell'), id) AS id")
    with pytest.raises(Exception, match="bad cell"):
        overwrite(failing, table, layout)
    assert spark.table(table).count() == 5
    overwrite(spark.range(7), table, layout)
    assert spark.table(table).count() == 7


def test_float_columns_are_exported_by_their_own_digits(spark):
    df = spark.sql("SELECT CAST('1e20' AS FLOAT) AS a, CAST('12345678' AS FLOAT) AS b")
    assert tuple(as_export_text(df, {}).first()) == ("1e+20", "12345678.0")


def test_run_script_keeps_other_braces(spark):
    text = "SELECT get_json_object('{\"a\": {\"k\": 1}}', '$.a.k') AS x, k FROM {t}"
    assert rows(run_script(spark, text, t=frame(spark, ("b", 2)))) == [("1", "b")]
