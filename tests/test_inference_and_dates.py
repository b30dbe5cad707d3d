"""Types and date orders that nothing declares, double texts, and exports as one file."""

from __future__ import annotations

import random
import struct
from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest

from tallymart.functions import AmbiguousDates, UnreadableDates, detect_orders, parse_detected
from tallymart.functions.export_text import float_text
from tallymart.sinks import export_delimited, files
from tallymart.sources import infer_types, read_inferred
from tallymart.sources.inference import fitting_types
from tests.test_tables_and_exports import frame, rows, text_of, write_csv

# Inference -------------------------------------------------------------------

COLUMNS = {
    "whole": (["1", "-20", "NA", "0"], "bigint"),
    "measure": (["1", "2.5", "", "-1e-3"], "double"),
    "point": ([".5", "5.", "0.0", "7"], "double"),
    "code": (["01810", "2", "3", "4"], "string"),
    "long": (["1", "12345678901234567890", "2", "3"], "string"),
    "flag": (["true", "FALSE", "null", "True"], "boolean"),
    "day": (["2021-01-02", "2021-02-28 10:11:12", "N/A", "2021-01-02T01:02"], "timestamp_ntz"),
    "no day": (["2021-02-30", "2021-01-01", "2021-01-01", "2021-01-01"], "string"),
    "empty": (["", "NA", "None", "nan"], "string"),
    "mixed": (["1", "x", "2", "3"], "string"),
    "padded": ([" 1", "2", "3", "4"], "string"),
}


def test_types_are_the_narrowest_that_fit_all_cells(spark, tmp_path):
    path = write_csv(tmp_path / "s", COLUMNS, *zip(*(c for c, _ in COLUMNS.values()), strict=True))
    df = read_inferred(spark, path)
    assert dict(df.dtypes) == {name: kind for name, (_, kind) in COLUMNS.items()}
    first = df.collect()
    assert first[1]["whole"] == -20 and first[3]["measure"] == -0.001 and first[0]["code"] == "01810"
    assert first[1]["day"] == datetime(2021, 2, 28, 10, 11, 12) and first[2]["flag"] is None


def test_one_late_cell_of_many_files_decides(spark, tmp_path):
    spark.range(0, 10_000, 1, 8).selectExpr("if(id = 9999, 'x', CAST(id AS string)) AS a", "id AS b").write.option(
        "header", True
    ).csv(str(tmp_path / "s"))
    assert dict(read_inferred(spark, str(tmp_path / "s")).dtypes) == {"a": "string", "b": "bigint"}


def test_inferred_types_of_empty_and_typed_tables(spark):
    empty = spark.createDataFrame([], "a string, b double")
    found = [tuple(r) for r in infer_types(empty).orderBy("position").collect()]
    assert found == [(0, "a", "string", 0, 0), (1, "b", "double", 0, 0)]
    odd = spark.createDataFrame([("1", None), (None, "x")], ["all rows", "mask 0"])
    assert [(r["column"], r["type"]) for r in infer_types(odd).collect()] == [("all rows", "bigint"), ("mask 0", "string")]


def test_a_cell_is_matched_against_few_patterns(spark):
    df = spark.createDataFrame([("x",)], "a string")
    assert df.select(fitting_types(df["a"]).alias("m"))._jdf.queryExecution().analyzed().toString().count("RLIKE") == 3


# Dates -----------------------------------------------------------------------


def dates(spark, *cells):
    return spark.createDataFrame([(c,) for c in cells], "d string")


@pytest.mark.parametrize(
    ("cells", "order", "expected"),
    [
        (["13/02/2021", "2021-03-04", "01.02.2021", None], "dmy", [(2021, 2, 13), (2021, 3, 4), (2021, 2, 1), None]),
        (["2/13/2021 4:05", "01/02/2021"], "mdy", [(2021, 2, 13, 4, 5), (2021, 1, 2)]),
        (["2021-01-02T03:04:05.25", "2021/1/2", "20210102"], "ymd", [(2021, 1, 2, 3, 4, 5, 250000), (2021, 1, 2), (2021, 1, 2)]),
        (["2 Jan 2021", "Feb 3, 2021", "4-March-2021", "sept. 5, 2021"], "ymd", [(2021, 1, 2), (2021, 2, 3), (2021, 3, 4), (2021, 9, 5)]),
        (["01/01/2021", "2/2/2021"], "mdy", [(2021, 1, 1), (2021, 2, 2)]),
        ([None, ""], "ymd", [None, None]),
    ],
)
def test_the_order_of_dates_is_read_off_the_column(spark, cells, order, expected):
    df = dates(spark, *cells)
    assert detect_orders(df, ["d"]) == {"d": order}
    found = [r["d"] for r in parse_detected(df, ["d"]).collect()]
    assert found == [e and datetime(*e) for e in expected]


def test_dates_are_read_by_orders_found_before(spark):
    df = dates(spark, "13/02/2021 1:02:60\n", "2021-01-02\n", "Feb 3, 2021 24:00", None)
    found = [r["d"] for r in parse_detected(df, ["d"], orders={"d": "dmy"}).collect()]
    assert found == [datetime(2021, 2, 13, 1, 3), datetime(2021, 1, 2), None, None]


def test_dates_that_can_be_read_two_ways_are_refused(spark):
    df = dates(spark, "01/02/2021", "03/03/2021")
    with pytest.raises(AmbiguousDates, match="1 cells of 'd'"):
        parse_detected(df, ["d"])
    assert parse_detected(df, ["d"], prefer="dmy").first()["d"] == datetime(2021, 2, 1)


@pytest.mark.parametrize("cell", ["13/13/2021", "2021-02-30", "soon", "31/02/2021", "1/2/21", "2021-1/2"])
def test_dates_that_cannot_be_read_are_refused(spark, cell):
    with pytest.raises(UnreadableDates):
        detect_orders(dates(spark, cell, "2021-01-01"), ["d"])


def test_a_column_of_both_orders_is_refused(spark):
    with pytest.raises(UnreadableDates, match="'d'"):
        detect_orders(dates(spark, "13/01/2021", "01/13/2021"), ["d"])


# Double texts ----------------------------------------------------------------


def all_kinds():
    rng = random.Random(7)
    some = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(60_000)]
    some += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(40_000)]
    some += [round(rng.uniform(0, 1e6), 2) for _ in range(5_000)]
    some += [s * 2.0**k for k in range(-1074, 1024) for s in (1, -1)]
    some += [5e-324, 2e-322, 2.2250738585072014e-308, 1.7976931348623157e308, 2e23, 9007199254740993.0, 1e16, 1e15]
    return [*some, 123456789012345680.0, 0.0, -0.0, 1e22, 1e21, 0.1 + 0.2, 1e-4, 9.999e-5, float("inf"), -float("inf")]


def test_double_texts_equal_those_of_pandas(spark):
    values = [v for v in all_kinds() if v == v]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values})).repartition(8)
    found = [r["t"] for r in df.select("i", float_text(df["x"]).alias("t")).orderBy("i").collect()]
    expected = pd.Series(values).to_csv(index=False, header=False).split("\n")[:-1]
    wrong = [(v, f, e) for v, f, e in zip(values, found, expected, strict=True) if f != e]
    # a 17th digit may be another one that reads back
    assert len(wrong) <= 5 and all(float(f) == v and len(f) == len(e) for v, f, e in wrong), wrong[:10]


def test_double_texts_are_exact_without_a_search_per_cell(spark):
    values = [v for v in all_kinds() if v == v]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values})).repartition(8)
    text = df.select("i", float_text(df["x"]).alias("t"))
    assert "lambda" not in text._jdf.queryExecution().executedPlan().toString()
    assert [r["t"] for r in text.orderBy("i").collect()] == [repr(v) for v in values]


def test_missing_doubles_are_empty(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r["t"] for r in df.select(float_text(df["x"]).alias("t")).collect()] == [None, None]


# Exports ---------------------------------------------------------------------


def test_a_single_file_export_is_one_file(spark, tmp_path):
    path = tmp_path / "a b" / "out.csv"
    export_delimited(frame(spark, ("a", 1), ("b", 2)), str(path), single_file=True)
    assert path.is_file() and text_of(path) == "k|v\na|1\nb|2\n"
    export_delimited(frame(spark, ("c", 3)).limit(0), str(path), single_file=True)
    assert path.is_file() and text_of(path) == "k|v\n"
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["out.csv"]


@pytest.mark.parametrize("single_file", [True, False])
@pytest.mark.parametrize("was_file", [True, False])
def test_a_failed_export_leaves_the_old_one(spark, tmp_path, single_file, was_file):
    path = str(tmp_path / "out")
    export_delimited(frame(spark, ("a", 1)).coalesce(1), path, single_file=was_file)
    bad = frame(spark, ("a", 1)).selectExpr("if(v = 1, raise_error('bad cell'), k) AS k")
    with pytest.raises(Exception, match="bad cell"):
        export_delimited(bad, path, single_file=single_file)
    assert text_of(path) == "k|v\na|1\n"
    for call in ("replace_file", "move"):
        export_delimited(frame(spark, ("a", 1)).coalesce(1), path, single_file=was_file)
        real, stopped = getattr(files, call), False
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(files, call, lambda s, a, b: real(s, a, b) if (a + b).count(".old") else _fail())
            try:
                export_delimited(frame(spark, ("b", 2)).coalesce(1), path, single_file=single_file)
            except RuntimeError:
                stopped = True
        assert text_of(path) == ("k|v\na|1\n" if stopped else "k|v\nb|2\n")
    export_delimited(frame(spark, ("c", 3)).coalesce(1), path, single_file=single_file)
    assert text_of(path) == "k|v\nc|3\n" and Path(path).is_file() == single_file
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out"]


def _fail():
    raise RuntimeError("stopped")
