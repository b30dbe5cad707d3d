"""Overwrites that are stopped at any step, merges that are repeated, and the ledger of batches."""

from __future__ import annotations

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart import derived
from tallymart.functions import rename_headers
from tallymart.plans import queries, run_sheets
from tallymart.schemas import MERGE_KEYS, ORDERS_RENAMES, PEOPLE_RENAMES, PEOPLE_SHEET
from tallymart.session import WIDE_STEPS
from tallymart.sinks import Layout, compact, files, merge_insert_only, overwrite, recover, tables
from tallymart.sources.sheets import Sheets, read_sheet, read_sheets
from tallymart.streaming import Ledger, ingest_available, ingest_batches, ledger
from tests.test_pipeline import FIRST, TABLES, batch, loaded, odd_tables  # noqa: F401
from tests.test_tables_and_exports import frame, rows


class Stopped(Exception):
    pass


def stop_at(monkeypatch, module, name, step, after):
    """Make the ``step``-th call of a function fail, before or after it has done its work."""
    calls, real = [0], getattr(module, name)

    def called(*args):
        calls[0] += 1
        if calls[0] == step and not after:
            raise Stopped
        result = real(*args)
        if calls[0] == step:
            raise Stopped
        return result

    monkeypatch.setattr(module, name, called)


# Versions --------------------------------------------------------------------


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", [1, 2, 3])
@pytest.mark.parametrize("case", ["first", "same", "other columns", "other buckets"])
def test_a_stopped_overwrite_leaves_old_or_new_rows(spark, schema, case, step, after):
    table, old, new = f"{schema}.t", [("a", 1), ("b", 2)], [("c", 3), ("d", 4), ("e", 5)]
    if case != "first":
        overwrite(frame(spark, *old), table)
    made = frame(spark, *new)
    if case == "other columns":
        made = made.withColumn("v", F.col("v").cast("bigint"))
    layout = Layout(("k",), 2) if case == "other buckets" else None
    with pytest.MonkeyPatch.context() as patch:
        stop_at(patch, tables, "_run", step, after)
        try:
            overwrite(made, table, layout)
        except Stopped:
            pass
    added = [("x", 8), ("y", 9)]
    merge_insert_only(spark, frame(spark, *added), table, ("k",))
    assert rows(spark.table(table)) in ([*(old if case != "first" else []), *added], [*new, *added])
    overwrite(frame(spark, *new), table)
    assert rows(spark.table(table)) == new
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_a_failing_write_leaves_the_old_rows_and_no_entry(spark, schema):
    table = f"{schema}.t"
    overwrite(spark.range(5), table)
    with pytest.raises(Exception, match="bad cell"):
        overwrite(spark.range(3).selectExpr("if(id = 2, raise_error('bad cell'), id) AS id"), table)
    recover(spark, table)
    assert spark.table(table).count() == 5
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_a_version_becomes_current_where_it_was_written(spark, schema):
    table, seen = f"{schema}.t", []
    for n in range(5):
        overwrite(spark.range(n + 1), table)
        seen.append(set(spark.table(table).inputFiles()))
        folder = f"{tables._versions_folder(spark, table)}"
        assert len(files.names(spark, folder)) == min(n + 1, tables.KEPT_VERSIONS)
        assert all(f.startswith("file:") and ".versions/" in f for f in seen[-1])
    assert len({tables.generation(spark, table)}) == 1 and not seen[3] & seen[4]
    reader = spark.table(table)
    overwrite(reader.where("id > 1"), table)  # from its own rows
    assert rows(spark.table(table)) == [(2,), (3,), (4,)]


@pytest.mark.parametrize("buckets", [0, 2])
def test_small_merges_leave_a_bounded_number_of_files(spark, schema, buckets):
    table, layout = f"{schema}.t", Layout(("k",), buckets)
    overwrite(frame(spark, ("a", 0), (None, 0)), table, layout)
    began, done = tables.generation(spark, table), []
    for n in range(1, 9):
        merge_insert_only(spark, frame(spark, (f"k{n}", n)), table, ("k",), layout, token=f"t{n}")
        done.append(compact(spark, table, layout, max_files=4))
        assert len(files.data_files(spark, tables.location(spark, table))) <= 4
    assert any(done) and tables.generation(spark, table) == began
    assert rows(spark.table(table)) == [("a", 0), *((f"k{n}", n) for n in range(1, 9)), (None, 0)]


# Merges under a token --------------------------------------------------------


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_merge_under_a_token_can_be_repeated(spark, schema, buckets):
    table, layout = f"{schema}.t", Layout(("k",), buckets)
    overwrite(frame(spark, ("a", 1), (None, 0)), table, layout)
    source = frame(spark, ("a", 9), ("b", 2), ("b", 3), (None, 4), (None, 4))
    for _ in range(3):
        merge_insert_only(spark, source, table, ("k",), layout, token="one")
        assert rows(spark.table(table)) == [("a", 1), ("b", 2), ("b", 3), (None, 0), (None, 4), (None, 4)]
    merge_insert_only(spark, source.where("k IS NULL"), table, ("k",), layout, token="two")
    assert spark.table(table).where("k IS NULL").count() == 5
    assert sorted(t.name for t in spark.catalog.listTables(schema)) == ["t"]
    if buckets:
        plan = spark.table(table).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", [1, 2])
def test_a_merge_stopped_between_files_is_completed_once(spark, schema, step, after):
    table = f"{schema}.t"
    overwrite(frame(spark, ("a", 1)), table)
    source = spark.range(0, 40, 1, 4).selectExpr("if(id % 4 = 0, NULL, CAST(id AS string)) AS k", "CAST(id AS int) AS v")
    with pytest.MonkeyPatch.context() as patch:
        stop_at(patch, files, "move", step, after)
        with pytest.raises(Stopped):
            merge_insert_only(spark, source, table, ("k",), token="t1")
    merge_insert_only(spark, source, table, ("k",), token="t1")
    assert rows(spark.table(table)) == rows(source.unionByName(frame(spark, ("a", 1))))


def test_a_merge_under_a_token_matches_columns_by_name(spark, schema):
    overwrite(frame(spark, ("a", 1, 1.0), schema="k string, v int, w double"), f"{schema}.t")
    merge_insert_only(spark, frame(spark, (7, "b"), schema="v int, k string"), f"{schema}.t", ("k",), token="x")
    assert rows(spark.table(f"{schema}.t")) == [("a", 1, 1.0), ("b", 7, None)]
    with pytest.raises(ValueError, match="no columns other"):
        merge_insert_only(spark, frame(spark, ("c", 1), schema="k string, other int"), f"{schema}.t", ("k",), token="x")


# Ledger ----------------------------------------------------------------------

GAPS = [{"Sales": 2.0, "Customer ID": " null "}, {"Order ID": "O-5", "Customer ID": "C-5"}]


def land(spark, landing, **batches):
    for name, made in batches.items():
        derived.write_batch(made, f"{landing}/{name}")
    return [f"{landing}/{name}" for name in batches]


def test_a_bad_batch_is_set_aside_and_replays_add_nothing(spark, schema, tmp_path):
    landing = str(tmp_path / "landing")
    paths = land(
        spark, landing,
        b1=batch(spark, FIRST, ["O-1", "O-1"]),
        b2=batch(spark, [{"Order ID": "O-7"}, {"Order ID": "O-7", "Product ID": "P-7"}], ["O-7"]),
        b3=batch(spark, GAPS),
    )
    ingest_available(spark, landing, schema, str(tmp_path / "s1"))
    once = loaded(spark, schema)
    assert len([r for r in once["customers"] if r[0] is None]) == 1
    assert not [r for r in once["orders"] if r[0] == "O-7"] and [r for r in once["orders"] if r[0] == "O-5"]
    (aside,) = Ledger(spark, schema).quarantined().collect()
    assert aside.batch.endswith("/b2") and "different number of times" in aside.reason and aside.attempt == 1

    ingest_available(spark, landing, schema, str(tmp_path / "s2"))  # a lost checkpoint
    states = ingest_batches(spark, paths, schema)
    assert loaded(spark, schema) == once
    assert list(states.values()) == [ledger.LOADED, ledger.QUARANTINED, ledger.LOADED]


def test_a_mended_batch_is_released(spark, schema, tmp_path):
    (path,) = land(spark, str(tmp_path), b=batch(spark, [{"Order ID": "O-7"}, {"Order ID": "O-7", "Product ID": "P-7"}], ["O-7"]))
    assert ingest_batches(spark, [path], schema) == {path: ledger.QUARANTINED}
    assert ingest_batches(spark, [path], schema, on_mismatch="flag") == {path: ledger.QUARANTINED}
    Ledger(spark, schema).release(path)
    assert Ledger(spark, schema).quarantined().count() == 0
    assert ingest_batches(spark, [path], schema, on_mismatch="flag") == {path: ledger.LOADED}
    assert len(loaded(spark, schema)["orders"]) == 2


@pytest.mark.parametrize("cell", [{"Quantity": "two"}, {"Order Date": "soon"}])
def test_cells_that_do_not_fit_set_a_batch_aside(spark, schema, tmp_path, cell):
    (path,) = land(spark, str(tmp_path), b=batch(spark, FIRST, ["O-1", "O-1"]))
    header = next(iter(cell))
    orders = spark.read.option("header", True).csv(f"{path}/orders").withColumn(header, F.lit(cell[header]))
    bad = str(tmp_path / "bad")
    for name in ("people", "returns"):
        spark.read.option("header", True).csv(f"{path}/{name}").write.option("header", True).csv(f"{bad}/{name}")
    orders.write.option("header", True).csv(f"{bad}/orders")
    assert ingest_batches(spark, [bad, path], schema) == {bad: ledger.QUARANTINED, path: ledger.LOADED}


def test_an_interrupted_batch_is_completed_and_counts_once(spark, schema, tmp_path):
    (path,) = land(spark, str(tmp_path), b=batch(spark, [*GAPS, {"Order ID": "O-6", "Customer ID": "C-6"}]))
    with pytest.MonkeyPatch.context() as patch:
        stop_at(patch, files, "move", 3, True)
        with pytest.raises(Stopped):
            ingest_batches(spark, [path], schema)
    assert Ledger(spark, schema).loaded(path) < set(TABLES)
    assert ingest_batches(spark, [path, path], schema) == {path: ledger.LOADED}
    tables_now = loaded(spark, schema)
    assert sorted(str(r[0]) for r in tables_now["customers"]) == ["C-5", "C-6", "None"]
    assert len(tables_now["orders"]) == 3 and Ledger(spark, schema).loaded(path) == set(MERGE_KEYS)
    last = Ledger(spark, schema).latest(path)
    assert last[ledger.WHOLE_BATCH][0] == ledger.LOADED and last[ledger.WHOLE_BATCH][2] == 2


def test_dropped_tables_take_their_batches_again_and_the_ledger_stays_small(spark, schema, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_FILES", 4)
    paths = land(spark, str(tmp_path), b1=batch(spark, FIRST, ["O-1", "O-1"]), b2=batch(spark, GAPS))
    ingest_batches(spark, paths, schema)
    once = loaded(spark, schema)
    spark.sql(f"DROP TABLE {schema}.customers")
    ingest_batches(spark, paths, schema)
    assert loaded(spark, schema) == once
    assert len(Ledger(spark, schema).rows().inputFiles()) <= 4 + 6


def test_batches_are_written_compressed_and_read_back(spark, tmp_path):
    people = spark.createDataFrame([(" M ", "a,b"), ("null", 'say "x"'), (None, "c")], "`Regional Manager` string, Region string")
    path = derived.write_batch(Sheets(None, people, None), str(tmp_path / "batch"), ["people"])
    assert all(n.endswith(".csv.gz") for n in files.data_files(spark, f"{path}/people"))
    found = read_sheet(spark, f"{path}/people", PEOPLE_SHEET).collect()
    assert {tuple(r) for r in found} == {(" M ", "a,b"), (None, 'say "x"'), (None, "c")}


def shuffle_files(spark):
    """The shuffle files in the folders of the session."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_a_batch_leaves_no_shuffle_files_and_no_settings(spark, schema, tmp_path):
    made = batch(spark, FIRST, ["O-1", "O-1"])
    before, settings = shuffle_files(spark), {key: spark.conf.get(key, None) for key in WIDE_STEPS}
    run_sheets(spark, made, schema, token="t")
    deadline = time.time() + 20
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert {key: spark.conf.get(key, None) for key in WIDE_STEPS} == settings


def test_batches_of_one_pass_are_those_written_one_by_one(spark, tmp_path):
    days = [datetime(1997, 12, 31), datetime(1998, 1, 1), None, datetime(1999, 1, 1)]
    lines = [{"Row ID": i, "Order ID": f"O-{i}", "Order Date": day, "Segment": f" {i} "} for i, day in enumerate(days)]
    sheets = batch(spark, lines, ["O-0", "O-3"], people=[("A", "East"), ("A", "East")])
    orders = rename_headers(sheets.orders, ORDERS_RENAMES)
    people, returns = rename_headers(sheets.people, PEOPLE_RENAMES, snake=False), rename_headers(sheets.returns)
    unlike = returns.limit(1)
    parts = {"b1": derived.FIRST, "b2": derived.WHOLE, "b3": derived.SECOND, "b4": "order_date IS NULL AND row_id < 0"}
    waiting = derived.write_batches(orders, people, [(returns, ["b1", "b3", "b4"]), (unlike, ["b2"])], parts, str(tmp_path / "waiting"))
    for name, met in parts.items():
        assert not files.exists(spark, f"{waiting}/{name}/READY")
        path = derived.deliver(spark, waiting, name, str(tmp_path / "landing"))
        alone = derived.sheets(orders.where(met), people, unlike if name == "b2" else returns)
        expected = read_sheets(spark, derived.write_batch(alone, str(tmp_path / "alone" / name)))
        found = read_sheets(spark, path)
        assert files.exists(spark, f"{path}/READY")
        for sheet in derived.SHEETS:
            assert rows(getattr(found, sheet)) == rows(getattr(expected, sheet))
            assert all(n.endswith(".csv.gz") for n in files.data_files(spark, f"{path}/{sheet}"))


def test_the_orders_sheet_of_all_batches_is_derived_once(spark, odd_tables, monkeypatch):
    made, sheet = [], derived.orders
    monkeypatch.setattr(derived, "orders", lambda *args: made.append(args) or sheet(*args))
    written, write = [], derived._write_dealt
    monkeypatch.setattr(derived, "_write_dealt", lambda *args: written.append(args[-1]) or write(*args))
    queries.incremental_ledger(spark, odd_tables)
    assert len(made) == 1 and written == ["orders", "people", "returns", "returns"]
