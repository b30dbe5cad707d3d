from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallymart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tallymart-tests",
        "local[8]",
        shuffle_partitions=4,
        **{
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A fresh catalog schema."""
    from tallymart.sinks import create_schema

    name = "t_" + "".join(ch for ch in tmp_path.name if ch.isalnum()).lower()
    create_schema(spark, name, str(tmp_path / "tables"))
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
