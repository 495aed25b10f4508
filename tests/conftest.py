from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

DATA = os.environ.get("LEDGERLINE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    """Rows with columns by name, in order, floats to six digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(round(row[i], 6)) if isinstance(row[i], float) else str(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="session")
def agrees(spark, duck, sf_dir):
    """Holds a query's rows against those of its SQL."""

    def check(query, sql):
        found, expected = query(spark, sf_dir), duck.sql(sql)
        assert sorted(found.columns) == sorted(expected.columns)
        assert comparable(found.columns, found.collect()) == comparable(expected.columns, expected.fetchall())

    return check
