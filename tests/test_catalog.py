import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from riskframe.catalog import loans
from riskframe.catalog.base import settle
from tests.conftest import DATA

ROOT = Path(__file__).resolve().parents[1]
SLOW = {"loan_model_table", "train_gbt", "train_forest", "train_logistic"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    want = duck.sql(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table(want.columns, want.fetchall())


def test_catalog_loads_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_whole_numbers_are_settled_without_rounding(spark):
    values = [0, 1, -5, 7, 999, 1000, -1001, 123456, 10**7, -(10**7) - 1, 2**31 - 1, 2**53 - 1, -(2**53), 2**62 + 1, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [r[0] for r in loans._comparable(df).collect()] == [r[0] for r in df.select(settle("v")).collect()]
    assert "round" not in loans._comparable(df)._jdf.queryExecution().optimizedPlan().toString()


def test_customers_are_spread_before_they_are_widened(spark):
    assert loans.flat_table(spark, DATA).rdd.getNumPartitions() >= 8  # a single small file
