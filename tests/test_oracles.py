"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import compare, database
from conftest import TABLES

import __spark_entry__ as driver
from skytune.oracles import ORACLES
from skytune.registry import QUERIES

WITHOUT_SQL = {"rf_train", "rf_importance", "rf_weather"}


@pytest.fixture(scope="module")
def db():
    return database(TABLES)


def test_every_query_but_the_forests_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    report = compare(spark, db, TABLES, name)
    assert report.startswith(f"{name}: ok") and "TYPES" not in report, report


@pytest.mark.parametrize("name", ["weather_model", "combined_mart", "listening_hourly"])
def test_shuffled_joins_give_the_same(spark, db, name):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        report = compare(spark, db, TABLES, name)
    finally:
        spark.conf.set(limit, before)
    assert report.startswith(f"{name}: ok"), report


def test_forest_over_saved_model(spark):
    row = driver.queries()["rf_weather"](spark, TABLES).first()
    assert row.n > 0 and row.r2 > 0.8


def test_entry(spark):
    assert driver.entry(spark).count() > 0
