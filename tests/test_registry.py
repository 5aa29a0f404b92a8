"""Every registered query equals its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as driver
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = oracle.spark_rows(driver.queries()[name](spark, SF_DIR))
    assert got == oracle.duck_rows(duck, driver.oracle_sql()[name])


def test_lookup_with_merged_partitions(spark, duck):
    """Spark's own merging of small partitions, which the other tests switch off."""
    merging = spark.newSession()
    merging.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = oracle.spark_rows(driver.queries()["parsed_codes_lookup"](merging, SF_DIR))
    assert got == oracle.duck_rows(duck, driver.oracle_sql()["parsed_codes_lookup"])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
