"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import DATA, database, same

from tallyvane.plans import catalog


@pytest.fixture(scope="module")
def duck():
    return database("sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    same(catalog.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


@pytest.mark.parametrize("name", ["a1_source_latest_floor", "w5_trajectory", "j8_asof_join"])
def test_partitions_and_order_change_nothing(spark, name):
    a = catalog.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        same(catalog.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), a)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
