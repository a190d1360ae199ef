"""Indexed pages against plain ones."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import page_index as PX
from candlewick.operators import pages as PG
from candlewick.session import scratch_path


def order():
    return [F.col("day").desc(), F.col("key").asc()]


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(2_500).select(((F.col("id") * 7919) % 2_500).alias("key"), (F.col("id") % 9).alias("day"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("_note"))


@pytest.fixture(scope="module")
def index(spark, table):
    path = scratch_path(spark, "index")
    PX.write_index(table, order(), path, rows_per_range=100, fan_out=4)   # several groups of ranges
    return path


@pytest.mark.parametrize("limit, offset", [(10, 0), (25, 90), (1, 2_499), (50, 2_480), (10, 2_500), (10, 10**9), (0, 5), (450, 350), (3_000, 0)])
def test_indexed_page_is_the_page(spark, table, index, limit, offset):
    want = [tuple(r) for r in PG.page(table, order(), limit, offset).collect()]
    assert [tuple(r) for r in PX.indexed_page(spark, index, limit, offset).collect()] == want


def test_a_deep_page_reads_one_range(spark, index):
    groups = spark.read.parquet(index + "/groups").orderBy("start").collect()
    assert len(groups) > 1 and [g.start for g in groups][0] == 0
    last = groups[-1]
    ranges = spark.read.parquet(f"{index}/ranges/_group={last._group}").orderBy("start").collect()
    inside = next(r for r in ranges if r.n > 3)
    page = PX.indexed_page(spark, index, 2, last.start + inside.start + 1, total=False)
    files = page.inputFiles()
    assert files and all(f"_group={last._group}/_range={inside._range}/" in f for f in files)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_row,1)" in plan and "LessThan(_row,3)" in plan
    assert page.count() == 2


def test_empty_table_and_bad_arguments(spark, table):
    path = scratch_path(spark, "index")
    PX.write_index(table.where("key < 0"), order(), path)
    page = PX.indexed_page(spark, path, 10, 0)
    assert page.count() == 0 and page.columns == [*table.columns, "total"]
    with pytest.raises(ValueError):
        PX.indexed_page(spark, path, -1, 0)
