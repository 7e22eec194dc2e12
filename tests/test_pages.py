"""Pages of a stored order against offset and limit."""

import random

import pytest
from conftest import rows

from carelake.operators import items, pages


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    made = [(rng.choice([None, 1, 2, 3, rng.randrange(10**6)]), f"n{i}") for i in range(5000)]
    return spark.createDataFrame(made, "key long, name string").repartition(5).cache()


def test_pages_equal_offset_and_limit(spark, table, tmp_path):
    path = str(tmp_path / "p")
    pages.paginate(table, ["key"], path, range_rows=300)
    for number, limit in ((1, 100), (2, 299), (25, 200), (50, 100), (51, 100), (9, 1)):
        got = [tuple(r) for r in pages.read_page(spark, path, number, limit).collect()]
        assert got == [tuple(r) for r in items.page(table, ["key", "name"], number, limit).collect()]
    assert [tuple(r) for r in pages.read_rows(spark, path, 0, 6000).collect()] == [tuple(r) for r in table.orderBy("key", "name").collect()]
    assert pages.read_rows(spark, path, 10, 0).count() == 0


def test_a_deep_page_reads_one_or_two_ranges(spark, table, tmp_path):
    path = str(tmp_path / "p")
    pages.paginate(table, ["key"], path, range_rows=300)
    page = pages.read_page(spark, path, 40, 100)
    scan = page._jdf.queryExecution().executedPlan().toString()
    assert "page_range" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    touched = {r[0] for r in page.selectExpr("split(_metadata.file_path, 'page_range=')[1] AS f").selectExpr("split(f, '/')[0]").distinct().collect()}
    assert touched == {"13"}


def test_equal_rows_empty_tables_and_clashing_names(spark, tmp_path):
    same = spark.createDataFrame([(1, None)] * 7, "a int, b string")
    pages.paginate(same, ["a"], str(tmp_path / "s"), range_rows=2)
    assert [pages.read_page(spark, str(tmp_path / "s"), n, 3).count() for n in (1, 2, 3, 4)] == [3, 3, 1, 0]
    pages.paginate(same.limit(0), ["a"], str(tmp_path / "e"))
    assert rows(pages.read_page(spark, str(tmp_path / "e"))) == []
    with pytest.raises(ValueError):
        pages.paginate(same.withColumnRenamed("b", "Page_Row"), ["a"], str(tmp_path / "c"))
