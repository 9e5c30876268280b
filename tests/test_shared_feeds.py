"""Inputs that several steps of a query begin with, and the comparison of their outcomes."""

from checks import queries
from tests.conftest import final_plan
from tests.test_published_lake import tables  # noqa: F401


def test_a_shared_feed_is_cleaned_once(spark, tables):  # noqa: F811
    alone = queries.cleaned_plan(spark, tables, "src_customer_hist")
    assert "Window" in final_plan(alone)
    with queries.shared_cleaned():
        first = queries.cleaned(spark, tables, "src_customer_hist")
        again = queries.cleaned_plan(spark, tables, "src_customer_hist")
        other = queries.cleaned_plan(spark, tables, "src_customer_inc")
    assert set(first.inputFiles()) == set(again.inputFiles()) != set(other.inputFiles())
    assert "Window" not in final_plan(again)
    assert again.dtypes == alone.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, alone.collect())) != []


def test_the_difference_reads_each_table_once(spark, tmp_path):
    schema = "k string, v string, d double"
    once = [("1", "x", 1.0), ("1", "x", 1.0), ("2", None, None), (None, "q", 1.0), (None, "r", None)]
    twice = [("1", "x", 1.0), ("2", None, None), (None, "q", 1.0), (None, "q", 1.0), (None, "r", None), ("4", "n", 0.0)]
    for name, rows in (("once", once), ("twice", twice)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    one, two = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("once", "twice"))
    found = queries._difference("t", one, two)
    assert [tuple(r) for r in found.collect()] == [("t", 5, 6, 3)]
    plan = final_plan(found).split("Initial Plan")[0]
    assert plan.count("FileScan") == 2
    none = queries._difference("t", one.limit(0), two.limit(0))
    assert [tuple(r) for r in none.collect()] == [("t", 0, 0, 0)]
