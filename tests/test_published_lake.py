"""What building the published lake leaves behind, and what it writes once."""

import datetime
import os

import pytest

from checks import queries
from martwright.operators.keys import dense_key_by
from martwright.sources import files
from martwright.sources.staging import SETTING, stage, stage_by
from tests.conftest import final_plan


@pytest.fixture
def tables(spark, tmp_path):
    """Sales of two customers and products before and after the cut, one line without an order."""
    when = datetime.datetime
    rows = {
        "region": ([(1, "ASIA")], "r_regionkey long, r_name string"),
        "nation": ([(1, "JAPAN", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": (
            [(1, 1, "AUTO", 1.0), (3, 1, "AUTO", -1.0)],
            "c_custkey long, c_nationkey long, c_mktsegment string, c_acctbal double",
        ),
        "supplier": ([(1, 1)], "s_suppkey long, s_nationkey long"),
        "part": (
            [(1, "p", "b", "t", 3, 9.5), (2, "q", "b", "t", 4, 8.5)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "orders": (
            [(1, 1, "F", "LOW", when(1999, 3, 5)), (2, 3, "O", "LOW", when(1999, 12, 1)), (3, 3, "O", "LOW", when(2000, 2, 1))],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz",
        ),
        "lineitem": (
            [
                (key, part, 1, line, 3.0, 10.5, 0.1, 0.0, "A", "O", when(2000 if key == 3 else 1999, 12, 9))
                for key, part, line in [(1, 1, 1), (1, 2, 2), (1, 2, 2), (2, 1, 1), (3, 2, 1), (3, 1, 7), (9, 1, 1)]
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
            " l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


def test_only_the_lake_holds_rows_when_it_is_published(spark, tables, tmp_path, conf):
    conf(SETTING, f"{tmp_path}/staged")
    lake = queries.published_lake(spark, tables)
    sold = {(r.transaction_id, r.product_sk, r.customer_sk) for r in lake.star()["fact_sales"].collect()}
    assert {t for t, _, _ in sold} == {"9", "10", "17", "25", "31"}
    assert all(product and customer for _, product, customer in sold)
    folders = [f for f in os.listdir(f"{tmp_path}/staged/martwright") if not lake.root.endswith(f)]
    assert folders
    for folder in folders:
        assert spark.read.parquet(f"{tmp_path}/staged/martwright/{folder}").count() == 0


def test_a_delivery_leaves_only_its_files(spark, tables, tmp_path, conf):
    conf(SETTING, f"{tmp_path}/staged")
    paths = queries._deliver(spark, tables)
    sold = files.read_entity_feed(spark, paths["historical"], "sales")
    assert sorted(r.transaction_id for r in sold.collect()) == ["10", "10", "17", "9"]
    root = paths["historical"].split("/delivery")[0]
    folders = [f for f in os.listdir(f"{tmp_path}/staged/martwright") if not root.endswith(f)]
    assert folders
    for folder in folders:
        assert spark.read.parquet(f"{tmp_path}/staged/martwright/{folder}").count() == 0


def test_rows_in_buckets_are_numbered_without_another_copy(spark, tmp_path, conf):
    conf(SETTING, f"{tmp_path}/staged")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.createDataFrame([("2", "x"), ("10", "y"), ("10", "z"), (None, "n")], "id string, v string")
    stored = stage_by(rows, "id")
    numbered = dense_key_by(stored, "id", "sk", after=5, in_buckets=True)
    assert set(stored.inputFiles()) <= set(numbered.inputFiles())
    assert sorted((r.sk, r.id) for r in numbered.collect()) == [(6, None), (7, "2"), (8, "10"), (9, "10")]
    assert "Exchange" not in final_plan(numbered)


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}


def test_a_write_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).selectExpr("id % 10 as k", "id as v")
    before = _shuffle_files(spark)
    again = stage(rows.repartition(4, "k")).repartition(3, "v")
    assert not _shuffle_files(spark) - before
    assert stage_by(again, "k").count() == 1000
    assert stage(again).count() == 1000
    left = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    assert left in (None, "false")
