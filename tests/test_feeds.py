"""Feeds that several steps of a query read."""

import datetime

from checks import feeds, queries
from martwright.operators import cleanse
from martwright.sources.staging import stage
from tests.conftest import final_plan


def _tables(spark, folder) -> str:
    """Lines whose order, supplier or key is missing, and lines that come twice."""
    when = datetime.datetime
    rows = {
        "region": ([(1, "ASIA")], "r_regionkey long, r_name string"),
        "nation": ([(1, "JAPAN", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(1, 1)], "c_custkey long, c_nationkey long"),
        "supplier": ([(1, 1), (2, None)], "s_suppkey long, s_nationkey long"),
        "part": ([(1, "p")], "p_partkey long, p_name string"),
        "orders": (
            [(1, 1, when(1999, 12, 5)), (2, 1, when(2000, 3, 1)), (3, None, None), (None, 1, when(1999, 1, 1))],
            "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
        ),
        "lineitem": (
            [
                (key, 1, supplier, line, 3.0, 10.5, 0.1, 0.0, "A", None, when(1999, 12, 9))
                for key, supplier, line in
                [(1, 1, 1), (1, 1, 1), (1, 2, 2), (2, 1, 7), (3, 1, 1), (None, 1, 1), (9, 1, 1), (2, None, 3)]
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
            " l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_sales_feeds_of_a_query_share_one_join(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    names = ("src_sales", "src_sales_hist", "src_sales_inc")
    plain = {name: feeds.feed(spark, sf_dir, name, often=True) for name in names}
    with feeds.shared_lines():
        shared = {name: feeds.feed(spark, sf_dir, name, often=True) for name in names}
        once = feeds.feed(spark, sf_dir, "src_sales")
    scans = {name: frozenset(df.inputFiles()) for name, df in shared.items()}
    assert len(set(scans.values())) == 1
    for name in names:
        assert shared[name].schema == plain[name].schema
        assert sorted(map(str, shared[name].collect())) == sorted(map(str, plain[name].collect()))
        assert "Join" in final_plan(plain[name])
        assert "Join" not in final_plan(shared[name])
    assert [shared[name].count() for name in names] == [4, 2, 3]
    # A feed that is read once is not stored.
    assert "Join" in final_plan(once)


def test_the_ledgers_rows_are_joined_and_ranked_without_a_shuffle(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf_dir = _tables(spark, tmp_path)
    names = ("src_sales", "src_sales_hist", "src_sales_inc")
    plain = {name: feeds.feed(spark, sf_dir, name) for name in names}
    assert "Exchange" in final_plan(cleanse.clean_sales(plain["src_sales"]))
    with feeds.shared_lines():
        lines = feeds.feed(spark, sf_dir, "src_sales", to_store=True)
        rows = {name: queries.ledger_rows(spark, sf_dir, name) for name in names}
    # Lines and orders meet in their buckets; suppliers and nations still travel.
    assert "hashpartitioning(l_orderkey" not in final_plan(lines)
    assert "hashpartitioning(l_orderkey" in final_plan(plain["src_sales"])
    assert sorted(map(str, lines.collect())) == sorted(map(str, plain["src_sales"].collect()))
    for name in names:
        assert "Exchange" not in final_plan(rows[name])
        cleaned = cleanse.clean_sales(plain[name])
        assert rows[name].schema == cleaned.schema
        assert sorted(map(str, rows[name].collect())) == sorted(map(str, cleaned.collect()))
    assert [rows[name].count() for name in names] == [3, 1, 2]


def test_a_staged_frame_is_stored_small(spark):
    files = stage(spark.range(10)).inputFiles()
    assert files and all(".zstd." in name for name in files)
