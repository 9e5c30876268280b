from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.keys import dense_key, dense_key_by, id_order
from martwright.sources import staging
from martwright.sources.staging import stage
from tests.conftest import final_plan


def test_equals_the_global_row_number(spark):
    df = stage(
        spark.range(20000).select(
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), "id"))
            .when(F.col("id") % 3 == 1, F.lit("7"))
            .otherwise(F.col("id").cast("string"))
            .alias("k"),
            "id",
        )
    )
    order = [*id_order("k"), F.col("id")]
    ours = dense_key(df, order, "sk")
    naive = df.withColumn("naive", F.row_number().over(Window.orderBy(*order)))
    assert ours.join(naive, ["k", "id"]).filter("sk = naive").count() == 20000


def test_equal_leading_values_spread_over_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(40000).select(F.lit("no number").alias("k"), "id")
    sorted_rows = df.orderBy(*id_order("k"), "id").withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in sorted_rows.groupBy("task").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20000
    keyed = dense_key(df, [*id_order("k"), F.col("id")], "sk")
    assert keyed.filter("sk = id + 1").count() == 40000


def test_the_only_unpartitioned_window_is_over_task_counts(spark):
    keyed = dense_key(spark.range(100), [F.col("id")], "sk")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line or "+- Window " in line]
    assert len(windows) == 1 and "_rows" in windows[0]


def test_goes_on_from_the_greatest_key(spark):
    target = spark.createDataFrame([(41,), (5,)], "sk bigint")
    df = spark.createDataFrame([("10",), ("9",)], "k string")
    keyed = dense_key(df, id_order("k"), "sk", after=target)
    assert {r.k: r.sk for r in keyed.collect()} == {"9": 42, "10": 43}
    assert dense_key(df.limit(0), id_order("k"), "sk", after=target).count() == 0
    fresh = dense_key(df, id_order("k"), "sk", after=target.limit(0))
    assert sorted(r.sk for r in fresh.collect()) == [1, 2]


def test_keys_by_a_text_id_shuffle_no_whole_row(spark):
    ids = ["10", "9", None, "x", "2.0", "9", None, "", "-1"]
    rows = spark.createDataFrame([(k, f"row {i}") for i, k in enumerate(ids)], "id string, payload string")
    numbered = dense_key_by(rows, "id", "sk", after=100)
    by_key = sorted((r.sk, r.id) for r in numbered.collect())
    sorted_whole = dense_key(rows, id_order("id"), "sk", after=100)
    assert by_key == sorted((r.sk, r.id) for r in sorted_whole.collect())
    assert sorted(r.payload for r in numbered.collect()) == sorted(f"row {i}" for i in range(len(ids)))
    assert "Exchange" not in final_plan(numbered)
    assert dense_key_by(rows.limit(0), "id", "sk").count() == 0


def test_a_bucket_that_a_hot_key_fills_is_not_read_by_one_task(spark, monkeypatch):
    monkeypatch.setattr(staging, "BUCKET_ROWS", 100)
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, cast(id as string), 'hot') id", "id n")
    hot, even = staging.stage_by(rows, "id"), staging.stage_by(rows.filter("id != 'hot'"), "id")
    assert "Exchange" in final_plan(hot.groupBy("id").count())
    assert "Exchange" not in final_plan(even.groupBy("id").count())
    assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, rows.collect()))
    numbered = dense_key_by(rows, "id", "sk")
    assert sorted(r.sk for r in numbered.collect()) == list(range(1, 1001))
    # Ids that are no numbers come first.
    assert numbered.filter("id = 'hot'").agg(F.min("sk"), F.max("sk")).first()[:] == (1, 666)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("martwright_")] == []
