import datetime

from pyspark.sql import functions as F

from martwright.operators import lookups, merge
from martwright.sources.staging import stage_by
from tests.conftest import final_plan

D = datetime.date


def customers(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"customer_id string, income_bracket string{extra}")


def history(df):
    return sorted(
        (r.customer_id, r.customer_sk, r.income_bracket, str(r.effective_start_date),
         r.effective_end_date and str(r.effective_end_date), r.is_current)
        for r in df.collect()
    )


def start(spark):
    return merge.initialize_history(customers(spark, [("2", "low"), ("10", "mid"), ("3", "mid")]))


def test_change_closes_the_version_the_day_before(spark):
    inc = customers(
        spark,
        [("2", "high", "2024-05-01"), ("10", "mid", "2024-05-01"), ("7", "low", None)],
        ", effective_start_date string",
    )
    merged = merge.merge_history(start(spark), inc, "2024-06-30")
    assert history(merged.table()) == [
        ("10", 3, "mid", "1900-01-01", None, True),
        ("2", 1, "low", "1900-01-01", "2024-04-30", False),
        ("2", 4, "high", "2024-05-01", None, True),
        ("3", 2, "mid", "1900-01-01", None, True),
        ("7", 5, "low", "2024-06-30", None, True),
    ]
    assert merged.closed().count() == 1
    assert merge.current_violations(merged.table()).isEmpty()
    assert merged.late_starts.isEmpty()


def versions(spark):
    return customers(
        spark,
        [
            ("2", "high", "1", "2024-01-01"),
            ("2", "high", "2", "2024-02-01"),
            ("2", "low", "3", "2024-03-01"),
            ("2", "high", "4", "2024-04-01"),
            ("2", "top", "5", "2024-04-01"),
            ("3", "mid", "1", "2024-01-01"),
        ],
        ", version string, effective_start_date string",
    )


def test_versions_of_one_batch_form_a_chain(spark):
    merged = merge.merge_history(start(spark), versions(spark)).table()
    assert [r[2:] for r in history(merged) if r[0] == "2"] == [
        ("low", "1900-01-01", "2023-12-31", False),
        ("high", "2024-01-01", "2024-02-29", False),
        ("low", "2024-03-01", "2024-03-31", False),
        ("top", "2024-04-01", None, True),
    ]


def test_a_repeated_version_batch_changes_nothing(spark):
    once = merge.merge_history(start(spark), versions(spark)).table()
    again = merge.merge_history(once, versions(spark))
    assert again.inserted.isEmpty()
    assert history(again.table()) == history(once)


def test_a_contradicting_old_version_is_reported(spark):
    once = merge.merge_history(start(spark), versions(spark)).table()
    late = customers(
        spark, [("2", "other", "9", "2024-01-15")], ", version string, effective_start_date string"
    )
    assert [r.customer_id for r in merge.merge_history(once, late).late_starts.collect()] == ["2"]


def test_ranges_never_overlap_with_a_hot_customer(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "2").otherwise(F.col("id").cast("string")).alias("customer_id"),
        (F.col("id") % 5).cast("string").alias("income_bracket"),
        F.col("id").cast("string").alias("version"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("effective_start_date"),
    )
    table = merge.merge_history(start(spark), hot).table()
    spans = {}
    for r in table.collect():
        spans.setdefault(r.customer_id, []).append((r.effective_start_date, r.effective_end_date))
    for ranges in spans.values():
        ranges.sort()
        for (_, end), (following, _) in zip(ranges, ranges[1:]):
            assert end + datetime.timedelta(days=1) == following
        assert ranges[-1][1] is None
    assert len(spans["2"]) > 100


def test_products_keep_their_key(spark):
    target = merge.initialize_products(
        spark.createDataFrame([("1", "a"), ("2", "b")], "product_id string, product_name string")
    )
    source = spark.createDataFrame([("2", "B"), ("11", "n"), ("9", "m")], "product_id string, product_name string")
    rows = merge.upsert_products(target, source).collect()
    assert {(r.product_id, r.product_name, r.product_sk) for r in rows} == {
        ("1", "a", 1), ("2", "B", 2), ("9", "m", 3), ("11", "n", 4),
    }


def test_ledger_rows_never_change(spark):
    schema = "transaction_id string, quantity int"
    target = merge.initialize_ledger(spark.createDataFrame([("1", 1), ("2", 1)], schema))
    once = merge.append_ledger(target, spark.createDataFrame([("2", 99), ("3", 1)], schema))
    assert {(r.transaction_id, r.quantity, r.sales_sk) for r in once.collect()} == {
        ("1", 1, 1), ("2", 1, 2), ("3", 1, 3),
    }
    assert merge.ledger_additions(once, spark.createDataFrame([("3", 5)], schema)).isEmpty()


def test_only_an_increment_of_few_rows_goes_to_every_task(spark, tmp_path):
    """Stored rows may be much smaller than in memory, so their files' size does not decide."""
    ids = spark.range(150_000).select(F.col("id").cast("string").alias("customer_id"), F.lit("x").alias("tier"))
    ids.write.parquet(f"{tmp_path}/all")
    ids.limit(50).write.parquet(f"{tmp_path}/few")
    everything, few = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("all", "few"))
    current = everything.withColumn("effective_start_date", F.lit(D(2024, 1, 1)))

    def broadcasts(df):
        return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")

    for increment, expected in ((everything, False), (few, True)):
        for plan in (
            lookups.matching(everything, increment, "customer_id"),
            lookups.new_keys(increment, everything, "customer_id"),
            lookups.carry_key(increment, everything.withColumn("sk", F.lit(1)), "customer_id", "sk"),
            merge.classify_changes(increment, current),
        ):
            assert (broadcasts(plan) > 0) == expected
    assert lookups.new_keys(few, everything.unionByName(few), "customer_id").isEmpty()
    assert lookups.new_keys(everything, few, "customer_id").count() == 150_000 - 50


def test_a_stored_increment_meets_the_ledger_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lookups, "INCREMENT_BYTES", 0)
    rows = spark.range(3000).selectExpr("cast(id as string) transaction_id", "id quantity")
    target = merge.initialize_ledger(rows.filter("id < 2000"))
    source = stage_by(rows.filter("id >= 1500").withColumn("quantity", F.lit(-1)), "transaction_id")
    added = lookups.new_keys(source, target, "transaction_id")
    assert "Exchange" not in final_plan(added)
    ledger = {int(r.transaction_id): (r.sales_sk, r.quantity) for r in merge.append_ledger(target, source).collect()}
    assert ledger == {i: (i + 1, i if i < 2000 else -1) for i in range(3000)}
    entries = [t.name for t in spark.catalog.listTables() if t.name.startswith("martwright_")]
    assert entries == []
