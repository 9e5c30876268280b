from pyspark.sql import functions as F

from martwright.functions.parsing import to_double, to_flag, to_moment, to_whole
from martwright.operators import cleanse, dedup


# The input frames of the next three tests.


def test_customer_rows_without_key_or_copies(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (None, "B")], "customer_id bigint, gender string")
    rows = cleanse.clean_customer(df).collect()
    assert [(r.customer_id, r.gender) for r in rows] == [(1, "A")]


def test_product_types_and_labels(spark):
    df = spark.createDataFrame(
        [("10", "4.5", None)], "product_id string, product_rating string, product_name string"
    )
    cleaned = cleanse.clean_product(df)
    assert dict(cleaned.dtypes)["product_rating"] == "double"
    assert cleaned.first().product_name == "Unknown"


def test_sales_types_and_key(spark):
    df = spark.createDataFrame(
        [("1", "2", None), (None, "3", "x")],
        "transaction_id string, quantity string, payment_method string",
    )
    rows = cleanse.clean_sales(df).collect()
    assert [(r.quantity, r.payment_method) for r in rows] == [(2, "Unknown")]


def test_whole_numbers_follow_the_lenient_cast(spark):
    given = {
        "12": 12, " 12 ": 12, "+7": 7, "-7": -7, "4.5": 4, "-4.9": -4, ".5": 0, "5.": 5,
        "1e3": None, "3d": None, "1_000": None, "abc": None, "": None, " ": None,
        "2147483647.9": 2147483647, "2147483648": None, "NaN": None,
    }
    df = spark.createDataFrame([(k,) for k in given], "t string").select("t", to_whole(F.col("t")))
    assert {r[0]: r[1] for r in df.collect()} == given


def test_malformed_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("x",), ("2024-02-30",)], "t string")
    rows = df.select(to_double(F.col("t")), to_moment(F.col("t")), to_flag(F.col("t"))).collect()
    assert all(v is None for r in rows for v in r)


def test_flags(spark):
    words = [" TRUE ", "y", "1", "No", "0", "maybe", None]
    df = spark.createDataFrame([(w,) for w in words], "t string").select(to_flag(F.col("t")).alias("f"))
    assert [r.f for r in df.collect()] == [True, True, True, False, False, None, None]


def test_blank_keeps_key_and_tabs(spark):
    df = spark.createDataFrame([("  ", " ", "\t")], "k string, a string, b string")
    assert tuple(cleanse.blank_to_null(df, keep=["k"]).first()) == ("  ", None, "\t")


def test_product_prefers_latest_update_then_ingest(spark):
    df = spark.createDataFrame(
        [("1", "a", None, 9), ("1", "b", "2024-01-02", 1), ("1", "c", "2024-01-02", 2), ("1", "d", "bad", 8)],
        "product_id string, product_name string, last_updated string, ingested_at int",
    )
    assert cleanse.clean_product(df).first().product_name == "c"


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("1", f"n{i}", 5) for i in range(50)]
    schema = "transaction_id string, store_location string, ingested_at int"
    kept = {
        dedup.latest_by_ingest(spark.createDataFrame(part, schema).repartition(n), "transaction_id")
        .first()
        .store_location
        for n, part in ((1, rows), (7, rows[::-1]))
    }
    assert len(kept) == 1


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    hot = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.col("id").alias("ingested_at"),
    )
    kept = dedup.latest_by_ingest(hot, "transaction_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit", shuffle) > shuffle
    assert kept.count() == 20001
    assert kept.filter("transaction_id = 'hot'").first().ingested_at == 29997
