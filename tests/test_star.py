import datetime

from pyspark.sql import functions as F

from conftest import final_plan
from martwright.operators import kpis, lookups, merge, star

D = datetime.date


def versions(spark):
    return spark.createDataFrame(
        [
            ("1", D(1900, 1, 1), D(2024, 4, 30), 1),
            ("1", D(2024, 5, 1), None, 2),
        ],
        "customer_id string, effective_start_date date, effective_end_date date, customer_sk bigint",
    )


def test_as_of_lookup_is_closed_at_both_ends(spark):
    sales = spark.createDataFrame(
        [("a", "1", D(2024, 4, 30)), ("b", "1", D(2024, 5, 1)), ("c", "1", None), ("d", "2", D(2024, 5, 1)), ("e", None, D(2024, 5, 1))],
        "t string, customer_id string, day date",
    )
    found = lookups.lookup_as_of(sales, versions(spark), "customer_id", F.col("day"), "customer_sk")
    assert {r.t: r.customer_sk for r in found.collect()} == {"a": 1, "b": 2, "c": 0, "d": 0, "e": 0}


def test_a_hot_key_is_split_in_a_shuffled_lookup(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    fact = spark.range(0, 200000, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("product_id"),
    )
    dimension = spark.range(1, 5000).select(
        F.when(F.col("id") == 1, "hot").otherwise(F.col("id").cast("string")).alias("product_id"),
        F.col("id").alias("product_sk"),
    )
    found = lookups.lookup(fact, dimension, ["product_id"], "product_sk")
    assert "skew=true" in final_plan(found)
    assert found.count() == 200000
    assert found.filter("product_id = 'hot' and product_sk = 1").count() == 100000


def silver_sales(spark):
    rows = [
        ("1", "2024-04-30 10:00:00", "1", "p1", 1.0, "promo", 10.0, 1.0),
        ("2", "2024-05-01 10:00:00", "1", "p9", 1.0, "promo-b", 20.0, 2.0),
        ("3", None, "9", None, 0.0, "Unknown", 30.0, 0.5),
    ]
    sales = spark.createDataFrame(
        rows,
        "transaction_id string, transaction_date string, customer_id string, product_id string, "
        "promotion_id double, promotion_type string, total_sales double, discount_applied double",
    )
    return merge.initialize_ledger(
        sales.withColumns(
            {
                "transaction_date": F.col("transaction_date").cast("timestamp"),
                "quantity": F.lit(1), "unit_price": F.lit(1.0), "store_location": F.lit("S"),
                "transaction_hour": F.lit(9), "day_of_week": F.lit("Monday"),
            }
        )
    )


def test_fact_has_one_row_per_sale(spark):
    sales = silver_sales(spark)
    products = spark.createDataFrame([("p1", 1)], "product_id string, product_sk bigint")
    promotions = star.dim_promotion(sales)
    customers = star.dim_customer(versions(spark).withColumn("is_current", F.col("effective_end_date").isNull()))
    fact = star.fact_sales(sales, customers, star.dim_product(products), promotions)
    assert fact.columns == list(star.FACT_COLUMNS)
    assert [
        (r.transaction_id, r.customer_sk, r.product_sk, r.promotion_sk, r.date_sk)
        for r in fact.orderBy("sales_sk").collect()
    ] == [("1", 1, 1, 1, 20240430), ("2", 2, 0, 2, 20240501), ("3", 0, 0, 0, 0)]


def test_dates_and_promotions_have_an_unknown_member(spark):
    sales = silver_sales(spark)
    days = {r.date_sk: r for r in star.dim_date(sales).collect()}
    assert set(days) == {0, 20240430, 20240501}
    assert days[20240501].day_name == "Wednesday" and days[20240501].week_of_year == 18
    assert days[0].day_name == "Unknown" and days[0].weekend is False
    assert {(r.promotion_id, r.promotion_type, r.promotion_sk) for r in star.dim_promotion(sales).collect()} == {
        (1, "promo", 1), (1, "promo-b", 2), (0, "Unknown", 0),
    }


def test_kpis(spark):
    fact = silver_sales(spark)
    margin = kpis.net_margin_by_store(fact).first()
    assert (margin.gross_revenue, margin.discount_amount, margin.net_margin) == (60.0, 3.5, 56.5)
    assert {r.promotion_type: r.aov for r in kpis.order_value_by_promotion(fact).collect()}["promo"] == 10.0
    traffic = kpis.store_traffic(fact).first()
    assert (traffic.transaction_count, traffic.average_transaction_value) == (3, 20.0)
    customers = spark.createDataFrame(
        [("S", "Yes", True, True, 1), ("S", "Yes", None, True, 2), ("S", "Yes", True, False, 3), ("S", "Yes", False, True, 0)],
        "customer_state string, loyalty_program string, churned boolean, is_current boolean, customer_sk bigint",
    )
    churn = kpis.churn_heatmap(customers).first()
    assert (churn.total_customers, churn.churned_customers, churn.churn_rate) == (2, 1, 50.0)
    products = spark.createDataFrame([("c", 0.1, 1), ("c", 0.2, 2), ("c", 9.0, 0)], "product_category string, product_return_rate double, product_sk bigint")
    quality = kpis.product_quality(products).first()
    assert (quality.number_of_products, quality.average_return_rate, quality.highest_return_rate) == (2, 0.15, 0.2)


def test_an_infinite_amount_does_not_break_a_total(spark):
    fact = spark.createDataFrame([("p", float("inf")), ("q", 1.5)], "promotion_type string, total_sales double")
    assert {r.promotion_type: r.aov for r in kpis.order_value_by_promotion(fact).collect()} == {"p": float("inf"), "q": 1.5}
