"""Batches are taken once, the star is published as one, and builds touch what changes."""

import pytest
from pyspark.sql import functions as F

from martwright.operators import audit, kpis, lookups, merge, star
from martwright.plans import gold, medallion
from martwright.sources import provenance
from martwright.sources.staging import new_folder
from martwright.sources.tables import SnapshotTable, joined_schema, write_observed
from test_flow import deliver, rows, sales


def batch(spark, entity, label, load_type="incremental", **columns):
    stamp = medallion.stamp_provenance
    return medallion.CLEANERS[entity](stamp(rows(spark, entity, 2, **columns), entity, load_type, label))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_changed_delivery_under_a_known_name_is_refused(spark):
    root, lake = new_folder(spark), medallion.Lakehouse(spark, new_folder(spark))

    def load(price):
        deliver(spark, root, "incremental", {"product": rows(spark, "product", 2, unit_price=F.lit(price))})
        medallion.ingest_raw(lake, f"{root}/in/incremental", "product", "incremental")
        medallion.land(lake, f"{root}/landing", "product", "incremental", "may")
        medallion.append_bronze(lake, "product", "incremental", "may")

    load("7")
    load("7")
    assert lake.bronze("product", "incremental").published() == 1
    with pytest.raises(ValueError, match="another content"):
        load("8")
    assert {r.unit_price for r in lake.landing("product", "incremental").latest().collect()} == {"7"}
    assert lake.bronze("product", "incremental").history().count() == 2


def test_older_batches_change_nothing_after_newer_ones(spark):
    lake = medallion.Lakehouse(spark, new_folder(spark))
    medallion.refine_products(lake, batch(spark, "product", "", "historical", product_stock=F.lit("10")), "historical")
    b, c = (batch(spark, "product", n, product_stock=F.lit(v)) for n, v in (("b", "20"), ("c", "30")))
    for increment in (b, c, b):
        medallion.refine_products(lake, increment, "incremental")
    assert {r.product_stock for r in lake.products().collect()} == {30.0}
    medallion.refine_customers(lake, batch(spark, "customer", "", "historical", age=F.lit("30")), "historical")
    undated, later = (batch(spark, "customer", n, age=F.lit(a)) for n, a in (("u", "40"), ("v", "50")))
    medallion.refine_customers(lake, undated, "incremental", "2024-01-10")
    medallion.refine_customers(lake, later, "incremental", "2024-01-20")
    medallion.refine_customers(lake, undated, "incremental", "2024-02-01")
    assert {r.age for r in lake.customers().filter("is_current").collect()} == {50}
    assert lake.customers().count() == 6
    # A batch without a change is recorded as taken too.
    medallion.refine_customers(lake, batch(spark, "customer", "w", age=F.lit("50")), "incremental", "2024-03-01")
    table = lake.silver("customer")
    assert table.batch(provenance.batch_name("customer", "incremental", "w"))["rows"] == 0
    assert table.published() == 3


def test_a_missing_start_is_the_day_the_batch_was_taken(spark):
    target = merge.initialize_history(spark.createDataFrame([("1", "low")], "customer_id string, income_bracket string"))
    taken = F.lit("2024-01-10 08:00:00").cast("timestamp")
    increment = spark.createDataFrame([("1", "high")], "customer_id string, income_bracket string")
    added = merge.merge_history(target.withColumn("ingested_at", taken), increment.withColumn("ingested_at", taken)).inserted
    assert str(added.first().effective_start_date) == "2024-01-10"


def test_digest_and_greatest_key_of_a_write(spark):
    one = spark.createDataFrame([("a", None, 1), (None, "a", 2), ("b", "c", 9)], "x string, y string, k int")
    seen = write_observed(one, new_folder(spark), digest_of=["x", "y"], greatest=["k"])
    turned = spark.createDataFrame([("b", "c"), (None, "a"), ("a", None)], "x string, y string").repartition(3)
    other = spark.createDataFrame([("b", "c"), (None, "a"), (None, "a")], "x string, y string")
    assert (seen["count"], seen["greatest"]) == (3, {"k": 9})
    assert write_observed(turned, new_folder(spark), digest_of=["x", "y"])["digest"] == seen["digest"]
    assert write_observed(other, new_folder(spark), digest_of=["x", "y"])["digest"] != seen["digest"]
    assert write_observed(one.limit(0), new_folder(spark), digest_of=["x"], greatest=["k"]) == {
        "count": 0, "greatest": {}, "digest": "0", "widest": {},
    }


def test_records_say_schema_and_batch_without_reading_files(spark):
    """Removing every data file leaves the plans of `history` and `of_batch` as they are."""
    table = SnapshotTable(spark, new_folder(spark))
    for n, columns in enumerate((["id"], ["id", "more"]), 1):
        df = spark.range(n).withColumn("more", F.lit(n)).select(*columns)
        table.publish(table.write_observed(df, greatest=["id"]), batch_id=f"b{n}")
    assert table.history().columns == ["id", "more"] and table.of_batch("b1").columns == ["id"]
    assert sorted(r.more or 0 for r in table.history().collect()) == [0, 2, 2]
    assert table.of_batch("b1").inputFiles() != table.of_batch("b2").inputFiles()
    assert all("snapshot=2" in f for f in table.history(after=1).inputFiles())
    with pytest.raises(ValueError, match="column id"):
        joined_schema([spark.range(1).schema.jsonValue(), spark.range(1).selectExpr("cast(id as string) id").schema.jsonValue()])


@pytest.fixture(scope="module")
def lake(spark):
    """Two deliveries: ten months of sales, then a change of one customer from September on, a
    product that sales of March have waited for, and new sales of October."""
    lake = medallion.Lakehouse(spark, new_folder(spark))

    def sold(first, count, **columns):
        month = F.col("id") % 10 + 1
        given = {
            "transaction_id": (F.col("id") + first).cast("string"),
            "transaction_date": F.format_string("2024-%02d-15", month),
            "customer_id": (F.col("id") % 3 + 1).cast("string"),
            "product_id": F.when(month == 3, "77").otherwise("1"),
            "promotion_id": F.when(F.col("id") % 2 == 0, "1").otherwise("5"),
            "total_sales": (F.col("id") % 7 + 0.25).cast("string"),
            **columns,
        }
        return rows(spark, "sales", count, **given)

    def take(load_type, customers, products, sold):
        for entity, df in (("customer", customers), ("product", products), ("sales", sold)):
            cleaned = medallion.CLEANERS[entity](medallion.stamp_provenance(df, entity, load_type, ""))
            if entity == "sales":
                medallion.refine_sales(lake, cleaned)
            elif entity == "product":
                medallion.refine_products(lake, cleaned, load_type)
            else:
                medallion.refine_customers(lake, cleaned, load_type, "2024-12-31")
        medallion.build_star(lake)

    take("historical", rows(spark, "customer", 3), rows(spark, "product", 2), sold(1, 200))
    change = {"customer_id": F.lit("2"), "age": F.lit("50"), "effective_start_date": F.lit("2024-09-01")}
    new = rows(spark, "product", 1, product_id=F.lit("77"))
    october = {"transaction_date": F.lit("2024-10-20"), "promotion_id": F.lit("3")}
    first = lake.publication()
    before = {k: v.collect() for k, v in lake.star().items()}
    take("incremental", rows(spark, "customer", 1, **change), new, sold(1000, 20, **october))
    return lake, first, before


def test_an_increment_rewrites_the_months_it_changes(spark, lake):
    lake, first, _ = lake
    record = lake.publication()
    changed = {m for m, n in record["months"].items() if n == record["number"]}
    assert changed == {"202403", "202409", "202410"}
    assert len(record["months"]) == 10 and set(first["months"].values()) == {1}
    folder = lake.gold("fact_sales").folder(record["number"])
    written = spark.read.parquet(folder).inputFiles()
    assert {f.split("sale_month=")[1][:6] for f in written} == changed
    whole = star.fact_sales(
        lake.sales(), *(lake.star()[n] for n in ("dim_customer", "dim_product", "dim_promotion"))
    )
    assert sorted(map(str, whole.collect())) == sorted(map(str, lake.star()["fact_sales"].collect()))


def test_a_build_reads_only_affected_months(lake):
    lake, _, _ = lake
    ledger = lake.ledger().filter(F.col("sale_month").isin([202403, 202410]))
    read = {r.f.split("sale_month=")[1][:6] for r in ledger.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read == {"202403", "202410"}


def test_a_reader_between_publications_joins_consistently(lake):
    """Tables taken before the second publication still are those of the first."""
    lake, first, before = lake
    old = lake.star(first)
    assert {k: sorted(map(str, v.collect())) for k, v in old.items()} == {
        k: sorted(map(str, v)) for k, v in before.items()
    }
    members = {n.replace("dim_", "") + "_sk": old[n] for n in gold.DIMENSIONS}
    assert all(r.orphans == 0 for r in audit.fact_key_orphans(old["fact_sales"], members).collect())


def test_promotion_keys_stay(lake):
    """Promotion 3 comes between 1 and 5 and gets the next key."""
    lake, _, before = lake
    keys = {r.promotion_id: r.promotion_sk for r in lake.star()["dim_promotion"].collect()}
    old = {r.promotion_id: r.promotion_sk for r in before["dim_promotion"]}
    assert old == {1: 1, 5: 2, 0: 0} and keys == {**old, 3: 3}


def test_kpis_from_states_equal_those_of_the_whole_fact(lake):
    lake, _, _ = lake
    whole, partial = medallion.kpi_report(lake.star()), medallion.published_kpis(lake)
    for name, report in whole.items():
        assert list(map(tuple, report.collect())) == list(map(tuple, partial[name].collect()))


def test_states_hold_amounts_that_no_decimal_can(spark):
    schema = "transaction_id string, store_location string, promotion_type string, day_of_week string, transaction_hour int, total_sales double, discount_applied double, m int"
    rows = [("1", "a", "p", "d", 1, float("inf"), 1.0, 1), ("2", "b", "q", "d", 1, 1.1, None, 1), ("3", "b", "q", "d", 2, 2.2, 0.1, 2), ("4", "c", None, None, None, None, None, 0)]
    fact = spark.createDataFrame(rows, schema)
    partial = kpis.states(fact, "m")
    for whole, sums in (
        (kpis.net_margin_by_store(fact), kpis.net_margin_from(partial)),
        (kpis.order_value_by_promotion(fact), kpis.order_value_from(partial)),
        (kpis.store_traffic(fact), kpis.store_traffic_from(partial)),
    ):
        assert list(map(tuple, whole.collect())) == list(map(tuple, sums.collect()))


def test_a_second_batch_looks_up_no_greatest_key(lake):
    """Keys go on from the records: no aggregate over sales_sk in the plan."""
    lake, _, _ = lake
    greatest = lake.silver("sales").greatest("sales_sk")
    assert greatest == lake.sales().agg(F.max("sales_sk")).first()[0] == 220
    new = lake.sales().drop("sales_sk").withColumn("transaction_id", F.concat(F.lit("x"), "transaction_id"))
    assert "max(sales_sk" not in plan_of(merge.ledger_additions(lake.sales(), new, greatest))
    assert "max(sales_sk" in plan_of(merge.ledger_additions(lake.sales(), new))


def test_new_sales_are_checked_without_shuffling_the_ledger(spark, lake):
    lake, first, _ = lake
    checked = lake.ledger(until=first["silver"]["sales"])
    new = lake.ledger(after=first["silver"]["sales"])
    found = lookups.matching(checked.select("transaction_id"), new, "transaction_id")
    found.collect()
    assert "Exchange hashpartitioning" not in plan_of(found)
    versions = lake.customers().filter("customer_sk > 3")
    report = audit.silver_invariants(lake.customers(), lake.products(), checked, versions, new)
    assert all(r.violations == 0 for r in report.collect())
    twice = audit.silver_invariants(lake.customers(), lake.products(), lake.ledger(), versions, new)
    assert {r.rule: r.violations for r in twice.collect()}["transaction_id_unique"] == 20


def test_a_batch_reads_the_ids_of_the_parts_it_touches(spark, lake):
    lake, first, _ = lake
    small = lake.ledger(after=first["silver"]["sales"]).filter("sales_sk in (201, 202)")
    known = merge.touched_keys(lake.sales_keys(until=1), small)
    parts = {r[0] for r in small.select(merge.key_part()).collect()}
    read = {int(f.split("key_part=")[1].split("/")[0]) for f in _read_files(known)}
    assert read <= parts and len(parts) <= 2
    assert all("/keys/snapshot=1/" in f for f in _read_files(known))
    ids = lambda df: {r.transaction_id for r in df.select("transaction_id").collect()}
    assert ids(lake.sales_keys()) == ids(lake.sales())
    again = lake.sales().filter("sales_sk < 50").drop("sales_sk")
    assert merge.ledger_additions(merge.touched_keys(lake.sales_keys(), again), again, 220).isEmpty()


def test_a_build_shuffles_the_ledger_once_at_most(spark, lake, conf):
    """With broadcasts off but for dimensions whose size their write has shown."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    lake, _, _ = lake
    dims = [lake.star()[n] for n in ("dim_customer", "dim_product", "dim_promotion")]
    shuffled = star.fact_sales(lake.sales(), *dims)
    once = star.fact_sales(lake.sales(), *dims, small=frozenset({"dim_product", "dim_promotion"}))
    # One side of the customer lookup is the ledger, the other the customers.
    assert plan_of(once).count("Exchange hashpartitioning") == 2
    assert plan_of(shuffled).count("Exchange hashpartitioning") == 6
    assert sorted(map(str, once.collect())) == sorted(map(str, shuffled.collect()))
    assert lookups.fits_broadcast(100_000, 20) and not lookups.fits_broadcast(10_000_000, 20)
    seen = write_observed(lake.products(), new_folder(spark), widest=["product_id"])
    assert (seen["count"], seen["widest"]) == (3, {"product_id": 2})


def _read_files(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_registered_months_follow_a_publication(spark, lake):
    lake, _, _ = lake
    medallion.register_star(lake, "batches_test", location=f"{lake.root}/catalog")
    medallion.register_star(lake, "batches_test", location=f"{lake.root}/catalog")
    counts = spark.table("batches_test.fact_sales").groupBy("sale_month").count().collect()
    assert sum(r["count"] for r in counts) == 220 and len(counts) == 10
    spark.sql("DROP SCHEMA batches_test CASCADE")


def test_an_increment_without_sales_or_changes_keeps_all_months(spark):
    lake = medallion.Lakehouse(spark, new_folder(spark))
    for entity, refine in (("customer", medallion.refine_customers), ("product", medallion.refine_products)):
        refine(lake, batch(spark, entity, "", "historical"), "historical")
    sold = rows(spark, "sales", 3, transaction_date=F.lit("2024-03-01"))
    medallion.refine_sales(lake, medallion.CLEANERS["sales"](medallion.stamp_provenance(sold, "sales", "historical", "")))
    medallion.build_star(lake)
    medallion.refine_products(lake, batch(spark, "product", "b", unit_price=F.lit("9")), "incremental")
    tables = medallion.build_star(lake)
    record = lake.publication()
    assert (record["number"], record["months"]) == (2, {"202403": 1})
    assert tables["fact_sales"].count() == 3 and {r.unit_price for r in tables["dim_product"].collect()} == {0.0, 9.0}
    # Nothing new: the same publication stands.
    medallion.build_star(lake)
    assert lake.publication()["number"] == 2
