import pytest
from pyspark.sql import functions as F

from checks.queries import write_audit
from martwright.contracts import ENTITIES, SOURCE_COLUMNS
from martwright.operators import audit
from martwright.plans import medallion
from martwright.sources import files, staging
from martwright.sources.staging import new_folder


def rows(spark, entity, count, **columns):
    given = {SOURCE_COLUMNS[entity][0]: (F.col("id") + 1).cast("string"), **columns}
    return spark.range(count).select(
        *[given.get(c, F.lit("1")).alias(c) for c in SOURCE_COLUMNS[entity]],
        *[given[c].alias(c) for c in given if c not in SOURCE_COLUMNS[entity]],
    )


def deliver(spark, root, load_type, feeds, slip=0):
    for entity, df in feeds.items():
        files.write_text_csv(df, f"{root}/in/{load_type}/{entity}")
        counts = lambda name: audit.row_counts({name: df}).withColumn("actual", F.col("actual") + slip)
        write_audit(
            counts(f"{entity}_{load_type}"),
            f"{root}/landing/{medallion.LANDING_AUDIT_FILES[load_type].format(entity=entity)}",
        )
        write_audit(
            counts(medallion.SILVER_AUDIT_DATASETS[load_type].format(entity=entity)),
            f"{root}/silver/{medallion.SILVER_AUDIT_FILES[load_type].format(entity=entity)}",
        )


def sales(spark, first, count):
    return rows(
        spark, "sales", count,
        transaction_id=(F.col("id") + first).cast("string"),
        transaction_date=F.lit("2024-03-01"),
        total_sales=F.lit("10.5"),
    )


def test_the_flow_and_its_rerun(spark, conf):
    root, lake = new_folder(spark), medallion.Lakehouse(spark, new_folder(spark))
    staged = f"{new_folder(spark)}/staged"
    conf(staging.SETTING, staged)
    deliver(
        spark, root, "historical",
        {"customer": rows(spark, "customer", 3), "product": rows(spark, "product", 2), "sales": sales(spark, 1, 4)},
    )
    change = rows(spark, "customer", 4, age=F.lit("50"), effective_start_date=F.lit("2024-02-01"))
    deliver(
        spark, root, "incremental",
        {"customer": change, "product": rows(spark, "product", 3, unit_price=F.lit("9")), "sales": sales(spark, 3, 5)},
    )
    roots = {load: f"{root}/in/{load}" for load in ("historical", "incremental")}
    report = medallion.run(lake, roots, f"{root}/landing", f"{root}/silver", "2024-12-31")
    assert [r.status for r in report.collect()] == ["PASS"] * 6

    def sizes():
        return lake.customers().count(), lake.products().count(), lake.sales().count()

    assert sizes() == (7, 3, 7)
    # Rows staged on the way are gone, the tables stand for themselves.
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(staged)
    folders = {r.path.rsplit("/", 1)[0] for r in folders.select("path").collect()}
    assert len(folders) > 5 and all(spark.read.parquet(f).count() == 0 for f in folders)
    tables = lake.star()
    assert {k: v.count() for k, v in tables.items()} == {
        "dim_customer": 8, "dim_product": 4, "dim_promotion": 2, "dim_date": 2, "fact_sales": 7,
    }
    assert medallion.kpi_report(tables)["net_margin_by_store"].first().gross_revenue == 73.5
    assert medallion.published_kpis(lake)["net_margin_by_store"].first().gross_revenue == 73.5

    medallion.run(lake, roots, f"{root}/landing", f"{root}/silver", "2024-12-31")
    assert sizes() == (7, 3, 7)
    assert lake.bronze("sales", "incremental").history().count() == 5

    later = new_folder(spark)
    deliver(
        spark, later, "incremental",
        {
            "customer": rows(spark, "customer", 1, age=F.lit("51"), effective_start_date=F.lit("2024-05-01")),
            "product": rows(spark, "product", 1, unit_price=F.lit("8")),
            "sales": sales(spark, 100, 2),
        },
    )
    medallion.load_batch(lake, f"{later}/in/incremental", f"{later}/landing", f"{later}/silver", "incremental", "may")
    assert sizes() == (8, 3, 9)
    first = lake.customers().filter("customer_id = '1'").orderBy("effective_start_date").collect()
    assert [str(r.effective_end_date) for r in first] == ["2024-01-31", "2024-04-30", "None"]

    medallion.register_star(lake, "flow_test", location=f"{lake.root}/catalog")
    assert spark.table("flow_test.fact_sales").count() == 7


def test_a_failed_audit_leaves_landing_unpublished(spark):
    root, lake = new_folder(spark), medallion.Lakehouse(spark, new_folder(spark))
    deliver(spark, root, "historical", {"product": rows(spark, "product", 2)}, slip=1)
    medallion.ingest_raw(lake, f"{root}/in/historical", "product", "historical")
    with pytest.raises(RuntimeError, match="product_historical"):
        medallion.land(lake, f"{root}/landing", "product", "historical")
    assert lake.landing("product", "historical").published() == 0


def test_entities():
    assert ENTITIES == ("customer", "product", "sales")


def test_another_historical_delivery_is_refused(spark):
    """Also if all its keys are known and only attributes differ."""
    lake = medallion.Lakehouse(spark, new_folder(spark))

    def batch(entity, load_type, label="", **columns):
        return medallion.CLEANERS[entity](medallion.stamp_provenance(rows(spark, entity, 1, **columns), entity, load_type, label))

    first = batch("product", "historical")
    medallion.refine_products(lake, first, "historical")
    medallion.refine_products(lake, batch("product", "incremental", unit_price=F.lit("9")), "incremental")
    # Silver has taken this batch, though none of its rows is current any more.
    medallion.refine_products(lake, first, "historical")
    with pytest.raises(ValueError, match="historical product"):
        medallion.refine_products(lake, batch("product", "historical", "corrected", unit_price=F.lit("8")), "historical")
    customers = batch("customer", "historical")
    medallion.refine_customers(lake, customers, "historical")
    medallion.refine_customers(lake, customers, "historical")
    with pytest.raises(ValueError, match="historical customer"):
        medallion.refine_customers(lake, batch("customer", "historical", "corrected", age=F.lit("60")), "historical")
