import pytest
from pyspark.sql import functions as F

from martwright.contracts import SOURCE_COLUMNS
from martwright.operators import audit
from martwright.sources import files, provenance
from martwright.sources.staging import new_folder
from martwright.sources.tables import SnapshotTable


def control(spark, rows):
    return spark.createDataFrame(rows, "table_name string, row_count string")


def report(spark, actual, rows):
    counts = spark.createDataFrame([("d", actual)], "dataset string, actual bigint")
    r = audit.reconcile(counts, control(spark, rows)).first()
    return r.difference, r.status


def test_reconciliation_passes_and_fails(spark):
    assert report(spark, 1052, [("d", "1052")]) == (0, "PASS")
    assert report(spark, 1050, [("d", " 1052 ")]) == (-2, "FAIL")


@pytest.mark.parametrize("rows", [[], [("d", "1"), ("d", "1")], [("d", "one")], [("e", "1")]])
def test_unusable_control_rows_fail(spark, rows):
    assert report(spark, 1, rows) == (None, "FAIL")
    datasets = spark.createDataFrame([("d",)], "dataset string")
    assert audit.audit_problems(control(spark, rows), datasets).count() == 1


def test_gate_stops_on_failure(spark):
    failed = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "dataset string, status string")
    with pytest.raises(RuntimeError, match="MANDATORY AUDIT FAILED: b"):
        audit.assert_reconciled(failed)
    audit.assert_reconciled(failed.filter("status = 'PASS'"))


def test_audit_file_must_have_its_columns(spark):
    folder = new_folder(spark)
    files.write_text_csv(spark.range(1), folder)
    with pytest.raises(ValueError, match="lacks columns"):
        files.read_audit(spark, folder)


def product_file(spark, folder, columns, value):
    df = spark.range(1).select(*[F.lit(f"{value}-{c}").alias(c) for c in columns])
    files.write_text_csv(df.coalesce(1), folder)


def test_feed_columns_bind_by_name(spark):
    root = new_folder(spark)
    names = list(SOURCE_COLUMNS["product"])
    product_file(spark, f"{root}/a/product", names, "a")
    product_file(spark, f"{root}/b/Product", [*reversed(names)], "b")
    product_file(spark, f"{root}/audit/product", ["table_name"], "no")
    rows = files.read_entity_feed(spark, root, "product").collect()
    assert {r.unit_price for r in rows} == {"a-unit_price", "b-unit_price"}
    with pytest.raises(FileNotFoundError):
        files.read_entity_feed(spark, root, "sales")


def test_optional_columns_are_kept_and_gaps_refused(spark):
    folder = new_folder(spark)
    names = list(SOURCE_COLUMNS["product"])
    product_file(spark, folder, ["noise", "last_updated", *names], "v")
    assert files.read_contract_csv(spark, "product", folder).columns == [*names, "last_updated"]
    short = new_folder(spark)
    product_file(spark, short, names[:-1], "v")
    with pytest.raises(ValueError, match="unit_price"):
        files.read_contract_csv(spark, "product", short)


def test_a_folder_with_mixed_headers_fails_or_is_read_per_file(spark):
    root = new_folder(spark)
    names = list(SOURCE_COLUMNS["product"])
    for columns, value in ((names, "a"), ([*reversed(names)], "b")):
        df = spark.range(1).select(*[F.lit(f"{value}-{c}").alias(c) for c in columns])
        df.coalesce(1).write.mode("append").option("header", True).csv(f"{root}/product")
    with pytest.raises(Exception, match="header"):
        files.read_entity_feed(spark, root, "product").collect()
    rows = files.read_entity_feed(spark, root, "product", per_file=True).collect()
    assert {r.product_id for r in rows} == {"a-product_id", "b-product_id"}


def test_files_of_one_header_are_one_scan(spark):
    """300 files in folders of odd names with two headers: two scans, in both readings."""
    root = f"{new_folder(spark)}/feed (a) 5%41"
    names = list(SOURCE_COLUMNS["product"])
    for folder, columns in (("one x", names), ("two", [*reversed(names)]), ("three", names)):
        df = spark.range(0, 100, 1, 100).select(*[F.concat(F.lit(f"{folder}-{c}-"), "id").alias(c) for c in columns])
        files.write_text_csv(df, f"{root}/{folder}/product")
    for per_file in (False, True):
        feed = files.read_entity_feed(spark, root, "product", per_file=per_file)
        plan = feed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2
        rows = feed.collect()
        assert len(rows) == 300 and all(getattr(r, c).split("-")[1] == c for r in rows for c in names)


def test_blanks_survive_the_raw_csv(spark):
    folder = new_folder(spark)
    files.write_text_csv(spark.createDataFrame([(" a ", "  ", None)], "x string, y string, z string"), folder)
    assert tuple(files.read_text_csv(spark, folder).first()) == (" a ", "  ", None)


def test_strict_union_refuses_other_columns(spark):
    with pytest.raises(Exception):
        files.strict_union([spark.range(1), spark.range(1).toDF("x")]).collect()


def test_a_batch_is_appended_once(spark):
    batch = provenance.stamp_provenance(spark.range(3), "sales", "incremental", "a")
    name = provenance.batch_identity("sales", "incremental", "a")
    other = provenance.batch_identity("sales", "incremental", "b")
    assert provenance.append_batch(batch.limit(0), batch, name).count() == 3
    assert provenance.append_batch(batch, batch, name).count() == 3
    assert provenance.append_batch(batch, batch, other).count() == 6


def test_snapshots_show_only_when_published(spark):
    table = SnapshotTable(spark, new_folder(spark))
    assert table.published() == 0
    table.write(spark.range(2))
    with pytest.raises(FileNotFoundError):
        table.latest()
    table.publish()
    table.write(table.latest().filter("id = 1"))
    assert table.latest().count() == 2
    table.publish()
    table.write(spark.range(50))
    assert (table.latest().count(), table.history().count()) == (1, 3)


def test_orphans_and_nulls(spark):
    fact = spark.createDataFrame(
        [(0, 1, 1, 1), (0, 2, 1, 1), (7, None, 1, 1), (0, 1, 1, 1)],
        "customer_sk bigint, product_sk bigint, promotion_sk bigint, date_sk int",
    )
    dims = {k: spark.createDataFrame([(0,), (1,)], f"{k} int") for k in fact.columns}
    orphans = {r.key: r.orphans for r in audit.fact_key_orphans(fact, dims).collect()}
    assert orphans == {"customer_sk": 1, "product_sk": 1, "promotion_sk": 0, "date_sk": 0}
    nulls = {r.key: r.nulls for r in audit.fact_key_nulls(fact).collect()}
    assert nulls == {"customer_sk": 0, "product_sk": 1, "promotion_sk": 0, "date_sk": 0}


def test_feed_files_are_compressed_and_found_beside_plain_ones(spark, tmp_path):
    names = list(SOURCE_COLUMNS["product"])
    rows = spark.range(2000).coalesce(1).select(*[F.concat(F.lit(f"{c}-"), "id").alias(c) for c in names])
    files.write_text_csv(rows, f"{tmp_path}/packed/product")
    rows.write.option("header", True).csv(f"{tmp_path}/plain/product")
    sizes = {
        r.path.split(str(tmp_path))[1].split("/")[1]: r.length
        for r in files.list_feed_files(spark, str(tmp_path), "product").collect()
    }
    assert sizes["packed"] * 3 < sizes["plain"]
    for per_file in (False, True):
        feed = files.read_entity_feed(spark, str(tmp_path), "product", per_file=per_file)
        assert feed.groupBy(*names).count().filter("count = 2").count() == 2000
