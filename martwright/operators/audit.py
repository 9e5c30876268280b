"""Row-count reconciliation, table invariants, referential checks."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.lookups import matching
from martwright.operators.merge import CUSTOMER_KEY, SALES_KEY, current_violations
from martwright.operators.star import FACT_KEYS
from martwright.sources.files import strict_union


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, actual) of all datasets in one plan; Parquet answers from footers."""
    return strict_union(
        df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("dataset"), "actual")
        for name, df in datasets.items()
    )


def known_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """(dataset, actual) of counts that writes have observed."""
    return strict_union(
        spark.range(1).select(F.lit(name).alias("dataset"), F.lit(n).cast("bigint").alias("actual"))
        for name, n in counts.items()
    )


def audit_problems(audit: DataFrame, datasets: DataFrame) -> DataFrame:
    """Datasets whose control rows cannot be used: none, several, or no whole number."""
    entries = audit.groupBy(F.col("table_name").alias("dataset")).agg(
        F.count(F.lit(1)).alias("entries"),
        F.count(F.trim("row_count").try_cast("bigint")).alias("numbers"),
    )
    found = F.coalesce(F.col("entries"), F.lit(0))
    return (
        datasets.select("dataset")
        .join(entries, "dataset", "left")
        .select(
            "dataset",
            found.cast("bigint").alias("entries"),
            F.when(found != 1, "expected exactly one audit row")
            .when(F.col("numbers") != 1, "row count is no whole number")
            .alias("problem"),
        )
        .filter("problem IS NOT NULL")
    )


def reconcile(actual: DataFrame, audit: DataFrame) -> DataFrame:
    """Compare counts with the control rows; what cannot be compared fails."""
    expected = audit.groupBy(F.col("table_name").alias("dataset")).agg(
        F.when(
            F.count(F.lit(1)) == 1, F.max(F.trim("row_count").try_cast("bigint"))
        ).alias("expected")
    )
    difference = F.col("actual") - F.col("expected")
    return actual.join(expected, "dataset", "left").select(
        "dataset",
        "expected",
        "actual",
        difference.alias("difference"),
        F.when(difference == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def assert_reconciled(report: DataFrame) -> None:
    """Stop on any dataset that did not pass; the report has one row per dataset."""
    failed = report.filter("status != 'PASS'").orderBy("dataset").collect()
    if failed:
        names = ", ".join(row["dataset"] for row in failed)
        raise RuntimeError(f"MANDATORY AUDIT FAILED: {names}")


def uniqueness_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that do not occur exactly once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows != 1")


def silver_invariants(
    customers: DataFrame,
    products: DataFrame,
    sales: DataFrame,
    new_versions: DataFrame | None = None,
    new_sales: DataFrame | None = None,
) -> DataFrame:
    """(rule, violations) of the three Silver tables.

    Where versions and sales are given that have come since the last check, `customers`
    hold the rules but for these versions' customers, and `sales`, which are those checked
    before, are only searched for the new ids and need hold no other column. A small batch
    is broadcast there, so they are scanned and not shuffled.
    """
    if new_versions is not None:
        customers = matching(customers, new_versions, CUSTOMER_KEY)
    if new_sales is None:
        repeated = uniqueness_violations(sales, SALES_KEY)
    else:
        repeated = strict_union(
            [
                uniqueness_violations(new_sales, SALES_KEY).select(SALES_KEY),
                matching(sales.select(SALES_KEY), new_sales, SALES_KEY),
            ]
        )
    broken = {
        "customer_has_one_current_row": current_violations(customers),
        "customer_sk_not_null": customers.filter("customer_sk IS NULL"),
        "product_id_unique": uniqueness_violations(products, "product_id"),
        "transaction_id_unique": repeated,
    }
    return row_counts(broken).select(
        F.col("dataset").alias("rule"), F.col("actual").alias("violations")
    )


def fact_key_nulls(fact: DataFrame) -> DataFrame:
    """(key, nulls) for every foreign key of the fact, in one scan."""
    counts = fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in FACT_KEYS])
    return counts.unpivot([], list(FACT_KEYS), "key", "nulls")


def fact_key_orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """(key, orphans): fact rows per foreign key whose member does not exist.

    Fact rows are first counted per key value, so the join sees each value once; a
    member as frequent as the Unknown one is a single row there.
    """
    keys = list(dimensions)
    uses = (
        fact.select(*[F.col(k).cast("bigint").alias(k) for k in keys])
        .unpivot([], keys, "key", "member")
        .groupBy("key", "member")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    members = strict_union(
        df.select(F.lit(k).alias("key"), F.col(k).cast("bigint").alias("member"))
        for k, df in dimensions.items()
    )
    known = members.distinct().withColumn("_known", F.lit(True))
    orphan = F.col("_known").isNull() & F.col("member").isNotNull()
    missing = F.when(orphan, F.col("rows")).otherwise(0)
    return (
        uses.join(known, ["key", "member"], "left")
        .groupBy("key")
        .agg(F.sum(missing).alias("orphans"))
    )


def assert_no_violations(report: DataFrame, count: str = "violations") -> None:
    """Stop where a check report has a count above 0; one row per rule."""
    broken = report.filter(F.col(count) > 0).collect()
    if broken:
        raise AssertionError(f"violated: {[row.asDict() for row in broken]}")
