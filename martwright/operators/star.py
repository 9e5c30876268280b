"""Gold star schema: four dimensions with an Unknown member, one fact table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.contracts import UNKNOWN_LABEL, UNKNOWN_SK
from martwright.functions.calendar import calendar_attributes, date_key
from martwright.functions.parsing import to_day
from martwright.operators.keys import dense_key
from martwright.operators.lookups import is_small, lookup, lookup_as_of, matching, spread
from martwright.sources.files import strict_union

# Fixed value: the fact table's columns, in order.
FACT_COLUMNS = (
    "sales_sk", "transaction_id", "customer_sk", "product_sk", "promotion_sk",
    "date_sk", "quantity", "unit_price", "discount_applied", "total_sales",
    "store_location", "transaction_hour", "day_of_week", "promotion_type",
)
FACT_KEYS = ("customer_sk", "product_sk", "promotion_sk", "date_sk")


def _unknown_value(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        value = F.lit(UNKNOWN_LABEL)
    elif isinstance(field.dataType, T.NumericType):
        value = F.lit(UNKNOWN_SK)
    else:
        value = F.lit(None)
    return value.cast(field.dataType)


def unknown_member(dimension: DataFrame, **given) -> DataFrame:
    """One row: 'Unknown' for text, 0 for numbers and keys, NULL or given otherwise."""
    values = [
        (F.lit(given[f.name]) if f.name in given else _unknown_value(f)).alias(f.name)
        for f in dimension.schema
    ]
    return dimension.sparkSession.range(1).select(*values)


def with_unknown(dimension: DataFrame, **given) -> DataFrame:
    return dimension.unionByName(unknown_member(dimension, **given))


def dim_customer(customers: DataFrame) -> DataFrame:
    """All customer versions. The Unknown member is current and has no day range, so no
    sale meets it by date."""
    return with_unknown(customers, is_current=True)


def dim_product(products: DataFrame) -> DataFrame:
    return with_unknown(products)


def promotion_pairs(sales: DataFrame) -> DataFrame:
    return (
        sales.select(promotion_number().alias("promotion_id"), "promotion_type")
        .filter(F.col("promotion_id") != 0)
        .distinct()
    )


def dim_promotion(
    sales: DataFrame, known: DataFrame | None = None, greatest: int | None = None
) -> DataFrame:
    """Observed (id, type) pairs, keyed in that order.

    With the dimension as it was, `sales` need only be new ones: known pairs keep their
    keys and new ones go on from the greatest."""
    pair = ["promotion_id", "promotion_type"]
    pairs = promotion_pairs(sales)
    if known is None:
        return with_unknown(dense_key(pairs, [F.col(c) for c in pair], "promotion_sk"))
    # The type may be NULL.
    same = (pairs.promotion_id == known.promotion_id) & pairs.promotion_type.eqNullSafe(
        known.promotion_type
    )
    new = pairs.join(known, same, "left_anti")
    after = known if greatest is None else greatest
    return known.unionByName(
        dense_key(new, [F.col(c) for c in pair], "promotion_sk", after=after)
    )


def promotion_number() -> Column:
    """Ledger promotion ids are doubles, dimension ids integers."""
    return F.col("promotion_id").try_cast("bigint")


def dim_date(sales: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Observed days; with the dimension as it was, `sales` need only be new ones."""
    days = (
        sales.select(to_day(F.col("transaction_date")).alias("date"))
        .filter(F.col("date").isNotNull())
        .distinct()
    )
    if known is not None:
        days = days.join(known, "date", "left_anti")
    dated = days.withColumns(calendar_attributes(F.col("date")))
    return with_unknown(dated, weekend=False) if known is None else known.unionByName(dated)


def sale_month() -> Column:
    """Year and month of a sale as a number, 0 without a date."""
    day = to_day(F.col("transaction_date"))
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0)).cast("int")


def affected_months(
    ledger: DataFrame, new_sales: DataFrame, new_versions: DataFrame, new_products: DataFrame,
    unknown_months: list[int],
) -> DataFrame:
    """Months (`sale_month`) whose fact rows a batch changes: those of new sales, those in which
    a customer with a new version has bought on its first day or later, and those of sales
    that had an unknown product, among `unknown_months`, and whose product has arrived.

    A day of an older version's customer before the new one's start keeps its version.
    """
    starts = new_versions.groupBy("customer_id").agg(F.min("effective_start_date").alias("_from"))
    first = F.min(F.year("_from") * 100 + F.month("_from"))
    # One number, by which whole months are left unread.
    first = starts.agg(first.alias("month")).first().month
    touched = [new_sales.select("sale_month")]
    if first is not None:
        starts = spread(starts, is_small(new_versions, "customer_id"))
        later = ledger.filter(F.col("sale_month") >= first).join(starts, "customer_id")
        touched.append(
            later.filter(to_day(F.col("transaction_date")) >= F.col("_from")).select("sale_month")
        )
    if unknown_months:
        unresolved = ledger.filter(F.col("sale_month").isin(unknown_months))
        touched.append(matching(unresolved, new_products, "product_id").select("sale_month"))
    return strict_union(touched).distinct()


def fact_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    promotions: DataFrame,
    unknown: bool = True,
    carry: tuple[str, ...] = (),
    small: frozenset[str] = frozenset(),
) -> DataFrame:
    """One row per ledger row with the keys of its dimension members; without `unknown`,
    keys that find no member stay NULL. Columns in `carry` come along; the dimensions named
    in `small` fit_broadcast, so the ledger is shuffled once at most, by customer.

    A promotion is looked up by id and type, as it is keyed, so an id with two types
    does not multiply sales.
    """
    day = to_day(F.col("transaction_date"))
    dated = sales.withColumns(
        {
            "date_sk": F.coalesce(date_key(day), F.lit(0)) if unknown else date_key(day),
            "promotion_id": promotion_number(),
        }
    )
    # Promotions are few: found first, their ids go no further.
    pair = ["promotion_id", "promotion_type"]
    found = lookup(dated, promotions, pair, "promotion_sk", unknown, "dim_promotion" in small)
    found = lookup_as_of(found, customers, "customer_id", day, "customer_sk", unknown)
    found = lookup(found, products, ["product_id"], "product_sk", unknown, "dim_product" in small)
    return found.select(*FACT_COLUMNS, *carry)
