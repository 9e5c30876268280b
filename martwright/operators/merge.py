"""Merges into Silver: customer history, current products, the sales ledger.

Each merge is a function of the target and the increment. The increment must hold one
row per key (customers: per key and version), which the cleaners ensure.
"""

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.contracts import OPTIONAL_COLUMNS, PROVENANCE
from martwright.functions.hashing import row_hash
from martwright.functions.parsing import to_day, to_whole
from martwright.operators.dedup import keep_first
from martwright.operators.keys import dense_key, dense_key_by, id_order
from martwright.operators.lookups import carry_key, is_small, matching, new_keys, spread
from martwright.sources.files import padded_union

CUSTOMER_KEY, CUSTOMER_SK = "customer_id", "customer_sk"
PRODUCT_KEY, PRODUCT_SK = "product_id", "product_sk"
SALES_KEY, SALES_SK = "transaction_id", "sales_sk"

# Fixed value: start of every initial customer version.
BEGINNING = "1900-01-01"

_SCD_COLUMNS = ("effective_start_date", "effective_end_date", "is_current")


# --- customer: full history ---------------------------------------------------------


def tracked_columns(df: DataFrame) -> list[str]:
    """Attributes whose change makes a new version."""
    untracked = {
        CUSTOMER_KEY, CUSTOMER_SK, *PROVENANCE, *OPTIONAL_COLUMNS["customer"],
    }
    return [c for c in df.columns if c not in untracked and not c.startswith("_")]


def change_hash(df: DataFrame) -> Column:
    tracked = tracked_columns(df)
    if not tracked:
        raise ValueError("no customer attributes to track")
    return row_hash(tracked)


def initialize_history(historical: DataFrame) -> DataFrame:
    """First customer table: one open version per row, valid from the beginning."""
    rows = historical.drop(*OPTIONAL_COLUMNS["customer"])
    keyed = dense_key(
        rows.withColumn("_hash", change_hash(rows)),
        [*id_order(CUSTOMER_KEY), F.col("_hash")],
        CUSTOMER_SK,
    )
    return keyed.drop("_hash").withColumns(
        {
            "effective_start_date": F.lit(BEGINNING).cast("date"),
            "effective_end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def classify_changes(
    source: DataFrame, current: DataFrame, small: bool | None = None
) -> DataFrame:
    """Mark source rows as new, changed or unchanged against the current versions.

    Hashes are taken of the current versions that the increment touches, not of all. `small`
    says whether the source is_small; where it is not given, the source is counted.
    """
    tracked = tracked_columns(source)
    small = is_small(source, CUSTOMER_KEY) if small is None else small
    known = matching(current, source, CUSTOMER_KEY, small).select(
        CUSTOMER_KEY,
        F.col("effective_start_date").alias("_known_start"),
        row_hash(tracked).alias("_known_hash"),
    )
    return (
        source.withColumn("_hash", change_hash(source))
        .join(known if small else spread(known, small), CUSTOMER_KEY, "left")
        .withColumn(
            "change",
            F.when(F.col("_known_hash").isNull(), "new")
            .when(F.col("_hash") == F.col("_known_hash"), "unchanged")
            .otherwise("changed"),
        )
    )


def _with_start(source: DataFrame, as_of: datetime.date | str | None) -> DataFrame:
    """Missing starts are the given day, or else the day on which the batch was taken."""
    if as_of is not None:
        default = F.lit(str(as_of)).cast("date")
    elif "ingested_at" in source.columns:
        default = F.coalesce(F.col("ingested_at").cast("date"), F.current_date())
    else:
        default = F.current_date()
    if "effective_start_date" not in source.columns:
        return source.withColumn("effective_start_date", default)
    given = to_day(F.col("effective_start_date").cast("string"))
    return source.withColumn("effective_start_date", F.coalesce(given, default))


def _drop_settled(
    versions: DataFrame, target: DataFrame, tracked: list[str], small: bool
) -> DataFrame:
    """Drop versions from before the current one that the history already shows.

    A repeated batch brings them again. A version whose attributes differ from those
    valid on its day stays, and the merge reports its late start.
    """
    history = matching(target, versions, CUSTOMER_KEY, small)
    shown = history.select(
        F.col(CUSTOMER_KEY).alias("_id"),
        row_hash(tracked).alias("_shown_hash"),
        F.col("effective_start_date").alias("_from"),
        F.col("effective_end_date").alias("_to"),
    )
    start = F.col("effective_start_date")
    settled = (
        (F.col(CUSTOMER_KEY) == F.col("_id"))
        & (F.col("_hash") == F.col("_shown_hash"))
        & (start <= F.col("_known_start"))
        & (start >= F.col("_from"))
        & (F.col("_to").isNull() | (start <= F.col("_to")))
    )
    return versions.join(shown if small else spread(shown, small), settled, "left_anti")


def _chain_versions(dated: DataFrame, target: DataFrame, small: bool) -> DataFrame:
    """Versions of one increment, each closed the day before the next starts.

    Ranges are whole days, so of several versions starting on one day the last stays;
    that also bounds a customer's group by the number of days, however many rows it had.
    """
    last_of_day = keep_first(
        dated,
        [CUSTOMER_KEY, "effective_start_date"],
        [
            to_whole(F.col("version").cast("string"), "bigint").desc_nulls_last(),
            F.col("version").desc_nulls_last(),
            change_hash(dated).desc(),
        ],
    )
    open_versions = _drop_settled(
        classify_changes(last_of_day, target.filter("is_current"), small),
        target,
        tracked_columns(dated),
        small,
    )
    by_start = Window.partitionBy(CUSTOMER_KEY).orderBy("effective_start_date")
    before = F.coalesce(F.lag("_hash").over(by_start), F.col("_known_hash"))
    changed = (
        open_versions.withColumn("_before", before)
        .filter(F.col("_before").isNull() | (F.col("_before") != F.col("_hash")))
        .drop("_before", "change")
    )
    following = F.lead("effective_start_date").over(by_start)
    return changed.withColumn("effective_end_date", F.date_sub(following, 1))


def version_changes(
    target: DataFrame,
    source: DataFrame,
    as_of: datetime.date | str | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The versions an increment adds, with their ranges, not yet keyed."""
    small = is_small(source, CUSTOMER_KEY) if small is None else small
    dated = _with_start(source, as_of)
    if "version" in source.columns:
        changes = _chain_versions(dated, target, small)
    else:
        classified = classify_changes(dated, target.filter("is_current"), small)
        changes = (
            _drop_settled(classified, target, tracked_columns(dated), small)
            .filter("change != 'unchanged'")
            .withColumn("effective_end_date", F.lit(None).cast("date"))
            .drop("change")
        )
    return changes.withColumn("is_current", F.col("effective_end_date").isNull()).drop(
        "_known_hash", "_known_start", "version", "surrogate_key"
    )


@dataclass(frozen=True)
class HistoryMerge:
    """A customer merge in the parts that storage treats differently."""

    earlier: DataFrame
    resolved: DataFrame
    inserted: DataFrame
    late_starts: DataFrame

    def table(self) -> DataFrame:
        """The whole table after the merge."""
        return padded_union([self.earlier, self.resolved, self.inserted])

    def current(self) -> DataFrame:
        """The open versions after the merge."""
        return padded_union([self.resolved, self.inserted]).filter("is_current")

    def closed(self) -> DataFrame:
        """The versions this merge closed or added as closed."""
        return padded_union([self.resolved, self.inserted]).filter("NOT is_current")


def merge_history(
    target: DataFrame,
    source: DataFrame,
    as_of: datetime.date | str | None = None,
    greatest: int | None = None,
) -> HistoryMerge:
    """Close changed versions and add their successors and new customers.

    A version without a start date starts on `as_of`, or else on the day of its
    `ingested_at`. `late_starts` lists customers whose new version would not start after
    the one it closes; the caller must refuse such a batch. Keys go on from `greatest`, or
    else from the target's greatest one.
    """
    small = is_small(source, CUSTOMER_KEY)
    changes = version_changes(target, source, as_of, small)
    inserted = dense_key(
        changes,
        [*id_order(CUSTOMER_KEY), F.col("effective_start_date"), F.col("_hash")],
        CUSTOMER_SK,
        after=target if greatest is None else greatest,
    ).drop("_hash")

    successors = inserted.groupBy(CUSTOMER_KEY).agg(
        F.min("effective_start_date").alias("_successor")
    )
    successors = spread(successors, small)
    current = target.filter("is_current")
    succeeded = current.join(successors, CUSTOMER_KEY, "left")
    resolved = succeeded.withColumns(
        {
            "effective_end_date": F.coalesce(
                F.date_sub("_successor", 1), F.col("effective_end_date")
            ),
            "is_current": F.col("_successor").isNull(),
        }
    ).drop("_successor")
    late = (
        current.join(successors, CUSTOMER_KEY)
        .filter(F.col("_successor") <= F.col("effective_start_date"))
        .select(CUSTOMER_KEY, "effective_start_date", F.col("_successor").alias("new_start"))
    )
    return HistoryMerge(target.filter("NOT is_current"), resolved, inserted, late)


def current_violations(customers: DataFrame) -> DataFrame:
    """Customers that do not have exactly one current version."""
    return (
        customers.groupBy(CUSTOMER_KEY)
        .agg(F.count_if("is_current").alias("current_rows"))
        .filter(F.col("current_rows") != 1)
    )


# --- product: current values --------------------------------------------------------


def initialize_products(historical: DataFrame) -> DataFrame:
    return dense_key(historical, id_order(PRODUCT_KEY), PRODUCT_SK)


def upsert_products(
    target: DataFrame, source: DataFrame, greatest: int | None = None
) -> DataFrame:
    """Replace matching products under their key, add new ones under the next keys."""
    incoming, small = source.drop(PRODUCT_SK), is_small(source, PRODUCT_KEY)
    ids = spread(incoming.select(PRODUCT_KEY), small)
    untouched = target.join(ids, PRODUCT_KEY, "left_anti")
    replaced = carry_key(incoming, target, PRODUCT_KEY, PRODUCT_SK, small)
    added = dense_key(
        new_keys(incoming, target, PRODUCT_KEY, small),
        id_order(PRODUCT_KEY),
        PRODUCT_SK,
        after=target if greatest is None else greatest,
    )
    return padded_union([untouched, replaced, added])


# --- sales: insert-only ledger ------------------------------------------------------


def initialize_ledger(historical: DataFrame, in_buckets: bool = False) -> DataFrame:
    """`in_buckets` as for dense_key_by."""
    return dense_key_by(historical, SALES_KEY, SALES_SK, in_buckets=in_buckets)


# Stored ids are dealt into so many parts by their hash.
KEY_PARTS = 64
KEY_PART = "key_part"


def key_part() -> Column:
    """Part of the stored ids that an id belongs to."""
    return F.pmod(F.xxhash64(SALES_KEY), F.lit(KEY_PARTS)).cast("int")


def touched_keys(keys: DataFrame, source: DataFrame) -> DataFrame:
    """The stored ids (with their `key_part`) among which those of the source can be; other
    parts' files stay unread. The parts, KEY_PARTS at most, go through the driver."""
    parts = [row[0] for row in source.select(key_part()).distinct().collect()]
    return keys.filter(F.col(KEY_PART).isin(parts)).select(SALES_KEY)


def ledger_additions(
    target: DataFrame, source: DataFrame, greatest: int | None = None
) -> DataFrame:
    """Transactions the ledger lacks, keyed on from its greatest key; with that given, the
    target need only hold the ids."""
    return dense_key_by(
        new_keys(source.drop(SALES_SK), target, SALES_KEY),
        SALES_KEY,
        SALES_SK,
        after=target if greatest is None else greatest,
    )


def append_ledger(target: DataFrame, source: DataFrame) -> DataFrame:
    """Ledger with the unseen transactions; those it holds never change."""
    return padded_union([target, ledger_additions(target, source)])


def touched_violations(merged: HistoryMerge) -> DataFrame:
    """current_violations among the customers that a merge has touched."""
    rows = padded_union([merged.resolved, merged.inserted])
    return current_violations(matching(rows, merged.inserted, CUSTOMER_KEY))
