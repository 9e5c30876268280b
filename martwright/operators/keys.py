"""Dense sequential surrogate keys without a single-task window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.parsing import to_whole
from martwright.sources.staging import stage, stage_by

_POSITION = "_position"
_RUN = "_run"

# monotonically_increasing_id puts the task number above bit 33 and the row's position
# within the task below it.
_RUN_BITS = 33


def id_order(key: str) -> list[Column]:
    """Numeric order of a text id; the text itself orders ids that are no numbers."""
    return [to_whole(F.col(key).cast("string"), "bigint"), F.col(key)]


def dense_key(
    df: DataFrame, order: list[Column], name: str, after: DataFrame | int | None = None
) -> DataFrame:
    """Number rows 1, 2, 3… in a total order, or on from the greatest key of `after`, a
    table or, where that is known from its publish records, the key itself.

    A global sort spreads rows over tasks by range on all ordering columns, which also
    splits a run of equal or NULL leading values. The sorted rows are written once with
    their position, because a second evaluation of the sort could draw other range
    bounds. Per-task counts then give each run its offset: one row per task of the
    sort, hence a broadcast and an unpartitioned window of that size.
    """
    positioned = df.orderBy(*order).withColumn(_POSITION, F.monotonically_increasing_id())
    rows = stage(positioned).withColumn(_RUN, F.shiftright(_POSITION, _RUN_BITS))

    earlier_runs = Window.orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(_RUN)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_RUN, F.coalesce(F.sum("_rows").over(earlier_runs), F.lit(0)).alias("_offset"))
    )
    within_run = F.col(_POSITION).bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    number = greatest_key(after, name) + F.col("_offset") + within_run + 1
    return (
        rows.join(F.broadcast(offsets), _RUN)
        .withColumn(name, number.cast("bigint"))
        .drop(_RUN, _POSITION, "_offset")
    )


def dense_key_by(
    df: DataFrame, key: str, name: str, after: DataFrame | int | None = None, in_buckets: bool = False
) -> DataFrame:
    """Number rows as dense_key does in the id_order of a key; rows that share a key, or have
    none, follow each other in any order.

    Only the keys are sorted. Rows are written once, in buckets of the key, and meet their
    numbers there, so no whole row is shuffled for it. `in_buckets` says that stage_by has
    stored them by the key already.
    """
    rows = df.drop(name) if in_buckets else stage_by(df.drop(name), key)
    numbers = stage_by(dense_key(rows.select(key), id_order(key), "_number"), key)
    first = numbers.groupBy(key).agg(F.min("_number").alias("_first"))
    # Rows without a key come first in the order and meet no number.
    start = greatest_key(after, name) + F.coalesce(F.col("_first"), F.lit(1))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    # Never by the size of the files, which is a small part of the keys' size in memory.
    return (
        rows.withColumn("_nth", nth)
        .join(first.hint("shuffle_merge"), key, "left")
        .withColumn(name, (start + F.col("_nth") - 1).cast("bigint"))
        .select(*rows.columns, name)
    )


def greatest_key(df: DataFrame | int | None, name: str) -> Column:
    """Greatest key, of a table as a scalar subquery; 0 for no table or an empty one."""
    if df is None or isinstance(df, int):
        return F.lit(df or 0).cast("bigint")
    return F.coalesce(df.select(F.max(name)).scalar(), F.lit(0)).cast("bigint")
