"""Joins between ledger, dimensions and increments.

A dimension is broadcast where its size is known from its write and within BROADCAST_BYTES,
so that the ledger is not shuffled for it. Otherwise no side is hinted: Catalyst broadcasts a
side whose measured size is under `spark.sql.autoBroadcastJoinThreshold` and shuffles beyond.
An increment is broadcast by the rows it holds. Catalyst would go by the size of its files,
which compression makes a small part of the rows' size in the driver's memory.
In a shuffled lookup the dimension has one row per key, and adaptive execution splits the
fact rows of a hot or NULL key over several tasks.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.contracts import UNKNOWN_SK

#: Keys and surrogate keys of a dimension that may go to every task.
BROADCAST_BYTES = 64 << 20

#: Keys of an increment that may go to every task. A merge holds several of them at a time.
INCREMENT_BYTES = 8 << 20


def fits_broadcast(rows: int, key_bytes: int) -> bool:
    """Whether so many rows, with keys of at most so many bytes, may go to every task; a row
    takes some 64 bytes beside its keys."""
    return rows * (key_bytes + 64) <= BROADCAST_BYTES


def is_small(increment: DataFrame, key: str) -> bool:
    """Whether an increment's keys may go to every task, counted in one scan of its keys; so it
    should be stored."""
    widest = F.max(F.octet_length(F.col(key).cast("string")))
    rows, key_bytes = increment.agg(F.count(F.lit(1)), widest).first()
    return rows * ((key_bytes or 0) + 64) <= INCREMENT_BYTES


def spread(side: DataFrame, small: bool) -> DataFrame:
    """A join's side that goes to every task if it is small, and else is shuffled whatever
    size its files have."""
    return F.broadcast(side) if small else side.hint("shuffle_merge")


def matching(
    target: DataFrame, source: DataFrame, key: str, small: bool | None = None
) -> DataFrame:
    """Target rows whose key occurs in the source.

    A small increment is broadcast here, so the big target is only scanned. Where `small` is
    not given, the source is counted.
    """
    small = is_small(source, key) if small is None else small
    return target.join(spread(source.select(key), small), key, "left_semi")


def new_keys(
    source: DataFrame, target: DataFrame, key: str, small: bool | None = None
) -> DataFrame:
    """Source rows whose key the target lacks."""
    small = is_small(source, key) if small is None else small
    # Keys once each, however often the target repeats them.
    known = matching(target.select(key), source, key, small).distinct()
    return source.join(spread(known, small), key, "left_anti")


def carry_key(
    source: DataFrame, target: DataFrame, key: str, surrogate: str, small: bool | None = None
) -> DataFrame:
    """Source rows whose key the target has, with the target's surrogate key."""
    small = is_small(source, key) if small is None else small
    owned = matching(target.select(key, surrogate), source, key, small)
    return source.join(owned if small else spread(owned, small), key, "inner")


def or_unknown(surrogate: Column) -> Column:
    return F.coalesce(surrogate, F.lit(UNKNOWN_SK).cast("bigint"))


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    on: list[str],
    surrogate: str,
    unknown: bool = True,
    small: bool = False,
) -> DataFrame:
    """Append the dimension's surrogate key; 0 where no member matches, or NULL if not `unknown`.
    `small` says that the dimension fits_broadcast."""
    members = dimension.select(*on, surrogate)
    if small:
        members = F.broadcast(members)
    found = fact.drop(surrogate).join(members, on, "left")
    return found.withColumn(surrogate, or_unknown(F.col(surrogate))) if unknown else found


def lookup_as_of(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    day: Column,
    surrogate: str,
    unknown: bool = True,
) -> DataFrame:
    """Append the key of the version valid on a day; 0 where none is, or NULL if not `unknown`.

    Versions of a key hold disjoint day ranges, closed at both ends, open while the end
    is NULL, so at most one matches. The key is the join key; the range is checked on
    its matches, of which there are as many as the key has versions.
    """
    ranges = versions.select(
        F.col(key).alias("_member"),
        F.col("effective_start_date").alias("_from"),
        F.col("effective_end_date").alias("_to"),
        surrogate,
    )
    dated = fact.drop(surrogate).withColumn("_day", day)
    valid = (
        (F.col(key) == F.col("_member"))
        & (F.col("_day") >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col("_day") <= F.col("_to")))
    )
    found = dated.join(ranges, valid, "left").drop("_member", "_from", "_to", "_day")
    return found.withColumn(surrogate, or_unknown(F.col(surrogate))) if unknown else found
