"""Keep one row per key.

Every operator ranks rows with `row_number` and keeps rank 1. Spark turns that into a
per-task top-1 ahead of the shuffle (WindowGroupLimit), so a key with a third of all
rows sends at most one row per task across the network.

Orders end with the payload columns themselves, which are compared only where all else
ties: rows that still tie have equal payloads, and a rerun keeps the same one.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.contracts import PROVENANCE
from martwright.functions.hashing import payload_hash
from martwright.functions.parsing import to_day


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") == 1).drop("_rank")


def payload_columns(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key and c not in PROVENANCE]


def _newest_ingest(df: DataFrame) -> list[Column]:
    return [F.col("ingested_at").desc()] if "ingested_at" in df.columns else []


def _tie_break(df: DataFrame, key: str) -> list[Column]:
    return [F.col(c).desc() for c in payload_columns(df, key)]


def latest_by_version(df: DataFrame, key: str) -> DataFrame:
    """Per key and version the newest ingest."""
    order = [*_newest_ingest(df), *_tie_break(df, key)]
    return keep_first(df, [key, "version"], order)


def one_by_payload(df: DataFrame, key: str) -> DataFrame:
    """Per key the row with the greatest payload digest."""
    payload = payload_columns(df, key)
    order = [payload_hash(payload).desc(), *_newest_ingest(df), *_tie_break(df, key)]
    return keep_first(df, [key], order)


def latest_by_update(df: DataFrame, key: str) -> DataFrame:
    """Per key the newest source update, rows without one last; then newest ingest."""
    updated = (
        [to_day(F.col("last_updated")).desc_nulls_last()]
        if "last_updated" in df.columns
        else []
    )
    return keep_first(df, [key], [*updated, *_newest_ingest(df), *_tie_break(df, key)])


def latest_by_ingest(df: DataFrame, key: str) -> DataFrame:
    """Per key the newest ingest."""
    return keep_first(df, [key], [*_newest_ingest(df), *_tie_break(df, key)])
