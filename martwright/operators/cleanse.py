"""Cleansing rules of the Silver layer."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.contracts import (
    CUSTOMER_RULES,
    PRODUCT_RULES,
    SALES_RULES,
    UNKNOWN_LABEL,
    CleanRules,
)
from martwright.functions.parsing import (
    blank_as_null,
    to_double,
    to_flag,
    to_moment,
    to_whole,
)
from martwright.operators.dedup import (
    latest_by_ingest,
    latest_by_update,
    latest_by_version,
    one_by_payload,
)


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def blank_to_null(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """NULL for text of spaces only, in every text column but those to keep."""
    texts = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in set(keep)
    ]
    return df.withColumns({c: blank_as_null(F.col(c)) for c in texts})


def fill_unknown(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    present = _present(df, columns)
    return df.fillna(UNKNOWN_LABEL, subset=present) if present else df


def fill_zero(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(present) if present else df


def normalize_booleans(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_flag(F.col(c)) for c in _present(df, columns)})


def cast_tolerant(
    df: DataFrame, integers: Iterable[str] = (), doubles: Iterable[str] = ()
) -> DataFrame:
    whole = {c: to_whole(F.col(c).cast("string")) for c in _present(df, integers)}
    real = {c: to_double(F.col(c)) for c in _present(df, doubles)}
    return df.withColumns({**whole, **real})


def parse_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_moment(F.col(c)) for c in _present(df, columns)})


def apply_types(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Types first, defaults for what is then NULL second."""
    typed = cast_tolerant(df, rules.integers, rules.doubles)
    typed = parse_timestamps(typed, rules.timestamps)
    typed = normalize_booleans(typed, rules.booleans)
    return fill_zero(fill_unknown(typed, rules.labels), rules.zero_filled)


def _keyed_and_blanked(df: DataFrame, rules: CleanRules) -> DataFrame:
    return blank_to_null(require_key(df, rules.key), keep=[rules.key])


def clean_customer(df: DataFrame) -> DataFrame:
    """One row per customer, or per customer and version where versions are given."""
    rows = _keyed_and_blanked(df, CUSTOMER_RULES)
    choose = latest_by_version if "version" in df.columns else one_by_payload
    return apply_types(choose(rows, CUSTOMER_RULES.key), CUSTOMER_RULES)


def clean_product(df: DataFrame) -> DataFrame:
    """The most recently updated row of each product."""
    rows = _keyed_and_blanked(df, PRODUCT_RULES)
    return apply_types(latest_by_update(rows, PRODUCT_RULES.key), PRODUCT_RULES)


def clean_sales(df: DataFrame) -> DataFrame:
    """The most recently ingested row of each transaction."""
    rows = _keyed_and_blanked(df, SALES_RULES)
    return apply_types(latest_by_ingest(rows, SALES_RULES.key), SALES_RULES)


CLEANERS = {"customer": clean_customer, "product": clean_product, "sales": clean_sales}
