"""SHA-256 digests over a list of columns."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digests' separators and NULL marker.
ROW_SEPARATOR = "||"
NULL_MARKER = "<NULL>"
PAYLOAD_SEPARATOR = "|"


def row_hash(columns: Iterable[str]) -> Column:
    """Digest that tells NULL from text and keeps column positions apart."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in columns]
    if not parts:
        raise ValueError("a row hash needs at least one column")
    return F.sha2(F.concat_ws(ROW_SEPARATOR, *parts), 256)


def payload_hash(columns: Iterable[str]) -> Column:
    """Digest of the non-NULL values, used to rank copies of a record."""
    return F.sha2(
        F.concat_ws(PAYLOAD_SEPARATOR, *[F.col(c).cast("string") for c in columns]), 256
    )
