"""Casts that turn malformed text into NULL, also where ANSI mode is on."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a flag and of a plain decimal number.
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")
PLAIN_NUMBER = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$"


def blank_as_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def to_flag(text: Column) -> Column:
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_whole(text: Column, type_name: str = "int") -> Column:
    """Integer of a decimal text, fraction cut off.

    The plain cast answers almost every row; only where it yields NULL is the text
    matched against a number with a fraction, which `try_cast` alone refuses.
    """
    fraction_cut = F.when(
        text.rlike(PLAIN_NUMBER), text.try_cast("decimal(38,18)").try_cast(type_name)
    )
    return F.coalesce(text.try_cast(type_name), fraction_cut)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_moment(text: Column) -> Column:
    return F.try_to_timestamp(text)


def to_day(value: Column) -> Column:
    return value.try_cast("date")
