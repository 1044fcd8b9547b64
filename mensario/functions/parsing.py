"""Raw strings to typed values.

A malformed value becomes NULL and never fails the job, whether or not the
session runs in ANSI mode: every conversion is a ``try_`` one.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from mensario.schemas import MONEY


def strip_prefix(col: str) -> Column:
    """Drop everything up to the last hyphen.

    On text of one line this is what removing PREFIX_TO_LAST_HYPHEN does, for half the
    time of a typed row: matching the pattern costs more than all its conversions.
    """
    return F.substring_index(col, "-", -1)


def strip_double_prefix(col: str) -> Column:
    """Drop everything up to the last hyphen if there are at least two, else keep the text.

    As above, but for PREFIX_OF_TWO_HYPHENS.
    """
    second = F.expr(f"locate('-', {col}, locate('-', {col}) + 1)")
    return F.when(second > 0, strip_prefix(col)).otherwise(F.col(col))


def to_id(col: str) -> Column:
    """Text to bigint. Like a non-ANSI cast, "345.0" is 345 and ".5" is 0.

    The pattern runs only for the text a plain conversion refuses.
    """
    integer_part = F.regexp_replace(col, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    fraction_only = F.when(F.col(col).rlike(r"^\s*[+-]?\.\d+\s*$"), F.lit(0).cast("bigint"))
    return F.coalesce(F.col(col).try_cast("bigint"), integer_part.try_cast("bigint"), fraction_only)


def to_day(col: str) -> Column:
    return F.col(col).try_cast("date")


def to_money(col: str) -> Column:
    """Text to decimal(14,2), rounding half up."""
    return F.col(col).try_cast(MONEY)


def year_month(col: str | Column) -> Column:
    """yyyyMM of a yyyy-MM-dd text; a text operation, so it does not validate the date."""
    return F.substring(F.replace(col if isinstance(col, Column) else F.col(col), F.lit("-"), F.lit("")), 1, 6)
