"""Typing, cleaning and checking expressions for tabular records.

Casts are lenient: a value that does not fit becomes NULL instead of failing
the job, whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_int(value: ColumnOrName) -> Column:
    return as_column(value).try_cast("int")


def split_list(value: ColumnOrName) -> Column:
    """``"A, B"`` → ``['A', ' B']``: quotes dropped, split on the comma, nothing trimmed."""
    return F.split(F.replace(as_column(value), F.lit('"'), F.lit("")), ",")


def percent_to_decimal(value: ColumnOrName) -> Column:
    """``"87.456%"`` → ``87.46``; text that is no number, or over 999.99, → NULL."""
    return F.replace(as_column(value), F.lit("%"), F.lit("")).try_cast("decimal(5,2)")


def attendance_number(value: ColumnOrName) -> Column:
    """Attendance as FLOAT, from a number or from text that may carry a percent sign."""
    return F.replace(as_column(value).cast("string"), F.lit("%"), F.lit("")).try_cast("float")


def short_date(value: ColumnOrName) -> Column:
    """Parse ``dd/MM/yy`` (years 2000 to 2099); anything else → NULL.

    The parts are put in the order that a cast takes: parsing by a pattern costs several times as much.
    """
    value = as_column(value)
    parts = [F.substring(value, place, 2) for place in (7, 4, 1)]
    return F.when(value.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{2}\z"), F.concat(F.lit("20"), F.concat_ws("-", *parts)).try_cast("date"))


def row_text(*columns: ColumnOrName) -> Column:
    """One comma-joined string for a whole row. NULL fields are skipped, so later fields move up."""
    return F.concat_ws(",", *[as_column(c).cast("string") for c in columns])


def joined_list(value: ColumnOrName) -> Column:
    return F.concat_ws(";", as_column(value))


def normalised(value: ColumnOrName) -> Column:
    return F.upper(F.trim(as_column(value)))


def is_missing_text(value: ColumnOrName) -> Column:
    value = as_column(value)
    return value.isNull() | (F.trim(value) == "")


def is_missing_list(value: ColumnOrName) -> Column:
    value = as_column(value)
    return value.isNull() | (F.size(value) == 0) | F.array_contains(value, "")


def breaks_pattern(value: ColumnOrName, pattern: str) -> Column:
    value = as_column(value)
    return value.isNotNull() & ~value.rlike(pattern)


def outside_range(value: ColumnOrName, low: float, high: float) -> Column:
    value = as_column(value)
    return value.isNotNull() & ((value < low) | (value > high))


def not_in_list(value: ColumnOrName, allowed: list[str]) -> Column:
    value = as_column(value)
    return value.isNotNull() & ~normalised(value).isin(allowed)


def not_short_date(value: ColumnOrName) -> Column:
    value = as_column(value)
    return value.isNotNull() & short_date(value).isNull()


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as DOUBLE; NULL when ``whole`` is zero."""
    return F.try_divide(F.lit(100.0) * part, whole)
