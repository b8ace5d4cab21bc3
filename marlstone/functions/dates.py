"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _day_quotient(later: Column, earlier: Column) -> Column:
    # Both sides are truncated to whole seconds before the division.
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / SECONDS_PER_DAY


def days_between(later, earlier, default: float | None = None, digits: int = 2) -> Column:
    """Fractional days, rounded half up; ``default`` where either side is null."""
    later, earlier = _column(later), _column(earlier)
    known = later.isNotNull() & earlier.isNotNull()
    value = F.round(_day_quotient(later, earlier), digits)
    return F.when(known, value).otherwise(F.lit(default).cast("double"))


def whole_days(later, earlier, default: int | None = None) -> Column:
    """Whole days truncated toward zero; ``default`` where either side is null."""
    later, earlier = _column(later), _column(earlier)
    known = later.isNotNull() & earlier.isNotNull()
    value = _day_quotient(later, earlier).cast("int")
    return F.when(known, value).otherwise(F.lit(default).cast("int"))


def age_years(born: Column, as_of: Column) -> Column:
    """Completed years: one less while the birthday has not come round."""
    before_birthday = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (
        F.month(born) * 100 + F.dayofmonth(born)
    )
    return F.year(as_of) - F.year(born) - before_birthday.cast("int")


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; null where it cannot be parsed."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def parse_dmy(text: Column) -> Column:
    """Day/month/year text to date; null where it cannot be parsed."""
    return F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def shift_days(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def shift_months(day: Column, months: int) -> Column:
    """Calendar months; the day is cut to the end of a shorter month."""
    return F.add_months(day, months)
