"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_true(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL and FALSE both count 0."""
    return F.count_if(cond)


def exact_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """ROUND(part::NUMERIC / whole * 100, scale) in exact decimal arithmetic.

    Spark rounds decimals HALF_UP, like the numeric type of the source model.
    A zero denominator yields NULL instead of an error.
    """
    num = F.lit(100).cast("decimal(3,0)") * part.cast("decimal(20,0)")
    return F.round(F.try_divide(num, whole.cast("decimal(20,0)")), scale)



def cents(value: Column, scale: int = 2) -> Column:
    """A 2-decimal value as an exact integer count of hundredths.

    Decimal multiplication runs through arbitrary-precision objects; going
    through ``double`` and rounding to the nearest integer is exact for
    values with ``scale`` decimals below 2**53 / 10**scale and stays in
    primitive generated code.
    """
    return F.rint(value.cast("double") * F.lit(float(10 ** scale))).cast("long")


def sum_cents(value: Column, scale: int = 2) -> Column:
    """SUM of a 2-decimal column on the fast 64-bit path.

    Summing ``decimal(10,2)`` directly widens to ``decimal(20,2)``, which
    Spark aggregates with arbitrary-precision objects; integer hundredths
    stay in whole-stage code and are exact (overflow raises under ANSI mode).
    """
    return F.sum(cents(value, scale))


def mean_from_cents(total_cents: Column, n: Column, scale: int = 2) -> Column:
    """Exact decimal mean of a sum of hundredths over a count (NULL if n = 0)."""
    return F.try_divide(total_cents.cast("decimal(20,0)"),
                        (n * F.lit(10 ** scale)).cast("decimal(22,0)"))



def date_key(d: Column) -> Column:
    """Calendar date -> YYYYMMDD integer key."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> dict[str, Column]:
    """Attributes of the calendar dimension as pure functions of the date.

    Queries derive these from the fact's own date instead of joining the
    calendar: same result for a complete date spine, and no join at all.
    """
    year = F.year(d)
    quarter = F.quarter(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week": F.date_format(d, "EEEE"),
        "day_number": (F.weekday(d) + 1).cast("short"),
        "week_number": F.weekofyear(d).cast("short"),
        "month_number": F.month(d).cast("short"),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": quarter.cast("short"),
        "year": year.cast("short"),
        "is_weekend": F.weekday(d) >= 5,
        "fiscal_period": F.format_string("FY%d-Q%d", year, quarter),
    }

