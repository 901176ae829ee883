"""Column helpers. All of them compile to built-in expressions, so scans stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def normalized_email(email: Column) -> Column:
    """Lower case without surrounding white space of any kind (plain trim keeps tabs)."""
    return F.lower(F.regexp_replace(email, r"(?U)^\s+|\s+$", ""))


def email_hash(email: Column) -> Column:
    """Hash of the normalised address; a missing one counts as empty, so that its key resolves."""
    return F.sha2(normalized_email(F.coalesce(email, F.lit(""))), 256)


def last4(phone: Column) -> Column:
    return F.right(phone, F.lit(4))


def present(col: Column) -> Column:
    """True when a text cell holds something; never NULL."""
    return col.isNotNull() & (col.cast("string") != "")


def in_domain(col: Column, values: Iterable[str]) -> Column:
    """Membership that counts NULL as outside instead of unknown."""
    return F.coalesce(col.isin(*values), F.lit(False))


def money(col: Column) -> Column:
    """Exact amount with two digits; NULL when the text is no finite number."""
    return col.try_cast("decimal(18,2)")


def parse_date(col: Column) -> Column:
    """A date, or NULL for text that isn't of the form yyyy-MM-dd; typed dates stay as they are.

    The type test is a constant, so only text columns are matched against the pattern.
    """
    formed = F.rlike(col.cast("string"), F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))
    return F.when((F.typeof(col) != "string") | formed, col.try_cast("date"))


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def calendar_attributes(day: Column) -> list[Column]:
    """The date-dimension columns of one day."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    ]


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of new-year boundaries between two days (31 Dec to 1 Jan counts one)."""
    return F.year(end) - F.year(start)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month starts between two days."""
    return year_boundaries(start, end) * 12 + F.month(end) - F.month(start)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Exact decimal quotient rounded half up; NULL when the denominator is zero."""
    return F.round(
        F.try_divide(numerator.cast("decimal(24,2)"), denominator.cast("decimal(16,0)")), digits
    )


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Part of a whole in percent."""
    return ratio(part * 100, whole, digits)
