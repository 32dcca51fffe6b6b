"""Date-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, grab, head, strip

BR_DATE = r"(\d{1,2})\/(\d{1,2})\/(\d{4})"


def iso_text(value: Column | str) -> Column:
    """ISO prefix or the first d/m/yyyy as ``YYYY-MM-DD`` text, no calendar check."""
    s = strip(value)
    pad = lambda g: F.lpad(grab(s, BR_DATE, g), 2, "0")
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), head(s, 10)).when(
        s.rlike(BR_DATE), F.concat_ws("-", grab(s, BR_DATE, 3), pad(2), pad(1))
    )


def br_date(iso: Column | str) -> Column:
    """ISO date or date-time text as DD/MM/YYYY."""
    d = F.to_date(F.try_to_timestamp(F.substring(F.replace(blank(iso), F.lit("T"), F.lit(" ")), 1, 10), F.lit("yyyy-MM-dd")))
    return F.date_format(d, "dd/MM/yyyy")


def year_in(text: Column | str) -> Column:
    """First run of four digits."""
    return grab(text, r"(\d{4})").cast("int")


def in_year(closes: Column | str, published: Column | str, year: int) -> Column:
    """Closing, else publication year is ``year``; undated rows stay."""
    y = F.coalesce(year_in(closes), year_in(published))
    return y.isNull() | (y == year)


def month_date(y: Column, m: Column, d: Column) -> Column:
    """Calendar date with day and month overflow rolled forward."""
    return F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)
