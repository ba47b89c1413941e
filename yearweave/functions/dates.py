"""Date scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearweave.functions.logic import ColumnOrName, col
from yearweave.functions.strings import squish

# The accepted date orders, tried in this order per value. ``Y`` is a four-digit year, ``m`` and
# ``d`` one or two digits, ``b`` an English month name or its first three letters. As the reference's parser
# does, separators in an order stand for any run of other characters between the parts, or none.
DEFAULT_DATE_ORDERS: tuple[str, ...] = ("Ymd", "mdY", "dbY")
_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + ")"
_PARTS = {"Y": r"((?!0000)\d{4})", "m": r"(\d{1,2})", "d": r"(\d{1,2})", "b": f"({_MONTH})"}
_TWO_DIGITS = {**_PARTS, "m": r"(\d{2})", "d": r"(\d{2})"}


def _order_patterns(order: str) -> list[str]:
    """Patterns of one order: digits run together (then two per month and day), or parts set apart; between a
    digit and a letter nothing need stand."""
    between = [r"[^\p{L}\d]*" if "b" in pair else r"[^\p{L}\d]+" for pair in zip(order, order[1:])]
    apart = "(?i)^" + _PARTS[order[0]] + "".join(sep + _PARTS[p] for sep, p in zip(between, order[1:])) + "$"
    return [apart] if "b" in order else ["^" + "".join(_TWO_DIGITS[p] for p in order) + "$", apart]


def parse_date_order(cleaned: Column, order: str) -> Column:
    """The date that squished text names in this one order, else NULL.

    A matching value is put into the form year-month-day, which Spark casts without a datetime pattern.
    """
    place = {p: f"${i}" for i, p in enumerate(order, 1)}
    form = "-".join(place[p] for p in ("Y", "b" if "b" in order else "m", "d"))
    attempts = []
    for pattern in _order_patterns(order):
        value = F.regexp_replace(cleaned, pattern, form)
        if "b" in order:
            parts = F.split(value, "-")
            month = (F.instr(F.lit("".join(m[:3] for m in _MONTHS)), F.initcap(F.left(F.get(parts, F.lit(1)), F.lit(3)))) + 2) / 3
            value = F.concat_ws("-", F.get(parts, F.lit(0)), month.cast("int"), F.get(parts, F.lit(2)))
        attempts.append(F.when(cleaned.rlike(pattern), value.try_cast("date")))
    return F.coalesce(*attempts)


def squish_or_null(c: ColumnOrName) -> Column:
    """Squished text, ``""`` as NULL - the input form of :func:`parse_date_multi`."""
    return F.nullif(squish(c), F.lit(""))


def parse_date_multi(c: ColumnOrName, orders: Sequence[str] = DEFAULT_DATE_ORDERS, squished: bool = False) -> Column:
    """Squish, ``""`` to NULL, then the first order that gives a valid date wins.

    ``2014/03/05``, ``2014.3.5``, ``2014 03 05``, ``03-05-2018``, ``5Mar2014`` and ``05-MAR-2014`` all parse. A value
    that no order accepts, or whose day does not exist, is NULL; nothing raises under ANSI mode. Pass ``squished=True`` when ``c`` already
    is :func:`squish_or_null` output (a staged column), so the squish runs once per value.
    """
    cleaned = col(c) if squished else squish_or_null(c)
    return F.coalesce(*[parse_date_order(cleaned, order) for order in orders])


def as_date(c: ColumnOrName) -> Column:
    """Timestamp (incl. TIMESTAMP_NTZ) or date to DATE."""
    return F.to_date(col(c))


def minus_months_strict(d: ColumnOrName, months: int) -> Column:
    """``d - months`` as a calendar period; NULL when the target day does not exist.

    ``add_months`` clamps 2014-08-31 minus 9 months to 2013-11-30; a period
    subtraction has no such day and yields NULL, so checks against it are skipped.
    """
    shifted = F.add_months(col(d), -months)
    return F.when(F.dayofmonth(shifted) == F.dayofmonth(col(d)), shifted)


def completed_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole years from ``start`` to ``end`` (age in completed years)."""
    s, e = col(start), col(end)
    before_birthday = (F.date_format(e, "MMdd") < F.date_format(s, "MMdd")).cast("int")
    return F.year(e) - F.year(s) - before_birthday


def year_start(year: ColumnOrName) -> Column:
    return F.make_date(col(year), F.lit(1), F.lit(1))


def year_end(year: ColumnOrName, plus_years: int = 0) -> Column:
    return F.make_date(col(year) + F.lit(plus_years), F.lit(12), F.lit(31))
