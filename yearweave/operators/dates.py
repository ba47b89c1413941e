"""Date cleaning (L1-L9) with a parse-error report (L3).

One projection parses every date column; the logic checks are ``when``
expressions over the parsed values, so the data is read once. The report is a
separate lazy DataFrame (one unpivot + one partial/final aggregate).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearweave.functions.dates import (
    DEFAULT_DATE_ORDERS,
    completed_years,
    minus_months_strict,
    parse_date_multi,
    parse_date_order,
    squish_or_null,
    year_end,
    year_start,
)
from yearweave.functions.logic import if_else3
from yearweave.operators._common import require_columns

# The date columns cleaned, and the logic-check constants.
DATE_VARS: tuple[str, ...] = (
    "date_harmonized", "date_of_birth", "date_of_death", "date_of_injury", "date_received", "disposition_date",
)
MIN_VALID_YEAR_EXCLUSIVE = 1850
MAX_AGE_YEARS = 120
INJURY_BEFORE_BIRTH_MONTHS = 9
LATE_FILING_YEARS = 2


class Cleaned(NamedTuple):
    df: DataFrame
    report: DataFrame


def _today(as_of_date):
    if as_of_date is None:
        return F.current_date()
    if isinstance(as_of_date, str):
        as_of_date = dt.date.fromisoformat(as_of_date)
    return F.lit(as_of_date)


def order_votes(df: DataFrame, vars: Sequence[str] = DATE_VARS, by: str = "file_year", orders=DEFAULT_DATE_ORDERS) -> DataFrame:
    """How many values of each vintage and column each date order accepts: ``<by>, variable, date_order, precedence, n_values``.

    One aggregate over all columns and orders, then a row per vintage, column and order.
    """
    require_columns(df, [by, *vars], "order_votes")
    cleaned = df.select(by, *[squish_or_null(v).alias(f"v{i}") for i, v in enumerate(vars)])
    counts = cleaned.groupBy(by).agg(*[
        F.count(parse_date_order(F.col(f"v{i}"), o)).alias(f"n{i}_{j}") for i in range(len(vars)) for j, o in enumerate(orders)])
    entries = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(o).alias("date_order"), F.lit(j).alias("precedence"), F.col(f"n{i}_{j}").alias("n_values"))
        for i, v in enumerate(vars) for j, o in enumerate(orders)])
    return counts.select(by, F.explode(entries).alias("e")).select(by, "e.*")


def elected_orders(votes: DataFrame, by: str = "file_year") -> DataFrame:
    """The order that accepts most values of a vintage and column (ties: the earlier in precedence): ``<by>, variable, date_order``."""
    best = F.min(F.struct(-F.col("n_values"), "precedence", "date_order")).alias("best")
    return votes.groupBy(by, "variable").agg(best).select(by, "variable", "best.date_order")


def _voted(cleaned, year, elected: dict, orders: Sequence[str]):
    """Each vintage's elected order first; a value that it does not accept goes through all orders."""
    years = {}
    for y, order in elected.items():
        years.setdefault(order, []).append(y)
    first = None
    for order, of in sorted(years.items()):
        met = F.coalesce(year.isin([y for y in of if y is not None]), F.lit(None in of))
        first = (F if first is None else first).when(met, parse_date_order(cleaned, order))
    rest = parse_date_multi(cleaned, orders, squished=True)
    return rest if first is None else F.coalesce(first, rest)


def parse_dates(df: DataFrame, vars: Sequence[str] = DATE_VARS, orders=DEFAULT_DATE_ORDERS, as_of_date=None,
                vote_by: str | None = None) -> DataFrame:
    """L1 + L2: add ``<v>_parsed`` for each column: multi-format parse, then
    future dates and years <= 1850 (placeholders such as 9999) to NULL.

    ``orders`` are tried in precedence, value by value. With orders that read one text in two ways (``mdY``
    and ``dmY``), name the vintage column as ``vote_by``: one pass counts what each order accepts, and the order
    elected for a vintage and column reads its values first, so that one column is read in one way. The default orders
    give the same dates either way: no text is valid in two of them with both years after 1850.
    """
    require_columns(df, vars, "clean_dates")
    today = _today(as_of_date)
    elected: dict[str, dict] = {v: {} for v in vars}
    if vote_by is not None:
        for r in elected_orders(order_votes(df, vars, vote_by, orders), vote_by).collect():  # vintages x columns
            elected[r["variable"]][r[vote_by]] = r["date_order"]
    # Two projections: the L2 checks reference the parsed column by name, so
    # the multi-format parse is computed once per value, not once per reference.
    df = df.withColumns({f"{v}_parsed": squish_or_null(v) for v in vars})
    df = df.withColumns({
        f"{v}_parsed": _voted(F.col(f"{v}_parsed"), F.col(vote_by or v), elected[v], orders) for v in vars})
    nd = F.lit(None).cast("date")
    out = {}
    for v in vars:
        p = F.col(f"{v}_parsed")
        out[f"{v}_parsed"] = F.when((p > today) | (F.year(p) <= MIN_VALID_YEAR_EXCLUSIVE), nd).otherwise(p)
    return df.withColumns(out)


def first_example(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One example row per distinct ``keys`` (E7): the row with the smallest
    ``order_cols`` (deterministic stand-in for "first row"). Partial aggregation
    keeps a hot key from landing whole in one task."""
    ex = F.min(F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in payload])).alias("__ex")
    agg = df.groupBy(*keys).agg(ex)
    return agg.select(*keys, *[F.col(f"__ex.{c}").alias(c) for c in [*order_cols, *payload]])


def date_error_report(parsed: DataFrame, vars: Sequence[str] = DATE_VARS, id_cols=("state_file_number", "file_year")) -> DataFrame:
    """L3: one example per (variable, raw value) where the raw value is non-NULL
    and the parsed value is NULL after L2 (logic-check failures are not reported)."""
    entries = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("original_value"), F.col(f"{v}_parsed").alias("parsed_value"))
        for v in vars
    ])
    long = parsed.select(*id_cols, F.explode(entries).alias("e")).select(*id_cols, "e.*")
    bad = long.filter(F.col("original_value").isNotNull() & F.col("parsed_value").isNull())
    sfn, year = id_cols
    rep = first_example(bad, ["variable", "original_value"], [year, sfn], ["parsed_value"])
    return rep.select(sfn, year, "variable", "original_value", "parsed_value")


def date_logic(df: DataFrame) -> DataFrame:
    """L4-L8 over ``*_parsed`` columns, in order (later checks use cleaned values)."""
    death, birth, injury = F.col("date_of_death_parsed"), F.col("date_of_birth_parsed"), F.col("date_of_injury_parsed")
    nd = F.lit(None).cast("date")
    start, end = year_start("file_year"), year_end("file_year")
    df = df.withColumn("date_of_death_parsed", if_else3(death.between(start, end), death, nd))
    df = df.withColumn("date_of_birth_parsed", if_else3(birth <= death, birth, nd))
    age = completed_years(birth, death)
    df = df.withColumn("date_of_birth_parsed", if_else3(age < MAX_AGE_YEARS, birth, nd))
    injury_rule = (
        F.when(injury < minus_months_strict(birth, INJURY_BEFORE_BIRTH_MONTHS), nd)
        .when(injury > death, nd)
        .otherwise(injury)
    )
    df = df.withColumn("date_of_injury_parsed", injury_rule)
    late = year_end("file_year", LATE_FILING_YEARS)
    return df.withColumns({
        f"{v}_parsed": if_else3(F.col(f"{v}_parsed").between(death, late), F.col(f"{v}_parsed"), nd)
        for v in ("date_received", "disposition_date")
    })


def replace_parsed(df: DataFrame, vars: Sequence[str] = DATE_VARS) -> DataFrame:
    """Drop the raw columns and rename ``<v>_parsed`` back to ``<v>``."""
    return df.drop(*vars).withColumnsRenamed({f"{v}_parsed": v for v in vars})


def clean_dates(df: DataFrame, vars: Sequence[str] = DATE_VARS, orders=DEFAULT_DATE_ORDERS, as_of_date=None,
                id_cols=("state_file_number", "file_year"), vote_by: str | None = None) -> Cleaned:
    """Full date cleaning: returns the cleaned frame and the parse-error report."""
    parsed = parse_dates(df, vars, orders, as_of_date, vote_by)
    report = date_error_report(parsed, vars, id_cols)
    cleaned = replace_parsed(date_logic(parsed), vars)
    return Cleaned(cleaned, report)
