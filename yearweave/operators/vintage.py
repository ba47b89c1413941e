"""Vintage assembly: per-year rename to canonical names (B3-B5), vintage
metadata (B6, B7), statistical + literals join (D1) and the union of all
years (H1).

Plan shape: each (year, file type) is one lazy column-pruned scan; scans of a
file type are unioned first, so the literals join and the recode are planned
once for all years instead of once per year.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections import OrderedDict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearweave.operators._common import DataGuardError, require_columns, sources_by_target

log = logging.getLogger("yearweave")

FRONT_COLUMNS = ("vintage_label", "date_harmonized", "source_system", "file_year")


def crosswalk_rows(cw_long: DataFrame):
    """The long rename crosswalk on the driver (a control table: columns times years)."""
    return [r.asDict() for r in cw_long.collect()]


def canonical_columns(rows) -> list[str]:
    """``unique(to_name)`` over all years, first appearance first."""
    return list(OrderedDict((r["to_name"], None) for r in rows))


def year_renames(rows, year: int) -> list[tuple[str, str]]:
    """(from_name, to_name) for one year; NULL ``from_name`` rows are absent variables."""
    return [(r["from_name"], r["to_name"]) for r in rows if r["file_year"] == year and r["from_name"] is not None]


def rename_to_canonical(df: DataFrame, renames: Sequence[tuple[str, str]], canonical: Sequence[str]) -> DataFrame:
    """B3-B5 on an already loaded frame: one ``select`` that renames, fills
    absent canonical columns with NULL strings and fixes the order."""
    require_columns(df, [f for f, _ in renames], "rename")
    by_target = sources_by_target(renames)
    return df.select(*[
        (F.col(f"`{by_target[t]}`").alias(t) if t in by_target else F.lit(None).cast("string").alias(t))
        for t in canonical
    ])


def attach_vintage(df: DataFrame, vintage_label: str, file_year: int, source_system: str,
                   date_harmonized: str | dt.date | None = None) -> DataFrame:
    """B6 + B7: constant vintage columns, moved to the front."""
    if date_harmonized is None:
        date_harmonized = dt.date.today()
    meta = {
        "vintage_label": F.lit(vintage_label),
        "date_harmonized": F.lit(str(date_harmonized)),
        "source_system": F.lit(source_system),
        "file_year": F.lit(int(file_year)).cast("int"),
    }
    df = df.withColumns(meta)
    return df.select(*FRONT_COLUMNS, *[c for c in df.columns if c not in FRONT_COLUMNS])


def union_vintages(frames: Sequence[DataFrame]) -> DataFrame:
    """H1: row-bind by name; columns absent from a frame are NULL."""
    if not frames:
        raise DataGuardError("no vintages to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_literals(stat: DataFrame, lit: DataFrame, keys: Sequence[str] = ("file_year", "state_file_number"),
                  null_safe: bool = False) -> DataFrame:
    """Statistical LEFT JOIN literals on the keys; every statistical row is kept.

    Non-key columns must be disjoint (a clash would be silently suffixed in R).

    NULL keys: dplyr matches NULL to NULL, which pairs every NULL-key
    statistical row with every NULL-key literals row - all pairs within one
    group, all of it hashed into one partition. By default a NULL key
    matches nothing here (its literal columns are NULL); use
    :func:`null_key_counts` to report such rows. ``null_safe=True`` restores
    NULL-matches-NULL for sources known to hold at most a handful of
    NULL-key literal rows.
    """
    keys = list(keys)
    require_columns(stat, keys, "join_literals(stat)")
    require_columns(lit, keys, "join_literals(literals)")
    clash = (set(stat.columns) & set(lit.columns)) - set(keys)
    if clash:
        raise DataGuardError(f"statistical and literals files share non-key column(s): {sorted(clash)}")
    order = [*stat.columns, *[c for c in lit.columns if c not in keys]]  # statistical columns first, as in R
    r = lit.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in lit.columns if c not in keys])
    if null_safe:
        cond = reduce(lambda a, b: a & b, [stat[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
        return stat.join(r, cond, "left").select(*order)
    # A NULL key matches nothing, but the shuffle would still hash every such row into one partition.
    # A row with a NULL key gets a salt of its own as one more key, which no literals row has: it
    # spreads such rows over all tasks whatever the keys' types.
    hashable = [c for c, t in stat.dtypes if not t.startswith(("map", "array", "struct"))]
    any_null = reduce(lambda a, b: a | b, [stat[k].isNull() for k in keys])
    salted = stat.withColumn("__salt", F.when(any_null, F.xxhash64(*[stat[c] for c in hashable])))
    r = r.withColumn("__r_salt", F.lit(None).cast("bigint"))
    apart = F.coalesce(salted["__salt"], F.lit(0).cast("bigint")) == F.coalesce(r["__r_salt"], F.lit(0).cast("bigint"))
    cond = reduce(lambda a, b: a & b, [salted[k] == r[f"__r_{k}"] for k in keys], apart)
    return salted.join(r, cond, "left").select(*order)


def null_key_counts(df: DataFrame, keys: Sequence[str] = ("file_year", "state_file_number")) -> DataFrame:
    """Rows per year whose join key has a NULL part (audit for D1)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    by = [k for k in keys if k == "file_year"]
    return df.filter(any_null).groupBy(*by).agg(F.count(F.lit(1)).alias("n_null_key_rows"))


def literal_key_audit(stat: DataFrame, lit: DataFrame, keys: Sequence[str] = ("file_year", "state_file_number")) -> DataFrame:
    """``side, file_year, n_null_key_rows`` for both sides of the literals join: rows that match nothing."""
    sides = [null_key_counts(df, keys).select(F.lit(side).alias("side"), "file_year", "n_null_key_rows")
             for side, df in (("statistical", stat), ("literals", lit))]
    return sides[0].unionByName(sides[1])


def literal_key_duplicates(lit: DataFrame, keys: Sequence[str] = ("file_year", "state_file_number")) -> DataFrame:
    """Audit: literals keys used by several rows, which multiply statistical rows."""
    return lit.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
