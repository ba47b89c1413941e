"""Shared guards: required columns (B11), unique keys, and how control tables are applied."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a control table (crosswalk, lookup) is applied; the caller chooses, and both give equal rows.
# "map": its rows become literal map expressions - no join, no exchange; for tables of some hundred rows.
# "join": an equi-join whose physical form adaptive execution picks by the sides' run-time sizes.
STRATEGIES = ("map", "join")


class SchemaMismatch(ValueError):
    """Required columns are missing (or unexpected ones present)."""


class DataGuardError(ValueError):
    """A data guard (uniqueness, unmatched codes, factor levels) failed."""


def require_columns(df: DataFrame, cols: Iterable[str], where: str = "") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        prefix = f"{where}: " if where else ""
        raise SchemaMismatch(f"{prefix}missing column(s): {', '.join(missing)}")


def check_strategy(strategy: str, known: Sequence[str] = STRATEGIES) -> None:
    if strategy not in known:
        raise ValueError(f"strategy must be one of {', '.join(known)}, not {strategy!r}")


def whole_number_text(c: Column) -> Column:
    """A year or code number as text in one form, whatever its type: 2014, 2014.0 and " 2014" are "2014".

    Text that is no number stays as it is (it matches nothing, and never fails a cast)."""
    s = F.trim(c.cast("string"))
    number = s.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint").cast("string")).otherwise(s)


def sources_by_target(renames: Iterable[tuple[str, str]]) -> dict[str, str]:
    """``{to_name: from_name}``; two source columns for one canonical name are an error."""
    out: dict[str, str] = {}
    for source, target in renames:
        if out.setdefault(target, source) != source:
            raise SchemaMismatch(f"rename crosswalk: both {out[target]} and {source} are mapped to {target}")
    return out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (E5 / D5); NULL keys group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
