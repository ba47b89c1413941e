"""Year-limited code lookups.

``lookup_before_year`` replaces ``target`` with the lookup value of ``key`` on
rows whose year is below a threshold (later vintages keep their own value),
with the reference's guards: the lookup must be many-to-one (checked on the
lookup table itself, O(lookup) instead of counting the fact table) and every
in-scope non-NULL key must find a non-NULL value (one aggregate for all pairs).

The lookup is prepared once, in Spark: keys and values as text, uniqueness as one
aggregate. The caller's ``strategy`` applies it, with equal rows: ``"map"`` as a literal map
(no join), ``"join"`` as an equi-join that adaptive execution broadcasts where it is small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearweave.operators._common import DataGuardError, check_strategy, duplicate_keys, require_columns
from yearweave.operators.guards import settle, watch

GUARD_MODES = ("raise", "observe", "scan", "ignore")


@dataclass(frozen=True)
class LookupPair:
    key_col: str
    target_col: str
    year_threshold: int
    value_transform: Callable[[Column], Column] | None = None


def _check_many_to_one(lookup: DataFrame, key: str, what: str) -> None:
    n = duplicate_keys(lookup.select(F.col(key).cast("string").alias(key)), [key]).count()
    if n:
        raise DataGuardError(f"{what}: {n} value(s) of lookup key {key} are not unique; duplicate_keys() lists them all")


def prefetch_lookup(lookup: DataFrame) -> list[dict]:
    """All rows of a small lookup as text, cast by Spark, so that several folds with ``strategy="map"`` read it once."""
    return [r.asDict() for r in lookup.select(*[F.col(c).cast("string").alias(c) for c in lookup.columns]).collect()]


def _map_literal(rows) -> Column | None:
    """The collected (k, v) rows as one literal map (non-NULL keys only)."""
    pairs = [x for r in rows if r["k"] is not None for x in (F.lit(r["k"]), F.lit(r["v"]).cast("string"))]
    return F.create_map(*pairs) if pairs else None


def _joined(df: DataFrame, key_col: str, keyed: DataFrame, alias: str) -> DataFrame:
    """Add ``alias`` by an equi-join on text keys. NULL keys match nothing here and are salted by row, so that they
    spread over the tasks of a shuffle join; the lookup's own NULL key is applied as an expression."""
    hashable = [c for c, t in df.dtypes if not t.startswith(("map", "array", "struct"))]
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[df[c] for c in hashable]).cast("string"))
    side = keyed.filter("k IS NOT NULL").select(F.col("k").alias(f"{alias}__k"), F.col("v").alias(alias))
    return df.join(side, F.coalesce(df[key_col].cast("string"), salt) == side[f"{alias}__k"], "left").drop(f"{alias}__k")


def apply_lookup_pairs(
    df: DataFrame,
    pairs: Sequence[LookupPair],
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    year_col: str = "file_year",
    on_unmatched: str = "raise",
    what: str = "lookup",
    prefetched: list[dict] | None = None,
    strategy: str = "map",
) -> DataFrame:
    """Fold ``lookup_before_year`` over several column pairs (D7), cumulatively.

    ``prefetched``: the lookup's rows from :func:`prefetch_lookup`, for ``strategy="map"``.

    Unmatched guard (D6) on in-scope non-NULL codes without a value, ``on_unmatched``:

    - ``"raise"`` (default): one guard for all pairs that raises on the first such code, naming column and
      code (:func:`yearweave.operators.guards.settle`). No extra pass, and no projection, count or later
      overwrite of the target can prune it; the job that reads the rows fails.
    - ``"observe"``: such codes go into guard columns, to be settled at the end of the stage, or counted and listed
      by the write itself (:func:`yearweave.operators.guards.write_checked`).
    - ``"scan"``: one pass per pair before returning; raises with the number of rows and every code.
    - ``"ignore"``: no check; :func:`unmatched_codes` gives the same list as a table.
    """
    if on_unmatched not in GUARD_MODES:
        raise ValueError(f"on_unmatched must be one of {', '.join(GUARD_MODES)}")
    check_strategy(strategy)
    require_columns(lookup, [lookup_key, lookup_value], what)
    keyed = lookup.select(F.col(lookup_key).cast("string").alias("k"), F.col(lookup_value).cast("string").alias("v"))
    if strategy == "map":
        rows = [{"k": r[lookup_key], "v": r[lookup_value]} for r in prefetched] if prefetched is not None else [
            r.asDict() for r in keyed.collect()]
        keys = [r["k"] for r in rows]
        repeated = len(keys) - len(set(keys))
        if repeated:
            _check_many_to_one(lookup, lookup_key, what)
        map_literal = _map_literal(rows)  # built once, shared by all pairs
        null_key = [r["v"] for r in rows if r["k"] is None]
    else:
        _check_many_to_one(lookup, lookup_key, what)
        null_key = [r["v"] for r in keyed.filter("k IS NULL").collect()]  # unique: one row at most
    for i, p in enumerate(pairs):
        require_columns(df, [year_col, p.key_col, p.target_col], what)
        if on_unmatched == "scan":
            found = unmatched_codes(df, p.key_col, lookup, lookup_key, lookup_value, p.year_threshold, year_col).agg(
                F.sum("n_rows").alias("n"), F.array_sort(F.collect_list("code")).alias("codes")).first()
            if found["n"]:
                raise DataGuardError(
                    f"{what}: {found['n']} row(s) of {p.key_col} hold {len(found['codes'])} code(s) without a value: "
                    + ", ".join(found["codes"]))
        tmp = f"__lookup_{i}"
        code = F.col(p.key_col).cast("string")
        if strategy == "map":
            df = df.withColumn(tmp, F.try_element_at(map_literal, code) if map_literal is not None else F.lit(None).cast("string"))
        else:
            df = _joined(df, p.key_col, keyed, tmp)
        if null_key:
            df = df.withColumn(tmp, F.when(F.col(p.key_col).isNull(), F.lit(null_key[0])).otherwise(F.col(tmp)))
        in_scope = F.col(year_col) < F.lit(int(p.year_threshold))
        if on_unmatched in ("raise", "observe"):
            bad = in_scope & F.col(p.key_col).isNotNull() & F.col(tmp).isNull()
            df = watch(df, f"{what}: {p.key_col} has no value for code", bad, code, " '{}'")
        mapped = p.value_transform(F.col(tmp)) if p.value_transform else F.col(tmp)
        df = df.withColumn(p.target_col, F.when(in_scope, mapped).otherwise(F.col(p.target_col))).drop(tmp)
    return settle(df) if on_unmatched == "raise" else df


def lookup_before_year(
    df: DataFrame,
    key_col: str,
    target_col: str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    year_threshold: int,
    year_col: str = "file_year",
    value_transform: Callable[[Column], Column] | None = None,
    on_unmatched: str = "raise",
    strategy: str = "map",
) -> DataFrame:
    """One pair of :func:`apply_lookup_pairs` (D3; with ``F.upper`` as transform, D4)."""
    pair = LookupPair(key_col, target_col, year_threshold, value_transform)
    return apply_lookup_pairs(df, [pair], lookup, lookup_key, lookup_value, year_col, on_unmatched, strategy=strategy)


def unmatched_codes(
    df: DataFrame,
    key_col: str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    year_threshold: int | None = None,
    year_col: str = "file_year",
) -> DataFrame:
    """Report of in-scope non-NULL codes without a lookup value: ``code, n_rows``.

    A code whose lookup value is NULL has none, as for the guard. Pre-aggregates per code before
    the anti join, so the join sees one row per distinct code however skewed the data is.
    """
    scope = F.col(key_col).isNotNull()
    if year_threshold is not None:
        scope = scope & (F.col(year_col) < F.lit(int(year_threshold)))
    codes = df.filter(scope).groupBy(F.col(key_col).cast("string").alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = lookup.filter(F.col(lookup_value).isNotNull()).select(F.col(lookup_key).cast("string").alias("code")).filter(
        F.col("code").isNotNull()).distinct()
    return codes.join(keys, "code", "left_anti")
