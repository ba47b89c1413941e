"""Time-of-day cleaning (M1-M9) with a parse-error report (M8).

Output is a string ``HH:mm:ss`` by default (``time_as="time"`` gives Spark's
TIME type, which needs ``spark.sql.timeType.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearweave.functions.logic import if_else3, null_string
from yearweave.functions.strings import pad_left, remove_first_punct
from yearweave.operators._common import require_columns
from yearweave.operators.dates import Cleaned, first_example
from yearweave.operators.schema import parse_double

# The time columns cleaned (each with _hour and _minutes parts).
TIME_VARS: tuple[str, ...] = ("time_of_death", "time_of_injury")
# Fixed value: accepted HHMM shape after cleaning (hour 00-23, minute 00-59).
HHMM_PATTERN = r"^([01][0-9]|2[0-3])[0-5][0-9]$"


def parse_hhmm(c: Column, time_as: str = "string") -> Column:
    """Strict ``HHMM`` parse; anything else is NULL (M7)."""
    ok = c.rlike(HHMM_PATTERN)
    if time_as == "time":
        return F.when(ok, F.try_to_time(c, F.lit("HHmm")))
    return F.when(ok, F.concat(F.substring(c, 1, 2), F.lit(":"), F.substring(c, 3, 2), F.lit(":00")))


def _parts(v: str) -> tuple[str, str]:
    return f"{v}_hour", f"{v}_minutes"


def build_times(df: DataFrame, vars: Sequence[str] = TIME_VARS, time_as: str = "string") -> DataFrame:
    """M1-M7: adds ``<v>_primary`` and ``<v>_final``; raw columns are normalized in place."""
    cols = [c for v in vars for c in (v, *_parts(v))]
    require_columns(df, cols, "clean_times")
    df = df.withColumns({c: remove_first_punct(c) for c in cols})                        # M1
    limits = {}
    for v in vars:
        h, m = _parts(v)
        limits[h] = if_else3(parse_double(F.col(h)) >= 24, null_string(), F.col(h))  # M2
        limits[m] = if_else3(parse_double(F.col(m)) >= 60, null_string(), F.col(m))
    df = df.withColumns(limits)
    df = df.withColumns({c: pad_left(c, 2) for v in vars for c in _parts(v)})           # M3
    prim = {}
    for v in vars:
        h, m = (F.col(x) for x in _parts(v))
        prim[f"{v}_primary"] = (
            F.when(h.isNotNull() & m.isNotNull(), F.concat(h, m))
            .when(h.isNotNull() & m.isNull(), F.concat(h, F.lit("00")))                 # M4
        )
    df = df.withColumns(prim)
    fixed = {}
    for v in vars:
        t = F.coalesce(F.col(f"{v}_primary"), F.col(v))                                   # M5
        t = F.when(t == "2400", F.lit("0000")).otherwise(t)                                # M6
        fixed[v] = F.when(t == "9999", null_string()).otherwise(t)
    df = df.withColumns(fixed)
    return df.withColumns({f"{v}_final": parse_hhmm(F.col(v), time_as) for v in vars})  # M7


def time_error_report(built: DataFrame, vars: Sequence[str] = TIME_VARS, id_cols=("state_file_number", "file_year")) -> DataFrame:
    """M8: one example per (variable, value, built value) that did not parse."""
    entries = F.array(*[
        F.struct(
            F.lit(v).alias("variable"),
            F.col(v).alias("original_value"),
            F.col(f"{v}_primary").alias("primary_value"),
            F.col(_parts(v)[0]).alias("hour_component"),
            F.col(_parts(v)[1]).alias("minute_component"),
            F.col(f"{v}_final").cast("string").alias("parsed_value"),
        )
        for v in vars
    ])
    long = built.select(*id_cols, F.explode(entries).alias("e")).select(*id_cols, "e.*")
    bad = long.filter((F.col("original_value").isNotNull() | F.col("primary_value").isNotNull()) & F.col("parsed_value").isNull())
    sfn, year = id_cols
    rep = first_example(bad, ["variable", "original_value", "primary_value"], [year, sfn],
                        ["hour_component", "minute_component", "parsed_value"])
    return rep.select(sfn, year, "variable", "original_value", "primary_value", "hour_component", "minute_component", "parsed_value")


def clean_times(df: DataFrame, vars: Sequence[str] = TIME_VARS, time_as: str = "string",
                id_cols=("state_file_number", "file_year")) -> Cleaned:
    built = build_times(df, vars, time_as)
    report = time_error_report(built, vars, id_cols)
    drop = [c for v in vars for c in (v, *_parts(v), f"{v}_primary")]
    cleaned = built.drop(*drop).withColumnsRenamed({f"{v}_final": v for v in vars})  # M9
    return Cleaned(cleaned, report)
