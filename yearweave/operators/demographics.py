"""Age and race/ethnicity derivations.

Raw codes are still strings here, so every comparison is against string
literals ('9', '10'): a string-to-int cast would raise under ANSI on bad text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearweave.operators.schema import parse_double
from yearweave.functions.bins import AGE_CUTS, bin_by_cuts
from yearweave.functions.logic import any_true, if_else3, in_set, null_string

# Race summary codes and their labels, the group flags, and outputs.
RACE6_LABELS = (
    ("10", "White Only"),
    ("11", "Black Only"),
    ("12", "American Indian/Alaska Native Only"),
    ("13", "Asian Only"),
    ("14", "Native Hawaiian and Pacific Islander Only"),
)
RACE_UNKNOWN_CODE = "99"
MULTI_RACE = "Multi Race"
MULTI_RACE_NH = "Multi-Race-NH"
HISPANIC_AS_RACE = "Hispanic as Race"
NON_HISPANIC_SUFFIX = "-NH"
HISPANIC_YES_CODES = ("1", "2", "3", "4", "5")
ASIAN_FLAGS = (
    "race_asian_indian", "race_chinese", "race_filipino", "race_japanese",
    "race_korean", "race_other_asian", "race_vietnamese",
)
NHPI_FLAGS = ("race_hawaiian", "race_samoan", "race_guamanian_or_chamorro", "race_other_pacific_islander")
RACE_CODE_FLAGS = ("race_white", "race_black", "race_amer_indian_alaskan", "race_asian", "race_nhpi")
MAX_AGE_YEARS = 120


def clean_age(df: DataFrame) -> DataFrame:
    """Unknown age to NULL, integer age_years capped at 120, four age groupings."""
    unknown = (F.col("age_type") == "9") & (F.col("age") == "999")
    df = df.withColumn("age", if_else3(unknown, null_string(), F.col("age")))
    years = parse_double(F.col("age_years")).try_cast("int")
    df = df.withColumn("age_years", years)
    df = df.withColumn("age_years", if_else3(F.col("age_years") > MAX_AGE_YEARS, F.lit(None).cast("int"), F.col("age_years")))
    return df.withColumns({name: bin_by_cuts("age_years", cuts) for name, cuts in AGE_CUTS.items()})


def hispanic(df: DataFrame, src: str = "hispanic_nchs_bridge") -> DataFrame:
    """Hispanic 0/1 and the two-way label."""
    h = F.when(F.col(src) == "0", F.lit(0)).when(in_set(src, HISPANIC_YES_CODES), F.lit(1))
    df = df.withColumn("hispanic", h)
    lab = F.when(F.col("hispanic") == 0, F.lit("Not Hispanic")).when(F.col("hispanic") == 1, F.lit("Hispanic"))
    return df.withColumn("race_ethnicity2", lab)


def race6(df: DataFrame, src: str = "race_summary_code") -> DataFrame:
    """Single-race label; '99'/NULL -> NULL; any other code -> Multi Race."""
    e = None
    for code, label in RACE6_LABELS:
        e = F.when(F.col(src) == code, F.lit(label)) if e is None else e.when(F.col(src) == code, F.lit(label))
    e = e.when(in_set(src, [RACE_UNKNOWN_CODE, None]), null_string()).otherwise(F.lit(MULTI_RACE))
    return df.withColumn("race6", e)


def race_ethnicity7(df: DataFrame) -> DataFrame:
    """Hispanic first; otherwise (hispanic 0 or NULL) the race6 label with -NH."""
    not_h = in_set("hispanic", [0, None])
    e = F.when(F.col("hispanic") == 1, F.lit(HISPANIC_AS_RACE))
    for _, label in RACE6_LABELS:
        e = e.when(not_h & (F.col("race6") == label), F.lit(label + NON_HISPANIC_SUFFIX))
    e = e.when(not_h & (F.col("race6") == MULTI_RACE), F.lit(MULTI_RACE_NH))
    return df.withColumn("race_ethnicity7", e)


def any_flag(cols) -> "F.Column":
    """'Y' if any flag is 'Y'; 'N' if all are known and none is; else NULL."""
    return if_else3(any_true([F.col(c) == "Y" for c in cols]), F.lit("Y"), F.lit("N"))


def race_groups(df: DataFrame) -> DataFrame:
    """P9 + P10: Asian / NHPI summary flags, then the 5-digit race code."""
    df = df.withColumns({"race_asian": any_flag(ASIAN_FLAGS), "race_nhpi": any_flag(NHPI_FLAGS)})
    bits = [if_else3(F.col(c) == "Y", F.lit("1"), F.lit("0")) for c in RACE_CODE_FLAGS]
    return df.withColumn("race_code", F.concat(*bits))


def derive_demographics_race(df: DataFrame) -> DataFrame:
    """P6-P10 in order."""
    df = hispanic(df)
    df = race6(df)
    df = race_ethnicity7(df)
    return race_groups(df)


def derive_demographics(df: DataFrame) -> DataFrame:
    """P3-P10 in order."""
    return derive_demographics_race(clean_age(df))
