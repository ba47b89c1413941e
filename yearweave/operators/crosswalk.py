"""Crosswalk control tables: wide->long rename crosswalk (B1), recode
crosswalk projection and validation (B2, D5), and the two review tables (Q2, Q3)."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearweave.operators._common import DataGuardError, require_columns

YEAR_COLUMN = re.compile(r"^\d{4}$")

RENAME_COLUMNS = ["file_year", "from_name", "to_name", "notes"]
RECODE_COLUMNS = ["file_year", "variable", "from_code", "from_label", "to_code", "to_label", "review_flag"]


def rename_crosswalk_long(wide: DataFrame) -> DataFrame:
    """Wide rename crosswalk (``to_name, notes, <yyyy>...``) to long form (B1).

    Rows whose year cell is NULL are kept: they mark a canonical variable the
    vintage does not have (it is then filled with NULL, B4).
    """
    require_columns(wide, ["to_name"], "rename crosswalk")
    years = [c for c in wide.columns if YEAR_COLUMN.match(c)]
    if not years:
        raise DataGuardError("rename crosswalk has no four-digit year columns")
    notes = F.col("notes").cast("string") if "notes" in wide.columns else F.lit(None).cast("string")
    base = wide.select(
        F.col("to_name").cast("string").alias("to_name"),
        notes.alias("notes"),
        *[F.col(f"`{y}`").cast("string").alias(y) for y in years],
    )
    long = base.unpivot(["to_name", "notes"], years, "file_year", "from_name")
    return long.select(
        F.col("file_year").cast("int").alias("file_year"),
        F.col("from_name"),
        F.col("to_name"),
        F.col("notes"),
    )


def recode_crosswalk(df: DataFrame) -> DataFrame:
    """Project and type the recode crosswalk (B2)."""
    require_columns(df, ["file_year", "variable", "from_code", "to_code"], "recode crosswalk")
    def opt(name: str, typ: str):
        return (F.col(name) if name in df.columns else F.lit(None)).cast(typ).alias(name)
    return df.select(
        F.col("file_year").cast("int").alias("file_year"),
        F.col("variable").cast("string").alias("variable"),
        F.col("from_code").cast("string").alias("from_code"),
        opt("from_label", "string"),
        F.col("to_code").cast("string").alias("to_code"),
        opt("to_label", "string"),
        opt("review_flag", "boolean"),
    )


def ambiguous_recodes(cw: DataFrame) -> DataFrame:
    """(year, variable, from_code) mapped to more than one distinct ``to_code``.

    Distinct pairs are taken first with NULLs equal, so a code mapped to both a
    value and NULL counts as ambiguous - exactly the rows a left join would
    duplicate.
    """
    pairs = cw.select("file_year", "variable", "from_code", "to_code").dropDuplicates()
    return (
        pairs.groupBy("file_year", "variable", "from_code")
        .agg(F.count(F.lit(1)).alias("n_to_codes"))
        .filter(F.col("n_to_codes") > 1)
    )


def validate_recode_crosswalk(cw: DataFrame) -> None:
    """Raise when the recode crosswalk would duplicate rows (D5 on the lookup)."""
    n = ambiguous_recodes(cw).count()
    if n:
        raise DataGuardError(f"recode crosswalk: {n} code(s) have more than one target; ambiguous_recodes() lists them all")


def _years_list(col_name: str):
    """Sorted, comma-joined distinct years of a group."""
    return F.array_join(F.sort_array(F.collect_set(F.col(col_name).cast("string"))), ",")


def missing_variable_summary(rename_crosswalks: Mapping[str, DataFrame]) -> DataFrame:
    """Per (file_type, to_name): the years where the variable has no source column (Q2)."""
    tagged = None
    for file_type, cw in rename_crosswalks.items():
        part = cw.select("file_year", "from_name", "to_name").withColumn("file_type", F.lit(file_type))
        tagged = part if tagged is None else tagged.unionByName(part)
    missing = tagged.filter(F.col("from_name").isNull()).select("file_type", "to_name", "file_year").distinct()
    return missing.groupBy("file_type", "to_name").agg(_years_list("file_year").alias("missing_years"))


def flagged_recode_summary(cw: DataFrame, file_type: str = "Death Statistical") -> DataFrame:
    """Flagged recodes with the years they apply to (Q3); years are sorted."""
    flagged = cw.filter(F.col("review_flag")).withColumn("file_type", F.lit(file_type))
    keys = ["file_type", "variable", "from_code", "to_code"]
    years = (
        flagged.select(*keys, "file_year").distinct()
        .groupBy(*keys).agg(_years_list("file_year").alias("applicable_years"))
    )
    labels = flagged.select(*keys, "from_label", "to_label").distinct()
    # Null-safe join on the group keys (from_code / to_code may be NULL).
    cond = [labels[k].eqNullSafe(years[k]) for k in keys]
    return labels.join(years, cond, "inner").select(
        labels["file_type"], labels["variable"], labels["from_code"], labels["from_label"],
        labels["to_code"], labels["to_label"], years["applicable_years"],
    )
