"""Cause-of-death code scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearweave.functions.logic import ColumnOrName, col, if_else3, null_string

# Fixed value: shape of a cleaned ICD-10 code (letter, digit, 2-4 more alphanumerics).
ICD10_PATTERN = r"^[A-Z][0-9][0-9A-Z]{1,3}$"


def icd10_clean(c: ColumnOrName) -> Column:
    """Upper-case, drop every non-alphanumeric char, keep only ICD-10 shaped codes."""
    cleaned = F.regexp_replace(F.upper(col(c)), r"[^A-Z0-9]", "")
    return if_else3(cleaned.rlike(ICD10_PATTERN), cleaned, null_string())
