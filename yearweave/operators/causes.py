"""Cause-of-death codes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearweave.functions.codes import icd10_clean
from yearweave.functions.strings import combine_columns as combine_expr

AXIS_PATTERN = re.compile(r"^record_axis_code_")
AXIS_COLUMNS = range(2, 21)  # the further causes; column 1 repeats the underlying one


def clean_cause_codes(df: DataFrame, underlying: str = "underlying_cod_code") -> DataFrame:
    """ICD-10 clean of the underlying cause and every ``record_axis_code_*``."""
    cols = [underlying, *[c for c in df.columns if AXIS_PATTERN.match(c)]]
    return df.withColumns({c: icd10_clean(c) for c in cols if c in df.columns})


def combine_columns(df: DataFrame, input_cols: Sequence[str], output_col: str, delimiter: str = ";",
                    remove_inputs: bool = False) -> DataFrame:
    """Delimiter-joined non-NULL values; all NULL gives ``""``.

    The new column sits at the first input's position. With ``remove_inputs``
    the inputs are dropped (a following ``record_axis_code_1`` too, as in the
    reference, where it duplicates the underlying cause).
    """
    input_cols = list(input_cols)
    if not input_cols:
        raise ValueError("combine_columns needs at least one input column")
    new = combine_expr(input_cols, delimiter).alias(output_col)
    drop = set(input_cols) | {"record_axis_code_1"} if remove_inputs else set()
    out = []
    for c in df.columns:
        if c == output_col:
            continue
        if c == input_cols[0]:
            out.append(new)  # placed before the first input, as tidyr's unite does
        if c not in drop:
            out.append(F.col(c))
    return df.select(*out)


def all_cause_codes(df: DataFrame, underlying: str = "underlying_cod_code", output_col: str = "all_cod_code") -> DataFrame:
    """Underlying cause plus axis codes 2-20 joined with ';'."""
    number = {c: c.removeprefix("record_axis_code_") for c in df.columns if AXIS_PATTERN.match(c)}
    inputs = [underlying, *[c for c, n in number.items() if n.isdigit() and str(int(n)) == n and int(n) in AXIS_COLUMNS]]
    return combine_columns(df, inputs, output_col, ";")
