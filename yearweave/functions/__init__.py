"""Column-expression builders shared by all operators."""

from yearweave.functions.bins import AGE_CUTS, bin_by_cuts, bin_labels
from yearweave.functions.codes import icd10_clean
from yearweave.functions.dates import (
    DEFAULT_DATE_ORDERS,
    as_date,
    completed_years,
    minus_months_strict,
    parse_date_multi,
    year_end,
    year_start,
)
from yearweave.functions.logic import any_true, if_else3, in_set, null_string
from yearweave.functions.strings import (
    combine_columns,
    extract_or_null,
    keep_if_match,
    last_n,
    normalize_text,
    nullify_placeholders,
    pad_left,
    percent_label,
    remove_first,
    remove_first_punct,
    squish,
    title_case,
    unicode_trim,
    zip5_or_null,
)

__all__ = [
    "AGE_CUTS", "DEFAULT_DATE_ORDERS", "any_true", "as_date", "bin_by_cuts", "bin_labels",
    "combine_columns", "completed_years", "extract_or_null", "icd10_clean", "if_else3", "in_set",
    "keep_if_match", "last_n", "minus_months_strict", "normalize_text", "null_string",
    "nullify_placeholders", "pad_left", "parse_date_multi", "percent_label", "remove_first",
    "remove_first_punct", "squish", "title_case", "unicode_trim", "year_end", "year_start",
    "zip5_or_null",
]
