"""String scalars as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearweave.functions.logic import ColumnOrName, col, if_else3, in_set, null_string

# Unicode-aware blank class: Java's \s plus every separator (\p{Z}), e.g. NBSP.
_BLANK = r"[\s\p{Z}]"


def unicode_trim(c: ColumnOrName) -> Column:
    """Trim ASCII and Unicode blanks (``trim`` only strips U+0020)."""
    return F.regexp_replace(col(c), rf"^{_BLANK}+|{_BLANK}+$", "")


def squish(c: ColumnOrName) -> Column:
    """Trim, then collapse every inner run of blanks to one space.

    Done as: collapse every run (including the outer ones) to one ASCII
    space, then ``trim`` that single space - one regex pass instead of two.
    """
    return F.trim(F.regexp_replace(col(c), rf"{_BLANK}+", " "))


def normalize_text(c: ColumnOrName) -> Column:
    """Raw-value normalization, in the reference's order.

    delete every ``\\p{C}`` char (control, format, unassigned) -> ``""`` to NULL
    -> ``"NA"`` to NULL -> trim. Trim comes last, so a value made only of
    blanks ends as ``""`` and a blank-padded ``"NA"`` stays ``"NA"``.
    """
    no_control = F.regexp_replace(col(c), r"\p{C}", "")
    return unicode_trim(F.nullif(F.nullif(no_control, F.lit("")), F.lit("NA")))


def pad_left(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """Left pad to ``width``; longer values pass through untouched (``lpad`` truncates)."""
    x = col(c)
    return F.when(F.length(x) < width, F.lpad(x, width, pad)).otherwise(x)


def last_n(c: ColumnOrName, n: int) -> Column:
    """Last ``n`` characters; a shorter string is returned whole."""
    return F.right(col(c), F.lit(n))


def remove_first(c: ColumnOrName, pattern: str) -> Column:
    """Remove the first match of ``pattern`` only (``regexp_replace`` removes all)."""
    if pattern.startswith("^"):
        return F.regexp_replace(col(c), pattern, "")
    return F.regexp_replace(col(c), rf"(?s)^(.*?)(?:{pattern})", "$1")


def remove_first_punct(c: ColumnOrName) -> Column:
    """Remove the first punctuation character (``\\p{P}``)."""
    return remove_first(c, r"\p{P}")


def extract_or_null(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` returning NULL (not ``""``) when nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


# A word is a run of letters, marks, digits and underscores, which may be
# joined by an apostrophe (straight or typographic), a period or another
# mid-word mark of Unicode's word breaking between two such runs ("o'brien", "u.s"). Everything else (spaces, hyphens, brackets) separates words.
_WORD = r"[\p{L}\p{M}\p{N}_]+(?:['.\u2019\u2018\u2024\uFE52\uFF07\uFF0E:\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A][\p{L}\p{M}\p{N}_]+)*"
TITLE_TOKEN_PATTERN = rf"({_WORD}|[^\p{{L}}\p{{M}}\p{{N}}_]+)"


def _title_char(ch: Column) -> Column:
    """Title-case form of one character: upper case, except that a sharp s
    titles as "Ss" (upper case would give "SS")."""
    return F.when(ch == "\u00df", F.lit("Ss")).otherwise(F.upper(ch))


def title_case(c: ColumnOrName) -> Column:
    """Word-wise title case: each word's first character upper, the rest lower.

    Unlike ``initcap`` a word also starts after a hyphen or a bracket:
    ``HIGH-SCHOOL O'BRIEN (RETIRED) 3RD`` -> ``High-School O'brien (Retired) 3rd``.
    """
    tokens = F.regexp_extract_all(F.lower(col(c)), F.lit(TITLE_TOKEN_PATTERN), 1)
    cased = F.transform(tokens, lambda t: F.concat(_title_char(F.left(t, F.lit(1))), F.substring(t, 2, 1 << 30)))
    return F.when(col(c).isNull(), null_string()).otherwise(F.array_join(cased, ""))


def nullify_placeholders(
    c: ColumnOrName,
    exact: Sequence[str] = (),
    contains_ci: Sequence[str] = (),
) -> Column:
    """NULL when the value is one of ``exact`` or contains any of ``contains_ci``
    (case-insensitive, literal text); otherwise the value."""
    x = col(c)
    out = F.when(in_set(x, exact), null_string()) if exact else None
    for needle in contains_ci:
        cond = x.rlike("(?i)" + re.escape(needle))
        out = out.when(cond, null_string()) if out is not None else F.when(cond, null_string())
    return out.otherwise(x) if out is not None else x


def keep_if_match(c: ColumnOrName, pattern: str) -> Column:
    """Value if it fully matches ``pattern`` else NULL (NULL stays NULL)."""
    return if_else3(col(c).rlike(pattern), col(c), null_string())


def zip5_or_null(c: ColumnOrName) -> Column:
    """Keep five-digit ZIP codes; anything else becomes NULL."""
    return keep_if_match(c, r"^[0-9]{5}$")


def combine_columns(cols: Iterable[ColumnOrName], delimiter: str = ";") -> Column:
    """Join columns with a delimiter, skipping NULLs; all NULL gives ``""``."""
    return F.concat_ws(delimiter, *[col(c) for c in cols])


def percent_label(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``n / d`` as a percent with one decimal, e.g. ``"71.1%"``.

    Rounded half-up on the exact ratio with integer arithmetic, so the label
    never depends on how a binary double prints (``0.1225`` -> ``"12.3%"``).
    """
    n, d = col(numerator).cast("long"), col(denominator).cast("long")
    tenths = (F.lit(2000) * n + d).cast("long") / (F.lit(2) * d)
    tenths = F.floor(tenths).cast("long")
    return F.when(d > 0, F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")))
