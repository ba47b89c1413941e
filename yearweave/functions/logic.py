"""Three-valued logic helpers.

R's ``if_else``/``%in%``/``if_any`` treat missing values differently from a
naive Spark ``when``/``isin``; these helpers keep those semantics while
staying plain Column expressions (whole-stage codegen friendly).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def if_else3(cond: Column, yes, no) -> Column:
    """``if_else(cond, yes, no)`` where a NULL condition yields NULL (not ``no``)."""
    return F.when(cond, lit_or_col(yes)).when(~cond, lit_or_col(no))


def in_set(c: ColumnOrName, values: Iterable) -> Column:
    """Null-safe membership that is never NULL.

    A NULL input is a member exactly when ``None`` is in ``values``; a non-NULL
    input is compared against the non-NULL values only.
    """
    values = list(values)
    has_null = any(v is None for v in values)
    present = [v for v in values if v is not None]
    member = col(c).isin(present) if present else F.lit(False)
    return F.when(col(c).isNull(), F.lit(has_null)).otherwise(member)


def any_true(conds: Iterable[Column]) -> Column:
    """Kleene OR over several conditions (TRUE wins over NULL)."""
    return reduce(or_, list(conds))


def null_string() -> Column:
    return F.lit(None).cast("string")
