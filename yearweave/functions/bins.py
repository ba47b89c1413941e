"""Left-closed bins from ascending cut points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearweave.functions.logic import ColumnOrName, col

# Age-group cut points of the four grouping schemes.
AGE_CUTS: dict[str, tuple[int, ...]] = {
    "age_6g": (0, 1, 15, 25, 45, 65),
    "age_11g": (0, 1, 5, 15, 25, 35, 45, 55, 65, 75, 85),
    "age_20g": (0, 1, 5, 10, 15, 18, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85),
    "age_5yr": (0, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85),
}


def bin_labels(cuts: Sequence[int]) -> list[str]:
    """Labels for ``[c_i, c_{i+1})`` bins: ``"0"`` for a one-value bin,
    ``"1-14"`` for a range, ``"65+"`` for the open last bin."""
    labels = []
    for lo, hi in zip(cuts, cuts[1:]):
        labels.append(str(lo) if hi - lo == 1 else f"{lo}-{hi - 1}")
    labels.append(f"{cuts[-1]}+")
    return labels


def bin_by_cuts(c: ColumnOrName, cuts: Sequence[int]) -> Column:
    """Label of the bin holding ``c``; below the first cut or NULL gives NULL.

    A ``when`` chain from the top bin down: one comparison per cut, no join.
    """
    cuts = list(cuts)
    if cuts != sorted(cuts) or len(set(cuts)) != len(cuts):
        raise ValueError(f"cuts must be strictly ascending: {cuts}")
    labels = bin_labels(cuts)
    x = col(c)
    expr = None
    for lo, label in reversed(list(zip(cuts, labels))):
        expr = F.when(x >= lo, F.lit(label)) if expr is None else expr.when(x >= lo, F.lit(label))
    return expr
