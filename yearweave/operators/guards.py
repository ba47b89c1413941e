"""Data guards in one pass.

An operator that meets a value it has no answer for writes it into a guard column: the offending code as text, NULL on
all other rows. Guard columns are marked by column metadata, ride along through the stage's projections, and are settled
once, at its end:

- :func:`write_checked` counts every guard's codes as observed metrics of the write itself. The table is written beside
  its place and takes it only if no guard was hit; otherwise nothing changes there, and the error lists every code with
  its number of rows. No second pass, no barrier in the plan: filters above the operators still reach the scan.
- :func:`settle` makes a lazy frame fail in the job that reads it, by one filter for all guards of the stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from yearweave.operators._common import DataGuardError

#: Different codes that one guard counts exactly; beyond it the rows are still counted, and codes are listed as far as known.
MOST_CODES = 10_000
_KEY = "guard"


class GuardViolation(DataGuardError):
    """Guards were hit. ``rows`` lists (guard, code, number of rows); ``complete`` is whether that is all of them."""

    def __init__(self, rows: list[tuple[str, str, int]], totals: dict[str, int]):
        self.rows, self.totals = rows, totals
        listed: dict[str, int] = {}
        for guard, _, n in rows:
            listed[guard] = listed.get(guard, 0) + n
        self.complete = all(listed.get(g, 0) == n for g, n in totals.items())
        parts = []
        for guard, n in totals.items():
            codes = [f"'{c}' ({k})" for g, c, k in rows if g == guard]
            more = "" if listed.get(guard, 0) == n else f", and more than {MOST_CODES} codes in all"
            parts.append(f"{guard}: {n} row(s), {len(codes)} code(s): {', '.join(codes)}{more}")
        super().__init__("; ".join(parts))


def watch(df: DataFrame, guard: str, bad: Column, code: Column, shown: str = ": {}") -> DataFrame:
    """Add the guard column: ``code`` as text where ``bad`` is true (a NULL code as an empty one), else NULL.

    ``shown`` is how a settled frame's error puts the code behind the guard's name."""
    taken = [int(c.rsplit("_", 1)[1]) for c in df.columns if c.startswith("__guard_")]
    name = f"__guard_{max(taken, default=-1) + 1}"
    return df.withColumn(name, F.when(bad, F.coalesce(code.cast("string"), F.lit("")))).withMetadata(
        name, {_KEY: guard, "shown": shown})


def guard_columns(df: DataFrame) -> dict[str, str]:
    """``{column: guard}`` of the guard columns not yet settled."""
    return {f.name: f.metadata[_KEY] for f in df.schema.fields if _KEY in f.metadata}


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """``df`` without its guard columns; any action on it fills ``observation``.

    Counts and codes are partial aggregates that travel with the tasks' results: at most ``MOST_CODES``
    codes a guard, whatever the rows.
    """
    columns = list(guard_columns(df))
    metrics = [F.count(c).alias(f"n_{c}") for c in columns]
    # The sketch is exact while its table holds all codes, that is up to three quarters of its size.
    metrics += [F.expr(f"approx_top_k({c}, {MOST_CODES}, {2 * MOST_CODES})").alias(f"codes_{c}") for c in columns]
    return df.observe(observation, *metrics).drop(*columns)


def violations(guards: dict[str, str], observation: Observation) -> tuple[list[tuple[str, str, int]], dict[str, int]]:
    """(guard, code, rows) by guard and code, and the rows of each guard that was hit. Waits for the action."""
    got = observation.get
    totals = {guard: got[f"n_{c}"] for c, guard in guards.items() if got.get(f"n_{c}")}
    rows = [(guard, r["item"], r["count"]) for c, guard in guards.items() if guard in totals
            for r in got[f"codes_{c}"] if r["item"] is not None]
    return sorted(rows), totals


def settle(df: DataFrame) -> DataFrame:
    """A lazy frame without guard columns whose reading job fails on the first row that hit a guard.

    One filter holds for all guards of the stage. It stands above the guards' metrics, which no optimizer rule moves
    filters through, so that it stays where the guard columns are computed: pushed further down it would compute them, and
    all that leads to them, a second time. Selecting, counting or overwriting columns above does not remove it.
    """
    guards = guard_columns(df)
    if not guards:
        return df
    texts = []
    for c, guard in guards.items():
        before, after = df.schema[c].metadata["shown"].split("{}")
        texts.append(F.concat(F.lit(guard + before), F.col(c), F.lit(after)))
    hit = F.coalesce(*texts)
    counted = df.observe("guards", *[F.count(c).alias(c) for c in guards])
    return counted.filter(F.when(hit.isNotNull(), F.raise_error(hit).cast("boolean")).otherwise(True)).drop(*guards)


def file_system(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return jvm_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``, in the same file system; what stood there goes."""
    fs, at = file_system(spark, path)
    old = f"{path}.old-{uuid.uuid4().hex}"
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at(staged), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(at(old), True)


def write_checked(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Write ``df`` without its guard columns to ``path``, replacing what is there, unless a guard is hit.

    ``write(frame, folder)`` does the writing (default: Parquet). The rows go to a folder beside ``path`` and take its
    place by renaming once the guards' metrics are known to be clean. If they are not, or the write fails,
    that folder is removed, ``path`` stays as it was, and the first case raises :class:`GuardViolation`.
    A reader that comes between the two renames finds no table, never half of one.
    """
    spark, guards = df.sparkSession, guard_columns(df)
    path = path.rstrip("/")
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    observation = Observation()
    done = False
    try:
        (write or (lambda frame, folder: frame.write.parquet(folder)))(observed(df, observation) if guards else df, staged)
        rows, totals = violations(guards, observation) if guards else ([], {})
        if totals:
            raise GuardViolation(rows, totals)
        replace_folder(spark, staged, path)
        done = True
    finally:
        if not done:
            fs, at = file_system(spark, staged)
            fs.delete(at(staged), True)
