"""Parquet sink and read-back (A14, A15), and small table writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearweave.operators.guards import guard_columns, write_checked


def write_harmonized(df: DataFrame, path: str, partition_by: str = "file_year", mode: str = "overwrite",
                     max_records_per_file: int = 5_000_000) -> None:
    """Write partitioned by year.

    The ``rebalance`` hint clusters rows by year so a task writes one year's
    files, and lets AQE split a large year into advisory-sized pieces (a
    plain ``repartition(year)`` would put a whole year in one task) and merge
    small ones. Year directories give partition pruning on read.

    A frame with guard columns is counted while it is written, after the shuffle, where a task's metrics
    count once however often lost executors make it run, and takes the place of ``path`` only if no guard was hit
    (:func:`yearweave.operators.guards.write_checked`).
    """
    def write(frame: DataFrame, folder: str) -> None:
        frame.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).partitionBy(partition_by).parquet(folder)

    rows = df.hint("rebalance", partition_by)
    if not guard_columns(df):
        write(rows, path)
    elif mode != "overwrite":
        raise ValueError("a frame with guards replaces the table; settle() it first to append")
    else:
        write_checked(rows, path, write)


def read_harmonized(spark: SparkSession, path: str, years=None) -> DataFrame:
    """Read back; a year filter prunes partitions (directories) before any read."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.filter(F.col("file_year").isin(list(years)))
    return df


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet",
                 sort_by: Mapping[str, list[str]] | None = None, single_file: bool | set = True) -> None:
    """Write report tables under one folder, one subfolder each.

    ``sort_by`` orders a table at this boundary (the only place rows are
    sorted). ``single_file`` (True, False or a set of names) collapses a
    table to one file - meant for tables bounded by the number of columns
    or rules, not for reports that grow with the data.
    """
    sort_by = sort_by or {}
    for name, df in tables.items():
        if name in sort_by:
            df = df.orderBy(*sort_by[name])
        one = single_file if isinstance(single_file, bool) else name in single_file
        w = (df.coalesce(1) if one else df).write.mode("overwrite")
        if fmt == "csv":
            w.option("header", "true").csv(f"{folder}/{name}")
        else:
            w.parquet(f"{folder}/{name}")
