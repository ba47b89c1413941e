"""A harmonized table that is refreshed vintage by vintage (A14, A15), with completeness kept as counts.

    <path>/rows/run=<id>/file_year=<year>/     rows of the vintages that this refresh wrote
    <path>/counts/run=<id>/file_year=<year>/   rows and non-NULL values of each column, by vintage
    <path>/_vintages/<number>.json             manifest: schema, and the run that holds each vintage

A refresh writes only its own vintages, beside what is there, and then one manifest. Readers take the last manifest, so that
they see all of a refresh or nothing of it, and a frame that was made before goes on reading the files it names until
:func:`drop_replaced` removes them. Completeness over all vintages comes from the counts alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from yearweave.operators._common import SchemaMismatch
from yearweave.operators.guards import GuardViolation, file_system, guard_columns, observed, violations
from yearweave.operators.quality import completeness_counts, shares

YEAR = "file_year"


class ConcurrentRefresh(RuntimeError):
    """Another refresh of the table was published meanwhile; nothing of this one is visible."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, at = file_system(spark, path)
    folder = at(f"{path}/_vintages")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(spark.read.text(f"{path}/_vintages/{number:09d}.json", wholetext=True).first()["value"])


def _last(spark: SparkSession, path: str) -> tuple[int, dict]:
    numbers = _numbers(spark, path)
    return (numbers[-1], _manifest(spark, path, numbers[-1])) if numbers else (0, {"schema": None, "vintages": []})


def _publish(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """The manifest appears under its number as a whole, by renaming, unless that number is taken."""
    fs, at = file_system(spark, path)
    final, staged = at(f"{path}/_vintages/{number:09d}.json"), at(f"{path}/_vintages/.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise ConcurrentRefresh(f"{path}: refresh {number} was published by another writer")


def _layout(df: DataFrame) -> StructType:
    """The table's columns, NULL allowed, the year last, as the files hold them; column metadata is kept."""
    fields = [f for f in df.schema.fields if f.name != YEAR] + [f for f in df.schema.fields if f.name == YEAR]
    if len(fields) < 2 or fields[-1].name != YEAR or not isinstance(fields[-1].dataType, IntegerType):
        raise SchemaMismatch(f"a refreshed table needs the column {YEAR} as int, and others")
    out = StructType()
    for f in fields:
        out.add(f.name, f.dataType, True, f.metadata)
    return out


def refresh(df: DataFrame, path: str, years: Iterable[int] | None = None, max_records_per_file: int = 5_000_000) -> list[int]:
    """Replace the vintages in ``df``, or those of ``years``, by its rows; returns their years. Other vintages stay as they are.

    A year named in ``years`` without a row in ``df`` leaves the table; a row of a year that is not named, or of none, raises.
    ``df`` must have the columns and types of the vintages that stay. Guard columns are counted by the write
    itself; if one was hit, or anything else fails, the table is as before, and this refresh's files are removed.
    """
    spark, path, guards = df.sparkSession, path.rstrip("/"), guard_columns(df)
    number, before = _last(spark, path)
    run = uuid.uuid4().hex
    observation = Observation()
    rows = df.hint("rebalance", YEAR)
    rows = observed(rows, observation) if guards else rows
    layout = _layout(rows)
    done = False
    try:
        rows.write.option("maxRecordsPerFile", max_records_per_file).partitionBy(YEAR).parquet(f"{path}/rows/run={run}")
        hit, totals = violations(guards, observation) if guards else ([], {})
        if totals:
            raise GuardViolation(hit, totals)
        written = spark.read.schema(layout).parquet(f"{path}/rows/run={run}")
        completeness_counts(written, YEAR).write.partitionBy(YEAR).parquet(f"{path}/counts/run={run}")
        counts = spark.read.schema(f"n_rows long, {YEAR} int").parquet(f"{path}/counts/run={run}")
        found = {r[YEAR]: r["n"] for r in counts.groupBy(YEAR).agg(F.max("n_rows").alias("n")).collect()}
        covered = (set(found) if years is None else set(years)) - {None}
        if stray := set(found) - covered:
            raise ValueError(f"rows of vintages that this refresh does not name: {sorted(stray, key=str)}")
        stay = [v for v in before["vintages"] if v["year"] not in covered]
        if stay and [(f.name, f.dataType) for f in StructType.fromJson(before["schema"])] != [(f.name, f.dataType) for f in layout]:
            raise SchemaMismatch(f"columns differ from those of the {len(stay)} vintage(s) that stay; refresh them as well")
        new = [{"year": y, "run": run, "rows": n} for y, n in found.items()]
        _publish(spark, path, number + 1, {"schema": layout.jsonValue(), "vintages": sorted(stay + new, key=lambda v: v["year"])})
        done = True
    finally:
        if not done:
            fs, at = file_system(spark, path)
            for part in ("rows", "counts"):
                fs.delete(at(f"{path}/{part}/run={run}"), True)
    return sorted(covered)


def _of(manifest: dict, path: str, part: str, years: Iterable[int] | None) -> list[str]:
    wanted = None if years is None else set(years)
    return [f"{path}/{part}/run={v['run']}/{YEAR}={v['year']}" for v in manifest["vintages"] if wanted is None or v["year"] in wanted]


def _read(spark: SparkSession, folders: list[str], base: str, schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*[f.name for f in schema])


def read_refreshed(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """The table as of its last refresh; with ``years``, only their folders are listed and read."""
    path = path.rstrip("/")
    number, manifest = _last(spark, path)
    if not number:
        raise FileNotFoundError(f"{path}: no refresh was published")
    return _read(spark, _of(manifest, path, "rows", years), f"{path}/rows", StructType.fromJson(manifest["schema"]))


def kept_completeness(spark: SparkSession, path: str) -> DataFrame:
    """:func:`yearweave.operators.quality.completeness` of the table as of its last refresh, from the counts alone."""
    path = path.rstrip("/")
    number, manifest = _last(spark, path)
    if not number:
        raise FileNotFoundError(f"{path}: no refresh was published")
    schema = StructType().add("variable", "string").add("n_rows", "long").add("n_complete", "long").add(YEAR, "integer")
    counts = _read(spark, _of(manifest, path, "counts", None), f"{path}/counts", schema)
    return shares(counts.select(YEAR, "variable", "n_rows", "n_complete"))


def drop_replaced(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove the vintages that none of the last ``keep`` manifests names, and the older manifests; returns how many folders.

    Runs that no manifest names are left alone: their refresh may be under way."""
    path = path.rstrip("/")
    fs, at = file_system(spark, path)
    numbers = _numbers(spark, path)
    named = [(n, {(v["run"], v["year"]) for v in _manifest(spark, path, n)["vintages"]}) for n in numbers]
    kept = set().union(*[vs for n, vs in named[-max(keep, 1):]])
    gone = set().union(*[vs for _, vs in named]) - kept
    for run, year in gone:
        for part in ("rows", "counts"):
            fs.delete(at(f"{path}/{part}/run={run}/{YEAR}={year}"), True)
    for n in numbers[:-max(keep, 1)]:
        fs.delete(at(f"{path}/_vintages/{n:09d}.json"), False)
    return len(gone)
