"""CSV sources: all-string vintage scans (A10, A11), code sets (A12) and
control tables (A13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearweave.functions.strings import normalize_text
from yearweave.operators._common import DataGuardError, SchemaMismatch, sources_by_target
from yearweave.sources.encodings import BYTES, line_facts, odd_quotes, translated, translated_name
from yearweave.sources.quoted_csv import read_quoted_csv

CSV_OPTIONS: Mapping[str, str] = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "inferSchema": "false",
    # Several files of one vintage are read by position; validate every
    # file's header against the first instead of silently shifting columns.
    "enforceSchema": "false",
    # Like readr's trim_ws: blanks around unquoted values go; quoted values keep theirs.
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
}


def read_csv_strings(spark: SparkSession, paths: Sequence[str] | str, options: Mapping[str, str] | None = None,
                     fallback_charset: str | None = None) -> DataFrame:
    """All columns as strings; no schema inference (a second full read).

    ``fallback_charset`` is a single-byte charset, such as ``windows-1252``. If a line of these files is not valid UTF-8,
    all of them are read in it; without one, invalid bytes become U+FFFD.
    """
    if isinstance(paths, str):
        paths = [paths]
    paths = list(paths)
    if not paths:
        raise DataGuardError("no input files for this vintage")
    opts = {**CSV_OPTIONS, **(options or {})}
    utf8 = opts["encoding"].upper().replace("-", "") == "UTF8"
    if fallback_charset and utf8:
        runs_on, invalid = line_facts(spark, paths, opts["quote"])
        if invalid:
            return _read_in_charset(spark, paths, opts, fallback_charset, runs_on)
        if runs_on and "multiLine" not in opts:
            return read_quoted_csv(spark, paths, opts)
    elif "multiLine" not in opts:
        if not utf8:
            opts["multiLine"] = "true"
        elif has_quoted_newlines(spark, paths, opts["quote"]):
            return read_quoted_csv(spark, paths, opts)
    return spark.read.options(**opts).csv(paths)


def _read_in_charset(spark: SparkSession, paths: list[str], opts: dict, charset: str, runs_on: bool) -> DataFrame:
    opts = {**opts, "encoding": BYTES}
    if runs_on and "multiLine" not in opts:
        raw = read_quoted_csv(spark, paths, opts)
    else:
        raw = spark.read.options(**opts).csv(paths)
    names = [translated_name(c, charset) for c in raw.columns]
    raw = raw.toDF(*[f"c{i}" for i in range(len(names))])
    return raw.select(*[translated(F.col(f"c{i}"), charset).alias(n) for i, n in enumerate(names)])


def has_quoted_newlines(spark: SparkSession, paths: Sequence[str], quote: str = '"') -> bool:
    """Whether a quoted value runs over a line end: then some line has an odd number of quotes.

    One splittable text pass that stops at the first such line. Vintages for which it holds are read by
    :func:`yearweave.sources.quoted_csv.read_quoted_csv`, in splits as well; name the option
    ``multiLine`` to skip the pass and use Spark's reader as it is. Other encodings than UTF-8 use its
    ``multiLine`` form.
    """
    return not spark.read.text(list(paths)).filter(odd_quotes(F.col("value"), quote)).isEmpty()


def scan_columns(
    spark: SparkSession,
    paths: Sequence[str] | str,
    rename: Mapping[str, str] | Sequence[tuple[str, str]],
    canonical: Sequence[str],
    options: Mapping[str, str] | None = None,
    normalize: bool = True,
    fallback_charset: str | None = None,
) -> DataFrame:
    """Read only the crosswalk's source columns, normalize (J1), rename to the
    canonical names (B3), add absent canonical columns as NULL (B4) and fix the
    column set and order (B5) - all in one projection.

    ``rename``: ``(from_name, to_name)`` pairs. A named source column absent
    from the header raises (only the header is read to check it).
    """
    pairs = list(rename.items()) if isinstance(rename, Mapping) else list(rename)
    raw = read_csv_strings(spark, paths, options, fallback_charset)
    missing = sorted({f for f, _ in pairs} - set(raw.columns))
    if missing:
        raise SchemaMismatch(f"source column(s) not found in {list(paths) if not isinstance(paths, str) else paths}: {', '.join(missing)}")
    by_target = sources_by_target(pairs)
    out = []
    for t in canonical:
        if t in by_target:
            src = F.col(f"`{by_target[t]}`")
            out.append((normalize_text(src) if normalize else src).alias(t))
        else:
            out.append(F.lit(None).cast("string").alias(t))
    return raw.select(*out)


def load_code_sets(spark: SparkSession, folder: str, suffix: str = "_codes.csv") -> dict[str, DataFrame]:
    """Every ``<name>_codes.csv`` in ``folder`` as an all-string DataFrame keyed by ``<name>``.

    Spark lists the folder, so it may lie in any store that Spark reads. A leading UTF-8 BOM is
    stripped by Spark's CSV reader.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    paths = sorted(r["path"] for r in files.collect())  # a folder of code sets: tens of files
    name = lambda p: unquote(p.rsplit("/", 1)[-1])[: -len(suffix)]
    return {name(p): read_csv_strings(spark, p) for p in paths}


def load_control_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A crosswalk or schema table stored as CSV (all strings) or Parquet.

    ``fmt`` defaults to CSV for names that end in ``.csv``, ``.txt`` or ``.csv.gz``, else Parquet.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".txt", ".csv.gz")) else "parquet")
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_csv_strings(spark, path)
