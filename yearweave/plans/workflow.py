"""End-to-end harmonization: raw yearly CSVs -> one typed multi-year table.

Stage 1 (:func:`harmonize`): manifest -> per-vintage column-pruned scans
renamed to canonical names -> union per file type -> statistical + literals
join on (file_year, state_file_number) -> crosswalk recode. Written once as
Parquet (cuts lineage; executors lost later re-read it instead of re-running
the scans).

Stage 2 (:func:`clean`): geography, cause codes, demographics, dates, times,
type enforcement, string rules and the final projection - one narrow plan
(no shuffle) from the stage-1 table to the final partitioned Parquet. Reports
are aggregates read from the written tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearweave.functions.strings import nullify_placeholders, title_case, zip5_or_null
from yearweave.operators import causes, crosswalk, demographics, geography, guards, quality, recode, schema, vintage
from yearweave.operators import dates as dates_op
from yearweave.operators import times as times_op
from yearweave.operators._common import DataGuardError
from yearweave.operators.projection import Selector, contains, select_spec, starts_with
from yearweave.sources import csv_scan, encodings, manifest, parquet
from yearweave.sources import refresh as vintages

STATISTICAL = "Death Statistical"
LITERALS = "Cause of Death Literals"

# The geography pairs (column, column, first year *not* looked up).
DEFAULT_COLUMN_PAIRS = (("death_county_wa_code", "death_county_fips", 2022),
                        ("residence_county_wa_code", "residence_county_fips", 2016),
                        ("injury_county_wa_code", "injury_county_fips", 2022))
DEFAULT_LITERAL_PAIRS = (("residence_county_fips", "residence_county", 2016),
                         ("injury_county_fips", "injury_county", 2016))
# Columns the string rules apply to, placeholder spellings that
# become NULL, and the narrative columns the data dictionary shows no values for.
TITLE_CASE_COLUMNS = ("occupation", "industry", "informant_relationship", "injury_description")
ZIP_COLUMNS = ("death_zip_code", "injury_zip_code", "residence_zip_code")
OCCUPATION_PLACEHOLDERS = ("-", "--", "---", "------", ".", "?")
OCCUPATION_PLACEHOLDER_WORDS = ("Not Applicable", "Unknown")
INJURY_PLACE_PLACEHOLDERS = ("-", "?", "NONE", "UNKNOWN", "NOT APPLICABLE")
RESIDENCE_LENGTH_PLACEHOLDERS = ("999",)
SUPPRESSED = ("cod_text_1", "cod_text_2", "cod_text_3", "cod_text_4", "cod_text_other", "injury_description")

# Order of the final table (names, then selectors).
FINAL_SPEC: tuple[str | Selector, ...] = (
    "date_harmonized", "vintage_label", "source_system", "file_year", "state_file_number", "local_file_number",
    "date_of_birth", "date_of_injury", "date_of_death", "date_of_death_modifier", "date_received", "disposition_date",
    "time_of_death", "time_of_injury", "underlying_cod_code", "all_cod_code", starts_with("record_axis_code"),
    contains("cod_text"), "manner", "disposition", "injury_acme_place", "injury_at_work", "injury_description",
    starts_with("birthplace_country"), starts_with("birthplace_state_fips_code"), starts_with("residence_city"),
    "residence_county", "residence_county_fips", starts_with("residence_state_fips_code"), "residence_zip_code",
    "residence_city_limits", "residence_length", "residence_length_type", "injury_place", starts_with("injury_city"),
    "injury_county", "injury_county_fips", "injury_state", "injury_zip_code", starts_with("death_city"),
    "death_county_fips", "death_state", "death_zip_code", "place_of_death_type", contains("age"), "sex",
    "marital_status", "pregnancy", starts_with("education"), "armed_forces", "industry", starts_with("occupation"),
    "tobacco", contains("hispanic"), contains("race"), "death_facility", "informant_relationship", "autopsy",
    "certifier_designation", "me_coroner_referred",
)


# Row order of each written report (G1): sorting happens only at this boundary.
REPORT_ORDER = {
    "literal_null_keys": ["side", "file_year"],
    "literal_duplicate_keys": ["file_year", "state_file_number"],
    "invalid_bytes": ["file_year", "file"],
    "date_parse_errors": ["variable", "original_value"],
    "time_parse_errors": ["variable", "original_value", "primary_value"],
    "data_type_conversions": ["variable"],
    "completeness": ["file_year", "sort_key"],
    "validation": ["rule"],
    "data_dictionary": ["varname"],
    "missing_variable_summary": ["to_name", "file_type"],
    "recoding_variable_review": ["variable", "from_code", "to_code"],
}


# Columns the written table must have, with the type each must have (Q7).
REQUIRED_COLUMNS = {"file_year": "int", "state_file_number": "string", "underlying_cod_code": "string", "date_of_death": "date"}


@dataclass(frozen=True)
class Config:
    raw_folder: str
    output_folder: str
    rename_statistical: str          # wide rename crosswalk (CSV or Parquet)
    rename_literals: str
    recode_statistical: str          # recode crosswalk
    schema: str                      # long-form schema table
    county_map: str | None = None    # county code map; None -> generated by rule
    as_of_date: str | dt.date | None = None
    column_pairs: Sequence[tuple[str, str, int]] = DEFAULT_COLUMN_PAIRS
    literal_pairs: Sequence[tuple[str, str, int]] = DEFAULT_LITERAL_PAIRS
    csv_options: dict = field(default_factory=dict)
    fallback_charset: str | None = None  # for vintages that are not UTF-8; their invalid bytes are then counted in a report
    on_unmatched: str = "raise"      # lookup guard: settled at the stage's end ("raise"), one listing pass ("scan"), "ignore"
    check_levels: str = "plan"       # factor-level guard: settled at the stage's end ("plan"), one listing pass ("scan"), "off"
    time_as: str = "string"          # time of day as "HH:mm:ss" text, or Spark's TIME type ("time")
    completeness_threshold: float = 1.0
    keep_axis_in_completeness: bool = False
    final_spec: Sequence[str | Selector] = FINAL_SPEC


def _today(cfg: Config) -> dt.date:
    if cfg.as_of_date is None:
        return dt.date.today()
    return cfg.as_of_date if isinstance(cfg.as_of_date, dt.date) else dt.date.fromisoformat(str(cfg.as_of_date))


def harmonize(spark: SparkSession, cfg: Config, audits: dict[str, DataFrame] | None = None,
              years: Sequence[int] | None = None) -> DataFrame:
    """Stage 1: every selected vintage, or those of ``years`` alone, renamed, joined and recoded (lazy). ``audits`` receives the
    tables of rows whose NULL key matches nothing in the literals join and of literals keys used twice."""
    files = manifest.select_vintages(manifest.build_manifest(spark, cfg.raw_folder))
    paths = manifest.vintage_paths(files)
    if years is not None:
        if absent := sorted(set(years) - set(paths)):
            raise DataGuardError(f"no files for vintage(s) {', '.join(map(str, absent))}")
        paths = {y: paths[y] for y in years}
    meta = {r["file_year"]: (r["vintage_label"], r["system"]) for r in files.select("file_year", "vintage_label", "system").distinct().collect()}
    stat_rows = vintage.crosswalk_rows(crosswalk.rename_crosswalk_long(csv_scan.load_control_table(spark, cfg.rename_statistical)))
    lit_rows = vintage.crosswalk_rows(crosswalk.rename_crosswalk_long(csv_scan.load_control_table(spark, cfg.rename_literals)))
    stat_cols, lit_cols = vintage.canonical_columns(stat_rows), vintage.canonical_columns(lit_rows)
    today = _today(cfg)
    stats, lits = [], []
    for year in sorted(paths):
        label, system = meta[year]
        s = csv_scan.scan_columns(spark, paths[year].get(STATISTICAL, []), vintage.year_renames(stat_rows, year), stat_cols, cfg.csv_options, fallback_charset=cfg.fallback_charset)
        stats.append(vintage.attach_vintage(s, label, year, system, today))
        lit = csv_scan.scan_columns(spark, paths[year].get(LITERALS, []), vintage.year_renames(lit_rows, year), lit_cols, cfg.csv_options, fallback_charset=cfg.fallback_charset)
        lits.append(lit.withColumn("file_year", F.lit(int(year))))
    stat_all = vintage.union_vintages(stats)
    lit_all = vintage.union_vintages(lits).select("file_year", *lit_cols)
    joined = vintage.join_literals(stat_all, lit_all, ["file_year", "state_file_number"])
    if audits is not None and cfg.fallback_charset:
        audits["invalid_bytes"] = encodings.invalid_bytes_report(spark, {y: [p for of in paths[y].values() for p in of] for y in paths})
    if audits is not None:
        audits["literal_null_keys"] = vintage.literal_key_audit(stat_all, lit_all)
        audits["literal_duplicate_keys"] = vintage.literal_key_duplicates(lit_all)
    cw = crosswalk.recode_crosswalk(csv_scan.load_control_table(spark, cfg.recode_statistical))
    return recode.recode(joined, cw)


def _county_map(spark: SparkSession, cfg: Config) -> DataFrame:
    if cfg.county_map is None:
        return geography.county_map_from_rule(spark)
    return csv_scan.load_control_table(spark, cfg.county_map)


def derive(spark: SparkSession, df: DataFrame, cfg: Config):
    """Stage 2, part 1: geography, cause codes, demographics, dates, times.
    Returns ``(df, audits)``; the frame's columns are what the schema must list, beside guard columns to be settled."""
    df = geography.clean_geography(df, _county_map(spark, cfg), cfg.column_pairs, cfg.literal_pairs,
                                   "observe" if cfg.on_unmatched == "raise" else cfg.on_unmatched)
    df = causes.all_cause_codes(causes.clean_cause_codes(df))
    df = demographics.derive_demographics(df)
    df, date_errors = dates_op.clean_dates(df, as_of_date=_today(cfg))
    df, time_errors = times_op.clean_times(df, time_as=cfg.time_as)
    return df, {"date_parse_errors": date_errors, "time_parse_errors": time_errors}


def finish(df: DataFrame, cfg: Config, schema_df: DataFrame | None = None):
    """Stage 2, part 2: types from the schema, string rules, final projection. Guard columns stay, to be settled."""
    audits = {}
    if schema_df is not None:
        df, conversions = schema.enforce_schema(df, schema_df, "observe" if cfg.check_levels == "plan" else cfg.check_levels)
        audits["data_type_conversions"] = conversions
    cod_text = [c for c in df.columns if "cod_text" in c]
    df = df.withColumns({c: title_case(c) for c in [*TITLE_CASE_COLUMNS, *cod_text] if c in df.columns})
    df = df.withColumns({c: zip5_or_null(c) for c in ZIP_COLUMNS if c in df.columns})
    rules = {c: nullify_placeholders(c, OCCUPATION_PLACEHOLDERS, OCCUPATION_PLACEHOLDER_WORDS) for c in ("industry", "occupation")}
    rules["injury_place"] = nullify_placeholders("injury_place", INJURY_PLACE_PLACEHOLDERS)
    rules["residence_length"] = nullify_placeholders("residence_length", RESIDENCE_LENGTH_PLACEHOLDERS)
    df = df.withColumns({c: e for c, e in rules.items() if c in df.columns})
    return select_spec(df, cfg.final_spec), audits


def clean(spark: SparkSession, df: DataFrame, cfg: Config, schema_df: DataFrame | None = None):
    """Stage 2 (lazy): returns ``(final_df, audits)``. All guards are settled by one filter at the end."""
    df, audits = derive(spark, df, cfg)
    df, more = finish(df, cfg, schema_df)
    audits.update(more)
    return guards.settle(df), audits


def schema_table(spark: SparkSession, columns, types: dict, factors: dict | None = None) -> DataFrame:
    """A long-form schema table for ``columns``: ``types`` maps a column to its
    data type (default character); ``factors`` maps a column to
    ``[(value, label), ...]`` (unordered factor)."""
    factors = factors or {}
    rows = []
    for c in columns:
        if c in factors:
            rows += [(c, "factor", False, v, lab, None, c, None) for v, lab in factors[c]]
        else:
            rows.append((c, types.get(c, "character"), None, None, None, None, c, None))
    ddl = ("variable string, data_type string, factor_is_ordered boolean, factor_value string, factor_label string, "
           "factor_order int, description string, source_file_type string")
    return spark.createDataFrame(rows, ddl)


def run(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Both stages with their writes; returns the report tables (also written).

    The second write counts what its guards meet; if any code has no answer, the earlier table stays, and
    :class:`yearweave.operators.guards.GuardViolation` lists all of them with their numbers of rows."""
    out = cfg.output_folder.rstrip("/")
    stage1 = f"{out}/_stage1_harmonized"
    stage1_audits: dict[str, DataFrame] = {}
    harmonize(spark, cfg, stage1_audits).write.mode("overwrite").parquet(stage1)
    staged = spark.read.parquet(stage1)
    schema_df = csv_scan.load_control_table(spark, cfg.schema)
    derived, audits = derive(spark, staged, cfg)
    final, conversions = finish(derived, cfg, schema_df)
    audits.update(conversions)
    parquet.write_harmonized(final, f"{out}/harmonized_data.parquet")
    written = parquet.read_harmonized(spark, f"{out}/harmonized_data.parquet")
    reports = {**stage1_audits, **audits}
    reports["completeness"] = quality.completeness_report(
        written, threshold=cfg.completeness_threshold, keep_axis=cfg.keep_axis_in_completeness)
    reports["validation"] = quality.validate_rules(written, death_record_rules(written), [("state_file_number_unique", ["file_year", "state_file_number"])])
    source = F.col("source_file_type") if "source_file_type" in schema_df.columns else F.lit(None).cast("string")
    descriptions = schema_df.select(F.col("variable").alias("varname"), F.col("description").alias("desc"), source.alias("source")).distinct()
    reports["data_dictionary"] = quality.data_dictionary(written, descriptions, SUPPRESSED)
    reports["column_rules"] = quality.column_rules(written, REQUIRED_COLUMNS)
    parquet.write_tables(reports, f"{out}/reports", sort_by=REPORT_ORDER,
                         single_file={"completeness", "validation", "column_rules", "data_dictionary", "data_type_conversions"})
    return reports


def refresh(spark: SparkSession, cfg: Config, years: Sequence[int] | None = None) -> dict[str, DataFrame]:
    """Both stages for the vintages of ``years`` alone (default: all), kept in ``harmonized_vintages`` beside those of earlier
    refreshes (:mod:`yearweave.sources.refresh`). Returns ``data``, the whole table, the audits of the refreshed
    vintages, and ``completeness`` over all vintages, which reads counts only; it is written under ``reports`` too."""
    out = cfg.output_folder.rstrip("/")
    audits: dict[str, DataFrame] = {}
    stage1 = f"{out}/_stage1_refreshed"
    harmonize(spark, cfg, audits, years).write.mode("overwrite").parquet(stage1)
    derived, more = derive(spark, spark.read.parquet(stage1), cfg)
    final, conversions = finish(derived, cfg, csv_scan.load_control_table(spark, cfg.schema))
    table = f"{out}/harmonized_vintages"
    vintages.refresh(final.withColumn("file_year", F.col("file_year").cast("int")), table, years)
    reports = {**audits, **more, **conversions}
    reports["completeness"] = quality.report_of(
        vintages.kept_completeness(spark, table), cfg.completeness_threshold, cfg.keep_axis_in_completeness)
    parquet.write_tables({"completeness": reports["completeness"]}, f"{out}/reports", sort_by=REPORT_ORDER)
    return {**reports, "data": vintages.read_refreshed(spark, table)}


def review(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Crosswalk review tables (Q2, Q3), written under ``reports/review``."""
    renames = {
        STATISTICAL: crosswalk.rename_crosswalk_long(csv_scan.load_control_table(spark, cfg.rename_statistical)),
        LITERALS: crosswalk.rename_crosswalk_long(csv_scan.load_control_table(spark, cfg.rename_literals)),
    }
    cw = crosswalk.recode_crosswalk(csv_scan.load_control_table(spark, cfg.recode_statistical))
    tables = {
        "missing_variable_summary": crosswalk.missing_variable_summary(renames),
        "recoding_variable_review": crosswalk.flagged_recode_summary(cw, STATISTICAL),
    }
    parquet.write_tables(tables, f"{cfg.output_folder.rstrip('/')}/reports/review", sort_by=REPORT_ORDER)
    return tables


def death_record_rules(df: DataFrame) -> dict:
    """Q7 row rules (own spec): ICD shape of the underlying cause, age range, file year set."""
    from yearweave.functions.codes import ICD10_PATTERN
    rules = {"file_year_present": F.col("file_year").isNotNull()}
    if "underlying_cod_code" in df.columns:
        rules["underlying_cod_code_icd10"] = F.col("underlying_cod_code").rlike(ICD10_PATTERN)
    if "all_cod_code" in df.columns:  # every code of the joined causes
        codes = F.filter(F.split("all_cod_code", ";"), lambda c: c != "")
        rules["all_cod_code_icd10"] = F.when(F.col("all_cod_code").isNotNull(), F.forall(codes, lambda c: c.rlike(ICD10_PATTERN)))
    for c in df.columns:
        if c.startswith("record_axis_code_"):
            rules[f"{c}_icd10"] = F.col(c).rlike(ICD10_PATTERN)
    if "age_years" in df.columns:
        rules["age_years_0_120"] = F.col("age_years").between(0, 120)
    return rules
