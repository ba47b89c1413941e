"""End to end: generated raw vintages (two layouts) in a temp folder ->
manifest -> harmonize -> clean -> partitioned Parquet + reports."""

import csv
import os

import pytest

from yearweave.operators.demographics import ASIAN_FLAGS, NHPI_FLAGS
from yearweave.plans import workflow
from yearweave.sources import manifest

STAT = [
    "state_file_number", "local_file_number", "sex", "date_of_birth", "date_of_death", "date_of_injury", "date_received",
    "disposition_date", "date_of_death_modifier", "time_of_death", "time_of_death_hour", "time_of_death_minutes",
    "time_of_injury", "time_of_injury_hour", "time_of_injury_minutes", "underlying_cod_code", "record_axis_code_1",
    "record_axis_code_2", "residence_county_wa_code", "death_county_wa_code", "injury_county_wa_code",
    "residence_county_fips", "death_county_fips", "injury_county_fips", "residence_county", "injury_county",
    "residence_state_fips_code", "death_state", "injury_state", "age", "age_type", "age_years", "hispanic_nchs_bridge",
    "race_summary_code", *ASIAN_FLAGS, *NHPI_FLAGS, "race_white", "race_black", "race_amer_indian_alaskan",
    "occupation", "industry", "informant_relationship", "injury_description", "injury_place", "residence_length",
    "death_zip_code", "injury_zip_code", "residence_zip_code", "manner", "disposition", "injury_acme_place",
    "injury_at_work", "residence_city_limits", "residence_length_type", "place_of_death_type", "marital_status",
    "pregnancy", "armed_forces", "tobacco", "death_facility", "autopsy", "certifier_designation", "me_coroner_referred",
]
LIT = ["state_file_number", "cod_text_1", "cod_text_other"]
ABSENT_2014 = {"time_of_death"}
ABSENT_2018 = {"time_of_death_hour", "time_of_death_minutes", "residence_county_wa_code", "death_county_wa_code", "injury_county_wa_code"}


def old_name(c):
    return c.upper()


def new_name(c):
    return c.replace("_", " ").title()


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def stat_rows(year, layout):
    base = {
        2014: [
            {"state_file_number": "14001", "sex": "1", "date_of_death": "20140305", "date_of_birth": "19500101",
             "time_of_death_hour": "9", "time_of_death_minutes": "5", "underlying_cod_code": "i21.9",
             "record_axis_code_2": "E14.9", "residence_county_wa_code": "1", "death_county_wa_code": "17",
             "injury_county_wa_code": "99", "age": "64", "age_type": "1", "age_years": "64", "hispanic_nchs_bridge": "0",
             "race_summary_code": "10", "race_white": "Y", "occupation": "HIGH-SCHOOL TEACHER", "industry": "--",
             "residence_zip_code": "98101", "residence_state_fips_code": "48", "death_state": "48"},
            {"state_file_number": "14002", "sex": "2", "date_of_death": "3/5/2014", "date_of_birth": "junk",
             "time_of_death_hour": "13", "time_of_death_minutes": "75", "underlying_cod_code": " NA ",
             "residence_county_wa_code": "00", "age": "999", "age_type": "9", "age_years": "x",
             "occupation": "retired, \"chief\"\nengineer", "injury_description": "FELL\tFROM LADDER"},
        ],
        2018: [
            {"state_file_number": "18001", "sex": "1", "date_of_death": "03/05/2018", "time_of_death": "14:05",
             "residence_county_fips": "53033", "residence_state_fips_code": "WA", "death_county_fips": "33",
             "age_years": "45.7", "hispanic_nchs_bridge": "3", "race_summary_code": "15", "residence_zip_code": "98101-1234"},
            {"state_file_number": "18002", "sex": "9", "date_of_death": "2018-12-31", "time_of_death": "2400",
             "residence_county_fips": "41051", "residence_state_fips_code": "OR", "injury_place": "UNKNOWN",
             "residence_length": "999"},
        ],
    }[year]
    absent = ABSENT_2014 if year == 2014 else ABSENT_2018
    cols = [c for c in STAT if c not in absent]
    header = [layout(c) for c in cols]
    return header, [[r.get(c, "") for c in cols] for r in base]


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("proj")
    raw = root / "raw"
    for year, layout in ((2014, old_name), (2018, new_name)):
        h, rows = stat_rows(year, layout)
        write_csv(str(raw / f"DeathStatF{year}.csv"), h, rows)
        lit_rows = [[f"{year % 100}001", "cardiac arrest", ""], [f"{year % 100}001x", "orphan literal", "x"]]
        write_csv(str(raw / "lit" / f"DeathLitF{year}.csv"), [layout(c) for c in LIT], lit_rows)
    write_csv(str(raw / "DeathNamesF2018.csv"), ["NAME"], [["x"]])
    write_csv(str(raw / "DeathStatQ2024.csv"), ["X"], [["y"]])
    (raw / "harmonized_data.parquet").write_bytes(b"not a vintage")
    ctl = root / "ctl"
    write_csv(str(ctl / "rename_stat.csv"), ["to_name", "notes", "2014", "2018"],
              [[c, "", "" if c in ABSENT_2014 else old_name(c), "" if c in ABSENT_2018 else new_name(c)] for c in STAT])
    write_csv(str(ctl / "rename_lit.csv"), ["to_name", "notes", "2014", "2018"], [[c, "", old_name(c), new_name(c)] for c in LIT])
    write_csv(str(ctl / "recode.csv"), ["file_year", "variable", "from_code", "from_label", "to_code", "to_label", "review_flag"],
              [[y, "sex", f, "", t, "", "TRUE" if f == "9" else "FALSE"] for y in (2014, 2018) for f, t in (("1", "M"), ("2", "F"), ("9", "U"))])
    derived = ["all_cod_code", "age_6g", "age_11g", "age_20g", "age_5yr", "hispanic", "race_ethnicity2", "race6",
               "race_ethnicity7", "race_asian", "race_nhpi", "race_code"]
    cols = ["vintage_label", "date_harmonized", "source_system", "file_year", *STAT, "cod_text_1", "cod_text_other", *derived]
    cols = [c for c in cols if c not in ("time_of_death_hour", "time_of_death_minutes", "time_of_injury_hour", "time_of_injury_minutes")]
    types = {"file_year": "integer", "age_years": "integer", "hispanic": "integer"}
    types.update({c: "date" for c in ("date_harmonized", "date_of_birth", "date_of_death", "date_of_injury", "date_received", "disposition_date")})
    types.update({"time_of_death": "time", "time_of_injury": "time"})
    srows = []
    for c in cols:
        if c == "sex":
            srows += [[c, "factor", "FALSE", v, lab, "", "sex", "stat"] for v, lab in (("M", "Male"), ("F", "Female"), ("U", "Unknown"))]
        else:
            srows.append([c, types.get(c, "character"), "", "", "", "", f"{c} description", "stat"])
    write_csv(str(ctl / "schema.csv"), ["variable", "data_type", "factor_is_ordered", "factor_value", "factor_label", "factor_order", "description", "source_file_type"], srows)
    cfg = workflow.Config(
        raw_folder=str(raw), output_folder=str(root / "out"), rename_statistical=str(ctl / "rename_stat.csv"),
        rename_literals=str(ctl / "rename_lit.csv"), recode_statistical=str(ctl / "recode.csv"), schema=str(ctl / "schema.csv"),
        as_of_date="2026-01-01",
    )
    return cfg


def test_manifest_classification(spark, project):
    m = {r["file_name"]: r.asDict() for r in manifest.build_manifest(spark, project.raw_folder).collect()}
    assert m["DeathLitF2014"]["file_type"] == "Cause of Death Literals" and m["DeathLitF2014"]["file_status"] == "Final"
    assert m["DeathStatQ2024"]["file_status"] == "Preliminary" and m["DeathStatQ2024"]["system"] == "WHALES"
    assert m["DeathStatF2014"]["system"] == "BEDROCK"
    assert m["harmonized_data"]["file_type"] is None and m["harmonized_data"]["file_year"] is None
    sel = manifest.select_vintages(manifest.build_manifest(spark, project.raw_folder)).collect()
    assert sorted(r["vintage_label"] for r in sel) == ["BEDROCK_2014", "BEDROCK_2014", "WHALES_2018", "WHALES_2018"]


def test_end_to_end(spark, project):
    reports = workflow.run(spark, project)
    out = spark.read.parquet(os.path.join(project.output_folder, "harmonized_data.parquet"))
    rows = {r["state_file_number"]: r.asDict() for r in out.collect()}
    assert set(rows) == {"14001", "14002", "18001", "18002"}                  # row-preserving literals join
    a, b, c, d = rows["14001"], rows["14002"], rows["18001"], rows["18002"]
    assert a["sex"] == "Male" and b["sex"] == "Female" and d["sex"] == "Unknown"   # recode then factor label
    assert a["residence_county_fips"] == "001" and a["residence_county"] == "COUNTY 01"
    assert a["residence_state_fips_code"] == "WA" and a["death_state"] == "WASHINGTON"
    assert c["residence_county_fips"] == "033" and d["residence_county_fips"] == "00"
    assert a["underlying_cod_code"] == "I219" and a["all_cod_code"] == "I219;E149" and b["all_cod_code"] == ""
    assert a["time_of_death"] == "09:05:00" and b["time_of_death"] == "13:00:00"
    assert c["time_of_death"] == "14:05:00" and d["time_of_death"] == "00:00:00"
    assert str(a["date_of_death"]) == "2014-03-05" and b["date_of_birth"] is None
    assert a["age_6g"] == "45-64" and c["age_years"] == 45 and b["age"] is None
    assert a["occupation"] == "High-School Teacher" and a["industry"] is None
    assert b["occupation"] == "Retired, \"Chief\"Engineer"                        # newline removed, quotes kept
    assert b["injury_description"] == "Fellfrom Ladder"                          # tab removed before title case
    assert a["residence_zip_code"] == "98101" and c["residence_zip_code"] is None
    assert d["injury_place"] is None and d["residence_length"] is None
    assert a["cod_text_1"] == "Cardiac Arrest" and c["cod_text_1"] == "Cardiac Arrest"
    assert a["race_ethnicity7"] == "White Only-NH" and c["race_ethnicity7"] == "Hispanic as Race"
    assert "residence_county_wa_code" not in out.columns                          # dropped by the final projection
    assert sorted(n for n in os.listdir(os.path.join(project.output_folder, "harmonized_data.parquet")) if not n.startswith(".")) == [
        "_SUCCESS", "file_year=2014", "file_year=2018"]
    errs = {(r["variable"], r["original_value"]) for r in reports["date_parse_errors"].collect()}
    assert ("date_of_birth", "junk") in errs
    val = {r["rule"]: r["n_failed"] for r in reports["validation"].collect()}
    assert val["state_file_number_unique"] == 0
    dd = {r["varname"]: r for r in reports["data_dictionary"].collect()}
    assert dd["cod_text_1"]["value_counts"] is None and dd["sex"]["desc"] == "sex"
    review = workflow.review(spark, project)
    assert [r["to_name"] for r in review["missing_variable_summary"].collect()] != []


def test_rerun_is_idempotent(spark, project):
    path = os.path.join(project.output_folder, "harmonized_data.parquet")
    workflow.run(spark, project)
    first = sorted(tuple(str(v) for v in r) for r in spark.read.parquet(path).collect())
    workflow.run(spark, project)
    second = sorted(tuple(str(v) for v in r) for r in spark.read.parquet(path).collect())
    assert first == second and len(first) == 4


def test_refresh_of_one_vintage(spark, project):
    """All vintages, then one alone: the table equals a whole run, and completeness counts both."""
    from yearweave.operators._common import DataGuardError
    from yearweave.operators.quality import completeness_report
    workflow.refresh(spark, project)
    reports = workflow.refresh(spark, project, years=[2018])
    workflow.run(spark, project)
    whole = spark.read.parquet(os.path.join(project.output_folder, "harmonized_data.parquet"))
    text = lambda df: sorted(tuple(str(v) for v in r) for r in df.select(sorted(whole.columns)).collect())
    assert text(reports["data"]) == text(whole)
    want = completeness_report(whole)
    assert sorted(map(tuple, reports["completeness"].select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(DataGuardError, match="1999"):
        workflow.refresh(spark, project, years=[1999])
