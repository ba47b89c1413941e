"""Geography rules K1-K12 on the hand-worked edge rows of FIXTURES 5."""

import pytest
from pyspark.sql import functions as F

from yearweave.operators import geography
from yearweave.operators._common import DataGuardError
from yearweave.operators.lookup import lookup_before_year, unmatched_codes

COLS = ["file_year", "residence_county_wa_code", "death_county_wa_code", "injury_county_wa_code",
        "residence_county_fips", "death_county_fips", "injury_county_fips", "residence_state_fips_code",
        "death_state", "injury_state", "injury_county", "residence_county"]
DDL = ", ".join(f"{c} {'int' if c == 'file_year' else 'string'}" for c in COLS)


def frame(spark, **kw):
    base = {c: None for c in COLS}
    base.update(kw)
    return spark.createDataFrame([tuple(base[c] for c in COLS)], DDL)


def run(spark, **kw):
    cmap = geography.county_map_from_rule(spark)
    df = geography.clean_geography(frame(spark, **kw), cmap, geography_pairs(), literal_pairs())
    return df.collect()[0].asDict()


def geography_pairs():
    return [("death_county_wa_code", "death_county_fips", 2022), ("residence_county_wa_code", "residence_county_fips", 2016),
            ("injury_county_wa_code", "injury_county_fips", 2022)]


def literal_pairs():
    return [("residence_county_fips", "residence_county", 2016), ("injury_county_fips", "injury_county", 2016)]


def test_old_vintage_wa_code_to_fips_and_name(spark):
    r = run(spark, file_year=2014, residence_county_wa_code="1")
    assert r["residence_county_wa_code"] == "01" and r["residence_county_fips"] == "001"
    assert r["residence_county"] == "COUNTY 01"


def test_unknown_and_out_of_state_codes(spark):
    r = run(spark, file_year=2014, residence_county_wa_code="99")
    assert (r["residence_county_wa_code"], r["residence_county_fips"], r["residence_county"]) == (None, None, None)
    r = run(spark, file_year=2014, residence_county_wa_code="00")
    assert r["residence_county_fips"] is None and r["residence_county"] is None


def test_unmatched_code_raises(spark):
    with pytest.raises(Exception, match="no value for code '77'"):      # in-plan guard, no extra pass
        run(spark, file_year=2014, residence_county_wa_code="77")
    cmap = geography.county_map_from_rule(spark)
    df = frame(spark, file_year=2014, residence_county_wa_code="77")
    with pytest.raises(DataGuardError, match="1 row.* 1 code.*77"):                  # counting guard
        geography.clean_geography(df, cmap, geography_pairs(), literal_pairs(), on_unmatched="scan")


@pytest.mark.parametrize("fips,state,expected", [
    ("53033", "WA", "033"), ("33", "WA", "033"), ("41051", "OR", "00"), ("33", None, "033"),
])
def test_residence_fips_2018(spark, fips, state, expected):
    assert run(spark, file_year=2018, residence_county_fips=fips, residence_state_fips_code=state)["residence_county_fips"] == expected


def test_residence_prefix_kept_after_2023(spark):
    assert run(spark, file_year=2024, residence_county_fips="53033", residence_state_fips_code="WA")["residence_county_fips"] == "53033"


@pytest.mark.parametrize("year,fips,expected", [(2022, "9", "009"), (2022, "0053009", "009"), (2022, "00", "000"), (2024, "9", "9")])
def test_death_fips(spark, year, fips, expected):
    assert run(spark, file_year=year, death_county_fips=fips)["death_county_fips"] == expected


def test_death_state_code(spark):
    assert run(spark, file_year=2012, death_state="48")["death_state"] == "WASHINGTON"
    assert run(spark, file_year=2018, death_state="48")["death_state"] == "48"


@pytest.mark.parametrize("year,state,county,fips,expected", [
    (2022, None, None, "033", None), (2022, "WASHINGTON", None, "033", None), (2022, "OREGON", None, "033", "00"),
    (2022, None, "KING", "99033", "033"), (2024, "OREGON", None, "9", "00"), (2024, "WASHINGTON", None, "9", "9"),
])
def test_injury_fips(spark, year, state, county, fips, expected):
    r = run(spark, file_year=year, injury_state=state, injury_county=county, injury_county_fips=fips)
    assert r["injury_county_fips"] == expected


def test_lookup_is_row_preserving_and_reports_unmatched(spark):
    cmap = geography.county_map_from_rule(spark, 5)
    df = spark.createDataFrame([(2014, "01", None), (2014, "09", None), (2018, "09", "keep")], "file_year int, k string, t string")
    out = lookup_before_year(df, "k", "t", cmap, "county_wa_code", "county_fips_code", 2016, on_unmatched="ignore")
    assert [r["t"] for r in out.collect()] == ["001", None, "keep"]
    rep = unmatched_codes(df, "k", cmap, "county_wa_code", "county_fips_code", 2016).collect()
    assert [(r["code"], r["n_rows"]) for r in rep] == [("09", 1)]


def test_duplicate_lookup_key_raises(spark):
    cmap = geography.county_map_from_rule(spark, 3)
    dup = cmap.unionByName(cmap.limit(1))
    df = spark.createDataFrame([(2014, "01", None)], "file_year int, k string, t string")
    with pytest.raises(DataGuardError):
        lookup_before_year(df, "k", "t", dup, "county_wa_code", "county_fips_code", 2016)
