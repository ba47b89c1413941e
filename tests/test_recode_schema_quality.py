"""Recode (D2), crosswalk (B1, Q2, Q3), schema (N1-N8), demographics
and quality outputs (E1-E3, Q1, Q7, Q8)."""

import pytest
from pyspark.sql import functions as F

from yearweave.operators import crosswalk, demographics, quality, recode, schema
from yearweave.operators._common import DataGuardError, SchemaMismatch
from yearweave.operators.projection import contains, resolve_columns, starts_with

CW = "file_year int, variable string, from_code string, from_label string, to_code string, to_label string, review_flag boolean"


def cw(spark, rows):
    return spark.createDataFrame([(y, v, f, None, t, None, flag) for y, v, f, t, flag in rows], CW)


@pytest.mark.parametrize("strategy", ["map", "join", "year"])
def test_recode_semantics(spark, strategy):
    data = spark.createDataFrame([(2014, "1", "a"), (2014, None, "b"), (2015, "1", "c"), (2014, "2", "d"), (2014, "3", "e")],
                                 "file_year int, sex string, id string")
    table = cw(spark, [(2014, "sex", "1", "M", False), (2014, "sex", None, "U", True), (2014, "sex", "2", None, False),
                       (2015, "sex", "1", "Male", False), (2014, "absent_var", "x", "y", False)])
    out = recode.recode(data, table, strategy=strategy).orderBy("id")
    assert [r["sex"] for r in out.collect()] == ["M", "U", "Male", "2", "3"]
    assert out.count() == 5



@pytest.mark.parametrize("strategy", ["join", "year"])
def test_crosswalk_is_worked_out_once(spark, strategy):
    """A crosswalk may be a query over all data: its rows are made once, whatever recode asks of it."""
    rows = [(y, v, c, None, f"{y}{v}{c}", None, False) for y in (2014, 2015) for v in ("sex", "race") for c in ("1", "2", None)]
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    table = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), CW)
    data = spark.createDataFrame([(2014, "1", None), (2015, "2", "3")], "file_year int, sex string, race string")
    got = sorted(tuple(r) for r in recode.recode(data, table, strategy=strategy).collect())
    assert got == [(2014, "2014sex1", "2014raceNone"), (2015, "2015sex2", "3")]
    assert made.value == len(rows)


def test_recode_groups_years_with_equal_codes(spark):
    """Years with the same code mapping share one literal map; results match the join path."""
    years = list(range(2005, 2020))
    rows = [(y, "sex", c, f"{c}{'x' if y < 2015 else 'y'}", False) for y in years for c in ("1", "2")]
    rows.append((2016, "sex", None, "U", False))
    table = cw(spark, rows)
    data = spark.createDataFrame([(y, v, f"{y}-{v}") for y in [*years, 2021] for v in ("1", "2", "3", None)],
                                 "file_year int, sex string, id string")
    by_map = recode.recode(data, table)
    by_join = recode.recode(data, table, strategy="join")
    got = {r["id"]: r["sex"] for r in by_map.collect()}
    assert got == {r["id"]: r["sex"] for r in by_join.collect()}
    assert got["2010-1"] == "1x" and got["2015-2"] == "2y" and got["2010-3"] == "3"
    assert got["2016-None"] == "U" and got["2017-None"] is None and got["2021-1"] == "1"
    analyzed = by_map._jdf.queryExecution().analyzed().toString()
    assert analyzed.count("map(") == 2          # two groups of years, not one map per year


def test_recode_text_year_column(spark):
    """A text year column is compared as text: a malformed year keeps its value instead of failing a cast."""
    data = spark.createDataFrame([("2014", "1"), ("2015", "1"), ("20x5", "1"), ("2014", None)], "file_year string, sex string")
    table = cw(spark, [(2014, "sex", "1", "M", False), (2015, "sex", "1", "Male", False), (2014, "sex", None, "U", False)])
    got = [tuple(r) for r in recode.recode(data, table).collect()]
    assert sorted(got, key=str) == sorted([("2014", "M"), ("2015", "Male"), ("20x5", "1"), ("2014", "U")], key=str)

def test_ambiguous_crosswalk_raises(spark):
    data = spark.createDataFrame([(2014, "1")], "file_year int, sex string")
    with pytest.raises(DataGuardError):
        recode.recode(data, cw(spark, [(2014, "sex", "1", "M", False), (2014, "sex", "1", "F", False)]))
    with pytest.raises(DataGuardError):  # a value and NULL are two targets
        recode.recode(data, cw(spark, [(2014, "sex", "1", "M", False), (2014, "sex", "1", None, False)]))


def test_rename_crosswalk_and_reviews(spark):
    wide = spark.createDataFrame([("sex", "n1", "SEX", "Sex"), ("time_of_death", None, None, "Time of Death")],
                                 "to_name string, notes string, `2014` string, `2018` string")
    long = crosswalk.rename_crosswalk_long(wide)
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r) for r in long.collect()), key=key) == sorted([
        (2014, "SEX", "sex", "n1"), (2018, "Sex", "sex", "n1"), (2014, None, "time_of_death", None),
        (2018, "Time of Death", "time_of_death", None)], key=key)
    miss = crosswalk.missing_variable_summary({"Death Statistical": long}).collect()
    assert [(r["to_name"], r["missing_years"]) for r in miss] == [("time_of_death", "2014")]
    table = cw(spark, [(2016, "sex", "1", "M", True), (2014, "sex", "1", "M", True), (2014, "race", "9", None, False)])
    rev = crosswalk.flagged_recode_summary(table).collect()
    assert [(r["variable"], r["applicable_years"]) for r in rev] == [("sex", "2014,2016")]


SCHEMA = "variable string, data_type string, factor_is_ordered boolean, factor_value string, factor_label string, factor_order int, description string, source_file_type string"


def test_enforce_schema_types_and_factors(spark):
    df = spark.createDataFrame([("45", "45.7", "yes", "1", "b"), ("45.0", "x", "maybe", "2", None)],
                               "n_int string, n_dbl string, flag string, lvl string, txt string")
    rows = [("n_int", "integer", None, None, None, None, "", ""), ("n_dbl", "numeric", None, None, None, None, "", ""),
            ("flag", "logical", None, None, None, None, "", ""), ("txt", "character", None, None, None, None, "", ""),
            ("lvl", "factor", True, "2", "Two", 2, "", ""), ("lvl", "factor", True, "1", "One", 1, "", "")]
    out, audit = schema.enforce_schema(df, spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in out.collect()]
    assert got == [(45, 45.7, True, "One", "b"), (None, None, None, "Two", None)]
    assert out.schema["lvl"].metadata["factor"] == {"levels": ["1", "2"], "labels": ["One", "Two"], "ordered": True}
    assert [r["variable"] for r in audit.collect()] == sorted(df.columns)


def test_schema_guards(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    base = [("a", "character", None, None, None, None, "", "")]
    with pytest.raises(SchemaMismatch):
        schema.enforce_schema(df, spark.createDataFrame(base, SCHEMA))                       # extra column b
    with pytest.raises(DataGuardError):
        schema.enforce_schema(df, spark.createDataFrame(base + [("b", "blob", None, None, None, None, "", "")], SCHEMA))
    fac = base + [("b", "factor", True, "x", "X", None, "", "")]
    with pytest.raises(DataGuardError):                                                        # NULL order
        schema.enforce_schema(df, spark.createDataFrame(fac, SCHEMA))
    fac = base + [("b", "factor", False, "x", "X", None, "", ""), ("b", "factor", False, "x", "Y", None, "", "")]
    with pytest.raises(DataGuardError):                                                        # one value, two labels
        schema.enforce_schema(df, spark.createDataFrame(fac, SCHEMA))
    fac = base + [("b", "factor", False, "y", "Y", None, "", "")]
    with pytest.raises(DataGuardError, match="x"):                                             # unexpected level, scan
        schema.enforce_schema(df, spark.createDataFrame(fac, SCHEMA), check_levels="scan")
    typed, _ = schema.enforce_schema(df, spark.createDataFrame(fac, SCHEMA))                   # in-plan: raises on use
    with pytest.raises(Exception, match="without a factor level: x"):
        typed.collect()


def test_demographics(spark):
    cols = ["age_type", "age", "age_years", "hispanic_nchs_bridge", "race_summary_code", *demographics.ASIAN_FLAGS,
            *demographics.NHPI_FLAGS, "race_white", "race_black", "race_amer_indian_alaskan"]
    def row(**kw):
        return tuple(kw.get(c) for c in cols)
    data = [
        row(age_type=None, age="999", age_years="45.7", hispanic_nchs_bridge="0", race_summary_code="10",
            **{f: "N" for f in demographics.ASIAN_FLAGS}),
        row(age_type=None, age="50", age_years="121", hispanic_nchs_bridge="5", race_summary_code="15", race_chinese="Y"),
        row(age_type="9", age="999", age_years="x", hispanic_nchs_bridge="9", race_summary_code="99"),
        row(hispanic_nchs_bridge=None, race_summary_code="10", race_white="Y", race_black="N", race_amer_indian_alaskan="N",
            **{f: "N" for f in (*demographics.ASIAN_FLAGS, *demographics.NHPI_FLAGS)}),
    ]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    out = [r.asDict() for r in demographics.derive_demographics(df).collect()]
    assert [r["age"] for r in out] == [None, "50", None, None]
    assert [r["age_years"] for r in out] == [45, None, None, None]
    assert [r["age_6g"] for r in out] == ["45-64", None, None, None]
    assert [r["hispanic"] for r in out] == [0, 1, None, None]
    assert [r["race6"] for r in out] == ["White Only", "Multi Race", None, "White Only"]
    assert [r["race_ethnicity7"] for r in out] == ["White Only-NH", "Hispanic as Race", None, "White Only-NH"]
    assert [r["race_asian"] for r in out] == ["N", "Y", None, "N"]
    assert [r["race_code"] for r in out] == [None, None, None, "10000"]


def test_completeness_and_report(spark):
    df = spark.createDataFrame([(2014, "a", None, "x"), (2014, "b", "c", "y"), (2015, "c", "d", None)],
                               "file_year int, full string, part string, record_axis_code_2 string")
    comp = {(r["file_year"], r["variable"]): r["pct_complete"] for r in quality.completeness(df).collect()}
    assert comp[(2014, "part")] == 0.5 and comp[(2015, "full")] == 1.0
    rep = quality.completeness_report(df).collect()
    assert sorted((r["file_year"], r["variable"], r["pct_label"]) for r in rep) == [(2014, "part", "50.0%"), (2015, "part", "100.0%")]


def test_validate_and_dictionary(spark):
    df = spark.createDataFrame([(2014, "1", 30), (2014, "1", 130), (2015, "2", None)], "file_year int, sfn string, age int")
    res = {r["rule"]: (r["n_checked"], r["n_failed"]) for r in
           quality.validate_rules(df, {"age": F.col("age").between(0, 120)}, [("unique", ["file_year", "sfn"])]).collect()}
    assert res == {"age": (2, 1), "unique": (3, 2)}
    d = {r["varname"]: r for r in quality.data_dictionary(df, suppress=["sfn"], max_unique_values=2).collect()}
    assert d["file_year"]["value_counts"] == "2014 (2); 2015 (1)"
    assert d["sfn"]["value_counts"] is None and d["sfn"]["n_distinct"] == 2
    assert d["age"]["n_null"] == 1 and d["age"]["n_distinct"] == 2


def test_projection_selectors():
    cols = ["residence_city", "residence_city_limits", "age", "page", "stage_x", "file_year"]
    spec = ["file_year", starts_with("RESIDENCE_CITY"), "residence_city_limits", contains("age")]
    assert resolve_columns(cols, spec) == ["file_year", "residence_city", "residence_city_limits", "age", "page", "stage_x"]
    with pytest.raises(SchemaMismatch):
        resolve_columns(cols, ["missing"])
