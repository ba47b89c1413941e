"""Truth tables for the column-expression helpers."""

import datetime as dt

from pyspark.sql import functions as F

from yearweave.functions import (
    AGE_CUTS, bin_by_cuts, bin_labels, combine_columns, completed_years, icd10_clean, if_else3, in_set, last_n,
    minus_months_strict, normalize_text, nullify_placeholders, pad_left, parse_date_multi, percent_label,
    remove_first, remove_first_punct, squish, title_case, zip5_or_null,
)


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).collect()[0]["y"]


def test_if_else3_null_condition_gives_null(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    got = [r[0] for r in df.select(if_else3(F.col("x") > 3, "big", "small")).collect()]
    assert got == ["small", "big", None]


def test_in_set_is_never_null(spark):
    df = spark.createDataFrame([("0",), ("7",), (None,)], "x string")
    assert [r[0] for r in df.select(in_set("x", ["0", None])).collect()] == [True, False, True]
    assert [r[0] for r in df.select(in_set("x", ["0"])).collect()] == [True, False, False]


def test_pad_left_never_truncates(spark):
    assert one(spark, pad_left("x", 3), "53033") == "53033"
    assert one(spark, pad_left("x", 3), "9") == "009"
    assert one(spark, pad_left("x", 2), None) is None


def test_last_n_returns_short_strings_whole(spark):
    assert one(spark, last_n("x", 3), "9") == "9"
    assert one(spark, last_n("x", 3), "0053009") == "009"


def test_remove_first_only_first_match(spark):
    assert one(spark, remove_first_punct("x"), "1:2:5") == "12:5"
    assert one(spark, remove_first("x", "^53"), "53053") == "053"
    assert one(spark, remove_first("x", r"\."), "a.b.c") == "ab.c"


def test_title_case_starts_words_after_any_separator(spark):
    assert one(spark, title_case("x"), "HIGH-SCHOOL O'BRIEN (RETIRED) 3RD") == "High-School O'brien (Retired) 3rd"
    assert one(spark, title_case("x"), "ßtraße") == "Sstraße"
    assert one(spark, title_case("x"), None) is None


def test_normalize_text_order(spark):
    assert one(spark, normalize_text("x"), "a\tb\u200bc ") == "abc"
    assert one(spark, normalize_text("x"), "") is None
    assert one(spark, normalize_text("x"), "NA") is None
    assert one(spark, normalize_text("x"), " NA ") == "NA"          # trim comes last
    assert one(spark, normalize_text("x"), "\u00a0\u00a0") == ""      # only blanks -> ""
    assert one(spark, normalize_text("x"), "\u200b") is None          # only control -> NULL


def test_squish(spark):
    assert one(spark, squish("x"), "  a \u00a0 b  ") == "a b"


def test_bins_labels_and_edges(spark):
    assert bin_labels(AGE_CUTS["age_6g"]) == ["0", "1-14", "15-24", "25-44", "45-64", "65+"]
    df = spark.createDataFrame([(v,) for v in (0, 1, 14, 15, 64, 65, 120, -1, None)], "a int")
    got = [r[0] for r in df.select(bin_by_cuts("a", AGE_CUTS["age_6g"])).collect()]
    assert got == ["0", "1-14", "1-14", "15-24", "45-64", "65+", "65+", None, None]


def test_icd10_clean(spark):
    assert one(spark, icd10_clean("x"), "i21.9") == "I219"
    assert one(spark, icd10_clean("x"), "E14") == "E14"
    assert one(spark, icd10_clean("x"), "123") is None
    assert one(spark, icd10_clean("x"), "A12345") is None


def test_combine_columns_skips_nulls(spark):
    df = spark.createDataFrame([(None, "I219", None, "E149"), (None, None, None, None)], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(combine_columns(["a", "b", "c", "d"])).collect()] == ["I219;E149", ""]


def test_zip_and_placeholders(spark):
    df = spark.createDataFrame([("98101",), ("98101-1234",), (None,)], "x string")
    assert [r[0] for r in df.select(zip5_or_null("x")).collect()] == ["98101", None, None]
    df = spark.createDataFrame([("--",), ("unknown trade",), ("Nurse",), (None,)], "x string")
    e = nullify_placeholders("x", ("-", "--"), ("Not Applicable", "Unknown"))
    assert [r[0] for r in df.select(e).collect()] == [None, None, "Nurse", None]


def test_percent_label_rounds_exact_ratio_half_up(spark):
    df = spark.createDataFrame([(711111, 1000000), (1225, 10000), (1, 3), (0, 5)], "n long, d long")
    assert [r[0] for r in df.select(percent_label("n", "d")).collect()] == ["71.1%", "12.3%", "33.3%", "0.0%"]


def test_parse_date_formats(spark):
    vals = ["20140305", "2014-03-05", "3/5/2014", "05MAR2014", " 2014-03-05 ", "2014/03/05", "2014.3.5", "2014 03 05", "03-05-2014",
            "5Mar2014", "05-MAR-2014", "5 march 2014", "03052014", "junk", "20141305", "2014-02-30", "5Foo2014", "2014-3", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(parse_date_multi("x")).collect()]
    d = dt.date(2014, 3, 5)
    assert got == [d] * 13 + [None] * 7


def test_minus_months_strict_and_completed_years(spark):
    df = spark.createDataFrame([(dt.date(2014, 8, 31),), (dt.date(2014, 3, 15),)], "d date")
    got = [r[0] for r in df.select(minus_months_strict("d", 9)).collect()]
    assert got == [None, dt.date(2013, 6, 15)]
    df = spark.createDataFrame([(dt.date(2008, 2, 29), dt.date(2011, 2, 28)), (dt.date(1890, 1, 1), dt.date(2014, 3, 5))], "a date, b date")
    assert [r[0] for r in df.select(completed_years("a", "b")).collect()] == [2, 124]
