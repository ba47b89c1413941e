"""Vintage assembly: rename to canonical names (B3-B5), union (H1), literals join (D1), CSV scan (A10)."""

import pytest
from pyspark.sql import functions as F

from yearweave.operators import vintage
from yearweave.operators._common import DataGuardError, SchemaMismatch
from yearweave.sources import csv_scan


def test_rename_to_canonical_fills_and_orders(spark):
    df = spark.createDataFrame([("1", "M", "x")], "CERTNO string, SEX string, EXTRA string")
    out = vintage.rename_to_canonical(df, [("CERTNO", "state_file_number"), ("SEX", "sex")], ["sex", "time_of_death", "state_file_number"])
    assert out.columns == ["sex", "time_of_death", "state_file_number"]
    assert tuple(out.collect()[0]) == ("M", None, "1")
    with pytest.raises(SchemaMismatch):
        vintage.rename_to_canonical(df, [("MISSING", "x")], ["x"])


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(2014, "1")], "file_year int, a string")
    b = spark.createDataFrame([(2018, "2")], "file_year int, b string")
    rows = sorted(tuple(r) for r in vintage.union_vintages([a, b]).select("file_year", "a", "b").collect())
    assert rows == [(2014, "1", None), (2018, None, "2")]


def test_join_literals_keeps_rows_and_order(spark):
    stat = spark.createDataFrame([("v", 2014, "1"), ("v", 2014, None), ("v", 2014, "3")], "vintage_label string, file_year int, state_file_number string")
    lit = spark.createDataFrame([(2014, "1", "cardiac"), (2014, None, "orphan")], "file_year int, state_file_number string, cod_text_1 string")
    out = vintage.join_literals(stat, lit)
    assert out.columns == ["vintage_label", "file_year", "state_file_number", "cod_text_1"]
    got = sorted((r["state_file_number"] or "", r["cod_text_1"] or "") for r in out.collect())
    assert got == [("", ""), ("1", "cardiac"), ("3", "")]                      # NULL key matches nothing
    both = sorted((r["state_file_number"] or "", r["cod_text_1"] or "") for r in vintage.join_literals(stat, lit, null_safe=True).collect())
    assert both == [("", "orphan"), ("1", "cardiac"), ("3", "")]
    assert [tuple(r) for r in vintage.null_key_counts(stat).collect()] == [(2014, 1)]
    with pytest.raises(DataGuardError):
        vintage.join_literals(stat, lit.withColumn("vintage_label", lit["cod_text_1"]))



def test_join_literals_salts_null_keys(spark):
    """NULL-key statistical rows hash by a per-row salt, not all into one partition."""
    from pyspark.sql import functions as F
    stat = spark.range(200).select(F.lit(2014).alias("file_year"),
                                   F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("state_file_number"),
                                   F.col("id").alias("x"))
    lit = spark.range(0, 200, 4).select(F.lit(2014).alias("file_year"), F.col("id").cast("string").alias("state_file_number"),
                                        F.lit("c").alias("cod_text_1"))
    out = vintage.join_literals(stat, lit)
    assert out.count() == 200
    assert out.filter(F.col("cod_text_1").isNotNull()).count() == 50
    assert out.filter(F.col("state_file_number").isNull() & F.col("cod_text_1").isNotNull()).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan


def test_null_keys_of_any_type_match_nothing_and_are_salted(spark):
    stat = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k long, x string")
    lit = spark.createDataFrame([(1, "one"), (None, "none")], "k long, y string")
    out = vintage.join_literals(stat, lit, ["k"])
    assert sorted((r.x, r.y) for r in out.collect()) == [("a", "one"), ("b", None), ("c", None)]
    assert "xxhash64" in out._jdf.queryExecution().executedPlan().toString()
    audit = {(r.side, r.file_year): r.n_null_key_rows for r in vintage.literal_key_audit(
        stat.withColumn("file_year", F.lit(2014)), lit.withColumn("file_year", F.lit(2015)), ["file_year", "k"]).collect()}
    assert audit == {("statistical", 2014): 2, ("literals", 2015): 1}


def test_two_sources_for_one_name_raise(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(SchemaMismatch, match="both a and b"):
        vintage.rename_to_canonical(df, [("a", "x"), ("b", "x")], ["x"])


def test_scan_columns_missing_source_raises(spark, tmp_path):
    p = tmp_path / "DeathStatF2014.csv"
    p.write_text('CERTNO,SEX\n1, M \n2,"a, ""b"""\n', encoding="utf-8")
    out = csv_scan.scan_columns(spark, [str(p)], [("CERTNO", "state_file_number"), ("SEX", "sex")], ["state_file_number", "sex", "age"])
    assert sorted(tuple(r) for r in out.collect()) == [("1", "M", None), ("2", 'a, "b"', None)]
    with pytest.raises(SchemaMismatch):
        csv_scan.scan_columns(spark, [str(p)], [("DTH_DT", "date_of_death")], ["date_of_death"])
    with pytest.raises(DataGuardError):
        csv_scan.scan_columns(spark, [], [("CERTNO", "state_file_number")], ["state_file_number"])


def test_code_sets_strip_bom_and_stay_strings(spark, tmp_path):
    from yearweave.sources.csv_scan import load_code_sets
    (tmp_path / "wa_county_code_to_fips_codes.csv").write_bytes(
        "\ufeffcounty_wa_code,county_wa_label,county_fips_code,county_fips_label\n01,Adams,001,Adams\n00,Unknown,00,Unknown\n".encode("utf-8"))
    (tmp_path / "notes.txt").write_text("ignored")
    sets = load_code_sets(spark, str(tmp_path))
    assert list(sets) == ["wa_county_code_to_fips"]
    df = sets["wa_county_code_to_fips"]
    assert df.columns[0] == "county_wa_code" and dict(df.dtypes)["county_wa_code"] == "string"
    assert sorted(r[0] for r in df.select("county_wa_code").collect()) == ["00", "01"]


def test_parquet_roundtrip_prunes_years(spark, tmp_path):
    from yearweave.sources.parquet import read_harmonized, write_harmonized
    df = spark.createDataFrame([(2014, "a"), (2015, "b"), (2015, "c")], "file_year int, v string")
    write_harmonized(df, str(tmp_path / "h"))
    back = read_harmonized(spark, str(tmp_path / "h"), years=[2015])
    assert sorted(r["v"] for r in back.collect()) == ["b", "c"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_year" in plan and "2015" in plan


def test_several_files_per_vintage_must_share_the_header(spark, tmp_path):
    a, b, c = tmp_path / "a.csv", tmp_path / "b.csv", tmp_path / "c.csv"
    a.write_text("CERTNO,SEX\n1,M\n")
    b.write_text("CERTNO,SEX\n2,F\n")
    c.write_text("SEX,CERTNO\nF,3\n")
    ok = csv_scan.scan_columns(spark, [str(a), str(b)], [("CERTNO", "id"), ("SEX", "sex")], ["id", "sex"])
    assert sorted(tuple(r) for r in ok.collect()) == [("1", "M"), ("2", "F")]
    swapped = csv_scan.scan_columns(spark, [str(a), str(c)], [("CERTNO", "id"), ("SEX", "sex")], ["id", "sex"])
    with pytest.raises(Exception):
        swapped.collect()
