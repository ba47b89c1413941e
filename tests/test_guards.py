"""Guards settled once: observed by the write, or one filter at the end of a stage."""

import os

import pytest
from pyspark.sql import functions as F

from yearweave.operators import geography, guards, lookup, schema
from yearweave.operators._common import DataGuardError
from yearweave.plans.driver_queries import QUERIES, guarded_orders
from yearweave.sources.parquet import read_harmonized, write_harmonized

SF = "/root/testdata/sf0.001"
TABLE = [("A", "1"), ("B", "2"), ("C", None)]


def looked_up(spark, codes, mode, year=2010):
    df = spark.createDataFrame([(i, c, "old", year) for i, c in enumerate(codes)], "id long, k string, t string, file_year int")
    table = spark.createDataFrame(TABLE, "k string, v string")
    return lookup.lookup_before_year(df, "k", "t", table, "k", "v", 2015, on_unmatched=mode)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_write_lists_every_code_with_its_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(guards.GuardViolation) as hit:
        guards.write_checked(looked_up(spark, ["A", "x", "C", None, "x", "", "y\"z"], "observe"), path)
    guard = "lookup: k has no value for code"
    assert hit.value.rows == [(guard, "", 1), (guard, "C", 1), (guard, "x", 2), (guard, 'y"z', 1)]
    assert hit.value.complete and "5 row(s), 4 code(s)" in str(hit.value) and "'x' (2)" in str(hit.value)
    assert os.listdir(tmp_path) == []  # neither a table nor what was written of it


def test_clean_write_replaces_the_table_and_keeps_no_guard_column(spark, tmp_path):
    path = str(tmp_path / "out")
    for codes in (["A"], ["A", "B", None]):
        guards.write_checked(looked_up(spark, codes, "observe"), path)
        got = spark.read.parquet(path)
        assert got.columns == ["id", "k", "t", "file_year"] and got.count() == len(codes)
    with pytest.raises(guards.GuardViolation):
        guards.write_checked(looked_up(spark, ["q"], "observe"), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["out"]


def test_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "out")
    guards.write_checked(looked_up(spark, ["A"], "observe"), path)

    def breaks(frame, folder):
        frame.limit(1).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        guards.write_checked(looked_up(spark, ["A", "A"], "observe"), path, breaks)
    assert spark.read.parquet(path).count() == 1 and os.listdir(tmp_path) == ["out"]


def test_partitioned_write_is_checked_too(spark, tmp_path):
    path = str(tmp_path / "out")
    write_harmonized(looked_up(spark, ["A", "B"], "observe"), path)
    with pytest.raises(guards.GuardViolation):
        write_harmonized(looked_up(spark, ["A", "?"], "observe"), path)
    assert sorted(r.k for r in read_harmonized(spark, path, [2010]).collect()) == ["A", "B"]
    with pytest.raises(ValueError):
        write_harmonized(looked_up(spark, ["A"], "observe"), path, mode="append")


def test_many_codes_are_counted_and_listed_as_far_as_known(spark, tmp_path):
    codes = spark.range(40_000).select(F.col("id").cast("string").alias("c"))
    watched = guards.watch(codes, "g", F.lit(True), F.col("c"))
    with pytest.raises(guards.GuardViolation) as hit:
        guards.write_checked(watched, str(tmp_path / "out"))
    assert hit.value.totals == {"g": 40_000} and not hit.value.complete and "more than" in str(hit.value)
    exact = guards.watch(codes.filter("c < 9000").unionAll(codes.filter("c < 9000")), "g", F.lit(True), F.col("c"))
    with pytest.raises(guards.GuardViolation) as hit:
        guards.write_checked(exact, str(tmp_path / "out"))
    assert hit.value.complete and {n for _, _, n in hit.value.rows} == {2} and len(hit.value.rows) == 9000


def test_settled_frames_fail_whatever_is_read_of_them(spark):
    df = looked_up(spark, ["A", "x"], "raise")
    assert df.columns == ["id", "k", "t", "file_year"] and not guards.guard_columns(df)
    for read in (df, df.select("id"), df.withColumn("t", F.lit(1)), df.groupBy().count()):
        with pytest.raises(Exception, match="k has no value for code 'x'"):
            read.collect()
    assert looked_up(spark, ["A", "x"], "raise", year=2020).count() == 2  # out of scope
    assert guards.settle(df) is df


def test_filters_above_observed_operators_reach_the_scan(spark):
    df = guarded_orders(spark, SF, 39, [("O", "Open"), ("F", "Final"), ("P", "Partial")])
    plan = plan_of(df.filter("fips_code IS NOT NULL AND wa_code = '07'"))
    assert "monotonically" not in plan and "CollectMetrics" not in plan
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", F.lit("07").alias("k"), F.lit("?").alias("t"), F.year("o_orderdate").alias("file_year"))
    cmap = geography.county_map_from_rule(spark)
    out = lookup.lookup_before_year(o, "k", "t", cmap, "county_wa_code", "county_fips_code", 2015, on_unmatched="observe")
    assert "EqualTo(o_orderkey,7)" in plan_of(out.filter("o_orderkey = 7"))


@pytest.mark.parametrize("name", ["geo_rules", "clean_death_records"])
def test_a_stage_has_one_guard(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.count("CollectMetrics") == 1 and plan.count("raise_error") == 1 and "monotonically" not in plan


def test_operators_share_one_settlement(spark):
    df = looked_up(spark, ["A", "B"], "observe").withColumn("f", F.lit("bad"))
    rows = [(c, "character", None, None, None, None) for c in ("id", "k", "t", "file_year")] + [("f", "factor", False, "good", "Good", None)]
    table = spark.createDataFrame(rows, "variable string, data_type string, factor_is_ordered boolean, factor_value string, "
                                        "factor_label string, factor_order int")
    both = schema.enforce_schema(df, table, check_levels="observe").df
    assert sorted(guards.guard_columns(both).values()) == [
        "enforce_schema: f holds a value without a factor level", "lookup: k has no value for code"]
    with pytest.raises(Exception, match="f holds a value without a factor level: bad"):
        guards.settle(both).collect()
    with pytest.raises(Exception, match="level: bad"):
        schema.enforce_schema(df, table).df.select("id").collect()
    with pytest.raises(DataGuardError):
        schema.enforce_schema(df, table, check_levels="scan")
