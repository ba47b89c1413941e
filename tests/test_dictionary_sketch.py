"""The data dictionary from sketches: exact where values are listed, one aggregate whatever the columns hold."""

from pyspark.sql import functions as F

from yearweave.operators.quality import data_dictionary

COLUMNS = ["varname", "data_type", "n_rows", "n_null", "n_distinct", "value_counts", "min_value", "max_value"]


def table(spark, n):
    k = F.col("id")
    return spark.range(0, n, 1, 4).select(
        "id", (k % 30).alias("thirty"), (k % 31).alias("more"), F.when(k % 3 > 0, (k % 5).cast("string")).alias("with nulls"),
        F.lit(None).cast("string").alias("none"), F.lit("").alias("empty"), (k % 700).cast("string").alias("hundreds"),
        F.concat(F.lit("a long value, cut "), (k % 2).cast("string")).alias("back`tick"), F.array("id").alias("nested"), (k % 2 == 0).alias("flag"))


def test_equal_to_the_exact_dictionary(spark):
    df = table(spark, 20_000)
    exact = {r.varname: r for r in data_dictionary(df, suppress=("flag",)).collect()}
    found = {r.varname: r for r in data_dictionary(df, suppress=("flag",), distinct="sketch").collect()}
    assert set(exact) == set(found) == set(df.columns)
    for name, row in found.items():
        assert row.distinct_estimated == (name in ("id", "more", "hundreds"))
        for c in COLUMNS:
            if c == "n_distinct" and row.distinct_estimated:
                assert abs(row[c] - exact[name][c]) <= 0.1 * exact[name][c]
            else:
                assert row[c] == exact[name][c], (name, c)


def test_empty_table_and_descriptions(spark):
    df = table(spark, 0)
    notes = spark.createDataFrame([("flag", "b", "s"), ("flag", "a", "s")], "varname string, desc string, source string")
    rows = {r.varname: r for r in data_dictionary(df, notes, distinct="sketch").collect()}
    assert rows["flag"].desc == "a; b" and rows["id"].n_distinct == 0 and not rows["id"].distinct_estimated and rows["id"].value_counts == ""


def test_shuffles_no_row_per_value(spark):
    plan = data_dictionary(table(spark, 1000), distinct="sketch")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan
