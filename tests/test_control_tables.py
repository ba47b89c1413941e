"""Control tables: both strategies of recode and lookup agree, guards survive pruning, folders are named by the session."""

import pytest
from pyspark.sql import functions as F

from yearweave.operators import lookup, recode
from yearweave.operators._common import DataGuardError
from yearweave.operators.schema import enforce_schema, parse_double

CW = "file_year string, variable string, from_code string, to_code string"


@pytest.mark.parametrize("year_type", ["int", "string", "double"])
@pytest.mark.parametrize("code_type", ["int", "string"])
def test_recode_strategies_agree(spark, year_type, code_type):
    rows = [(i, y, c) for i, (y, c) in enumerate((y, c) for y in ("2014", "2015", "2016", None) for c in ("1", "2", "3", None))]
    if year_type == "string":
        rows += [(90, "bad", "1"), (91, " 2014", "1")]
    df = spark.createDataFrame(rows, "id int, file_year string, code string").select(
        "id", F.col("file_year").cast(year_type), F.col("code").cast(code_type), F.lit("x").alias("untouched"))
    cw = spark.createDataFrame([
        ("2014", "code", "1", "one"), ("2014", "code", None, "none"), ("2015", "code", "1", "uno"), ("2015", "code", "2", None),
        (None, "code", "3", "never"), ("2016", "code", "3", "b"), ("2014", "absent", "1", "x")], CW)
    got = {s: sorted(map(tuple, recode.recode(df, cw, strategy=s).collect()), key=str) for s in ("map", "join", "year")}
    assert got["map"] == got["join"] == got["year"] and len(got["map"]) == len(rows)
    codes = {r[0]: r[2] for r in got["map"]}
    assert [codes[i] for i in range(16)] == [
        "one", "2", "3", "none", "uno", "2", "3", None, "1", "2", "b", None, "1", "2", "3", None]
    if year_type == "string":
        assert (codes[90], codes[91]) == ("1", "one")


def test_ambiguous_codes_have_one_outcome(spark):
    df = spark.createDataFrame([(1, 2014, "a"), (2, 2014, None)], "id int, file_year int, code string")
    cw = spark.createDataFrame([("2014", "code", "a", "y"), ("2014", "code", "a", "x"), ("2014", "code", None, "n"), ("2014", "code", None, "m")], CW)
    for s in ("map", "join", "year"):
        with pytest.raises(DataGuardError, match="2 code"):
            recode.recode(df, cw, strategy=s)
        out = recode.recode(df, cw, validate=False, strategy=s)
        assert sorted((r.id, r.code) for r in out.collect()) == [(1, "x"), (2, "m")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_recode_by_year_joins_once(spark, monkeypatch, broadcast):
    """Many variables with many codes: one join, and equal rows whether the table of years is broadcast or salted."""
    if not broadcast:
        monkeypatch.setattr(recode, "BROADCAST_BYTES", -1)
    names = [f"v{i}" for i in range(6)]
    cw = spark.range(2014, 2018).select(F.col("id").alias("file_year"), F.explode(F.array(*map(F.lit, names))).alias("variable")).select(
        "*", F.explode(F.expr("transform(sequence(0, 150, 2), c -> if(c = 0, null, cast(c as string)))")).alias("from_code")).select(
        "file_year", "variable", "from_code", F.concat_ws("-", "variable", "file_year", F.coalesce("from_code", F.lit("none"))).alias("to_code"))
    value = lambda i: F.when(F.col("id") % (7 + i) == 0, None).otherwise((F.col("id") * (i + 1) % 160).cast("string"))
    df = spark.range(600).select("id", (F.lit(2013) + F.col("id") % 6).alias("file_year"), *[value(i).alias(n) for i, n in enumerate(names)])
    by_year, by_map = (recode.recode(df, cw, strategy=s) for s in ("year", "map"))
    assert by_year.columns == df.columns
    assert {r["id"]: tuple(r) for r in by_year.collect()} == {r["id"]: tuple(r) for r in by_map.collect()}
    plan = by_year._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter, ((__rc_row_year") + plan.count("Join LeftOuter, (__rc_row_year") == 1


def test_recode_by_year_without_rows(spark):
    df = spark.createDataFrame([(1, 2014, "a")], "id int, file_year int, code string")
    cw = spark.createDataFrame([("2014", "code", "a", "b")], CW)
    assert recode.recode(df.limit(0), cw, strategy="year").collect() == []
    assert [r.code for r in recode.recode(df, cw.limit(0), strategy="year").collect()] == ["a"]
    nothing = spark.createDataFrame([("2014", "code", "a", None), (None, "code", "a", "b")], CW)
    assert [r.code for r in recode.recode(df, nothing, strategy="year").collect()] == ["a"]


@pytest.mark.parametrize("key", ["double", "boolean", "string", "int", "decimal(5,2)"])
def test_lookup_strategies_agree_on_typed_keys(spark, key):
    values = ["true", "false", None] if key == "boolean" else ["1", "900000000", "3", None] if key != "decimal(5,2)" else ["1", "90", None]
    df = spark.createDataFrame([(i, v, 2014 + i % 2) for i, v in enumerate(values * 2)], "id int, k string, file_year int").select(
        "id", F.col("k").cast(key).alias("k"), "file_year", F.lit("own").alias("t"))
    table = spark.createDataFrame([(v, f"v{v}") for v in values], "k string, v string").select(F.col("k").cast(key).alias("k"), "v")
    got = [sorted(map(tuple, lookup.lookup_before_year(df, "k", "t", table, "k", "v", 2015, strategy=s).collect()), key=str) for s in ("map", "join")]
    assert got[0] == got[1] and all((r[3] != "own") == (r[2] == 2014) for r in got[0])
    doubled = table.unionByName(table)
    for s in ("map", "join"):
        with pytest.raises(DataGuardError, match="not unique"):
            lookup.lookup_before_year(df, "k", "t", doubled, "k", "v", 2015, strategy=s)


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_lookup_guard_cannot_be_pruned(spark, strategy):
    df = spark.createDataFrame([(1, "a", 2014), (2, "b", 2014), (3, "c", 2014), (4, "c", 2014)], "id int, k string, file_year int").withColumn("t", F.lit("own"))
    table = spark.createDataFrame([("a", "A"), ("b", None)], "k string, v string")
    run = lambda **o: lookup.lookup_before_year(df, "k", "t", table, "k", "v", 2015, strategy=strategy, **o)
    for use in (lambda d: d.select("id").collect(), lambda d: d.count(), lambda d: d.withColumn("t", F.lit(1)).collect()):
        with pytest.raises(Exception, match="has no value for code"):
            use(run())
    with pytest.raises(DataGuardError, match="3 row.* 2 code.*b, c"):
        run(on_unmatched="scan")
    report = lookup.unmatched_codes(df, "k", table, "k", "v", 2015).collect()
    assert sorted(map(tuple, report)) == [("b", 1), ("c", 2)]


def test_factor_guard_cannot_be_pruned(spark):
    schema = spark.createDataFrame(
        [("id", "integer", None, None, None, None), ("f", "factor", False, "a", "A", None)],
        "variable string, data_type string, factor_is_ordered boolean, factor_value string, factor_label string, factor_order int")
    typed = enforce_schema(spark.createDataFrame([("1", "a"), ("2", "z")], "id string, f string"), schema).df
    for use in (lambda d: d.select("id").collect(), lambda d: d.count()):
        with pytest.raises(Exception, match="without a factor level: z"):
            use(typed)
    twice = schema.unionByName(schema.limit(1).withColumn("data_type", F.lit("character")))
    with pytest.raises(DataGuardError, match="two data types"):
        enforce_schema(spark.createDataFrame([("1", "a")], "id string, f string"), twice)


def test_numbers_take_no_type_suffix(spark):
    df = spark.createDataFrame([(v,) for v in ("45", " 4.5 ", "45f", "4d", "1e2", ".5", "x", "", None)], "x string")
    assert [r[0] for r in df.select(parse_double(F.col("x"))).collect()] == [45.0, 4.5, None, None, 100.0, 0.5, None, None, None]


def test_no_shared_folder_raises():
    from yearweave.session import ensure_checkpoint_dir

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_code_sets_and_quoted_newlines(spark, tmp_path):
    from yearweave.sources.csv_scan import has_quoted_newlines, load_code_sets, load_control_table
    (tmp_path / "county_codes.csv").write_text('\ufeffcode,label\n1,"A, ""x"""\n', encoding="utf-8")
    (tmp_path / "place codes_codes.csv").write_text('code,label\n2,"two\nlines"\n', encoding="utf-8")
    (tmp_path / "other.csv").write_text("x\n", encoding="utf-8")
    sets = load_code_sets(spark, str(tmp_path))
    assert sorted(sets) == ["county", "place codes"]
    assert [tuple(r) for r in sets["county"].collect()] == [("1", 'A, "x"')]
    assert [tuple(r) for r in sets["place codes"].collect()] == [("2", "two\nlines")]
    assert not has_quoted_newlines(spark, [str(tmp_path / "county_codes.csv")])
    assert load_control_table(spark, str(tmp_path / "county_codes.csv")).columns == ["code", "label"]
