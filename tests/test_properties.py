"""Property checks (hypothesis): each example is one DataFrame checked in one job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yearweave.functions import pad_left, parse_date_multi
from yearweave.operators import quality, recode

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
codes = st.one_of(st.none(), st.text(alphabet="0123456789AB", min_size=0, max_size=6))


@SETTINGS
@given(st.lists(codes, min_size=1, max_size=30), st.integers(min_value=1, max_value=5))
def test_pad_left_never_shortens(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    for x, y in df.select("x", pad_left("x", width).alias("y")).collect():
        if x is None:
            assert y is None
        else:
            assert len(y) == max(len(x), width) and y.endswith(x)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2014, 2015]), codes), min_size=1, max_size=40),
       st.dictionaries(st.sampled_from(["1", "2", "A", None]), st.sampled_from(["X", "Y", None]), max_size=4))
def test_recode_preserves_rows_and_untouched_codes(spark, rows, mapping):
    df = spark.createDataFrame([(y, v, i) for i, (y, v) in enumerate(rows)], "file_year int, code string, id int")
    cw = spark.createDataFrame([(2014, "code", f, None, t, None, False) for f, t in mapping.items()],
                               "file_year int, variable string, from_code string, from_label string, to_code string, to_label string, review_flag boolean")
    out = {r["id"]: r["code"] for r in recode.recode(df, cw).collect()}
    assert len(out) == len(rows)
    for i, (y, v) in enumerate(rows):
        target = mapping.get(v) if (y == 2014 and v in mapping) else None
        assert out[i] == (target if target is not None else v)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2014, 2015, 2016]), codes, codes), min_size=1, max_size=40))
def test_completeness_is_a_share(spark, rows):
    df = spark.createDataFrame(rows, "file_year int, a string, b string")
    for r in quality.completeness(df).collect():
        assert 0.0 <= r["pct_complete"] <= 1.0 and r["n_complete"] <= r["n_rows"]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789/-MARJNabc ", max_size=12), min_size=1, max_size=30))
def test_date_parse_never_raises(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert len(df.select(parse_date_multi("x")).collect()) == len(values)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2014, 2015]), codes), min_size=1, max_size=40),
       st.dictionaries(st.tuples(st.sampled_from([2014, 2015]), st.sampled_from(["1", "2", "A", None])),
                       st.sampled_from(["X", "Y", None]), max_size=6))
def test_recode_strategies_agree(spark, rows, mapping):
    df = spark.createDataFrame([(y, v, i) for i, (y, v) in enumerate(rows)], "file_year int, code string, id int")
    cw = spark.createDataFrame([(y, "code", f, None, t, None, False) for (y, f), t in mapping.items()],
                               "file_year int, variable string, from_code string, from_label string, to_code string, to_label string, review_flag boolean")
    by_map = {r["id"]: r["code"] for r in recode.recode(df, cw).collect()}
    by_join = {r["id"]: r["code"] for r in recode.recode(df, cw, strategy="join").collect()}
    by_year = {r["id"]: r["code"] for r in recode.recode(df, cw, strategy="year").collect()}
    assert by_map == by_join == by_year


dates_text = st.one_of(st.none(), st.dates(min_value=__import__("datetime").date(1840, 1, 1),
                                           max_value=__import__("datetime").date(2030, 12, 31)).map(lambda d: d.strftime("%Y%m%d")),
                       st.sampled_from(["junk", "99991231", ""]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2014, 2016]), dates_text, dates_text, dates_text, dates_text, dates_text),
                min_size=1, max_size=25))
def test_clean_dates_satisfy_logic_rules(spark, rows):
    import datetime as dt
    from yearweave.operators.dates import DATE_VARS, clean_dates
    data = [(str(i), y, "2026-01-01", b, d, inj, rec, disp) for i, (y, b, d, inj, rec, disp) in enumerate(rows)]
    ddl = ", ".join(f"{c} {'int' if c == 'file_year' else 'string'}" for c in ["state_file_number", "file_year", *DATE_VARS])
    out, _ = clean_dates(spark.createDataFrame(data, ddl), as_of_date="2026-01-01")
    for r in out.collect():
        death, birth, inj = r["date_of_death"], r["date_of_birth"], r["date_of_injury"]
        if death is not None:
            assert death.year == r["file_year"]                                    # L4
        if birth is not None:
            assert death is not None and birth <= death                            # L5
            assert (death.year - birth.year - ((death.month, death.day) < (birth.month, birth.day))) < 120  # L6
        if inj is not None and death is not None:
            assert inj <= death                                                    # L7
        for v in ("date_received", "disposition_date"):
            if r[v] is not None:                                                   # L8
                assert death is not None and death <= r[v] <= dt.date(r["file_year"] + 2, 12, 31)
        for v in DATE_VARS:
            if r[v] is not None:
                assert dt.date(1851, 1, 1) <= r[v] <= dt.date(2026, 1, 1)          # L2
