"""Date (L1-L9) and time (M1-M9) cleaning on FIXTURES 5 rows."""

import datetime as dt

from yearweave.operators.dates import DATE_VARS, clean_dates
from yearweave.operators.times import clean_times

D = dt.date


def date_frame(spark, rows):
    cols = ["state_file_number", "file_year", *DATE_VARS]
    full = [(str(i), r.get("file_year", 2014), r.get("date_harmonized", "2026-01-01"), r.get("birth"), r.get("death"),
             r.get("injury"), r.get("received"), r.get("disposition")) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} {'int' if c == 'file_year' else 'string'}" for c in cols))


def clean(spark, rows):
    df, rep = clean_dates(date_frame(spark, rows), as_of_date="2026-01-01")
    return [r.asDict() for r in df.orderBy("state_file_number").collect()], rep


def test_death_formats_and_placeholders(spark):
    rows = [{"death": v} for v in ("20140305", "2014-03-05", "3/5/2014", "05MAR2014", "99991231", "junk", "2013-12-31")]
    out, rep = clean(spark, rows)
    assert [r["date_of_death"] for r in out] == [D(2014, 3, 5)] * 4 + [None, None, None]
    reported = sorted(r["original_value"] for r in rep.collect())
    assert reported == ["99991231", "junk"]                                 # 2013-12-31 failed logic, not parsing


def test_birth_rules(spark):
    rows = [
        {"death": "2013-12-31", "birth": "1950-01-01"},                      # death out of year -> birth NULL
        {"death": "2014-03-05", "birth": "1890-01-01"},                      # age >= 120
        {"death": "2014-03-05", "birth": "2014-03-06"},                      # born after death
        {"death": "2014-03-05", "birth": "1950-01-01"},
    ]
    out, _ = clean(spark, rows)
    assert [r["date_of_birth"] for r in out] == [None, None, None, D(1950, 1, 1)]


def test_injury_and_late_dates(spark):
    rows = [
        {"death": "2014-03-05", "birth": "2013-12-15", "injury": "2013-03-14"},   # before birth - 9 months
        {"death": "2014-03-05", "birth": "2013-12-15", "injury": "2013-03-15"},
        {"death": "2014-03-05", "birth": "2013-08-31", "injury": "2010-01-01"},   # birth - 9 months does not exist
        {"death": "2014-03-05", "received": "2016-12-31", "disposition": "2017-01-01"},
        {"death": "2014-03-05", "injury": "2014-03-06"},                          # after death
    ]
    out, _ = clean(spark, rows)
    assert [r["date_of_injury"] for r in out] == [None, D(2013, 3, 15), D(2010, 1, 1), None, None]
    assert (out[3]["date_received"], out[3]["disposition_date"]) == (D(2016, 12, 31), None)


TIME_COLS = ["state_file_number", "file_year", "time_of_death", "time_of_death_hour", "time_of_death_minutes",
             "time_of_injury", "time_of_injury_hour", "time_of_injury_minutes"]


def test_time_rules(spark):
    cases = [  # (text, hour, minute) -> expected, reported?
        ((None, "9", "5"), "09:05:00", False),
        ((None, "13", "75"), "13:00:00", False),
        (("2400", "24", None), "00:00:00", False),
        ((None, None, "10"), None, False),
        (("14:05", None, None), "14:05:00", False),
        (("9999", None, None), None, False),
        (("930", None, None), None, True),
        (("1:2:5", None, None), None, True),
    ]
    rows = [(str(i), 2018, t, h, m, None, None, None) for i, ((t, h, m), _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'file_year' else 'string'}" for c in TIME_COLS))
    out, rep = clean_times(df)
    got = [r["time_of_death"] for r in out.orderBy("state_file_number").collect()]
    assert got == [c[1] for c in cases]
    assert sorted(r["original_value"] for r in rep.collect()) == ["12:5", "930"]


def test_time_type_output(spark):
    """time_as="time" gives Spark's TIME type when the session enables it."""
    prev = spark.conf.get("spark.sql.timeType.enabled", "false")
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        rows = [("1", 2018, "0930", None, None, None, None, None)]
        df = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'file_year' else 'string'}" for c in TIME_COLS))
        out, _ = clean_times(df, time_as="time")
        assert dict(out.dtypes)["time_of_death"].startswith("time")
        assert str(out.collect()[0]["time_of_death"]) == "09:30:00"
    finally:
        spark.conf.set("spark.sql.timeType.enabled", prev)
