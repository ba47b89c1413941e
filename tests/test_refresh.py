"""Refresh by vintage: one vintage is rewritten, readers see whole refreshes, completeness comes from kept counts."""

import os

import pytest
from pyspark.sql import functions as F

from yearweave.operators import guards, quality
from yearweave.operators._common import SchemaMismatch
from yearweave.sources import refresh as r

DDL = "id int, file_year int, sex string, record_axis_code_2 string"


def frame(spark, *years, sex="F"):
    rows = [(10 * y + i, y, sex if i else None, "x" if y % 2 else None) for y in years for i in range(4)]
    return spark.createDataFrame(rows, DDL)


def contents(df):
    return sorted(map(tuple, df.select("id", "file_year", "sex").collect()), key=str)


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{path}/rows") for f in fs if f.startswith("part-")}


def test_one_vintage_is_rewritten_and_old_frames_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    assert r.refresh(frame(spark, 2014, 2015, 2016), path) == [2014, 2015, 2016]
    old, files = r.read_refreshed(spark, path), data_files(path)
    want_old = contents(old)
    assert r.refresh(frame(spark, 2015, sex="M"), path) == [2015]
    assert {f: t for f, t in data_files(path).items() if f in files} == files
    assert all("file_year=2015" in f for f in set(data_files(path)) - set(files))
    assert contents(old) == want_old == contents(frame(spark, 2014, 2015, 2016))
    now = r.read_refreshed(spark, path)
    assert contents(now) == sorted(contents(frame(spark, 2014, 2016)) + contents(frame(spark, 2015, sex="M")), key=str)
    assert dict(now.dtypes)["file_year"] == "int"
    some = r.read_refreshed(spark, path, years=[2015])
    assert all("file_year=2015" in f for f in some.inputFiles()) and some.count() == 4
    assert r.drop_replaced(spark, path) == 1 and r.drop_replaced(spark, path) == 0
    assert contents(r.read_refreshed(spark, path)) == contents(now)
    assert sum("file_year=2015" in f for f in data_files(path)) == len(some.inputFiles())


def test_kept_completeness_is_that_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    r.refresh(frame(spark, 2014, 2015), path)
    r.refresh(frame(spark, 2015, 2016, sex=None), path)
    kept, whole = r.kept_completeness(spark, path), quality.completeness(r.read_refreshed(spark, path))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.select(kept.columns).collect()))
    assert all("/counts/" in f for f in kept.inputFiles())
    report = quality.report_of(kept, keep_axis=True)
    direct = quality.completeness_report(r.read_refreshed(spark, path), keep_axis=True)
    assert sorted(map(tuple, report.select(direct.columns).collect())) == sorted(map(tuple, direct.collect()))


def test_refused_and_failed_refreshes_leave_no_trace(spark, tmp_path):
    path = str(tmp_path / "t")
    r.refresh(frame(spark, 2014, 2015), path)
    before, files = contents(r.read_refreshed(spark, path)), data_files(path)
    bad = guards.watch(frame(spark, 2015, sex="?"), "sex", F.col("sex") == "?", F.col("sex"))
    with pytest.raises(guards.GuardViolation) as e:
        r.refresh(bad, path)
    assert e.value.rows == [("sex", "?", 3)]
    with pytest.raises(ValueError, match="does not name: \\[2016\\]"):
        r.refresh(frame(spark, 2015, 2016), path, years=[2015])
    with pytest.raises(ValueError, match="does not name: \\[None\\]"):
        r.refresh(frame(spark, 2015).withColumn("file_year", F.lit(None).cast("int")), path)
    with pytest.raises(SchemaMismatch, match="1 vintage"):
        r.refresh(frame(spark, 2015).withColumn("sex", F.lit(1)), path)
    with pytest.raises(SchemaMismatch, match="as int"):
        r.refresh(frame(spark, 2015).withColumn("file_year", F.lit("2015")), path)
    assert contents(r.read_refreshed(spark, path)) == before and data_files(path) == files
    clean = guards.watch(frame(spark, 2015, sex="M"), "sex", F.col("sex") == "?", F.col("sex"))
    r.refresh(clean, path)
    assert r.read_refreshed(spark, path).columns == ["id", "sex", "record_axis_code_2", "file_year"]


def test_vintages_without_rows_leave_and_empty_tables_read(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        r.read_refreshed(spark, path)
    r.refresh(frame(spark, 2014, 2015), path)
    assert r.refresh(frame(spark, 2014).limit(0), path) == []
    assert r.read_refreshed(spark, path).count() == 8
    assert r.refresh(frame(spark, 2014).limit(0), path, years=[2015]) == [2015]
    assert contents(r.read_refreshed(spark, path)) == contents(frame(spark, 2014))
    r.refresh(frame(spark, 2014).limit(0), path, years=[2014])
    assert r.read_refreshed(spark, path).collect() == [] == r.kept_completeness(spark, path).collect()
    # once all vintages are refreshed, columns may change
    r.refresh(frame(spark, 2014).withColumn("sex", F.lit(1)), path)
    assert dict(r.read_refreshed(spark, path).dtypes)["sex"] == "int"


def test_a_refresh_published_meanwhile_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    r.refresh(frame(spark, 2014), path)
    publish = r._publish

    def late(*args):
        monkeypatch.setattr(r, "_publish", publish)
        r.refresh(frame(spark, 2016), path)
        publish(*args)

    monkeypatch.setattr(r, "_publish", late)
    with pytest.raises(r.ConcurrentRefresh):
        r.refresh(frame(spark, 2015), path)
    assert contents(r.read_refreshed(spark, path)) == contents(frame(spark, 2014, 2016))
    assert not any("file_year=2015" in f for f in data_files(path))
