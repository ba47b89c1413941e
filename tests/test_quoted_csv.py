"""CSV with quoted line ends, read in splits, against Spark's one-task reader."""

import csv
import random
from collections import Counter

import pytest

from yearweave.operators._common import SchemaMismatch
from yearweave.sources.csv_scan import CSV_OPTIONS, read_csv_strings, scan_columns
from yearweave.sources.quoted_csv import csv_records, read_quoted_csv

VALUES = ["a", "", "two words", "line\nend", "cr\r\nlf", "\n\n", 'say "no"', '"', '""', ",", ',"\n"', "é\n日", " x ", "NA", "1"]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, terminator="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL if path.name.startswith("q") else csv.QUOTE_MINIMAL, lineterminator=terminator)
        out.writerows(rows)
    return str(path)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_reader_of_one_task(spark, small_splits, tmp_path, seed):
    r = random.Random(seed)
    folder = []
    for k in range(2):
        rows = [["id", "x", "y z"]] + [[str(i), r.choice(VALUES), r.choice(VALUES)] for i in range(r.randint(20, 120))]
        folder.append(written(tmp_path / f"{'q' if seed % 2 else 'm'}{k}.csv", rows, "\r\n" if seed >= 2 else "\n"))
    options = {**CSV_OPTIONS, "multiLine": "true"}
    want = spark.read.options(**options).csv(folder)
    got = read_quoted_csv(spark, folder, CSV_OPTIONS)
    assert got.columns == want.columns == ["id", "x", "y z"]
    assert rows_of(got) == rows_of(want)
    assert rows_of(read_csv_strings(spark, folder)) == rows_of(want)  # chosen by itself
    assert spark.read.text(folder).rdd.getNumPartitions() > 4


def test_a_record_over_many_blocks_and_numbers_in_order(spark, small_splits, tmp_path):
    long = "\n".join(f"line {i}" for i in range(400))
    path = written(tmp_path / "m.csv", [["id", "x"], ["1", "a"], ["2", long], ["3", "b\nc"], ["4", "d"]])
    got = {r.number: r.record for r in csv_records(spark, [path]).collect()}
    assert got == {0: "id,x", 1: "1,a", 2: f'2,"{long}"', 3: '3,"b\nc"', 4: "4,d"}
    assert {r.id: r.x for r in read_csv_strings(spark, path).collect()}["2"] == long


def test_scan_reads_named_columns_only(spark, tmp_path):
    path = written(tmp_path / "m.csv", [["a", "b", "c"], ["1", "x\ny", "2"], ["3", "", "4"]])
    df = scan_columns(spark, path, [("c", "last"), ("b", "text")], ["text", "last", "absent"], normalize=False)
    assert rows_of(df) == Counter([("x\ny", "2", None), (None, "4", None)])
    assert "`a`" not in df._jdf.queryExecution().executedPlan().toString()


def test_other_headers_raise_and_empty_files_give_no_rows(spark, tmp_path):
    one = written(tmp_path / "m1.csv", [["a", "b"], ["1", "x\ny"]])
    two = written(tmp_path / "m2.csv", [["a", "c"], ["1", "x\ny"]])
    with pytest.raises(SchemaMismatch, match="2 files name"):
        read_quoted_csv(spark, [one, two], CSV_OPTIONS)
    head = written(tmp_path / "m3.csv", [["a", "b"]])
    assert read_quoted_csv(spark, [head], CSV_OPTIONS).count() == 0
    assert rows_of(read_quoted_csv(spark, [head, one], CSV_OPTIONS)) == Counter([("1", "x\ny")])
