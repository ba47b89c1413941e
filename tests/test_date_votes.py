"""Date orders elected per vintage and column."""

import datetime as dt

from pyspark.sql import functions as F

from yearweave.functions.dates import parse_date_multi, parse_date_order
from yearweave.operators.dates import elected_orders, order_votes, parse_dates

D = dt.date
ROWS = [(2014, "03/04/2014"), (2014, "25/04/2014"), (2014, "junk"), (2014, "04/25/2014"), (2014, "26.4.2014"),
        (2015, "03/04/2015"), (2015, "04/25/2015"), (2016, "03/04/2016"), (2017, None), (None, "13/01/2010")]


def frame(spark):
    return spark.createDataFrame([(i, y, d) for i, (y, d) in enumerate(ROWS)], "id int, file_year int, d string")


def test_a_column_is_read_in_one_way(spark):
    parsed = parse_dates(frame(spark), ["d"], ("mdY", "dmY"), "2026-01-01", vote_by="file_year").orderBy("id")
    assert [r.d_parsed for r in parsed.collect()] == [
        D(2014, 4, 3), D(2014, 4, 25), None, D(2014, 4, 25), D(2014, 4, 26),  # day first, one value falls back
        D(2015, 3, 4), D(2015, 4, 25), D(2016, 3, 4), None, D(2010, 1, 13)]   # 2016: a tie, by precedence
    plain = parse_dates(frame(spark), ["d"], ("mdY", "dmY"), "2026-01-01").orderBy("id")
    assert [r.d_parsed for r in plain.collect()][:2] == [D(2014, 3, 4), D(2014, 4, 25)]  # value by value: two ways


def test_votes_and_election(spark):
    votes = order_votes(frame(spark), ["d"], orders=("mdY", "dmY"))
    got = {(r.file_year, r.date_order): r.n_values for r in votes.collect()}
    assert got[(2014, "mdY")] == 2 and got[(2014, "dmY")] == 3 and got[(2017, "mdY")] == 0
    elected = {r.file_year: r.date_order for r in elected_orders(votes).collect()}
    assert elected == {2014: "dmY", 2015: "mdY", 2016: "mdY", 2017: "mdY", None: "dmY"}


def test_default_orders_agree_with_the_vote(spark):
    texts = ["20140305", "2014-3-5", "2014.03.05", "03/05/2014", "3-5-2014", "03052014", "5Mar2014", "05-MAR-2014", "5 march 2014",
             "2014-02-30", "00000101", "0000-01-01", "5 Sept 2014", "31/12/2014", "", None, "2014 1 1", "20141301"]
    df = spark.createDataFrame([(i, 2010 + i % 3, t) for i, t in enumerate(texts)], "id int, file_year int, d string")
    one = parse_dates(df, ["d"], as_of_date="2026-01-01", vote_by="file_year").orderBy("id").collect()
    assert [r.d_parsed for r in one] == [r.d_parsed for r in parse_dates(df, ["d"], as_of_date="2026-01-01").orderBy("id").collect()]
    assert [r.d_parsed for r in one] == [D(2014, 3, 5)] * 9 + [None] * 7 + [D(2014, 1, 1), None]


def test_one_order_alone(spark):
    df = spark.createDataFrame([("31dec1999",), ("1/2/2003",), ("9999/12/31",), ("0000-12-31",)], "d string")
    got = df.select(parse_date_order(F.col("d"), "dbY"), parse_date_order(F.col("d"), "mdY"), parse_date_multi("d")).collect()
    assert [tuple(r) for r in got] == [
        (D(1999, 12, 31), None, D(1999, 12, 31)), (None, D(2003, 1, 2), D(2003, 1, 2)), (None, None, D(9999, 12, 31)), (None, None, None)]
