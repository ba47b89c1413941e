"""Ordered factors sort by their levels, also after Parquet."""

import pytest
from pyspark.sql import functions as F

from yearweave.operators._common import DataGuardError, SchemaMismatch
from yearweave.operators.schema import enforce_schema, factor_of, factor_rank, order_by_factors

DDL = "variable string, data_type string, factor_is_ordered boolean, factor_value string, factor_label string, factor_order int"


def typed(spark):
    rows = [("id", "integer", None, None, None, None), *[("size", "factor", True, v, label, k) for v, label, k in (
        ("l", "Large", 3), ("s", "Small", 1), ("m", "Medium", 2), ("xs", "Small", 0))], ("kind", "factor", False, "a", "A", None)]
    data = [(str(i), v, "a") for i, v in enumerate(["m", "l", None, "s", "xs", "l"])]
    return enforce_schema(spark.createDataFrame(data, "id string, size string, kind string"), spark.createDataFrame(rows, DDL)).df


def test_rank_and_sort(spark, tmp_path):
    typed(spark).write.parquet(str(tmp_path / "t"))
    for df in (typed(spark), spark.read.parquet(str(tmp_path / "t")), typed(spark).filter("id >= 0").select("kind", "size", "id")):
        assert factor_of(df, "size")["levels"] == ["xs", "s", "m", "l"]
        ranks = {r.id: r.rank for r in df.select("id", factor_rank(df, "size").alias("rank")).collect()}
        assert ranks == {0: 3, 1: 4, 2: None, 3: 1, 4: 1, 5: 4}
        assert [r.id for r in order_by_factors(df, "size", "id").collect()] == [3, 4, 0, 1, 5, 2]
        assert [r.id for r in order_by_factors(df, "size", "id", descending=True).collect()] == [5, 1, 0, 4, 3, 2]


def test_what_has_no_rank_raises(spark):
    df = typed(spark)
    with pytest.raises(DataGuardError, match="not ordered"):
        factor_rank(df, "kind")
    with pytest.raises(SchemaMismatch, match="no factor"):
        factor_rank(df, "id")
    assert df.select(factor_rank(df.withMetadata("size", df.schema["size"].metadata), "size")).count() == 6
    other = df.withColumn("size", F.lit("other")).withMetadata("size", df.schema["size"].metadata)
    assert {r[0] for r in other.select(factor_rank(other, "size")).collect()} == {None}
