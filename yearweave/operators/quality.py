"""Data-quality outputs: completeness by year (E1-E3, G2, Q1), validation
rules (Q7) and the data dictionary (Q8).

All are aggregates with partial (map-side) aggregation: the shuffle carries
one row per group and partition, so a hot group never lands whole in a task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearweave.functions.strings import pad_left, percent_label


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def natural_sort_key(variable: Column, prefix: str = "record_axis_code_") -> Column:
    """``record_axis_code_2`` sorts before ``_10``: the number is zero-padded to 2."""
    num = F.regexp_extract(variable, r"(\d+)$", 1)
    return F.when(variable.rlike("^" + re.escape(prefix) + r"\d+$"), F.concat(F.lit(prefix), pad_left(num, 2))).otherwise(variable)


def completeness_counts(df: DataFrame, by: str = "file_year") -> DataFrame:
    """Rows and non-NULL values of every column per ``by`` group (E1): ``<by>, variable, n_rows, n_complete``.

    One hash aggregate computes all columns' counts; the wide row per group is
    then unpivoted (a handful of rows per group, no second pass over the data).
    """
    cols = [c for c in df.columns if c != by]
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count(F.col(_quoted(c))).alias(f"c_{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(by).agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"c_{i}").alias("n_complete")) for i, c in enumerate(cols)])
    return wide.select(by, F.col("__n").alias("n_rows"), F.explode(entries).alias("e")).select(by, "e.variable", "n_rows", "e.n_complete")


def shares(counts: DataFrame) -> DataFrame:
    """Counts with ``pct_complete`` and the reports' ``sort_key``."""
    return counts.withColumn("pct_complete", F.col("n_complete") / F.col("n_rows")).withColumn(
        "sort_key", natural_sort_key(F.col("variable"))
    )


def completeness(df: DataFrame, by: str = "file_year") -> DataFrame:
    """Share of non-NULL values of every column per ``by`` group (E1, E2):
    ``<by>, variable, n_rows, n_complete, pct_complete, sort_key``."""
    return shares(completeness_counts(df, by))


def complete_variables(comp: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Variables whose completeness is >= threshold in every group."""
    return (
        comp.groupBy("variable")
        .agg(F.bool_and((F.col("pct_complete") >= threshold) & F.col("pct_complete").isNotNull()).alias("ok"))
        .filter("ok")
        .select("variable")
    )


def completeness_report(df: DataFrame, by: str = "file_year", threshold: float = 1.0, keep_axis: bool = False,
                        axis_pattern: str = "record_axis_code") -> DataFrame:
    """Q1: completeness minus variables complete everywhere (and, as the
    reference code does, minus the axis-code columns unless ``keep_axis``)."""
    return report_of(completeness(df, by), threshold, keep_axis, axis_pattern)


def report_of(comp: DataFrame, threshold: float = 1.0, keep_axis: bool = False, axis_pattern: str = "record_axis_code") -> DataFrame:
    """:func:`completeness_report` from shares that are already there."""
    full = complete_variables(comp, threshold)
    out = comp.join(F.broadcast(full), "variable", "left_anti")  # at most one row per column
    if not keep_axis:
        out = out.filter(~F.col("variable").contains(axis_pattern))
    return out.withColumn("pct_label", percent_label("n_complete", "n_rows"))


def validate_rules(df: DataFrame, rules: Mapping[str, Column], unique_within: Sequence[tuple[str, Sequence[str]]] = ()) -> DataFrame:
    """Q7: ``rule, n_checked, n_failed`` for each row rule, plus uniqueness rules.

    A row rule is a boolean Column: TRUE passes, FALSE fails, NULL is not
    checked. All row rules are one aggregate; each uniqueness rule is one
    ``groupBy(keys).count()`` (partial aggregation, skew-safe).
    """
    spark = df.sparkSession
    parts = []
    if rules:
        aggs = []
        for i, (name, cond) in enumerate(rules.items()):
            aggs += [F.count(cond).alias(f"k{i}"), F.count_if(~cond).alias(f"f{i}")]
        row = df.agg(*aggs)
        entries = F.array(*[
            F.struct(F.lit(name).alias("rule"), F.col(f"k{i}").alias("n_checked"), F.col(f"f{i}").alias("n_failed"))
            for i, name in enumerate(rules)
        ])
        parts.append(row.select(F.explode(entries).alias("e")).select("e.*"))
    for name, keys in unique_within:
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(
            F.lit(name).alias("rule"),
            F.sum("n").cast("long").alias("n_checked"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("n_failed"),
        ))
    if not parts:
        return spark.createDataFrame([], "rule string, n_checked long, n_failed long, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("n_failed") == 0)


def column_rules(df: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """Q7 on the columns themselves: ``column, expected_type, actual_type, passed``, one row per required column.

    Reads the schema only; an absent column has no ``actual_type``."""
    types = dict(df.dtypes)
    rows = [(c, t, types.get(c), types.get(c) == t) for c, t in required.items()]
    return df.sparkSession.createDataFrame(rows, "column string, expected_type string, actual_type string, passed boolean")


def data_dictionary(
    df: DataFrame,
    descriptions: DataFrame | None = None,
    suppress: Sequence[str] = (),
    max_unique_values: int = 30,
    truncation_threshold: int = 15,
    distinct: str = "exact",
) -> DataFrame:
    """Q8 (own spec): per column ``varname, data_type, n_rows, n_null, n_distinct, value_counts, min_value,
    max_value``, with ``descriptions`` (varname, desc, source) also ``desc`` and ``source``.

    ``n_distinct`` is exact. A column of at most ``max_unique_values`` distinct values has ``value_counts``: ``value
    (count)`` sorted by value, value text cut to ``truncation_threshold`` characters; a larger one has
    ``min_value`` and ``max_value``, whole. Suppressed columns show no values, nested columns only counts.

    Lazy: all columns are unpivoted and counted per value (pre-aggregated, one row per column and
    value), then per column; extremes come from one typed aggregate. Of several descriptions
    of a column the texts are joined, in order.

    ``distinct="sketch"`` reads the table once, with one aggregate row per task whatever the columns hold: the values
    of a column come from a frequent-items sketch, which is exact while it holds all of them, and larger columns have
    an estimated ``n_distinct``. ``distinct_estimated`` says which; all else is the same as with ``"exact"``.
    """
    if distinct not in ("exact", "sketch"):
        raise ValueError("distinct must be 'exact' or 'sketch'")
    cols, types = df.columns, dict(df.dtypes)
    comparable = [c for c in cols if not types[c].startswith(("array", "map", "struct", "binary", "variant"))]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(_quoted(c))).alias(f"nn{i}"))
        if c in comparable:
            aggs += [f(F.col(_quoted(c))).cast("string").alias(f"{n}{i}") for n, f in (("mn", F.min), ("mx", F.max))]
            if distinct == "sketch":
                text = f"CAST({_quoted(c)} AS STRING)"
                aggs += [F.approx_count_distinct(F.expr(text), 0.02).alias(f"ds{i}"),
                         F.expr(f"approx_top_k({text}, {max_unique_values + 2}, {_tracked(max_unique_values)})").alias(f"tk{i}")]
    none = F.lit(None).cast("string")
    entries = [F.struct(
        F.lit(c).alias("varname"), F.lit(types[c]).alias("data_type"), F.lit(i).alias("place"), F.col("__n").alias("n_rows"),
        (F.col("__n") - F.col(f"nn{i}")).alias("n_null"),
        (F.col(f"mn{i}") if c in comparable and c not in suppress else none).alias("mn"),
        (F.col(f"mx{i}") if c in comparable and c not in suppress else none).alias("mx"),
        *([_sketched(i, c in comparable, max_unique_values)] if distinct == "sketch" else [])) for i, c in enumerate(cols)]
    columns = df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    if distinct == "sketch":
        out = columns.select("*", "sketch.*").withColumn("listed", _listing("all", truncation_threshold))
        return _dictionary_rows(out, comparable, suppress, max_unique_values, descriptions, ["distinct_estimated"])
    values = F.array(*[F.struct(F.lit(c).alias("varname"), F.col(_quoted(c)).cast("string").alias("value")) for c in comparable])
    counted = df.select(F.explode(values).alias("e")).select("e.*").filter("value IS NOT NULL").groupBy("varname", "value").agg(
        F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("varname").agg(F.count(F.lit(1)).alias("n_distinct"))
    few = sizes.filter(F.col("n_distinct") <= max_unique_values).select("varname")
    listed = counted.join(few, "varname").groupBy("varname").agg(
        F.sort_array(F.collect_list(F.struct("value", "n"))).alias("all")).select(  # at most max_unique_values entries
        "varname", _listing("all", truncation_threshold).alias("listed"))
    out = columns.join(sizes, "varname", "left").join(listed, "varname", "left")
    return _dictionary_rows(out, comparable, suppress, max_unique_values, descriptions)


def _tracked(most: int) -> int:
    """Values that a frequent-items sketch keeps; it is exact up to three quarters of this, well beyond ``most``."""
    return max(1024, 1 << (4 * most).bit_length())


def _sketched(i: int, is_comparable: bool, most: int) -> Column:
    """Of column ``i``: its values if there are at most ``most``, how many there are, and whether that is an estimate."""
    if not is_comparable:
        return F.struct(F.lit(None).cast("array<struct<value:string,n:bigint>>").alias("all"), F.lit(None).cast("bigint").alias("n_distinct"),
                        F.lit(False).alias("distinct_estimated")).alias("sketch")
    items = F.filter(F.col(f"tk{i}"), lambda x: x["item"].isNotNull())
    # All values were kept if few came back, their rows add up, and the other sketch does not say otherwise.
    whole = (F.size(items) <= most) & (F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x["count"]) == F.col(f"nn{i}")) & (
        F.col(f"ds{i}") <= _tracked(most) // 2)
    values = F.sort_array(F.transform(items, lambda x: F.struct(x["item"].alias("value"), x["count"].cast("bigint").alias("n"))))
    estimate = F.greatest(F.col(f"ds{i}").cast("bigint"), F.lit(most + 1).cast("bigint"))
    return F.struct(F.when(whole, values).alias("all"), F.when(whole, F.size(items).cast("bigint")).otherwise(estimate).alias("n_distinct"),
                    (~whole).alias("distinct_estimated")).alias("sketch")


def _listing(values: str, width: int) -> Column:
    return F.array_join(F.transform(values, lambda v: F.concat(
        F.left(v["value"], F.lit(width)), F.lit(" ("), v["n"].cast("string"), F.lit(")"))), "; ")


def _dictionary_rows(out: DataFrame, comparable: Sequence[str], suppress: Sequence[str], most: int, descriptions: DataFrame | None,
                     more: Sequence[str] = ()) -> DataFrame:
    is_comparable = F.col("varname").isin(list(comparable))
    hidden = F.col("varname").isin(list(suppress)) if suppress else F.lit(False)
    n_distinct = F.when(is_comparable, F.coalesce("n_distinct", F.lit(0).cast("bigint")))
    large = n_distinct > most
    out = out.select(
        "varname", "data_type", "n_rows", "n_null", n_distinct.alias("n_distinct"),
        F.when(is_comparable & ~hidden & ~large, F.coalesce("listed", F.lit(""))).alias("value_counts"),
        F.when(large, F.col("mn")).alias("min_value"), F.when(large, F.col("mx")).alias("max_value"), *more)
    if descriptions is not None:
        texts = [c for c in ("desc", "source") if c in descriptions.columns]
        joined = descriptions.groupBy("varname").agg(*[
            F.array_join(F.array_sort(F.collect_set(c)), "; ").alias(c) for c in texts])  # a control table
        out = out.join(joined, "varname", "left")
    return out
