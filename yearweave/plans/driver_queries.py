"""Operators exercised on the driver's tables (``<sf_dir>/<table>.parquet``).

Each query builds its input from a whole driver table (codes and messy
values are *derived* from real columns, so the work grows with the data),
runs one library operator on it and returns a DataFrame. The DuckDB oracle
for each query is next to it in ``ORACLE_SQL``; both alias every output
column the same way and render dates as ISO strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearweave.functions.dates import as_date, parse_date_multi
from yearweave.functions.logic import null_string
from yearweave.functions.strings import (
    combine_columns,
    last_n,
    normalize_text,
    nullify_placeholders,
    pad_left,
    remove_first,
    remove_first_punct,
    title_case,
    zip5_or_null,
)
from yearweave.operators import causes, crosswalk, dates, demographics, geography, guards, lookup, projection, quality, recode, schema, times, vintage
from yearweave.sources.manifest import classify_files, missing_csv, select_vintages

AS_OF = "2026-01-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


# --------------------------------------------------------------------------
# Vintage layouts: orders printed in an old layout (years <= 1997) and a new
# one (>= 1998); the old layout has no priority column.
# --------------------------------------------------------------------------

OLD_LAYOUT = [("ORDKEY", "order_id"), ("CUSTKEY", "customer_id"), ("STATUS", "status"), ("ODATE", "order_date")]
NEW_LAYOUT = [("Order Key", "order_id"), ("Customer Key", "customer_id"), ("Order Status", "status"),
              ("Order Date", "order_date"), ("Order Priority", "priority")]
CANONICAL = ["order_id", "customer_id", "status", "order_date", "priority"]
LAYOUT_CUTOVER = 1997


def order_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layouts renamed to canonical names and unioned."""
    o = table(spark, sf_dir, "orders").withColumn("__y", F.year("o_orderdate"))
    old = o.filter(F.col("__y") <= LAYOUT_CUTOVER).select(
        F.col("__y").alias("YEAR"),
        s("o_orderkey").alias("ORDKEY"), s("o_custkey").alias("CUSTKEY"), F.col("o_orderstatus").alias("STATUS"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("ODATE"),
    )
    new = o.filter(F.col("__y") > LAYOUT_CUTOVER).select(
        F.col("__y").alias("YEAR"),
        s("o_orderkey").alias("Order Key"), s("o_custkey").alias("Customer Key"), F.col("o_orderstatus").alias("Order Status"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Order Date"), F.col("o_orderpriority").alias("Order Priority"),
    )
    frames = []
    for raw, layout, system in ((old, OLD_LAYOUT, "OLDSYS"), (new, NEW_LAYOUT, "NEWSYS")):
        canon = vintage.rename_to_canonical(raw, layout + [("YEAR", "file_year")], ["file_year", *CANONICAL])
        canon = canon.withColumns({
            "source_system": F.lit(system),
            "vintage_label": F.concat_ws("_", F.lit(system), s("file_year")),
            "date_harmonized": F.lit(AS_OF),
        })
        frames.append(projection.move_to_front(canon, vintage.FRONT_COLUMNS))
    return vintage.union_vintages(frames)


@register("attach_vintage", f"""
SELECT CASE WHEN o_orderstatus = 'O' THEN 'OLDSYS_1995' ELSE 'NEWSYS_1996' END AS vintage_label, '{AS_OF}' AS date_harmonized,
  CASE WHEN o_orderstatus = 'O' THEN 'OLDSYS' ELSE 'NEWSYS' END AS source_system,
  CAST(CASE WHEN o_orderstatus = 'O' THEN 1995 ELSE 1996 END AS INTEGER) AS file_year, o_orderkey, o_totalprice
FROM orders
""")
def q_attach_vintage(spark, sf_dir):
    """B6, B7 and H1 through the operators: two frames as two vintages."""
    o = table(spark, sf_dir, "orders")
    old, new = (o.filter(c).select("o_orderkey", "o_totalprice") for c in (F.col("o_orderstatus") == "O", F.col("o_orderstatus") != "O"))
    return vintage.union_vintages([
        vintage.attach_vintage(old, "OLDSYS_1995", 1995, "OLDSYS", AS_OF), vintage.attach_vintage(new, "NEWSYS_1996", 1996, "NEWSYS", AS_OF)])


_VINTAGES_SQL = f"""
SELECT 'OLDSYS_' || CAST(year(o_orderdate) AS VARCHAR) AS vintage_label, '{AS_OF}' AS date_harmonized,
       'OLDSYS' AS source_system, CAST(year(o_orderdate) AS INTEGER) AS file_year,
       CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderstatus AS status, strftime(o_orderdate, '%Y%m%d') AS order_date, CAST(NULL AS VARCHAR) AS priority
FROM orders WHERE year(o_orderdate) <= {LAYOUT_CUTOVER}
UNION ALL
SELECT 'NEWSYS_' || CAST(year(o_orderdate) AS VARCHAR), '{AS_OF}', 'NEWSYS', CAST(year(o_orderdate) AS INTEGER),
       CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
       strftime(o_orderdate, '%m/%d/%Y'), o_orderpriority
FROM orders WHERE year(o_orderdate) > {LAYOUT_CUTOVER}
"""


@register("rename_union_vintages", _VINTAGES_SQL)
def q_rename_union_vintages(spark, sf_dir):
    return order_vintages(spark, sf_dir)


# --------------------------------------------------------------------------
# Recode crosswalk (control table) for the order vintages.
# --------------------------------------------------------------------------

def _recode_rows():
    rows = []
    for y in range(1992, 2002):
        rows.append((y, "status", "O", "open", "OPEN", "Open", False))
        rows.append((y, "status", "F", "final", "FINAL" if y < 1998 else "FULFILLED", "Final", y == 1998))
        rows.append((y, "status", "P", "partial", None, None, False))          # NULL to_code keeps the value
        if y >= 1997:
            rows.append((y, "status", None, "missing", "UNKNOWN", "Unknown", True))  # NULL from_code matches NULL
        for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"):
            rows.append((y, "priority", p, p.lower(), p[0], p[2:].title(), p.startswith("4")))
        if y == 1999:
            rows.append((y, "priority", "5-LOW", "5-low", "5", "Low", True))
        rows.append((y, "not_in_data", "A", "a", "B", "b", False))              # variable absent: skipped
    return rows


RECODE_SCHEMA = "file_year int, variable string, from_code string, from_label string, to_code string, to_label string, review_flag boolean"


def recode_crosswalk_df(spark):
    return spark.createDataFrame(_recode_rows(), RECODE_SCHEMA)


def _recode_values_sql():
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return str(v)
        return "'" + v.replace("'", "''") + "'"
    return ",\n".join("(" + ", ".join(lit(x) for x in r) + ")" for r in _recode_rows())


_CW_CTE = f"""cw(file_year, variable, from_code, from_label, to_code, to_label, review_flag) AS (VALUES
{_recode_values_sql()})"""


def _status_with_nulls(o):
    """o_orderstatus with NULLs injected (every 11th order key)."""
    return F.when(F.col("o_orderkey") % 11 == 0, null_string()).otherwise(F.col("o_orderstatus"))


@register("recode_codes", f"""
WITH {_CW_CTE},
src AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS file_year,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status, o_orderpriority AS priority
  FROM orders)
SELECT src.o_orderkey AS o_orderkey, src.file_year AS file_year,
       coalesce(s.to_code, src.status) AS status, coalesce(p.to_code, src.priority) AS priority
FROM src
LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'status') s
  ON s.file_year = src.file_year AND s.from_code IS NOT DISTINCT FROM src.status
LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'priority') p
  ON p.file_year = src.file_year AND p.from_code IS NOT DISTINCT FROM src.priority
""")
def q_recode_codes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    df = o.select("o_orderkey", F.year("o_orderdate").cast("int").alias("file_year"),
                  _status_with_nulls(o).alias("status"), F.col("o_orderpriority").alias("priority"))
    return recode.recode(df, recode_crosswalk_df(spark))


@register("recode_codes_join_path", f"""
WITH {_CW_CTE},
src AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS file_year,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status, o_orderpriority AS priority
  FROM orders)
SELECT src.o_orderkey AS o_orderkey, src.file_year AS file_year,
       coalesce(s.to_code, src.status) AS status, coalesce(p.to_code, src.priority) AS priority
FROM src
LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'status') s
  ON s.file_year = src.file_year AND s.from_code IS NOT DISTINCT FROM src.status
LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'priority') p
  ON p.file_year = src.file_year AND p.from_code IS NOT DISTINCT FROM src.priority
""")
def q_recode_codes_join_path(spark, sf_dir):
    """The same recode as joins."""
    o = table(spark, sf_dir, "orders")
    df = o.select("o_orderkey", F.year("o_orderdate").cast("int").alias("file_year"),
                  _status_with_nulls(o).alias("status"), F.col("o_orderpriority").alias("priority"))
    return recode.recode(df, recode_crosswalk_df(spark), strategy="join")


# Five coded variables of every line item, one of 200 codes, and a crosswalk of the codes that occur per year.
_LINE_CODES = {"returnflag": "l_returnflag", "linestatus": "l_linestatus", "line": "l_linenumber",
               "part_group": "l_partkey % 12", "supplier_code": "l_suppkey % 200"}


def line_codes(spark, sf_dir) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    missing = F.col("l_orderkey") % 13 == 0
    return line.select("l_orderkey", "l_linenumber", F.year("l_shipdate").cast("int").alias("file_year"),
                       *[F.when(missing, null_string()).otherwise(s(F.expr(c))).alias(v) for v, c in _LINE_CODES.items()])


def line_crosswalk(codes: DataFrame) -> DataFrame:
    """New codes for those of even length or NULL in even years, and for the others in odd years."""
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("from_code")) for v in _LINE_CODES])
    found = codes.select("file_year", F.explode(entries).alias("e")).select("file_year", "e.*").distinct()
    changed = F.coalesce(F.length("from_code"), F.lit(0)) % 2 == F.col("file_year") % 2
    return found.select("*", F.when(changed, F.concat_ws("/", F.col("file_year"), F.coalesce("from_code", F.lit("none")))).alias("to_code"))


def _line_code_sql(v: str, c: str) -> str:
    x = f"CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST({c} AS VARCHAR) END"
    y = "year(l_shipdate)"
    return (f"CASE WHEN coalesce(length({x}), 0) % 2 = {y} % 2 THEN CAST({y} AS VARCHAR) || '/' || coalesce({x}, 'none') "
            f"ELSE {x} END AS {v}")


@register("recode_many_variables", f"""
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS file_year,
  {', '.join(_line_code_sql(v, c) for v, c in _LINE_CODES.items())}
FROM lineitem
""")
def q_recode_many_variables(spark, sf_dir):
    """D2 with one join for all variables."""
    codes = line_codes(spark, sf_dir)
    return recode.recode(codes, line_crosswalk(codes), strategy="year")


# --------------------------------------------------------------------------
# Crosswalks derived from data: a recode crosswalk from documents (one row per
# distinct year/lang/source) and a wide rename crosswalk from part.
# --------------------------------------------------------------------------

def documents_recode_crosswalk(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        (F.lit(2015) + F.col("doc_id") % 7).cast("int").alias("file_year"),
        F.concat(F.lit("source_"), F.col("lang")).alias("variable"),
        F.col("source").alias("from_code"),
        F.col("lang").alias("from_label"),
        F.when(F.col("source").endswith("3"), null_string()).otherwise(F.upper("source")).alias("to_code"),
        F.concat(F.lit("Source "), F.col("source")).alias("to_label"),
        (F.col("n_chars") > 5000).alias("review_flag"),
    ).distinct()


_DOC_CW_SQL = """doc_cw AS (
  SELECT DISTINCT CAST(2015 + doc_id % 7 AS INTEGER) AS file_year, 'source_' || lang AS variable, source AS from_code,
         lang AS from_label, CASE WHEN source LIKE '%3' THEN NULL ELSE upper(source) END AS to_code,
         'Source ' || source AS to_label, n_chars > 5000 AS review_flag
  FROM documents)"""


@register("flagged_recode_summary", f"""
WITH {_DOC_CW_SQL},
f AS (SELECT * FROM doc_cw WHERE review_flag),
y AS (SELECT variable, from_code, to_code, string_agg(CAST(file_year AS VARCHAR), ',' ORDER BY CAST(file_year AS VARCHAR)) AS applicable_years
      FROM (SELECT DISTINCT variable, from_code, to_code, file_year FROM f) GROUP BY variable, from_code, to_code)
SELECT DISTINCT 'Death Statistical' AS file_type, f.variable AS variable, f.from_code AS from_code, f.from_label AS from_label,
       f.to_code AS to_code, f.to_label AS to_label, y.applicable_years AS applicable_years
FROM f JOIN y ON f.variable = y.variable AND f.from_code IS NOT DISTINCT FROM y.from_code AND f.to_code IS NOT DISTINCT FROM y.to_code
""")
def q_flagged_recode_summary(spark, sf_dir):
    return crosswalk.flagged_recode_summary(documents_recode_crosswalk(spark, sf_dir))


@register("recode_ambiguous_codes", f"""
WITH {_DOC_CW_SQL},
p AS (SELECT DISTINCT file_year, variable, from_code, CASE WHEN review_flag THEN to_code || '_LONG' ELSE to_code END AS to_code FROM doc_cw)
SELECT file_year, variable, from_code, CAST(count(*) AS BIGINT) AS n_to_codes
FROM p GROUP BY file_year, variable, from_code HAVING count(*) > 1
""")
def q_recode_ambiguous_codes(spark, sf_dir):
    """D5 on a recode crosswalk in which long documents map a source to a target of their own."""
    cw = documents_recode_crosswalk(spark, sf_dir)
    return crosswalk.ambiguous_recodes(cw.withColumn(
        "to_code", F.when(F.col("review_flag"), F.concat("to_code", F.lit("_LONG"))).otherwise(F.col("to_code"))))


@register("recode_crosswalk_typed", """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS file_year, 'priority' AS variable, o_orderpriority AS from_code,
  CAST(NULL AS VARCHAR) AS from_label, CAST(o_custkey % 5 AS VARCHAR) AS to_code, CAST(NULL AS VARCHAR) AS to_label,
  o_orderstatus = 'P' AS review_flag
FROM orders
""")
def q_recode_crosswalk_typed(spark, sf_dir):
    """B2: a crosswalk with other types, without label columns, and with one column too many."""
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        F.date_format("o_orderdate", "yyyy").alias("file_year"), F.lit("priority").alias("variable"),
        F.col("o_orderpriority").alias("from_code"), (F.col("o_custkey") % 5).alias("to_code"),
        (F.col("o_orderstatus") == "P").cast("string").alias("review_flag"), F.lit(1).alias("other")).distinct()
    return crosswalk.recode_crosswalk(raw)


PART_YEARS = [str(y) for y in range(1995, 2002)]


def part_rename_crosswalk_wide(spark, sf_dir) -> DataFrame:
    """One canonical variable per part; a year's source name is NULL when the
    part size is divisible by (year - 1990) (the variable is absent that year)."""
    p = table(spark, sf_dir, "part")
    cols = [
        F.when(F.col("p_size") % (int(y) - 1990) == 0, null_string())
        .otherwise(F.concat(F.upper("p_brand"), F.lit("_"), F.lit(y))).alias(y)
        for y in PART_YEARS
    ]
    return p.select(F.concat(F.col("p_name"), F.lit("#"), s("p_partkey")).alias("to_name"), F.col("p_type").alias("notes"), *cols)


_PART_LONG_SQL = "part_long AS (\n" + "\nUNION ALL\n".join(
    f"  SELECT CAST({y} AS INTEGER) AS file_year, CASE WHEN p_size % {int(y) - 1990} = 0 THEN NULL ELSE upper(p_brand) || '_{y}' END AS from_name, "
    f"p_name || '#' || CAST(p_partkey AS VARCHAR) AS to_name, p_type AS notes FROM part"
    for y in PART_YEARS
) + ")"


@register("rename_crosswalk_unpivot", f"WITH {_PART_LONG_SQL} SELECT file_year, from_name, to_name, notes FROM part_long")
def q_rename_crosswalk_unpivot(spark, sf_dir):
    return crosswalk.rename_crosswalk_long(part_rename_crosswalk_wide(spark, sf_dir))


@register("missing_variable_summary", f"""
WITH {_PART_LONG_SQL},
tagged AS (
  SELECT 'Death Statistical' AS file_type, * FROM part_long
  UNION ALL
  SELECT 'Cause of Death Literals', file_year, CASE WHEN file_year = 1998 THEN NULL ELSE from_name END, to_name, notes FROM part_long)
SELECT file_type, to_name, string_agg(CAST(file_year AS VARCHAR), ',' ORDER BY CAST(file_year AS VARCHAR)) AS missing_years
FROM (SELECT DISTINCT file_type, to_name, file_year FROM tagged WHERE from_name IS NULL)
GROUP BY file_type, to_name
""")
def q_missing_variable_summary(spark, sf_dir):
    stat = crosswalk.rename_crosswalk_long(part_rename_crosswalk_wide(spark, sf_dir))
    lit = stat.withColumn("from_name", F.when(F.col("file_year") == 1998, null_string()).otherwise(F.col("from_name")))
    return crosswalk.missing_variable_summary({"Death Statistical": stat, "Cause of Death Literals": lit})


# --------------------------------------------------------------------------
# Joins and lookups.
# --------------------------------------------------------------------------

@register("null_key_left_join", """
WITH stat AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS num_key,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'c' || o_custkey END AS text_key FROM orders),
lit AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS num_key, 'c' || c_custkey AS text_key, c_name FROM customer)
SELECT o_orderkey, stat.num_key, stat.text_key, c_name FROM stat LEFT JOIN lit ON stat.num_key = lit.num_key AND stat.text_key = lit.text_key
""")
def q_null_key_left_join(spark, sf_dir):
    """D1 with NULL numeric and text keys on the left and NULL numeric keys on the right: NULL matches nothing."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    stat = table(spark, sf_dir, "orders").select(
        k, F.when(k % 3 != 0, F.col("o_custkey")).alias("num_key"),
        F.when(k % 4 != 0, F.concat(F.lit("c"), s("o_custkey"))).alias("text_key"))
    lit = table(spark, sf_dir, "customer").select(
        F.when(c % 5 != 0, c).alias("num_key"), F.concat(F.lit("c"), s("c_custkey")).alias("text_key"), "c_name")
    return vintage.join_literals(stat, lit, ["num_key", "text_key"])


@register("literal_key_audit", """
WITH k AS (SELECT 'statistical' AS side, CAST(year(o_orderdate) AS INTEGER) AS file_year, o_orderkey % 7 = 0 AS missing FROM orders
  UNION ALL SELECT 'literals', CAST(year(o_orderdate) AS INTEGER), o_orderkey % 9 = 0 FROM orders)
SELECT side, file_year, CAST(count(*) AS BIGINT) AS n_null_key_rows FROM k WHERE missing GROUP BY side, file_year
""")
def q_literal_key_audit(spark, sf_dir):
    """The audit of both sides' NULL keys that ``run`` writes."""
    o = table(spark, sf_dir, "orders")
    k, year = F.col("o_orderkey"), F.year("o_orderdate").cast("int").alias("file_year")
    side = lambda n: o.select(year, F.when(k % n != 0, s("o_orderkey")).alias("state_file_number"))
    return vintage.literal_key_audit(side(7), side(9))


@register("stat_literal_left_join", """
SELECT d.doc_id AS doc_id, d.lang AS lang, d.source AS source, d.n_chars AS n_chars, l.quality AS quality, l.toxic AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_stat_literal_left_join(spark, sf_dir):
    stat = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lit = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return vintage.join_literals(stat, lit, ["doc_id"])


def _orders_with_nation(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey", "left").select(
        "o_orderkey", "o_custkey", "c_nationkey", F.year("o_orderdate").cast("int").alias("file_year"),
    )


_ORDERS_NATION_SQL = """src AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS file_year
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

# SQL twin of geography.county_map_from_rule: WA code n -> FIPS 2n-1 padded to 3; 00 -> 00.
_FIPS_OF_NATION_SQL = "CASE WHEN c_nationkey = 0 THEN '00' ELSE lpad(CAST(2 * c_nationkey - 1 AS VARCHAR), 3, '0') END"
LOOKUP_THRESHOLD = 1998


@register("lookup_before_year", f"""
WITH {_ORDERS_NATION_SQL}
SELECT o_orderkey, file_year, CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS wa_code,
       CASE WHEN file_year < {LOOKUP_THRESHOLD} THEN {_FIPS_OF_NATION_SQL} ELSE 'T' || CAST(c_nationkey AS VARCHAR) END AS fips_code
FROM src
""")
def q_lookup_before_year(spark, sf_dir):
    df = _orders_with_nation(spark, sf_dir).select(
        "o_orderkey", "file_year", pad_left(s("c_nationkey"), 2).alias("wa_code"),
        F.concat(F.lit("T"), s("c_nationkey")).alias("fips_code"),
    )
    cmap = geography.county_map_from_rule(spark)
    return lookup.lookup_before_year(df, "wa_code", "fips_code", cmap, "county_wa_code", "county_fips_code", LOOKUP_THRESHOLD)


@register("lookup_literal_upper", f"""
WITH {_ORDERS_NATION_SQL}
SELECT o_orderkey, file_year, {_FIPS_OF_NATION_SQL} AS fips_code,
       CASE WHEN file_year < {LOOKUP_THRESHOLD}
            THEN (CASE WHEN c_nationkey = 0 THEN 'NON-STATE OR UNKNOWN' ELSE 'COUNTY ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END)
            ELSE 'Nation ' || CAST(c_nationkey AS VARCHAR) END AS county_name
FROM src
""")
def q_lookup_literal_upper(spark, sf_dir):
    fips = F.when(F.col("c_nationkey") == 0, F.lit("00")).otherwise(pad_left(s(F.col("c_nationkey") * 2 - 1), 3))
    df = _orders_with_nation(spark, sf_dir).select(
        "o_orderkey", "file_year", fips.alias("fips_code"), F.concat(F.lit("Nation "), s("c_nationkey")).alias("county_name"),
    )
    cmap = geography.county_map_from_rule(spark)
    return lookup.lookup_before_year(df, "fips_code", "county_name", cmap, "county_fips_code", "county_fips_label",
                                     LOOKUP_THRESHOLD, value_transform=F.upper)


PARTIAL_MAP_MAX = 14


@register("unmatched_codes", f"""
WITH {_ORDERS_NATION_SQL},
k AS (SELECT CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS code, file_year FROM src)
SELECT code, CAST(count(*) AS BIGINT) AS n_rows FROM k
WHERE file_year < {LOOKUP_THRESHOLD} AND code IS NOT NULL AND CAST(code AS INTEGER) > {PARTIAL_MAP_MAX}
GROUP BY code
""")
def q_unmatched_codes(spark, sf_dir):
    df = _orders_with_nation(spark, sf_dir).select("file_year", pad_left(s("c_nationkey"), 2).alias("wa_code"))
    partial = geography.county_map_from_rule(spark, PARTIAL_MAP_MAX)
    return lookup.unmatched_codes(df, "wa_code", partial, "county_wa_code", "county_fips_code", LOOKUP_THRESHOLD)


@register("unmatched_report", f"""
WITH {_ORDERS_NATION_SQL},
k AS (SELECT CAST(c_nationkey AS VARCHAR) AS code, file_year FROM src WHERE file_year < {LOOKUP_THRESHOLD} AND c_nationkey IS NOT NULL)
SELECT code, CAST(count(*) AS BIGINT) AS n_rows FROM k
WHERE code NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey % 3 <> 0 AND n_regionkey <> 2) GROUP BY code
""")
def q_unmatched_report(spark, sf_dir):
    """D6 with typed keys, codes without a lookup row, and codes whose lookup value is NULL."""
    n = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 3 != 0)
    names = n.select("n_nationkey", F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("name"))
    return lookup.unmatched_codes(_orders_with_nation(spark, sf_dir), "c_nationkey", names, "n_nationkey", "name", LOOKUP_THRESHOLD)


GUARDED_LEVELS = [("O", "Open"), ("F", "Final")]  # 'P' has no level
_GUARDED_SQL = f"""{_ORDERS_NATION_SQL},
g AS (
  SELECT s.*, o.o_orderstatus AS status, s.file_year < {LOOKUP_THRESHOLD} AND s.c_nationkey IS NOT NULL AND s.c_nationkey > {PARTIAL_MAP_MAX} AS unmatched
  FROM src s JOIN orders o ON o.o_orderkey = s.o_orderkey)"""


def guarded_orders(spark, sf_dir, n_counties: int, levels) -> DataFrame:
    """Orders with a lookup and a factor whose guards are left to the write."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    df = _orders_with_nation(spark, sf_dir).join(o, "o_orderkey").select(
        "o_orderkey", "file_year", pad_left(s("c_nationkey"), 2).alias("wa_code"), F.lit("?").alias("fips_code"), "status")
    cmap = geography.county_map_from_rule(spark, n_counties)
    df = lookup.lookup_before_year(df, "wa_code", "fips_code", cmap, "county_wa_code", "county_fips_code", LOOKUP_THRESHOLD,
                                   on_unmatched="observe")
    rows = _schema_rows([("o_orderkey", "numeric"), ("file_year", "integer"), ("wa_code", "character"), ("fips_code", "character")],
                        [("status", "factor", False, v, label, None, "status", "orders") for v, label in levels])
    return schema.enforce_schema(df, spark.createDataFrame(rows, SCHEMA_DDL), check_levels="observe").df


@register("guard_report", f"""
WITH {_GUARDED_SQL}
SELECT 'lookup: wa_code has no value for code' AS guard, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, CAST(count(*) AS BIGINT) AS n_rows
FROM g WHERE unmatched GROUP BY ALL
UNION ALL
SELECT 'enforce_schema: status holds a value without a factor level', status, CAST(count(*) AS BIGINT) FROM g WHERE status NOT IN ('O', 'F') GROUP BY ALL
""")
def q_guard_report(spark, sf_dir):
    """D6, N5 and E8 in the write's own pass: the refused write lists every code of every guard with its rows."""
    try:
        guards.write_checked(guarded_orders(spark, sf_dir, PARTIAL_MAP_MAX, GUARDED_LEVELS), scratch_folder(spark, "guard_report") + "/orders")
        found = []
    except guards.GuardViolation as e:
        found = e.rows
    return spark.createDataFrame(found, "guard string, code string, n_rows bigint")


@register("guarded_refresh", f"""
WITH {_GUARDED_SQL}
SELECT o_orderkey::DOUBLE AS o_orderkey, file_year, CASE WHEN file_year < {LOOKUP_THRESHOLD} THEN {_FIPS_OF_NATION_SQL} ELSE '?' END AS fips_code,
  CASE status WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' ELSE 'Partial' END AS status FROM g
""")
def q_guarded_refresh(spark, sf_dir):
    """A clean write takes its place; a refresh that its guards refuse leaves the table as it was."""
    from yearweave.sources.parquet import read_harmonized, write_harmonized
    path = scratch_folder(spark, "guarded_refresh") + "/orders"
    write_harmonized(guarded_orders(spark, sf_dir, 39, [*GUARDED_LEVELS, ("P", "Partial")]), path)
    try:
        write_harmonized(guarded_orders(spark, sf_dir, PARTIAL_MAP_MAX, GUARDED_LEVELS), path)
    except guards.GuardViolation:
        pass
    return read_harmonized(spark, path).select("o_orderkey", "file_year", "fips_code", "status")


@register("duplicate_lookup_keys", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_mktsegment HAVING count(*) > 1
""")
def q_duplicate_lookup_keys(spark, sf_dir):
    from yearweave.operators._common import duplicate_keys
    return duplicate_keys(table(spark, sf_dir, "customer").select("c_mktsegment"), ["c_mktsegment"])


# --------------------------------------------------------------------------
# Geography rules K1-K12 on code columns derived from orders + customer.
# Years are shifted into the rules' range: even order keys 2010-2016, odd 2018-2024.
# --------------------------------------------------------------------------

def geo_input(spark, sf_dir) -> DataFrame:
    d = _orders_with_nation(spark, sf_dir)
    k, nk, ck = F.col("o_orderkey"), F.col("c_nationkey"), F.col("o_custkey")
    year = (F.col("file_year") + F.when(k % 2 == 0, F.lit(15)).otherwise(F.lit(23))).cast("int")
    fips3 = F.lpad(s(nk * 2 + 1), 3, "0")
    return d.select(
        "o_orderkey", year.alias("file_year"),
        F.when(nk == 24, F.lit("99")).otherwise(s(nk)).alias("residence_county_wa_code"),
        s((nk + 3) % 40).alias("death_county_wa_code"),
        F.when(ck % 5 == 0, null_string()).otherwise(s(ck % 39)).alias("injury_county_wa_code"),
        F.when(k % 4 == 0, F.concat(F.lit("53"), fips3)).when(k % 4 == 1, s(nk * 2 + 1))
         .when(k % 4 == 2, F.lit("00")).otherwise(F.lit("41051")).alias("residence_county_fips"),
        F.when(k % 3 == 0, s(nk)).when(k % 3 == 1, F.concat(F.lit("00530"), F.lpad(s(nk), 2, "0")))
         .otherwise(F.lit("00")).alias("death_county_fips"),
        F.when(ck % 3 == 0, s(nk * 2 + 1)).when(ck % 3 == 1, F.concat(F.lit("99"), fips3))
         .otherwise(F.lit("00")).alias("injury_county_fips"),
        F.when(ck % 4 == 0, F.lit("WA")).when(ck % 4 == 1, F.lit("48")).when(ck % 4 == 2, F.lit("OR"))
         .otherwise(null_string()).alias("residence_state_fips_code"),
        F.when(k % 3 == 0, F.lit("48")).when(k % 3 == 1, F.lit("WASHINGTON")).otherwise(null_string()).alias("death_state"),
        F.when(k % 5 < 2, F.lit("WASHINGTON")).when(k % 5 < 4, F.lit("OREGON")).otherwise(null_string()).alias("injury_state"),
        F.when(ck % 2 == 0, null_string()).otherwise(F.lit("KING")).alias("injury_county"),
        F.lit("OLD NAME").alias("residence_county"),
    )


GEO_COLUMN_PAIRS = [("death_county_wa_code", "death_county_fips", 2022),
                    ("residence_county_wa_code", "residence_county_fips", 2016),
                    ("injury_county_wa_code", "injury_county_fips", 2022)]
GEO_LITERAL_PAIRS = [("residence_county_fips", "residence_county", 2016),
                     ("injury_county_fips", "injury_county", 2016)]


def _pad_sql(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END)"


def _wa_to_fips_sql(x: str) -> str:
    """SQL twin of the generated county map: WA code (00-39) -> FIPS."""
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} = '00' THEN '00' "
            f"WHEN regexp_full_match({x}, '[0-9]{{2}}') AND CAST({x} AS INTEGER) BETWEEN 1 AND 39 "
            f"THEN lpad(CAST(2 * CAST({x} AS INTEGER) - 1 AS VARCHAR), 3, '0') END)")


def _fips_to_name_sql(x: str) -> str:
    return (f"(CASE WHEN {x} = '00' THEN 'NON-STATE OR UNKNOWN' "
            f"WHEN regexp_full_match({x}, '[0-9]{{3}}') AND CAST({x} AS INTEGER) % 2 = 1 AND CAST({x} AS INTEGER) <= 77 "
            f"THEN 'COUNTY ' || lpad(CAST((CAST({x} AS INTEGER) + 1) // 2 AS VARCHAR), 2, '0') END)")


def _geo_steps_sql(src: str) -> str:
    """K1-K12 as CTEs ``g1`` .. ``g12`` over any table ``src`` holding the geography columns."""
    return f"""g1 AS (  -- K1
  SELECT * REPLACE (
    CASE WHEN {_pad_sql('residence_county_wa_code', 2)} = '99' THEN NULL ELSE {_pad_sql('residence_county_wa_code', 2)} END AS residence_county_wa_code,
    CASE WHEN {_pad_sql('death_county_wa_code', 2)} = '99' THEN NULL ELSE {_pad_sql('death_county_wa_code', 2)} END AS death_county_wa_code,
    CASE WHEN {_pad_sql('injury_county_wa_code', 2)} = '99' THEN NULL ELSE {_pad_sql('injury_county_wa_code', 2)} END AS injury_county_wa_code)
  FROM {src}),
g2 AS (  -- K2
  SELECT * REPLACE (
    CASE WHEN file_year < 2022 THEN {_wa_to_fips_sql('death_county_wa_code')} ELSE death_county_fips END AS death_county_fips,
    CASE WHEN file_year < 2016 THEN {_wa_to_fips_sql('residence_county_wa_code')} ELSE residence_county_fips END AS residence_county_fips,
    CASE WHEN file_year < 2022 THEN {_wa_to_fips_sql('injury_county_wa_code')} ELSE injury_county_fips END AS injury_county_fips)
  FROM g1),
g3 AS (  -- K3
  SELECT * REPLACE (
    CASE WHEN file_year < 2022 AND death_county_fips = '00' THEN NULL ELSE death_county_fips END AS death_county_fips,
    CASE WHEN file_year < 2022 AND injury_county_fips = '00' THEN NULL ELSE injury_county_fips END AS injury_county_fips,
    CASE WHEN file_year < 2016 AND residence_county_fips = '00' THEN NULL ELSE residence_county_fips END AS residence_county_fips)
  FROM g2),
g4 AS (  -- K4
  SELECT * REPLACE (
    CASE WHEN file_year < 2016 THEN {_fips_to_name_sql('residence_county_fips')} ELSE residence_county END AS residence_county,
    CASE WHEN file_year < 2016 THEN {_fips_to_name_sql('injury_county_fips')} ELSE injury_county END AS injury_county)
  FROM g3),
g5 AS (  -- K5, K6
  SELECT * REPLACE (
    CASE WHEN file_year BETWEEN 2022 AND 2023 THEN {_pad_sql('right(death_county_fips, 3)', 3)} ELSE death_county_fips END AS death_county_fips,
    CASE WHEN file_year BETWEEN 2010 AND 2015 AND death_state = '48' THEN 'WASHINGTON' ELSE death_state END AS death_state)
  FROM g4),
g7 AS (  -- K7
  SELECT * REPLACE (CASE WHEN file_year >= 2016 AND residence_state_fips_code <> 'WA' THEN '00' ELSE residence_county_fips END AS residence_county_fips)
  FROM g5),
g8 AS (  -- K8
  SELECT * REPLACE (CASE WHEN file_year >= 2016 AND residence_county_fips <> '00' THEN {_pad_sql('residence_county_fips', 3)} ELSE residence_county_fips END AS residence_county_fips)
  FROM g7),
g9 AS (  -- K9, K10
  SELECT * REPLACE (
    CASE WHEN file_year BETWEEN 2016 AND 2023 THEN regexp_replace(residence_county_fips, '^53', '') ELSE residence_county_fips END AS residence_county_fips,
    CASE WHEN file_year BETWEEN 2010 AND 2015 AND residence_state_fips_code = '48' THEN 'WA' ELSE residence_state_fips_code END AS residence_state_fips_code)
  FROM g8),
g11a AS (  -- K11 (first rule)
  SELECT * REPLACE (
    CASE WHEN file_year BETWEEN 2022 AND 2023 AND injury_state IS NULL AND injury_county IS NULL THEN NULL
         WHEN file_year BETWEEN 2022 AND 2023 AND injury_state = 'WASHINGTON' AND injury_county IS NULL THEN NULL
         WHEN file_year BETWEEN 2022 AND 2023 AND injury_state <> 'WASHINGTON' THEN '00'
         ELSE injury_county_fips END AS injury_county_fips)
  FROM g9),
g11 AS (  -- K11 (second rule)
  SELECT * REPLACE (
    CASE WHEN file_year BETWEEN 2022 AND 2023 AND injury_county_fips <> '00' THEN {_pad_sql('right(injury_county_fips, 3)', 3)} ELSE injury_county_fips END AS injury_county_fips)
  FROM g11a),
g12 AS (  -- K12
  SELECT * REPLACE (CASE WHEN file_year > 2023 AND injury_state <> 'WASHINGTON' THEN '00' ELSE injury_county_fips END AS injury_county_fips)
  FROM g11)"""


_GEO_SQL = f"""
WITH {_ORDERS_NATION_SQL},
g0 AS (
  SELECT o_orderkey,
    CAST(file_year + CASE WHEN o_orderkey % 2 = 0 THEN 15 ELSE 23 END AS INTEGER) AS file_year,
    CASE WHEN c_nationkey = 24 THEN '99' ELSE CAST(c_nationkey AS VARCHAR) END AS residence_county_wa_code,
    CAST((c_nationkey + 3) % 40 AS VARCHAR) AS death_county_wa_code,
    CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 39 AS VARCHAR) END AS injury_county_wa_code,
    CASE o_orderkey % 4 WHEN 0 THEN '53' || lpad(CAST(c_nationkey * 2 + 1 AS VARCHAR), 3, '0')
                        WHEN 1 THEN CAST(c_nationkey * 2 + 1 AS VARCHAR) WHEN 2 THEN '00' ELSE '41051' END AS residence_county_fips,
    CASE o_orderkey % 3 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN '00530' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                        ELSE '00' END AS death_county_fips,
    CASE o_custkey % 3 WHEN 0 THEN CAST(c_nationkey * 2 + 1 AS VARCHAR) WHEN 1 THEN '99' || lpad(CAST(c_nationkey * 2 + 1 AS VARCHAR), 3, '0')
                       ELSE '00' END AS injury_county_fips,
    CASE o_custkey % 4 WHEN 0 THEN 'WA' WHEN 1 THEN '48' WHEN 2 THEN 'OR' ELSE NULL END AS residence_state_fips_code,
    CASE o_orderkey % 3 WHEN 0 THEN '48' WHEN 1 THEN 'WASHINGTON' ELSE NULL END AS death_state,
    CASE WHEN o_orderkey % 5 < 2 THEN 'WASHINGTON' WHEN o_orderkey % 5 < 4 THEN 'OREGON' ELSE NULL END AS injury_state,
    CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE 'KING' END AS injury_county,
    'OLD NAME' AS residence_county
  FROM src),
{_geo_steps_sql('g0')}
SELECT o_orderkey, file_year, residence_county_wa_code, death_county_wa_code, injury_county_wa_code,
  residence_county_fips, death_county_fips,
  injury_county_fips,
  residence_state_fips_code, death_state, injury_state, injury_county, residence_county
FROM g12
"""


@register("geo_rules", _GEO_SQL)
def q_geo_rules(spark, sf_dir):
    cmap = geography.county_map_from_rule(spark)
    return geography.clean_geography(geo_input(spark, sf_dir), cmap, GEO_COLUMN_PAIRS, GEO_LITERAL_PAIRS)


# --------------------------------------------------------------------------
# String scalars.
# --------------------------------------------------------------------------

_BLANK_SQL = r"[\s\p{Z}]"
_TRIM_SQL = "regexp_replace({x}, '^" + _BLANK_SQL + "+|" + _BLANK_SQL + "+$', '', 'g')"


@register("normalize_text", "SELECT doc_id, " + _TRIM_SQL.replace(
    "{x}", r"nullif(nullif(regexp_replace(text, '\p{C}', '', 'g'), ''), 'NA')") + " AS text_norm FROM documents")
def q_normalize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_text("text").alias("text_norm"))


_TITLE_SQL = r"""array_to_string(list_transform(
    regexp_extract_all(lower({x}), '([\p{{L}}\p{{M}}\p{{N}}_]+(?:[''.][\p{{L}}\p{{M}}\p{{N}}_]+)*|[^\p{{L}}\p{{M}}\p{{N}}_]+)', 1),
    lambda t: (CASE WHEN left(t, 1) = 'ß' THEN 'Ss' ELSE upper(left(t, 1)) END) || substr(t, 2)), '')"""


@register("title_case", "SELECT doc_id, " + _TITLE_SQL.replace("{x}", "text").replace("{{", "{").replace("}}", "}") + " AS text_title FROM documents")
def q_title_case(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", title_case("text").alias("text_title"))


@register("pad_and_last_n", f"""
SELECT p_partkey, {_pad_sql('CAST(p_partkey AS VARCHAR)', 3)} AS key_pad3,
       right(CAST(p_partkey AS VARCHAR), 3) AS key_last3,
       {_pad_sql("right(CAST(p_size AS VARCHAR) || CAST(p_partkey AS VARCHAR), 3)", 3)} AS mixed_last3_pad3
FROM part
""")
def q_pad_and_last_n(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", pad_left(s("p_partkey"), 3).alias("key_pad3"), last_n(s("p_partkey"), 3).alias("key_last3"),
        pad_left(last_n(F.concat(s("p_size"), s("p_partkey")), 3), 3).alias("mixed_last3_pad3"),
    )


@register("strip_prefix", r"""
SELECT c_custkey, regexp_replace(c_name, '\p{P}', '') AS name_no_punct,
       regexp_replace(c_name, '^Customer', '') AS name_no_prefix,
       regexp_replace(c_name || '.x.y', '\.', '') AS first_dot_removed
FROM customer
""")
def q_strip_prefix(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", remove_first_punct("c_name").alias("name_no_punct"),
        remove_first("c_name", "^Customer").alias("name_no_prefix"),
        remove_first(F.concat("c_name", F.lit(".x.y")), r"\.").alias("first_dot_removed"),
    )


@register("zip_check", """
WITH z AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
                                          WHEN 1 THEN CAST(c_custkey * 7 AS VARCHAR) || '-1234'
                                          ELSE CAST(c_custkey AS VARCHAR) END AS zip FROM customer)
SELECT c_custkey, zip AS zip_raw, CASE WHEN regexp_full_match(zip, '[0-9]{5}') THEN zip END AS zip_code FROM z
""")
def q_zip_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    z = (F.when(k % 3 == 0, F.lpad(s(k), 5, "0")).when(k % 3 == 1, F.concat(s(k * 7), F.lit("-1234"))).otherwise(s(k)))
    return c.select("c_custkey", z.alias("zip_raw")).withColumn("zip_code", zip5_or_null("zip_raw"))


from yearweave.plans.workflow import (  # noqa: E402  (placeholder spellings)
    INJURY_PLACE_PLACEHOLDERS,
    OCCUPATION_PLACEHOLDER_WORDS,
    OCCUPATION_PLACEHOLDERS,
)


@register("placeholders", """
WITH p AS (
  SELECT p_partkey,
    CASE p_partkey % 9 WHEN 0 THEN '-' WHEN 1 THEN '--' WHEN 2 THEN '?' WHEN 3 THEN 'Not applicable job'
                       WHEN 4 THEN 'UNKNOWN trade' WHEN 5 THEN '.' ELSE p_name END AS occupation,
    CASE p_partkey % 7 WHEN 0 THEN 'NONE' WHEN 1 THEN 'unknown' WHEN 2 THEN '?' ELSE p_type END AS injury_place,
    CASE WHEN p_size % 4 = 0 THEN '999' ELSE CAST(p_size AS VARCHAR) END AS residence_length
  FROM part)
SELECT p_partkey,
  CASE WHEN occupation IN ('-', '--', '---', '------', '.', '?') THEN NULL
       WHEN regexp_matches(occupation, '(?i)Not Applicable') THEN NULL
       WHEN regexp_matches(occupation, '(?i)Unknown') THEN NULL ELSE occupation END AS occupation,
  CASE WHEN injury_place IN ('-', '?', 'NONE', 'UNKNOWN', 'NOT APPLICABLE') THEN NULL ELSE injury_place END AS injury_place,
  CASE WHEN residence_length = '999' THEN NULL ELSE residence_length END AS residence_length
FROM p
""")
def q_placeholders(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    occ = (F.when(k % 9 == 0, F.lit("-")).when(k % 9 == 1, F.lit("--")).when(k % 9 == 2, F.lit("?"))
           .when(k % 9 == 3, F.lit("Not applicable job")).when(k % 9 == 4, F.lit("UNKNOWN trade"))
           .when(k % 9 == 5, F.lit(".")).otherwise(F.col("p_name")))
    place = (F.when(k % 7 == 0, F.lit("NONE")).when(k % 7 == 1, F.lit("unknown")).when(k % 7 == 2, F.lit("?"))
             .otherwise(F.col("p_type")))
    rlen = F.when(F.col("p_size") % 4 == 0, F.lit("999")).otherwise(s("p_size"))
    return p.select("p_partkey", occ.alias("occupation"), place.alias("injury_place"), rlen.alias("residence_length")).select(
        "p_partkey",
        nullify_placeholders("occupation", OCCUPATION_PLACEHOLDERS, OCCUPATION_PLACEHOLDER_WORDS).alias("occupation"),
        nullify_placeholders("injury_place", INJURY_PLACE_PLACEHOLDERS).alias("injury_place"),
        nullify_placeholders("residence_length", ("999",)).alias("residence_length"),
    )


@register("combine_columns", """
SELECT l_orderkey, l_linenumber,
  concat_ws(';', l_returnflag, NULLIF(l_linestatus, 'O'),
            CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'L' || CAST(l_linenumber AS VARCHAR) END,
            CASE WHEN l_quantity > 25 THEN 'Q' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END) AS all_cod_code
FROM lineitem
""")
def q_combine_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_returnflag").alias("underlying_cod_code"),
        F.nullif("l_linestatus", F.lit("O")).alias("record_axis_code_2"),
        F.when(F.col("l_linenumber") % 3 == 0, null_string()).otherwise(F.concat(F.lit("L"), s("l_linenumber"))).alias("record_axis_code_3"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("Q"), s(F.col("l_quantity").cast("long")))).alias("record_axis_code_10"),
    )
    return causes.all_cause_codes(df).select("l_orderkey", "l_linenumber", "all_cod_code")


@register("icd_clean", r"""
WITH c AS (
  SELECT p_partkey,
    CASE p_partkey % 5 WHEN 0 THEN lower(left(p_type, 1)) || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR)
                       WHEN 1 THEN upper(left(p_name, 1)) || CAST(p_size % 10 AS VARCHAR) || CAST(p_partkey % 100 AS VARCHAR) || 'X'
                       WHEN 2 THEN ' ' || upper(left(p_type, 1)) || '-' || CAST(p_size AS VARCHAR)
                       WHEN 3 THEN CAST(p_size AS VARCHAR) || 'ABC'
                       ELSE p_brand END AS raw_code
  FROM part),
u AS (SELECT p_partkey, raw_code, regexp_replace(upper(raw_code), '[^A-Z0-9]', '', 'g') AS cleaned FROM c)
SELECT p_partkey, raw_code, CASE WHEN regexp_full_match(cleaned, '[A-Z][0-9][0-9A-Z]{1,3}') THEN cleaned END AS icd_code FROM u
""")
def q_icd_clean(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    raw = (F.when(k % 5 == 0, F.concat(F.lower(F.left("p_type", F.lit(1))), s("p_size"), F.lit("."), s(k % 10)))
           .when(k % 5 == 1, F.concat(F.upper(F.left("p_name", F.lit(1))), s(F.col("p_size") % 10), s(k % 100), F.lit("X")))
           .when(k % 5 == 2, F.concat(F.lit(" "), F.upper(F.left("p_type", F.lit(1))), F.lit("-"), s("p_size")))
           .when(k % 5 == 3, F.concat(s("p_size"), F.lit("ABC")))
           .otherwise(F.col("p_brand")))
    df = p.select("p_partkey", raw.alias("raw_code"))
    from yearweave.functions.codes import icd10_clean
    return df.withColumn("icd_code", icd10_clean("raw_code"))


# --------------------------------------------------------------------------
# Dates (L1-L9).
# --------------------------------------------------------------------------

def order_date_strings(spark, sf_dir) -> DataFrame:
    """Order dates printed in several layouts, with placeholders and junk."""
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    turn = F.floor(k / 6) % 12  # another layout of the same order each time
    raw = (F.when(k % 6 == 0, F.date_format(d, "yyyyMMdd"))
           .when((k % 6 == 1) & (turn % 4 == 0), F.date_format(d, "yyyy-MM-dd"))
           .when((k % 6 == 1) & (turn % 4 == 1), F.date_format(d, "yyyy/MM/dd"))
           .when((k % 6 == 1) & (turn % 4 == 2), F.date_format(d, "yyyy.M.d"))
           .when(k % 6 == 1, F.date_format(d, "yyyy MM dd"))
           .when((k % 6 == 2) & (turn % 2 == 0), F.date_format(d, "M/d/yyyy"))
           .when(k % 6 == 2, F.date_format(d, "MM-dd-yyyy"))
           .when((k % 6 == 3) & (turn % 3 == 0), F.upper(F.date_format(d, "ddMMMyyyy")))
           .when((k % 6 == 3) & (turn % 3 == 1), F.date_format(d, "dMMMyyyy"))
           .when(k % 6 == 3, F.upper(F.date_format(d, "dd-MMM-yyyy")))
           .when(k % 12 == 4, F.lit("99991231"))
           .when(k % 6 == 4, F.concat(F.lit("bad "), F.date_format(d, "yyyy-MM-dd")))
           .when(k % 12 == 5, F.lit("1850-06-01"))
           .otherwise(F.concat(F.lit("  "), F.date_format(d, "yyyy-MM-dd"), F.lit("\t"))))
    return o.select("o_orderkey", s("o_orderkey").alias("state_file_number"),
                    F.year(d).cast("int").alias("file_year"), raw.alias("order_date"))


_DATE_RAW_SQL = """raw AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS state_file_number, CAST(year(o_orderdate) AS INTEGER) AS file_year,
    CASE WHEN o_orderkey % 6 = 0 THEN strftime(o_orderdate, '%Y%m%d')
         WHEN o_orderkey % 6 = 1 THEN CASE (o_orderkey // 6) % 4
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
           WHEN 2 THEN strftime(o_orderdate, '%Y.%-m.%-d') ELSE strftime(o_orderdate, '%Y %m %d') END
         WHEN o_orderkey % 6 = 2 THEN CASE (o_orderkey // 6) % 2
           WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE strftime(o_orderdate, '%m-%d-%Y') END
         WHEN o_orderkey % 6 = 3 THEN CASE (o_orderkey // 6) % 3
           WHEN 0 THEN upper(strftime(o_orderdate, '%d%b%Y')) WHEN 1 THEN strftime(o_orderdate, '%-d%b%Y')
           ELSE upper(strftime(o_orderdate, '%d-%b-%Y')) END
         WHEN o_orderkey % 12 = 4 THEN '99991231'
         WHEN o_orderkey % 6 = 4 THEN 'bad ' || strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderkey % 12 = 5 THEN '1850-06-01'
         ELSE '  ' || strftime(o_orderdate, '%Y-%m-%d') || chr(9) END AS order_date
  FROM orders),
sq AS (SELECT *, nullif(regexp_replace(regexp_replace(order_date, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '[\\s\\p{Z}]+', ' ', 'g'), '') AS d FROM raw),
parsed AS (
  SELECT *, CAST(try_strptime(d, ['%Y%m%d', '%Y-%m-%d', '%Y/%m/%d', '%Y.%m.%d', '%Y %m %d', '%m/%d/%Y', '%m-%d-%Y', '%d%b%Y', '%d-%b-%Y']) AS DATE) AS p0
  FROM sq),
cleaned AS (
  SELECT *, CASE WHEN p0 > DATE '""" + AS_OF + """' OR year(p0) <= 1850 THEN NULL ELSE p0 END AS order_date_parsed FROM parsed)"""


@register("parse_dates", "WITH " + _DATE_RAW_SQL + """
SELECT o_orderkey, order_date AS date_raw, strftime(order_date_parsed, '%Y-%m-%d') AS date_parsed FROM cleaned
""")
def q_parse_dates(spark, sf_dir):
    parsed = dates.parse_dates(order_date_strings(spark, sf_dir), ["order_date"], as_of_date=AS_OF)
    return parsed.select("o_orderkey", F.col("order_date").alias("date_raw"), iso("order_date_parsed").alias("date_parsed"))


TWO_ORDERS = ("mdY", "dmY")  # they read one text in two ways wherever both parts are 12 or less
_TWO_ORDERS_SQL = """raw AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS file_year,
    CASE WHEN o_orderkey % 50 = 0 THEN 'unknown' WHEN year(o_orderdate) % 2 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
      ELSE strftime(o_orderdate, '%d/%m/%Y') END AS d FROM orders),
read AS (SELECT *, try_strptime(d, '%m/%d/%Y') AS month_first, try_strptime(d, '%d/%m/%Y') AS day_first FROM raw),
votes AS (SELECT file_year, count(month_first) AS m, count(day_first) AS f FROM read GROUP BY file_year)"""


def two_order_dates(spark, sf_dir) -> DataFrame:
    """Vintages that print dates month first, and others that print them day first."""
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("int")
    text = F.when(year % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", year.alias("file_year"), F.when(F.col("o_orderkey") % 50 == 0, F.lit("unknown")).otherwise(text).alias("d"))


@register("date_order_votes", "WITH " + _TWO_ORDERS_SQL + """
SELECT file_year, 'd' AS variable, 'mdY' AS date_order, CAST(0 AS INTEGER) AS precedence, CAST(m AS BIGINT) AS n_values FROM votes
UNION ALL SELECT file_year, 'd', 'dmY', 1, CAST(f AS BIGINT) FROM votes
""")
def q_date_order_votes(spark, sf_dir):
    return dates.order_votes(two_order_dates(spark, sf_dir), ["d"], orders=TWO_ORDERS)


@register("parse_dates_by_vintage", "WITH " + _TWO_ORDERS_SQL + """
SELECT o_orderkey, d AS date_raw,
  strftime(CASE WHEN m >= f THEN coalesce(month_first, day_first) ELSE coalesce(day_first, month_first) END, '%Y-%m-%d') AS date_parsed
FROM read JOIN votes USING (file_year)
""")
def q_parse_dates_by_vintage(spark, sf_dir):
    """L1 with the order chosen per vintage and column."""
    parsed = dates.parse_dates(two_order_dates(spark, sf_dir), ["d"], TWO_ORDERS, AS_OF, vote_by="file_year")
    return parsed.select("o_orderkey", F.col("d").alias("date_raw"), iso("d_parsed").alias("date_parsed"))


@register("date_error_report", "WITH " + _DATE_RAW_SQL + """
SELECT state_file_number, file_year, 'order_date' AS variable, order_date AS original_value, CAST(NULL AS VARCHAR) AS parsed_value
FROM cleaned WHERE order_date IS NOT NULL AND order_date_parsed IS NULL
QUALIFY row_number() OVER (PARTITION BY order_date ORDER BY file_year, state_file_number) = 1
""")
def q_date_error_report(spark, sf_dir):
    parsed = dates.parse_dates(order_date_strings(spark, sf_dir), ["order_date"], as_of_date=AS_OF)
    rep = dates.date_error_report(parsed, ["order_date"])
    return rep.withColumn("parsed_value", F.col("parsed_value").cast("string"))


def life_dates(spark, sf_dir) -> DataFrame:
    """Typed dates from lineitem + orders: death = ship date, birth = order date
    minus 0-129 years, injury / received / disposition offsets from the keys."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey", "inner")
    death, od = as_date("l_shipdate"), as_date("o_orderdate")
    return j.select(
        "l_orderkey", "l_linenumber",
        (F.year("l_shipdate") + F.when(F.col("l_orderkey") % 10 == 0, 1).otherwise(0)).cast("int").alias("file_year"),
        death.alias("date_of_death_parsed"),
        F.add_months(od, -12 * (F.col("o_custkey") % 130).cast("int")).alias("date_of_birth_parsed"),
        F.date_add(od, (F.col("l_linenumber") * 97 - 400).cast("int")).alias("date_of_injury_parsed"),
        F.date_add(death, (F.col("l_partkey") % 1500).cast("int")).alias("date_received_parsed"),
        F.date_sub(death, (F.col("l_suppkey") % 4).cast("int")).alias("disposition_date_parsed"),
    )


@register("date_logic", """
WITH j AS (
  SELECT l.l_orderkey, l.l_linenumber,
    CAST(year(l.l_shipdate) + CASE WHEN l.l_orderkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS file_year,
    CAST(l.l_shipdate AS DATE) AS death0,
    CAST(CAST(o.o_orderdate AS DATE) - to_months(CAST(12 * (o.o_custkey % 130) AS INTEGER)) AS DATE) AS birth0,
    CAST(o.o_orderdate AS DATE) + CAST(l.l_linenumber * 97 - 400 AS INTEGER) AS injury0,
    CAST(l.l_shipdate AS DATE) + CAST(l.l_partkey % 1500 AS INTEGER) AS received0,
    CAST(l.l_shipdate AS DATE) - CAST(l.l_suppkey % 4 AS INTEGER) AS disposition0
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
d1 AS (SELECT *, CASE WHEN death0 BETWEEN make_date(file_year, 1, 1) AND make_date(file_year, 12, 31) THEN death0
                      WHEN NOT (death0 BETWEEN make_date(file_year, 1, 1) AND make_date(file_year, 12, 31)) THEN NULL END AS death FROM j),
d2 AS (SELECT *, CASE WHEN birth0 <= death THEN birth0 END AS birth1 FROM d1),
d3 AS (SELECT *, CASE WHEN year(death) - year(birth1) - CASE WHEN strftime(death, '%m%d') < strftime(birth1, '%m%d') THEN 1 ELSE 0 END < 120
                      THEN birth1 END AS birth FROM d2),
d4 AS (SELECT *, CASE WHEN day(CAST(birth - INTERVAL 9 MONTH AS DATE)) = day(birth) THEN CAST(birth - INTERVAL 9 MONTH AS DATE) END AS birth_m9 FROM d3),
d5 AS (SELECT *, CASE WHEN injury0 < birth_m9 THEN NULL WHEN injury0 > death THEN NULL ELSE injury0 END AS injury,
              CASE WHEN received0 BETWEEN death AND make_date(file_year + 2, 12, 31) THEN received0 END AS received,
              CASE WHEN disposition0 BETWEEN death AND make_date(file_year + 2, 12, 31) THEN disposition0 END AS disposition
       FROM d4)
SELECT l_orderkey, l_linenumber, file_year,
  strftime(death, '%Y-%m-%d') AS date_of_death, strftime(birth, '%Y-%m-%d') AS date_of_birth,
  strftime(injury, '%Y-%m-%d') AS date_of_injury, strftime(received, '%Y-%m-%d') AS date_received,
  strftime(disposition, '%Y-%m-%d') AS disposition_date
FROM d5
""")
def q_date_logic(spark, sf_dir):
    out = dates.date_logic(life_dates(spark, sf_dir))
    names = ["date_of_death", "date_of_birth", "date_of_injury", "date_received", "disposition_date"]
    return out.select("l_orderkey", "l_linenumber", "file_year", *[iso(f"{n}_parsed").alias(n) for n in names])


# --------------------------------------------------------------------------
# Times (M1-M9).
# --------------------------------------------------------------------------

def event_time_parts(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k, ts = F.col("event_id"), F.col("ts")
    hh, mm = s(F.hour(ts)), s(F.minute(ts))
    return e.select(
        "event_id", s("event_id").alias("state_file_number"), F.year(ts).cast("int").alias("file_year"),
        (F.when(k % 8 == 0, null_string()).when(k % 8 == 1, F.lit("24")).when(k % 8 == 3, F.lit("x"))
         .when(k % 8 == 2, hh).otherwise(F.lpad(hh, 2, "0"))).alias("time_of_death_hour"),
        (F.when(k % 5 == 0, null_string()).when(k % 5 == 1, F.lit("75")).when(k % 5 == 2, mm)
         .otherwise(F.lpad(mm, 2, "0"))).alias("time_of_death_minutes"),
        (F.when(k % 7 == 0, F.lit("2400")).when(k % 7 == 1, F.lit("9999")).when(k % 7 == 2, F.lit("930"))
         .when(k % 7 == 3, F.lit("1:2:5")).when(k % 7 == 4, F.date_format(ts, "HH:mm")).when(k % 7 == 5, null_string())
         .otherwise(F.date_format(ts, "HHmm"))).alias("time_of_death"),
        (F.when(k % 6 == 1, null_string()).when(k % 6 == 2, F.lit("9.5")).when(k % 6 == 3, F.lit("-3"))
         .otherwise(hh)).alias("time_of_injury_hour"),
        (F.when(k % 4 == 0, null_string()).when(k % 4 == 1, F.lit("5")).otherwise(mm)).alias("time_of_injury_minutes"),
        (F.when(k % 3 == 0, null_string()).when(k % 3 == 1, F.date_format(ts, "H:mm")).otherwise(F.lit("abc"))).alias("time_of_injury"),
    )


def _pad2(x):
    return _pad_sql(x, 2)


_TIME_SQL = """
raw AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS state_file_number, CAST(year(ts) AS INTEGER) AS file_year,
    CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '24' WHEN 3 THEN 'x' WHEN 2 THEN CAST(hour(ts) AS VARCHAR)
                      ELSE lpad(CAST(hour(ts) AS VARCHAR), 2, '0') END AS dh,
    CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '75' WHEN 2 THEN CAST(minute(ts) AS VARCHAR)
                      ELSE lpad(CAST(minute(ts) AS VARCHAR), 2, '0') END AS dm,
    CASE event_id % 7 WHEN 0 THEN '2400' WHEN 1 THEN '9999' WHEN 2 THEN '930' WHEN 3 THEN '1:2:5'
                      WHEN 4 THEN strftime(ts, '%H:%M') WHEN 5 THEN NULL ELSE strftime(ts, '%H%M') END AS dt,
    CASE event_id % 6 WHEN 1 THEN NULL WHEN 2 THEN '9.5' WHEN 3 THEN '-3' ELSE CAST(hour(ts) AS VARCHAR) END AS ih,
    CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '5' ELSE CAST(minute(ts) AS VARCHAR) END AS im,
    CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(hour(ts) AS VARCHAR) || ':' || strftime(ts, '%M') ELSE 'abc' END AS it
  FROM events),
m1 AS (SELECT event_id, state_file_number, file_year,
         regexp_replace(dh, '\\p{P}', '') AS dh, regexp_replace(dm, '\\p{P}', '') AS dm, regexp_replace(dt, '\\p{P}', '') AS dt,
         regexp_replace(ih, '\\p{P}', '') AS ih, regexp_replace(im, '\\p{P}', '') AS im, regexp_replace(it, '\\p{P}', '') AS it FROM raw),
m2 AS (SELECT * REPLACE (
         CASE WHEN TRY_CAST(dh AS DOUBLE) >= 24 THEN NULL WHEN TRY_CAST(dh AS DOUBLE) < 24 THEN dh END AS dh,
         CASE WHEN TRY_CAST(dm AS DOUBLE) >= 60 THEN NULL WHEN TRY_CAST(dm AS DOUBLE) < 60 THEN dm END AS dm,
         CASE WHEN TRY_CAST(ih AS DOUBLE) >= 24 THEN NULL WHEN TRY_CAST(ih AS DOUBLE) < 24 THEN ih END AS ih,
         CASE WHEN TRY_CAST(im AS DOUBLE) >= 60 THEN NULL WHEN TRY_CAST(im AS DOUBLE) < 60 THEN im END AS im) FROM m1),
m3 AS (SELECT * REPLACE (""" + ", ".join(f"{_pad2(c)} AS {c}" for c in ("dh", "dm", "ih", "im")) + """) FROM m2),
m4 AS (SELECT *,
         CASE WHEN dh IS NOT NULL AND dm IS NOT NULL THEN dh || dm WHEN dh IS NOT NULL AND dm IS NULL THEN dh || '00' END AS dp,
         CASE WHEN ih IS NOT NULL AND im IS NOT NULL THEN ih || im WHEN ih IS NOT NULL AND im IS NULL THEN ih || '00' END AS ip FROM m3),
m5 AS (SELECT * REPLACE (coalesce(dp, dt) AS dt, coalesce(ip, it) AS it) FROM m4),
m6 AS (SELECT * REPLACE (
         CASE WHEN (CASE WHEN dt = '2400' THEN '0000' ELSE dt END) = '9999' THEN NULL WHEN dt = '2400' THEN '0000' ELSE dt END AS dt,
         CASE WHEN (CASE WHEN it = '2400' THEN '0000' ELSE it END) = '9999' THEN NULL WHEN it = '2400' THEN '0000' ELSE it END AS it) FROM m5),
m7 AS (SELECT *,
         CASE WHEN regexp_full_match(dt, '([01][0-9]|2[0-3])[0-5][0-9]') THEN substr(dt, 1, 2) || ':' || substr(dt, 3, 2) || ':00' END AS df,
         CASE WHEN regexp_full_match(it, '([01][0-9]|2[0-3])[0-5][0-9]') THEN substr(it, 1, 2) || ':' || substr(it, 3, 2) || ':00' END AS if_
       FROM m6)"""


@register("clean_times", "WITH " + _TIME_SQL + """
SELECT event_id, df AS time_of_death, if_ AS time_of_injury FROM m7
""")
def q_clean_times(spark, sf_dir):
    cleaned, _ = times.clean_times(event_time_parts(spark, sf_dir))
    return cleaned.select("event_id", "time_of_death", "time_of_injury")


@register("time_error_report", "WITH " + _TIME_SQL + """,
long AS (
  SELECT state_file_number, file_year, 'time_of_death' AS variable, dt AS original_value, dp AS primary_value,
         dh AS hour_component, dm AS minute_component, df AS parsed_value FROM m7
  UNION ALL
  SELECT state_file_number, file_year, 'time_of_injury', it, ip, ih, im, if_ FROM m7)
SELECT * FROM long
WHERE (original_value IS NOT NULL OR primary_value IS NOT NULL) AND parsed_value IS NULL
QUALIFY row_number() OVER (PARTITION BY variable, original_value, primary_value ORDER BY file_year, state_file_number, hour_component, minute_component) = 1
""")
def q_time_error_report(spark, sf_dir):
    _, report = times.clean_times(event_time_parts(spark, sf_dir))
    return report


# --------------------------------------------------------------------------
# Type enforcement.
# --------------------------------------------------------------------------

SCHEMA_DDL = ("variable string, data_type string, factor_is_ordered boolean, factor_value string, "
              "factor_label string, factor_order int, description string, source_file_type string")


def _schema_rows(vars_types, factors=()):
    rows = [(v, t, None, None, None, None, f"{v} column", "events") for v, t in vars_types]
    return rows + list(factors)


def event_strings(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        F.when(k % 10 == 0, F.concat(s(k), F.lit(".0"))).otherwise(s(k)).alias("event_id"),
        F.when(k % 9 == 0, F.lit("x")).otherwise(s("value")).alias("value"),
        F.col("event_type"),
        (F.when(k % 6 == 0, F.lit("Y")).when(k % 6 == 1, F.lit("no")).when(k % 6 == 2, F.lit("1"))
         .when(k % 6 == 3, F.lit("maybe")).when(k % 6 == 4, F.lit("F")).otherwise(null_string())).alias("flag"),
        F.concat(s("user_id"), F.when(k % 13 == 0, F.lit("a")).otherwise(F.lit(""))).alias("user_id"),
    )


@register("enforce_types", r"""
WITH e AS (
  SELECT CASE WHEN event_id % 10 = 0 THEN CAST(event_id AS VARCHAR) || '.0' ELSE CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN event_id % 9 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS value, event_type,
         CASE event_id % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'maybe' WHEN 4 THEN 'F' ELSE NULL END AS flag,
         CAST(user_id AS VARCHAR) || CASE WHEN event_id % 13 = 0 THEN 'a' ELSE '' END AS user_id
  FROM events)
SELECT CASE WHEN regexp_full_match(trim(event_id), '[+-]?[0-9]+') THEN TRY_CAST(trim(event_id) AS INTEGER) END AS event_id,
       TRY_CAST(trim(value) AS DOUBLE) AS value, event_type,
       CASE WHEN upper(trim(flag)) IN ('Y', 'YES', 'T', 'TRUE', '1') THEN TRUE
            WHEN upper(trim(flag)) IN ('N', 'NO', 'F', 'FALSE', '0') THEN FALSE END AS flag,
       CASE WHEN regexp_full_match(trim(user_id), '[+-]?[0-9]+') THEN TRY_CAST(trim(user_id) AS INTEGER) END AS user_id
FROM e
""")
def q_enforce_types(spark, sf_dir):
    sch = spark.createDataFrame(_schema_rows([("event_id", "integer"), ("value", "numeric"), ("event_type", "character"),
                                              ("flag", "logical"), ("user_id", "integer")]), SCHEMA_DDL)
    typed, _ = schema.enforce_schema(event_strings(spark, sf_dir), sch)
    return typed


# Fixed values for the order factor schema.
PRIORITY_LEVELS = [("1-URGENT", "Urgent", 1), ("2-HIGH", "High", 2), ("3-MEDIUM", "Medium", 3),
                   ("4-NOT SPECIFIED", "Not specified", 4), ("5-LOW", "Low", 5)]
STATUS_LEVELS = [("O", "Open"), ("F", "Fulfilled"), ("P", "Partial")]


def order_factor_schema(spark, status_levels=STATUS_LEVELS, priority_levels=PRIORITY_LEVELS):
    rows = [("o_orderkey", "character", None, None, None, None, "order key", "orders")]
    rows += [("o_orderpriority", "factor", True, v, lab, o, "priority", "orders") for v, lab, o in priority_levels]
    rows += [("o_orderstatus", "factor", False, v, lab, None, "status", "orders") for v, lab in status_levels]
    return spark.createDataFrame(rows, SCHEMA_DDL)


@register("factor_labels", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' WHEN 'P' THEN 'Partial' END AS o_orderstatus,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
                       WHEN '4-NOT SPECIFIED' THEN 'Not specified' WHEN '5-LOW' THEN 'Low' END AS o_orderpriority
FROM orders
""")
def q_factor_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(s("o_orderkey").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    typed, _ = schema.enforce_schema(o, order_factor_schema(spark))
    return typed


@register("ordered_factor_sort", """
WITH r AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END AS level
  FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(level AS INTEGER) AS level FROM r ORDER BY level DESC NULLS LAST, o_orderkey DESC
""")
def q_ordered_factor_sort(spark, sf_dir):
    """An ordered factor sorts by its levels, known from column metadata, after a Parquet round trip."""
    o = table(spark, sf_dir, "orders").select(s("o_orderkey").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    typed, _ = schema.enforce_schema(o, order_factor_schema(spark))
    path = scratch_folder(spark, "ordered_factor_sort")
    typed.write.parquet(path)
    ranked = schema.order_by_factors(spark.read.parquet(path), "o_orderpriority", "o_orderkey", descending=True)
    return ranked.select("o_orderkey", schema.factor_rank(ranked, "o_orderpriority").alias("level"))


@register("unexpected_levels", """
SELECT DISTINCT 'o_orderstatus' AS variable, o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL
SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
""")
def q_unexpected_levels(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(s("o_orderkey").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    sch = order_factor_schema(spark, STATUS_LEVELS[:2], PRIORITY_LEVELS[:4])
    return schema.unexpected_levels(o, sch)


# --------------------------------------------------------------------------
# Age and race/ethnicity.
# --------------------------------------------------------------------------

def part_ages(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k, sz = F.col("p_partkey"), F.col("p_size")
    return p.select(
        "p_partkey",
        F.when(k % 4 == 0, F.lit("9")).when(k % 4 == 1, F.lit("1")).when(k % 4 == 2, null_string()).otherwise(F.lit("2")).alias("age_type"),
        F.when(k % 3 == 0, F.lit("999")).when(k % 3 == 1, s(sz)).otherwise(null_string()).alias("age"),
        (F.when(k % 6 == 0, s(sz * 3)).when(k % 6 == 1, F.concat(s(sz * 3), F.lit(".7"))).when(k % 6 == 2, F.lit("x"))
         .when(k % 6 == 3, F.lit("121")).when(k % 6 == 4, F.lit("-1")).otherwise(s(sz * 2))).alias("age_years"),
    )


def _bins_sql(x: str, cuts) -> str:
    from yearweave.functions.bins import bin_labels
    arms = " ".join(f"WHEN {x} >= {c} THEN '{lab}'" for c, lab in reversed(list(zip(cuts, bin_labels(cuts)))))
    return f"CASE {arms} END"


def _age_sql():
    from yearweave.functions.bins import AGE_CUTS
    bins = ",\n  ".join(f"{_bins_sql('age_years', cuts)} AS {name}" for name, cuts in AGE_CUTS.items())
    return f"""
WITH p AS (
  SELECT p_partkey,
    CASE p_partkey % 4 WHEN 0 THEN '9' WHEN 1 THEN '1' WHEN 2 THEN NULL ELSE '2' END AS age_type,
    CASE p_partkey % 3 WHEN 0 THEN '999' WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE NULL END AS age,
    CASE p_partkey % 6 WHEN 0 THEN CAST(p_size * 3 AS VARCHAR) WHEN 1 THEN CAST(p_size * 3 AS VARCHAR) || '.7' WHEN 2 THEN 'x'
                       WHEN 3 THEN '121' WHEN 4 THEN '-1' ELSE CAST(p_size * 2 AS VARCHAR) END AS age_years_raw
  FROM part),
a AS (
  SELECT p_partkey, age_type,
    CASE WHEN age_type = '9' AND age = '999' THEN NULL WHEN NOT (age_type = '9' AND age = '999') THEN age END AS age,
    CAST(trunc(TRY_CAST(age_years_raw AS DOUBLE)) AS INTEGER) AS y0
  FROM p),
b AS (SELECT p_partkey, age_type, age, CASE WHEN y0 > 120 THEN NULL ELSE y0 END AS age_years FROM a)
SELECT p_partkey, age_type, age, age_years,
  {bins}
FROM b"""


@register("age_bins", _age_sql())
def q_age_bins(spark, sf_dir):
    return demographics.clean_age(part_ages(spark, sf_dir))


def event_race_codes(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    hisp = ["0", "1", "5", "9", None, "3", "6", "0"]
    race = ["10", "11", "12", "13", "14", "15", "99", None, "21"]

    def pick(values, mod):
        expr = None
        for i, v in enumerate(values):
            val = F.lit(v) if v is not None else null_string()
            expr = F.when(k % mod == i, val) if expr is None else expr.when(k % mod == i, val)
        return expr

    flags = list(demographics.ASIAN_FLAGS) + list(demographics.NHPI_FLAGS) + ["race_white", "race_black", "race_amer_indian_alaskan"]
    cols = [F.when((k * (i + 3)) % 7 == 0, F.lit("Y")).when((k * (i + 3)) % 7 == 6, null_string()).otherwise(F.lit("N")).alias(f)
            for i, f in enumerate(flags)]
    return e.select("event_id", pick(hisp, 8).alias("hispanic_nchs_bridge"), pick(race, 9).alias("race_summary_code"), *cols)


def _race_parts_sql():
    """SQL for race6, race_ethnicity7, the any-'Y' flag rule and race_code."""
    def any_y(cols):
        anyy = " OR ".join(f"{c} = 'Y'" for c in cols)
        return f"CASE WHEN ({anyy}) THEN 'Y' WHEN NOT ({anyy}) THEN 'N' END"

    labels = dict(demographics.RACE6_LABELS)
    r6 = ("CASE " + " ".join(f"WHEN race_summary_code = '{c}' THEN '{lab}'" for c, lab in labels.items())
          + " WHEN race_summary_code = '99' OR race_summary_code IS NULL THEN NULL ELSE 'Multi Race' END")
    r7 = ("CASE WHEN hispanic = 1 THEN 'Hispanic as Race' "
          + " ".join(f"WHEN (hispanic = 0 OR hispanic IS NULL) AND race6 = '{lab}' THEN '{lab}-NH'" for lab in labels.values())
          + " WHEN (hispanic = 0 OR hispanic IS NULL) AND race6 = 'Multi Race' THEN 'Multi-Race-NH' END")
    bits = " || ".join(f"(CASE WHEN {c} = 'Y' THEN '1' WHEN NOT ({c} = 'Y') THEN '0' END)" for c in demographics.RACE_CODE_FLAGS)
    return r6, r7, any_y, bits


def _race_sql():
    flags = list(demographics.ASIAN_FLAGS) + list(demographics.NHPI_FLAGS) + ["race_white", "race_black", "race_amer_indian_alaskan"]
    flag_cols = ",\n    ".join(
        f"CASE WHEN (event_id * {i + 3}) % 7 = 0 THEN 'Y' WHEN (event_id * {i + 3}) % 7 = 6 THEN NULL ELSE 'N' END AS {f}"
        for i, f in enumerate(flags))
    hisp = ["'0'", "'1'", "'5'", "'9'", "NULL", "'3'", "'6'", "'0'"]
    race = ["'10'", "'11'", "'12'", "'13'", "'14'", "'15'", "'99'", "NULL", "'21'"]
    hcase = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(hisp)) + " END"
    rcase = "CASE event_id % 9 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(race)) + " END"
    r6, r7, any_y, bits = _race_parts_sql()
    return f"""
WITH e AS (SELECT event_id, {hcase} AS hispanic_nchs_bridge, {rcase} AS race_summary_code,
    {flag_cols}
  FROM events),
h AS (SELECT *, CASE WHEN hispanic_nchs_bridge = '0' THEN 0 WHEN hispanic_nchs_bridge IN ('1', '2', '3', '4', '5') THEN 1 END AS hispanic,
             {r6} AS race6 FROM e),
g AS (SELECT *, {any_y(demographics.ASIAN_FLAGS)} AS race_asian, {any_y(demographics.NHPI_FLAGS)} AS race_nhpi FROM h)
SELECT event_id, hispanic,
  CASE WHEN hispanic = 0 THEN 'Not Hispanic' WHEN hispanic = 1 THEN 'Hispanic' END AS race_ethnicity2,
  race6, {r7} AS race_ethnicity7, race_asian, race_nhpi, {bits} AS race_code
FROM g"""


@register("hispanic_race", _race_sql())
def q_hispanic_race(spark, sf_dir):
    d = demographics.derive_demographics_race(event_race_codes(spark, sf_dir))
    return d.select("event_id", "hispanic", "race_ethnicity2", "race6", "race_ethnicity7", "race_asian", "race_nhpi", "race_code")


# --------------------------------------------------------------------------
# Quality outputs.
# --------------------------------------------------------------------------

def _sort_key_sql(v: str = "variable") -> str:
    num = f"regexp_extract({v}, '(\\d+)$', 1)"
    return (f"CASE WHEN regexp_full_match({v}, 'record_axis_code_\\d+') THEN 'record_axis_code_' || "
            f"(CASE WHEN length({num}) < 2 THEN lpad({num}, 2, '0') ELSE {num} END) ELSE {v} END")


def documents_labelled(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = vintage.join_literals(d, lab, ["doc_id"])
    return j.select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic",
        F.when(F.col("n_chars") < 500, null_string()).otherwise(F.col("lang")).alias("record_axis_code_2"),
        F.when(F.col("doc_id") % 3 == 0, null_string()).otherwise(F.col("source")).alias("record_axis_code_10"),
    )


_DOCS_LABELLED_SQL = """dl AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CASE WHEN d.n_chars < 500 THEN NULL ELSE d.lang END AS record_axis_code_2,
         CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.source END AS record_axis_code_10
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_DL_COLS = ["doc_id", "source", "n_chars", "quality", "toxic", "record_axis_code_2", "record_axis_code_10"]


@register("completeness_by_year", f"""
WITH {_DOCS_LABELLED_SQL},
c AS (SELECT lang, count(*) AS n_rows, {', '.join(f'count({c}) AS {c}' for c in _DL_COLS)} FROM dl GROUP BY lang),
u AS (UNPIVOT c ON {', '.join(_DL_COLS)} INTO NAME variable VALUE n_complete)
SELECT lang, variable, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_complete AS BIGINT) AS n_complete,
       CAST(n_complete AS DOUBLE) / n_rows AS pct_complete, {_sort_key_sql()} AS sort_key
FROM u
""")
def q_completeness_by_year(spark, sf_dir):
    return quality.completeness(documents_labelled(spark, sf_dir), by="lang")


def orders_customers_by_year(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    y = F.year("o_orderdate").cast("int")
    return j.select(
        y.alias("file_year"), "o_orderkey", "o_orderstatus",
        F.when((y == 1995) & (F.col("o_custkey") % 2 == 0), F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(y >= 1999, null_string()).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("o_orderkey") % 7 == 0, null_string()).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(y == 2001, null_string()).otherwise(F.col("o_orderstatus")).alias("record_axis_code_3"),
    )


_OC_COLS = ["o_orderkey", "o_orderstatus", "c_acctbal", "c_mktsegment", "o_orderpriority", "record_axis_code_3"]


@register("completeness_threshold", f"""
WITH oc AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS file_year, o.o_orderkey, o.o_orderstatus,
         CASE WHEN year(o.o_orderdate) = 1995 AND o.o_custkey % 2 = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal,
         CASE WHEN year(o.o_orderdate) >= 1999 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
         CASE WHEN year(o.o_orderdate) = 2001 THEN NULL ELSE o.o_orderstatus END AS record_axis_code_3
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
c AS (SELECT file_year, count(*) AS n_rows, {', '.join(f'count({c}) AS {c}' for c in _OC_COLS)} FROM oc GROUP BY file_year),
u AS (UNPIVOT c ON {', '.join(_OC_COLS)} INTO NAME variable VALUE n_complete),
full_vars AS (SELECT variable FROM u GROUP BY variable HAVING bool_and(CAST(n_complete AS DOUBLE) / n_rows >= 1.0)),
t AS (SELECT *, (2000 * n_complete + n_rows) // (2 * n_rows) AS tenths FROM u
      WHERE variable NOT IN (SELECT variable FROM full_vars) AND NOT contains(variable, 'record_axis_code'))
SELECT file_year, variable, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_complete AS BIGINT) AS n_complete,
       CAST(n_complete AS DOUBLE) / n_rows AS pct_complete, {_sort_key_sql()} AS sort_key,
       CAST(tenths // 10 AS VARCHAR) || '.' || CAST(tenths % 10 AS VARCHAR) || '%' AS pct_label
FROM t
""")
def q_completeness_threshold(spark, sf_dir):
    return quality.completeness_report(orders_customers_by_year(spark, sf_dir), by="file_year", threshold=1.0)


def order_rules():
    return {
        "totalprice_nonnegative": F.col("o_totalprice") >= 0,
        "status_known": F.col("o_orderstatus").isin("O", "F"),
        "priority_code_shape": F.col("o_orderpriority").rlike("^[1-5]-"),
        "orderdate_in_range": F.year("o_orderdate").between(1995, 2000),
    }


@register("validate_rules", """
WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
r AS (
  SELECT 'totalprice_nonnegative' AS rule, CAST(count(o_totalprice >= 0) AS BIGINT) AS n_checked,
         CAST(count(*) FILTER (WHERE NOT (o_totalprice >= 0)) AS BIGINT) AS n_failed FROM o
  UNION ALL SELECT 'status_known', count(o_orderstatus IN ('O', 'F')), count(*) FILTER (WHERE NOT (o_orderstatus IN ('O', 'F'))) FROM o
  UNION ALL SELECT 'priority_code_shape', count(regexp_matches(o_orderpriority, '^[1-5]-')),
                   count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-')) FROM o
  UNION ALL SELECT 'orderdate_in_range', count(y BETWEEN 1995 AND 2000), count(*) FILTER (WHERE NOT (y BETWEEN 1995 AND 2000)) FROM o
  UNION ALL SELECT 'orderkey_unique_per_year', sum(n), coalesce(sum(CASE WHEN n > 1 THEN n END), 0)
            FROM (SELECT y, o_orderkey, count(*) AS n FROM o GROUP BY y, o_orderkey)
  UNION ALL SELECT 'custkey_unique_per_year', sum(n), coalesce(sum(CASE WHEN n > 1 THEN n END), 0)
            FROM (SELECT y, o_custkey, count(*) AS n FROM o GROUP BY y, o_custkey))
SELECT rule, CAST(n_checked AS BIGINT) AS n_checked, CAST(n_failed AS BIGINT) AS n_failed, n_failed = 0 AS passed FROM r
""")
def q_validate_rules(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    return quality.validate_rules(o, order_rules(), [("orderkey_unique_per_year", ["y", "o_orderkey"]),
                                                     ("custkey_unique_per_year", ["y", "o_custkey"])])


_EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
                ("value", "double"), ("props", "string")]


def _dictionary_sql(max_unique=30, trunc=15):
    blocks = []
    for c, t in _EVENT_TYPES:
        nd = f"(SELECT count(DISTINCT {c}) FROM events)"
        vals = (f"(SELECT string_agg(left(v, {trunc}) || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY v) "
                f"FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM events WHERE {c} IS NOT NULL GROUP BY 1))")
        blocks.append(
            f"SELECT '{c}' AS varname, '{t}' AS data_type, CAST(count(*) AS BIGINT) AS n_rows, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
            f"CAST({nd} AS BIGINT) AS n_distinct, "
            + (f"CASE WHEN {nd} <= {max_unique} THEN {vals} END AS value_counts, "
               f"CASE WHEN {nd} > {max_unique} THEN CAST(min({c}) AS VARCHAR) END AS min_value, "
               f"CASE WHEN {nd} > {max_unique} THEN CAST(max({c}) AS VARCHAR) END AS max_value, " if c != "props" else
               "CAST(NULL AS VARCHAR) AS value_counts, CAST(NULL AS VARCHAR) AS min_value, CAST(NULL AS VARCHAR) AS max_value, ")
            + ("(SELECT string_agg(d, '; ' ORDER BY d) FROM (SELECT DISTINCT 'kind ' || event_type AS d FROM events)) AS \"desc\", 'stream' AS source "
               if c == "event_type" else "CAST(NULL AS VARCHAR) AS \"desc\", CAST(NULL AS VARCHAR) AS source ") + "FROM events")
    return "\nUNION ALL\n".join(blocks)


@register("data_dictionary", _dictionary_sql())
def q_data_dictionary(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kinds = events.select("event_type").distinct()  # descriptions that repeat, in any order
    texts = kinds.select(F.lit("event_type").alias("varname"), F.concat(F.lit("kind "), "event_type").alias("desc"), F.lit("stream").alias("source"))
    return quality.data_dictionary(events, texts, suppress=["props"])


@register("data_dictionary_sketch", f"""
WITH exact AS ({_dictionary_sql()})
SELECT * EXCLUDE (n_distinct, "desc", source), CASE WHEN n_distinct <= 30 THEN n_distinct END AS n_listed, n_distinct > 30 AS distinct_estimated,
  TRUE AS close FROM exact
""")
def q_data_dictionary_sketch(spark, sf_dir):
    """Q8 in one aggregate: small columns exactly, large ones by estimate (held to a tenth of the exact number)."""
    e = table(spark, sf_dir, "events")
    rows = quality.data_dictionary(e, suppress=("props",), distinct="sketch")
    exact = quality.data_dictionary(e, suppress=("props",)).select("varname", F.col("n_distinct").alias("exact"))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") / 10
    return rows.join(exact, "varname").select(
        "varname", "data_type", "n_rows", "n_null", F.when(~F.col("distinct_estimated"), F.col("n_distinct")).alias("n_listed"),
        "distinct_estimated", "value_counts", "min_value", "max_value", close.alias("close"))


# --------------------------------------------------------------------------
# File manifest (A2-A9) over file names derived from documents.
# --------------------------------------------------------------------------

def document_file_names(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    stems = ["DeathStatF", "DeathLitF", "DeathNamesF", "DeathGeoF", "DeathStatQ", "DeathStat", "harmonized_data"]
    stem = None
    for i, st in enumerate(stems):
        stem = F.when(k % 7 == i, F.lit(st)) if stem is None else stem.when(k % 7 == i, F.lit(st))
    year = F.when(k % 7 == 6, F.lit("")).otherwise(s(F.lit(2010) + k % 13))
    # every 5th file is a spreadsheet; literals files of 2017 exist only as spreadsheets
    xlsx = (k % 5 == 0) | ((k % 7 == 1) & (k % 13 == 7))
    ext = F.when(k % 7 == 6, F.lit(".parquet")).when(xlsx, F.lit(".xlsx")).otherwise(F.lit(".csv"))
    name = F.concat(stem, year, ext)
    return d.select(F.concat(F.lit("/raw/"), F.col("lang"), F.lit("/"), name).alias("file_location"))


_FILES_SQL = """files AS (
  SELECT '/raw/' || lang || '/' ||
         (CASE doc_id % 7 WHEN 0 THEN 'DeathStatF' WHEN 1 THEN 'DeathLitF' WHEN 2 THEN 'DeathNamesF' WHEN 3 THEN 'DeathGeoF'
                          WHEN 4 THEN 'DeathStatQ' WHEN 5 THEN 'DeathStat' ELSE 'harmonized_data' END) ||
         (CASE WHEN doc_id % 7 = 6 THEN '' ELSE CAST(2010 + doc_id % 13 AS VARCHAR) END) ||
         (CASE WHEN doc_id % 7 = 6 THEN '.parquet' WHEN doc_id % 5 = 0 OR (doc_id % 7 = 1 AND doc_id % 13 = 7) THEN '.xlsx' ELSE '.csv' END) AS file_location
  FROM documents),
n AS (SELECT file_location, regexp_extract(file_location, '([^/\\\\]+)$', 1) AS base FROM files),
e AS (SELECT *, regexp_extract(base, '\\.([^.]*)$', 1) AS file_ext FROM n),
st AS (SELECT *, CASE WHEN file_ext = '' THEN base ELSE regexp_replace(base, '\\.[^.]*$', '') END AS stem0 FROM e),
al AS (SELECT *, CASE WHEN stem0 = 'DeathStat2012' THEN 'DeathStatF2012' ELSE stem0 END AS file_name FROM st),
nm AS (SELECT *, CASE WHEN file_ext = '' THEN file_name ELSE file_name || '.' || file_ext END AS full_name FROM al),
cl AS (
  SELECT file_location, file_name, file_ext,
    CASE WHEN contains(full_name, 'Lit') THEN 'Cause of Death Literals' WHEN contains(full_name, 'Names') THEN 'Death Names'
         WHEN contains(full_name, 'Stat') THEN 'Death Statistical' WHEN contains(full_name, 'Geo') THEN 'Death Geographic' END AS file_type,
    CAST(nullif(regexp_extract(full_name, '(20[0-9]{2})', 1), '') AS INTEGER) AS file_year,
    regexp_replace(file_name, 'DeathLit|DeathNames|DeathStat', '') AS status_stem
  FROM nm),
manifest AS (
  SELECT file_type, file_name, file_ext, file_year,
    CASE WHEN file_year <= 2015 THEN 'BEDROCK' WHEN file_year > 2015 THEN 'WHALES' END AS system,
    CASE WHEN file_type IS NOT NULL AND regexp_matches(status_stem, '^F') THEN 'Final' WHEN file_type IS NOT NULL THEN 'Preliminary' END AS file_status,
    file_location
  FROM cl)"""


@register("file_manifest", "WITH " + _FILES_SQL + " SELECT * FROM manifest")
def q_file_manifest(spark, sf_dir):
    return classify_files(document_file_names(spark, sf_dir)).drop("file_modified_date_time")


@register("vintage_selection", "WITH " + _FILES_SQL + """
SELECT system || '_' || CAST(file_year AS VARCHAR) AS vintage_label, * FROM manifest
WHERE file_ext = 'csv' AND file_status = 'Final' AND file_type <> 'Death Names'
""")
def q_vintage_selection(spark, sf_dir):
    return select_vintages(classify_files(document_file_names(spark, sf_dir)).drop("file_modified_date_time"))


@register("csv_gate", "WITH " + _FILES_SQL + """
SELECT file_type, file_year, bool_or(file_ext = 'csv') AS has_csv FROM manifest
WHERE file_type IS NOT NULL GROUP BY file_type, file_year HAVING NOT bool_or(file_ext = 'csv')
""")
def q_csv_gate(spark, sf_dir):
    return missing_csv(classify_files(document_file_names(spark, sf_dir)))


# --------------------------------------------------------------------------
# Final projection (B8) and the flagship harmonization.
# --------------------------------------------------------------------------

@register("final_projection", """
SELECT l_orderkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_extendedprice, l_returnflag, l_linestatus FROM lineitem
""")
def q_final_projection(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    spec = ["l_orderkey", projection.starts_with("L_SHIP"), projection.contains("PRICE"), projection.matches("(flag|status)$"),
            "l_orderkey"]
    out = projection.select_spec(li, spec)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


HARMONIZE_COLUMNS = ["vintage_label", "date_harmonized", "source_system", "order_id", "customer_id", "status", "order_date", "priority"]


def harmonize_orders(spark, sf_dir) -> DataFrame:
    """Flagship: two layouts -> canonical union -> crosswalk recode -> date
    parse -> completeness per year."""
    v = order_vintages(spark, sf_dir)
    v = recode.recode(v, recode_crosswalk_df(spark))
    v = v.withColumn("order_date", parse_date_multi("order_date"))
    return quality.completeness(v, by="file_year")


@register("harmonize_orders", f"""
WITH v AS ({_VINTAGES_SQL}),
c AS (SELECT file_year, count(*) AS n_rows, {', '.join(f'count({c}) AS {c}' for c in HARMONIZE_COLUMNS)} FROM v GROUP BY file_year),
u AS (UNPIVOT c ON {', '.join(HARMONIZE_COLUMNS)} INTO NAME variable VALUE n_complete)
SELECT file_year, variable, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_complete AS BIGINT) AS n_complete,
       CAST(n_complete AS DOUBLE) / n_rows AS pct_complete, variable AS sort_key
FROM u
""")
def q_harmonize_orders(spark, sf_dir):
    return harmonize_orders(spark, sf_dir)


@register("harmonized_values", f"""
WITH {_CW_CTE}, v AS ({_VINTAGES_SQL}),
r AS (
  SELECT v.file_year, coalesce(s.to_code, v.status) AS status, coalesce(p.to_code, v.priority) AS priority,
    strftime(CAST(try_strptime(v.order_date, ['%Y%m%d', '%m/%d/%Y']) AS DATE), '%Y-%m') AS order_month
  FROM v LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'status') s
    ON s.file_year = v.file_year AND s.from_code IS NOT DISTINCT FROM v.status
  LEFT JOIN (SELECT DISTINCT file_year, from_code, to_code FROM cw WHERE variable = 'priority') p
    ON p.file_year = v.file_year AND p.from_code IS NOT DISTINCT FROM v.priority)
SELECT file_year, status, priority, order_month, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY ALL
""")
def q_harmonized_values(spark, sf_dir):
    """The flagship's values after recode and date parse, counted."""
    v = recode.recode(order_vintages(spark, sf_dir), recode_crosswalk_df(spark))
    return v.withColumn("order_month", F.date_format(parse_date_multi("order_date"), "yyyy-MM")).groupBy(
        "file_year", "status", "priority", "order_month").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# The whole cleaning stage (geography, codes, demographics, dates, times,
# types, strings, final projection) on death-record-shaped rows derived from
# orders + customer: one record per order, years shifted to 2012-2018.
# Its DuckDB twin chains the same rules as SQL CTEs (the geography steps are
# shared with the geo_rules oracle); dates are returned as ISO text.
# --------------------------------------------------------------------------

RECORD_YEAR_SHIFT = 17
RECORD_LAYOUT_CUTOVER = 2015

# The columns of the final table that the derivation leaves constant.
_CONSTANT_COLUMNS = {
    "manner": "N", "disposition": "B", "injury_acme_place": None, "injury_at_work": None, "residence_city_limits": "Y",
    "residence_length_type": "Y", "place_of_death_type": "4", "marital_status": "M", "pregnancy": None,
    "armed_forces": "N", "tobacco": "U", "death_facility": None, "autopsy": "N", "certifier_designation": "D",
    "me_coroner_referred": "N", "informant_relationship": "SPOUSE", "injury_description": None, "injury_place": None,
    "date_of_death_modifier": None, "injury_county": None, "residence_county": None, "injury_state": None,
    "injury_county_wa_code": None, "injury_county_fips": None, "time_of_injury": None, "time_of_injury_hour": None,
    "time_of_injury_minutes": None, "date_of_injury": None, "cod_text_other": None, "injury_zip_code": None,
}


def death_records(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    k, ck, nk = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    year = (F.year("o_orderdate") + RECORD_YEAR_SHIFT).cast("int")
    old = year <= RECORD_LAYOUT_CUTOVER
    death = F.add_months(as_date("o_orderdate"), 12 * RECORD_YEAR_SHIFT)
    birth = F.add_months(death, -12 * (ck % 100).cast("int") - (k % 12).cast("int"))

    def fmt(d):
        return F.when(old, F.date_format(d, "yyyyMMdd")).otherwise(F.date_format(d, "MM/dd/yyyy"))

    hour, minute = s(k % 25), s(k % 61)
    cols = {
        "vintage_label": F.concat_ws("_", F.when(old, F.lit("BEDROCK")).otherwise(F.lit("WHALES")), s(year)),
        "date_harmonized": F.lit(AS_OF),
        "source_system": F.when(old, F.lit("BEDROCK")).otherwise(F.lit("WHALES")),
        "file_year": year,
        "state_file_number": s(k), "local_file_number": s(ck),
        "sex": F.when(k % 3 == 0, F.lit("M")).when(k % 3 == 1, F.lit("F")).otherwise(F.lit("U")),
        "date_of_death": fmt(death), "date_of_birth": fmt(birth),
        "date_received": fmt(F.date_add(death, (k % 900).cast("int"))), "disposition_date": fmt(F.date_add(death, 3)),
        "time_of_death_hour": F.when(old, hour), "time_of_death_minutes": F.when(old, minute),
        "time_of_death": F.when(~old, F.concat(F.lpad(hour, 2, "0"), F.lpad(minute, 2, "0"))),
        "underlying_cod_code": F.concat(F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (k % 26 + 1).cast("int"), 1),
                                        s(k % 90 + 10), F.lit("."), s(k % 10)),
        "record_axis_code_1": F.when(k % 2 == 0, F.lit("I21.9")),
        "record_axis_code_2": F.when(k % 3 == 0, F.lit("E11.9")),
        "record_axis_code_10": F.when(k % 5 == 0, F.lit("j44")),
        "residence_county_wa_code": F.when(old, s(nk + 1)), "death_county_wa_code": F.when(old, s(nk % 39 + 1)),
        "residence_county_fips": F.when(~old, F.concat(F.lit("53"), F.lpad(s(nk * 2 + 1), 3, "0"))),
        "death_county_fips": F.when(~old, s(nk * 2 + 1)),
        "residence_state_fips_code": F.when(old, F.lit("48")).when(ck % 5 == 0, F.lit("OR")).otherwise(F.lit("WA")),
        "death_state": F.when(old, F.lit("48")).otherwise(F.lit("WASHINGTON")),
        "age": s(ck % 100), "age_type": F.lit("1"), "age_years": s(ck % 100),
        "hispanic_nchs_bridge": s(k % 7), "race_summary_code": s(k % 6 + 10),
        "race_white": F.when(k % 6 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "race_black": F.when(k % 6 == 1, F.lit("Y")).otherwise(F.lit("N")),
        "race_amer_indian_alaskan": F.when(k % 6 == 2, F.lit("Y")).otherwise(F.lit("N")),
        **{f: F.when(k % 6 == 3, F.lit("Y")).otherwise(F.lit("N")) for f in demographics.ASIAN_FLAGS},
        **{f: F.when(k % 6 == 4, F.lit("Y")).otherwise(F.lit("N")) for f in demographics.NHPI_FLAGS},
        "occupation": F.col("c_mktsegment"),
        "industry": F.when(k % 9 == 0, F.lit("unknown")).otherwise(F.col("o_orderpriority")),
        "residence_length": F.when(k % 4 == 0, F.lit("999")).otherwise(s(ck % 40)),
        "death_zip_code": F.lpad(s(ck % 100000), 5, "0"),
        "residence_zip_code": F.when(k % 8 == 0, F.concat(F.lpad(s(ck % 100000), 5, "0"), F.lit("-0001")))
                               .otherwise(F.lpad(s(ck % 100000), 5, "0")),
        "cod_text_1": F.lower(F.col("c_name")),
    }
    cols.update({name: F.lit(v).cast("string") for name, v in _CONSTANT_COLUMNS.items()})
    return j.select(*[e.alias(n) for n, e in cols.items()])


RECORD_TYPES = {"file_year": "integer", "age_years": "integer", "hispanic": "integer",
                "date_harmonized": "date", "date_of_birth": "date", "date_of_death": "date", "date_of_injury": "date",
                "date_received": "date", "disposition_date": "date", "time_of_death": "time", "time_of_injury": "time"}
RECORD_FACTORS = {"sex": [("M", "Male"), ("F", "Female"), ("U", "Unknown")]}


def cleaned_records(spark, sf_dir):
    from yearweave.plans import workflow
    cfg = workflow.Config(raw_folder="", output_folder="", rename_statistical="", rename_literals="",
                          recode_statistical="", schema="", as_of_date=AS_OF)
    derived, audits = workflow.derive(spark, death_records(spark, sf_dir), cfg)
    listed = [c for c in derived.columns if c not in guards.guard_columns(derived)]
    sch = workflow.schema_table(spark, listed, RECORD_TYPES, RECORD_FACTORS)
    final, more = workflow.finish(derived, cfg, sch)
    audits.update(more)
    return guards.settle(final), audits


# The 84 columns the final projection keeps for these records (FINAL_SPEC applied to them).
RECORD_FINAL_COLUMNS = (
    "date_harmonized", "vintage_label", "source_system", "file_year", "state_file_number", "local_file_number",
    "date_of_birth", "date_of_injury", "date_of_death", "date_of_death_modifier", "date_received", "disposition_date",
    "time_of_death", "time_of_injury", "underlying_cod_code", "all_cod_code", "record_axis_code_1", "record_axis_code_2",
    "record_axis_code_10", "cod_text_1", "cod_text_other", "manner", "disposition", "injury_acme_place", "injury_at_work",
    "injury_description", "residence_city_limits", "residence_county", "residence_county_fips", "residence_state_fips_code",
    "residence_zip_code", "residence_length", "residence_length_type", "injury_place", "injury_county",
    "injury_county_fips", "injury_state", "injury_zip_code", "death_county_fips", "death_state", "death_zip_code",
    "place_of_death_type", "age", "age_type", "age_years", "age_6g", "age_11g", "age_20g", "age_5yr", "sex",
    "marital_status", "pregnancy", "armed_forces", "industry", "occupation", "tobacco", "hispanic_nchs_bridge", "hispanic",
    "race_summary_code", "race_white", "race_black", "race_amer_indian_alaskan", *demographics.ASIAN_FLAGS,
    *demographics.NHPI_FLAGS, "race_ethnicity2", "race6", "race_ethnicity7", "race_asian", "race_nhpi", "race_code",
    "death_facility", "informant_relationship", "autopsy", "certifier_designation", "me_coroner_referred",
)
RECORD_DATE_COLUMNS = ("date_harmonized", "date_of_birth", "date_of_injury", "date_of_death", "date_received", "disposition_date")


def _records_sql() -> str:
    """DuckDB twin of the whole cleaning stage on the same derived records:
    input rows, geography (K1-K12), cause codes, age and race derivations,
    dates (L1-L8), times (M1-M7), types, string rules; dates as ISO text."""
    from yearweave.functions.bins import AGE_CUTS
    from yearweave.plans import workflow
    old = f"CAST(year(o.o_orderdate) + {RECORD_YEAR_SHIFT} AS INTEGER) <= {RECORD_LAYOUT_CUTOVER}"
    k, ck, nk = "o.o_orderkey", "o.o_custkey", "c.c_nationkey"

    def fmt(d):
        return f"CASE WHEN {old} THEN strftime({d}, '%Y%m%d') ELSE strftime({d}, '%m/%d/%Y') END"

    def flag(cond):
        return f"CASE WHEN {cond} THEN 'Y' ELSE 'N' END"

    def text(v):
        return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"

    death = f"CAST(CAST(o.o_orderdate AS DATE) + to_months({12 * RECORD_YEAR_SHIFT}) AS DATE)"
    birth = f"CAST({death} - to_months(CAST(12 * ({ck} % 100) + {k} % 12 AS INTEGER)) AS DATE)"
    hour, minute = f"CAST({k} % 25 AS VARCHAR)", f"CAST({k} % 61 AS VARCHAR)"
    zip5 = f"lpad(CAST({ck} % 100000 AS VARCHAR), 5, '0')"
    cols = {
        "vintage_label": f"(CASE WHEN {old} THEN 'BEDROCK' ELSE 'WHALES' END) || '_' || CAST(CAST(year(o.o_orderdate) + 17 AS INTEGER) AS VARCHAR)",
        "date_harmonized": f"'{AS_OF}'",
        "source_system": f"CASE WHEN {old} THEN 'BEDROCK' ELSE 'WHALES' END",
        "file_year": "CAST(year(o.o_orderdate) + 17 AS INTEGER)",
        "state_file_number": f"CAST({k} AS VARCHAR)", "local_file_number": f"CAST({ck} AS VARCHAR)",
        "sex": f"CASE {k} % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END",
        "date_of_death": fmt(death), "date_of_birth": fmt(birth),
        "date_received": fmt(f"{death} + CAST({k} % 900 AS INTEGER)"), "disposition_date": fmt(f"{death} + 3"),
        "time_of_death_hour": f"CASE WHEN {old} THEN {hour} END", "time_of_death_minutes": f"CASE WHEN {old} THEN {minute} END",
        "time_of_death": f"CASE WHEN NOT ({old}) THEN lpad({hour}, 2, '0') || lpad({minute}, 2, '0') END",
        "underlying_cod_code": f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST({k} % 26 + 1 AS INTEGER), 1) || CAST({k} % 90 + 10 AS VARCHAR) || '.' || CAST({k} % 10 AS VARCHAR)",
        "record_axis_code_1": f"CASE WHEN {k} % 2 = 0 THEN 'I21.9' END",
        "record_axis_code_2": f"CASE WHEN {k} % 3 = 0 THEN 'E11.9' END",
        "record_axis_code_10": f"CASE WHEN {k} % 5 = 0 THEN 'j44' END",
        "residence_county_wa_code": f"CASE WHEN {old} THEN CAST({nk} + 1 AS VARCHAR) END",
        "death_county_wa_code": f"CASE WHEN {old} THEN CAST({nk} % 39 + 1 AS VARCHAR) END",
        "residence_county_fips": f"CASE WHEN NOT ({old}) THEN '53' || lpad(CAST({nk} * 2 + 1 AS VARCHAR), 3, '0') END",
        "death_county_fips": f"CASE WHEN NOT ({old}) THEN CAST({nk} * 2 + 1 AS VARCHAR) END",
        "residence_state_fips_code": f"CASE WHEN {old} THEN '48' WHEN {ck} % 5 = 0 THEN 'OR' ELSE 'WA' END",
        "death_state": f"CASE WHEN {old} THEN '48' ELSE 'WASHINGTON' END",
        "age": f"CAST({ck} % 100 AS VARCHAR)", "age_type": "'1'", "age_years": f"CAST({ck} % 100 AS VARCHAR)",
        "hispanic_nchs_bridge": f"CAST({k} % 7 AS VARCHAR)", "race_summary_code": f"CAST({k} % 6 + 10 AS VARCHAR)",
        "race_white": flag(f"{k} % 6 = 0"), "race_black": flag(f"{k} % 6 = 1"), "race_amer_indian_alaskan": flag(f"{k} % 6 = 2"),
        **{f: flag(f"{k} % 6 = 3") for f in demographics.ASIAN_FLAGS},
        **{f: flag(f"{k} % 6 = 4") for f in demographics.NHPI_FLAGS},
        "occupation": "c.c_mktsegment",
        "industry": f"CASE WHEN {k} % 9 = 0 THEN 'unknown' ELSE o.o_orderpriority END",
        "residence_length": f"CASE WHEN {k} % 4 = 0 THEN '999' ELSE CAST({ck} % 40 AS VARCHAR) END",
        "death_zip_code": zip5,
        "residence_zip_code": f"CASE WHEN {k} % 8 = 0 THEN {zip5} || '-0001' ELSE {zip5} END",
        "cod_text_1": "lower(c.c_name)",
        **{n: text(v) for n, v in _CONSTANT_COLUMNS.items()},
    }
    r0 = ",\n    ".join(f"{e} AS {n}" for n, e in cols.items())

    def icd(x):
        c = f"regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g')"
        return f"CASE WHEN regexp_full_match({c}, '[A-Z][0-9][0-9A-Z]{{1,3}}') THEN {c} END"

    def squish_parse(x):
        sq = f"nullif(regexp_replace(regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'), '')"
        p0 = (f"CAST(coalesce(try_strptime({sq}, '%Y%m%d'), try_strptime({sq}, '%Y-%m-%d'), "
              f"try_strptime({sq}, '%m/%d/%Y'), try_strptime({sq}, '%d%b%Y')) AS DATE)")
        return f"CASE WHEN {p0} > DATE '{AS_OF}' OR year({p0}) <= 1850 THEN NULL ELSE {p0} END"

    def hour_ok(x, lim):
        return f"CASE WHEN TRY_CAST({x} AS DOUBLE) >= {lim} THEN NULL WHEN TRY_CAST({x} AS DOUBLE) < {lim} THEN {x} END"

    def hhmm(t):
        return f"CASE WHEN regexp_full_match({t}, '([01][0-9]|2[0-3])[0-5][0-9]') THEN substr({t}, 1, 2) || ':' || substr({t}, 3, 2) || ':00' END"

    def fix_time(t):
        return f"CASE WHEN (CASE WHEN {t} = '2400' THEN '0000' ELSE {t} END) = '9999' THEN NULL WHEN {t} = '2400' THEN '0000' ELSE {t} END"

    def title(x):
        return f"CASE WHEN {x} IS NULL THEN NULL ELSE " + _TITLE_SQL.replace("{x}", x).replace("{{", "{").replace("}}", "}") + " END"

    def placeholder(x, exact, words=()):
        arms = [f"WHEN {x} IN ({', '.join(repr(v) for v in exact)}) THEN NULL"]
        arms += [f"WHEN regexp_matches({x}, '(?i){w}') THEN NULL" for w in words]
        return f"CASE {' '.join(arms)} ELSE {x} END"

    r6, r7, any_y, bits = _race_parts_sql()
    bins = ", ".join(f"{_bins_sql('age_years', cuts)} AS {name}" for name, cuts in AGE_CUTS.items())
    time_parts = ("time_of_death_hour", "time_of_death_minutes", "time_of_death", "time_of_injury_hour", "time_of_injury_minutes", "time_of_injury")
    sex = "CASE sex " + " ".join(f"WHEN '{v}' THEN '{lab}'" for v, lab in RECORD_FACTORS["sex"]) + " END"
    final = {
        **{d: f"strftime({d}, '%Y-%m-%d')" for d in RECORD_DATE_COLUMNS},
        "sex": sex,
        **{c: title(c) for c in ("informant_relationship", "injury_description", "cod_text_1", "cod_text_other")},
        "industry": placeholder(title("industry"), workflow.OCCUPATION_PLACEHOLDERS, workflow.OCCUPATION_PLACEHOLDER_WORDS),
        "occupation": placeholder(title("occupation"), workflow.OCCUPATION_PLACEHOLDERS, workflow.OCCUPATION_PLACEHOLDER_WORDS),
        **{z: f"CASE WHEN regexp_full_match({z}, '[0-9]{{5}}') THEN {z} END" for z in workflow.ZIP_COLUMNS},
        "injury_place": placeholder("injury_place", workflow.INJURY_PLACE_PLACEHOLDERS),
        "residence_length": placeholder("residence_length", workflow.RESIDENCE_LENGTH_PLACEHOLDERS),
    }
    out = ",\n  ".join(f"{final.get(n, n)} AS {n}" for n in RECORD_FINAL_COLUMNS)
    return f"""
WITH r0 AS (
  SELECT {r0}
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
{_geo_steps_sql('r0')},
c1 AS (SELECT * REPLACE ({icd('underlying_cod_code')} AS underlying_cod_code, {icd('record_axis_code_1')} AS record_axis_code_1,
                         {icd('record_axis_code_2')} AS record_axis_code_2, {icd('record_axis_code_10')} AS record_axis_code_10) FROM g12),
c2 AS (SELECT *, concat_ws(';', underlying_cod_code, record_axis_code_2, record_axis_code_10) AS all_cod_code FROM c1),
a1 AS (SELECT * REPLACE (CASE WHEN age_type = '9' AND age = '999' THEN NULL WHEN NOT (age_type = '9' AND age = '999') THEN age END AS age,
                         CAST(trunc(TRY_CAST(age_years AS DOUBLE)) AS INTEGER) AS age_years) FROM c2),
a2 AS (SELECT * REPLACE (CASE WHEN age_years > 120 THEN NULL WHEN NOT (age_years > 120) THEN age_years END AS age_years) FROM a1),
a3 AS (SELECT *, {bins},
         CASE WHEN hispanic_nchs_bridge = '0' THEN 0 WHEN hispanic_nchs_bridge IN ('1', '2', '3', '4', '5') THEN 1 END AS hispanic,
         {r6} AS race6 FROM a2),
a4 AS (SELECT *, CASE WHEN hispanic = 0 THEN 'Not Hispanic' WHEN hispanic = 1 THEN 'Hispanic' END AS race_ethnicity2,
         {r7} AS race_ethnicity7, {any_y(demographics.ASIAN_FLAGS)} AS race_asian, {any_y(demographics.NHPI_FLAGS)} AS race_nhpi FROM a3),
a5 AS (SELECT *, {bits} AS race_code FROM a4),
d0 AS (SELECT * REPLACE ({", ".join(f"{squish_parse(d)} AS {d}" for d in RECORD_DATE_COLUMNS)}) FROM a5),
d1 AS (SELECT * REPLACE (CASE WHEN date_of_death BETWEEN make_date(file_year, 1, 1) AND make_date(file_year, 12, 31) THEN date_of_death
                              WHEN NOT (date_of_death BETWEEN make_date(file_year, 1, 1) AND make_date(file_year, 12, 31)) THEN NULL END AS date_of_death) FROM d0),
d2 AS (SELECT * REPLACE (CASE WHEN date_of_birth <= date_of_death THEN date_of_birth END AS date_of_birth) FROM d1),
d3 AS (SELECT * REPLACE (CASE WHEN year(date_of_death) - year(date_of_birth)
                                   - CASE WHEN strftime(date_of_death, '%m%d') < strftime(date_of_birth, '%m%d') THEN 1 ELSE 0 END < 120
                              THEN date_of_birth END AS date_of_birth) FROM d2),
d4 AS (SELECT *, CASE WHEN day(CAST(date_of_birth - INTERVAL 9 MONTH AS DATE)) = day(date_of_birth)
                      THEN CAST(date_of_birth - INTERVAL 9 MONTH AS DATE) END AS birth_m9 FROM d3),
d5 AS (SELECT * EXCLUDE (birth_m9) REPLACE (
         CASE WHEN date_of_injury < birth_m9 THEN NULL WHEN date_of_injury > date_of_death THEN NULL ELSE date_of_injury END AS date_of_injury,
         CASE WHEN date_received BETWEEN date_of_death AND make_date(file_year + 2, 12, 31) THEN date_received END AS date_received,
         CASE WHEN disposition_date BETWEEN date_of_death AND make_date(file_year + 2, 12, 31) THEN disposition_date END AS disposition_date)
       FROM d4),
t1 AS (SELECT * REPLACE ({", ".join(f"regexp_replace({t}, '\\p{{P}}', '') AS {t}" for t in time_parts)}) FROM d5),
t2 AS (SELECT * REPLACE ({hour_ok('time_of_death_hour', 24)} AS time_of_death_hour, {hour_ok('time_of_death_minutes', 60)} AS time_of_death_minutes,
                         {hour_ok('time_of_injury_hour', 24)} AS time_of_injury_hour, {hour_ok('time_of_injury_minutes', 60)} AS time_of_injury_minutes) FROM t1),
t3 AS (SELECT * REPLACE ({", ".join(f"{_pad_sql(t, 2)} AS {t}" for t in time_parts if t.endswith(("_hour", "_minutes")))}) FROM t2),
t4 AS (SELECT *,
         CASE WHEN time_of_death_hour IS NOT NULL AND time_of_death_minutes IS NOT NULL THEN time_of_death_hour || time_of_death_minutes
              WHEN time_of_death_hour IS NOT NULL AND time_of_death_minutes IS NULL THEN time_of_death_hour || '00' END AS dp,
         CASE WHEN time_of_injury_hour IS NOT NULL AND time_of_injury_minutes IS NOT NULL THEN time_of_injury_hour || time_of_injury_minutes
              WHEN time_of_injury_hour IS NOT NULL AND time_of_injury_minutes IS NULL THEN time_of_injury_hour || '00' END AS ip FROM t3),
t5 AS (SELECT * REPLACE (coalesce(dp, time_of_death) AS time_of_death, coalesce(ip, time_of_injury) AS time_of_injury) FROM t4),
t6 AS (SELECT * REPLACE ({fix_time('time_of_death')} AS time_of_death, {fix_time('time_of_injury')} AS time_of_injury) FROM t5),
t7 AS (SELECT * REPLACE ({hhmm('time_of_death')} AS time_of_death, {hhmm('time_of_injury')} AS time_of_injury) FROM t6)
SELECT {out}
FROM t7"""


@register("clean_death_records", _records_sql())
def q_clean_death_records(spark, sf_dir):
    final = cleaned_records(spark, sf_dir)[0]
    return final.withColumns({d: iso(d) for d in RECORD_DATE_COLUMNS})


# --------------------------------------------------------------------------
# Sources end to end: whole orders written as messy CSV (quoted blanks, NA,
# tab, newline, quoted comma / doubled quote, zero-width space, NBSP) into
# the session's checkpoint folder and read back as an all-string vintage
# (A10, A11, J1); and a partitioned Parquet round trip.
# --------------------------------------------------------------------------

def scratch_folder(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    import uuid
    from yearweave.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/yearweave-scratch/{name}-{uuid.uuid4().hex}"


def messy_order_strings(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    cause = (F.when(k % 8 == 0, p).when(k % 8 == 1, F.concat(F.lit("  "), p, F.lit(" ")))
             .when(k % 8 == 2, F.concat(p, F.lit("\tx"))).when(k % 8 == 3, F.lit("NA"))
             .when(k % 8 == 4, F.lit("")).when(k % 8 == 5, F.concat(F.lit('a, "b" '), p))
             .when(k % 8 == 6, F.concat(p, F.lit("\nline2")))
             .otherwise(F.concat(F.lit("\u200b"), p, F.lit("\u00a0"))))
    sex = F.when(k % 3 == 0, F.col("o_orderstatus")).when(k % 3 == 1, F.lit(" NA ")).otherwise(null_string())
    return o.select(s(k).alias("CERTNO"), sex.alias("SEX"), cause.alias("CAUSE_A"),
                    F.date_format("o_orderdate", "yyyyMMdd").alias("DTH_DT"))


_CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "true",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_LAYOUT = [("CERTNO", "state_file_number"), ("SEX", "sex"), ("CAUSE_A", "cod_text_1"), ("DTH_DT", "date_of_death")]
CSV_CANONICAL = ["state_file_number", "sex", "date_of_death", "cod_text_1", "time_of_death"]


def _j1_sql(x: str) -> str:
    return _TRIM_SQL.replace("{x}", f"nullif(nullif(regexp_replace({x}, '\\p{{C}}', '', 'g'), ''), 'NA')")


@register("csv_all_string_scan", f"""
WITH m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS certno,
    CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN ' NA ' ELSE NULL END AS sex,
    CASE o_orderkey % 8 WHEN 0 THEN o_orderpriority WHEN 1 THEN '  ' || o_orderpriority || ' '
      WHEN 2 THEN o_orderpriority || chr(9) || 'x' WHEN 3 THEN 'NA' WHEN 4 THEN ''
      WHEN 5 THEN 'a, "b" ' || o_orderpriority WHEN 6 THEN o_orderpriority || chr(10) || 'line2'
      ELSE chr(8203) || o_orderpriority || chr(160) END AS cause,
    strftime(o_orderdate, '%Y%m%d') AS dth
  FROM orders)
SELECT {_j1_sql('certno')} AS state_file_number, {_j1_sql('sex')} AS sex, {_j1_sql('dth')} AS date_of_death,
       {_j1_sql('cause')} AS cod_text_1, CAST(NULL AS VARCHAR) AS time_of_death
FROM m
""")
def q_csv_all_string_scan(spark, sf_dir):
    from yearweave.sources.csv_scan import scan_columns
    folder = scratch_folder(spark, "csv_all_string_scan")
    messy_order_strings(spark, sf_dir).write.options(**_CSV_WRITE).mode("overwrite").csv(folder)
    return scan_columns(spark, [folder], CSV_LAYOUT, CSV_CANONICAL)


# Odd years are written as Windows-1252, even ones as UTF-8; every fifth order has a name with an accent and a euro sign.
_NAME_SQL = "CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority || ' caf' || chr(233) || ' ' || chr(8364) ELSE o_orderpriority END"


def mixed_encodings(spark, sf_dir) -> dict[int, list[str]]:
    """``{year: [folder]}``. Spark writes bytes as ISO-8859-1, in which Windows-1252's euro sign is U+0080."""
    folder = scratch_folder(spark, "mixed_encodings")
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    out = {}
    for (year,) in sorted(map(tuple, o.select("y").distinct().collect())):
        euro, encoding = ("\u0080", "ISO-8859-1") if year % 2 else ("\u20ac", "UTF-8")
        name = F.when(F.col("o_orderkey") % 5 == 0, F.concat("o_orderpriority", F.lit(f" caf\u00e9 {euro}"))).otherwise(F.col("o_orderpriority"))
        rows = o.filter(F.col("y") == year).select(F.col("o_orderkey").alias("KEY"), name.alias("NAME"))
        rows.write.options(**_CSV_WRITE, encoding=encoding).csv(f"{folder}/{year}")
        out[year] = [f"{folder}/{year}"]
    return out


@register("vintage_encodings", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year, CAST(o_orderkey AS VARCHAR) AS certno, {_NAME_SQL} AS name FROM orders
""")
def q_vintage_encodings(spark, sf_dir):
    """Vintages that are not UTF-8 are read in the fallback charset, the others as they are."""
    from yearweave.sources.csv_scan import scan_columns
    parts = [scan_columns(spark, paths, [("KEY", "certno"), ("NAME", "name")], ["certno", "name"], fallback_charset="windows-1252").withColumn(
        "file_year", F.lit(int(year))) for year, paths in mixed_encodings(spark, sf_dir).items()]
    return union_parts(parts, spark)


def union_parts(parts, spark) -> DataFrame:
    """One frame of all parts; of none, an empty one."""
    if not parts:
        return spark.createDataFrame([], "certno string, name string, file_year int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("invalid_bytes", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year,
  CAST(count(*) FILTER (WHERE o_orderkey % 5 = 0 AND year(o_orderdate) % 2 = 1) AS BIGINT) AS n_invalid_lines,
  CAST(2 * count(*) FILTER (WHERE o_orderkey % 5 = 0 AND year(o_orderdate) % 2 = 1) AS BIGINT) AS n_invalid_sequences
FROM orders GROUP BY ALL
""")
def q_invalid_bytes(spark, sf_dir):
    """Bytes that are not UTF-8, counted per vintage."""
    from yearweave.sources.encodings import invalid_bytes_report
    return invalid_bytes_report(spark, mixed_encodings(spark, sf_dir)).groupBy("file_year").agg(
        F.sum("n_invalid_lines").alias("n_invalid_lines"), F.sum("n_invalid_sequences").alias("n_invalid_sequences"))


@register("parquet_roundtrip", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year, CAST(o_orderkey AS VARCHAR) AS state_file_number,
       o_orderstatus AS status, o_totalprice AS total_price
FROM orders WHERE year(o_orderdate) IN (1993, 1996)
""")
def q_parquet_roundtrip(spark, sf_dir):
    from yearweave.sources.parquet import read_harmonized, write_harmonized
    o = table(spark, sf_dir, "orders")
    df = o.select(F.year("o_orderdate").cast("int").alias("file_year"), s("o_orderkey").alias("state_file_number"),
                  F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_price"))
    folder = scratch_folder(spark, "parquet_roundtrip")
    write_harmonized(df, folder)
    return read_harmonized(spark, folder, years=[1993, 1996])


REFRESHED_YEAR = 1997  # refreshed once more, with every third balance gone


def refreshed_orders(spark, sf_dir) -> str:
    """Orders with their customers, all vintages written and one of them refreshed; a refresh that its guard refuses comes last."""
    from yearweave.sources.refresh import refresh
    path = scratch_folder(spark, "refreshed_orders")
    rows = orders_customers_by_year(spark, sf_dir)
    refresh(rows, path)
    gone = F.when(F.col("o_orderkey") % 3 != 0, F.col("c_acctbal"))
    again = rows.filter(F.col("file_year") == REFRESHED_YEAR).withColumn("c_acctbal", gone)
    refresh(again, path, years=[REFRESHED_YEAR])
    try:
        refresh(guards.watch(again.withColumn("o_orderstatus", null_string()), "refused", F.lit(True), F.col("c_mktsegment")), path)
    except guards.GuardViolation:
        pass
    return path


_REFRESHED_SQL = f"""oc AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS file_year, o.o_orderkey, o.o_orderstatus,
         CASE WHEN year(o.o_orderdate) = 1995 AND o.o_custkey % 2 = 0 THEN NULL
           WHEN year(o.o_orderdate) = {REFRESHED_YEAR} AND o.o_orderkey % 3 = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal,
         CASE WHEN year(o.o_orderdate) >= 1999 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
         CASE WHEN year(o.o_orderdate) = 2001 THEN NULL ELSE o.o_orderstatus END AS record_axis_code_3
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


@register("refreshed_vintages", f"WITH {_REFRESHED_SQL} SELECT * FROM oc")
def q_refreshed_vintages(spark, sf_dir):
    """A14 and A15 by vintage: a refresh replaces its vintage alone; one that is refused changes nothing."""
    from yearweave.sources.refresh import read_refreshed
    return read_refreshed(spark, refreshed_orders(spark, sf_dir))


@register("kept_completeness", f"""
WITH {_REFRESHED_SQL},
c AS (SELECT file_year, count(*) AS n_rows, {', '.join(f'count({c}) AS {c}' for c in _OC_COLS)} FROM oc GROUP BY file_year),
u AS (UNPIVOT c ON {', '.join(_OC_COLS)} INTO NAME variable VALUE n_complete)
SELECT file_year, variable, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_complete AS BIGINT) AS n_complete,
       CAST(n_complete AS DOUBLE) / n_rows AS pct_complete, {_sort_key_sql()} AS sort_key
FROM u
""")
def q_kept_completeness(spark, sf_dir):
    """E1 and E2 from counts kept beside the table: a refresh counts its own vintage alone."""
    from yearweave.sources.refresh import kept_completeness
    return kept_completeness(spark, refreshed_orders(spark, sf_dir))


@register("written_reports", """
SELECT o_orderpriority AS priority, CAST(count(*) AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY o_orderpriority DESC) AS BIGINT) AS place
FROM orders GROUP BY o_orderpriority
""")
def q_written_reports(spark, sf_dir):
    """A report written sorted into one file comes back in that order."""
    from yearweave.sources.parquet import write_tables
    report = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    folder = scratch_folder(spark, "written_reports")
    write_tables({"priorities": report}, folder, sort_by={"priorities": [F.desc("priority")]})
    return spark.read.parquet(f"{folder}/priorities").withColumn("place", F.monotonically_increasing_id() + 1)


@register("code_sets", """
SELECT 'nation' AS code_set, CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation
UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
UNION ALL SELECT 'control', CAST(n_nationkey AS VARCHAR), n_name FROM nation
""")
def q_code_sets(spark, sf_dir):
    """A13 (and A12's reader): control tables written as CSV and read back as text."""
    from yearweave.sources.csv_scan import load_control_table
    folder = scratch_folder(spark, "code_sets")
    sources = {"nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name"), "orders": ("o_orderkey", "o_orderpriority")}
    for name, (code, label) in sources.items():
        table(spark, sf_dir, name).select(F.col(code).alias("code"), F.col(label).alias("label")).write.options(
            header="true").csv(f"{folder}/{name}_codes.csv")
    sets = {n: load_control_table(spark, f"{folder}/{n}_codes.csv") for n in sources}
    sets["control"] = load_control_table(spark, f"{folder}/nation_codes.csv", "csv")
    out = None
    for name, codes in sets.items():
        part = codes.select(F.lit(name).alias("code_set"), "code", "label")
        out = part if out is None else out.unionByName(part)
    return out


def write_single_csv(df: DataFrame, path: str) -> None:
    """A control table as one CSV file of exactly this name, as users keep them."""
    from yearweave.operators.guards import replace_folder
    spark = df.sparkSession
    df.coalesce(1).write.options(header="true").csv(f"{path}.parts")
    part = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}.parts").select("path").first()["path"]
    replace_folder(spark, part, path)


@register("code_set_folder", """
SELECT 'nation' AS code_set, CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation
UNION ALL SELECT 'segments', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer
""")
def q_code_set_folder(spark, sf_dir):
    """Every ``*_codes.csv`` of a folder, other files left alone."""
    from yearweave.sources.csv_scan import load_code_sets
    folder = scratch_folder(spark, "code_set_folder")
    for name, source, code, label in (("nation_codes", "nation", "n_nationkey", "n_name"), ("notes", "nation", "n_nationkey", "n_name"),
                                      ("segments_codes", "customer", "c_custkey", "c_mktsegment")):
        write_single_csv(table(spark, sf_dir, source).select(F.col(code).alias("code"), F.col(label).alias("label")), f"{folder}/{name}.csv")
    parts = [d.select(F.lit(name).alias("code_set"), "code", "label") for name, d in sorted(load_code_sets(spark, folder).items())]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0].limit(0)


LISTED_YEARS_SHIFT = 10  # order years 1995-2001 become vintages 2005-2011


@register("listed_vintages", f"""
SELECT 'Death Statistical' AS file_type, 'DeathStatF' || CAST(year(o_orderdate) + {LISTED_YEARS_SHIFT} AS VARCHAR) AS file_name, 'csv' AS file_ext,
  CAST(year(o_orderdate) + {LISTED_YEARS_SHIFT} AS INTEGER) AS file_year, 'BEDROCK' AS system, 'Final' AS file_status,
  CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(o_custkey) AS BIGINT) AS sum_custkey
FROM orders GROUP BY ALL
""")
def q_listed_vintages(spark, sf_dir):
    """A1 to A9 on files that are there: written, listed, classified, selected and scanned."""
    from yearweave.sources import manifest
    from yearweave.sources.csv_scan import scan_columns
    folder = scratch_folder(spark, "listed_vintages")
    o = table(spark, sf_dir, "orders").withColumn("y", (F.year("o_orderdate") + LISTED_YEARS_SHIFT).cast("int"))
    for r in o.select("y").distinct().collect():
        rows = o.filter(F.col("y") == r["y"]).select(F.col("o_custkey").alias("CUST"), F.col("o_orderpriority").alias("NOTE"))
        rows.write.options(**_CSV_WRITE).csv(f"{folder}/DeathStatF{r['y']}.csv")
    files = manifest.select_vintages(manifest.build_manifest(spark, folder))
    out = None
    for year, paths in sorted(manifest.vintage_paths(files).items()):
        found = [p for of_type in paths.values() for p in of_type]
        part = scan_columns(spark, found, [("CUST", "custkey")], ["custkey"]).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("custkey").cast("bigint")).alias("sum_custkey")).withColumn("file_year", F.lit(int(year)))
        out = part if out is None else out.unionByName(part)
    kinds = files.select("file_type", "file_name", "file_ext", "file_year", "system", "file_status").distinct()
    return kinds.join(out, "file_year") if out is not None else kinds.withColumns(
        {"n_rows": F.lit(None).cast("bigint"), "sum_custkey": F.lit(None).cast("bigint")})


@register("written_dictionary", _dictionary_sql())
def q_written_dictionary(spark, sf_dir):
    """The data dictionary as written beside the table."""
    from yearweave.sources.parquet import write_tables
    folder = scratch_folder(spark, "written_dictionary")
    write_tables({"data_dictionary": q_data_dictionary(spark, sf_dir)}, folder, sort_by={"data_dictionary": ["varname"]})
    return spark.read.parquet(f"{folder}/data_dictionary")
