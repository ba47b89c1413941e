"""Crosswalk-driven recoding of coded variables, all vintages at once.

Semantics kept from the reference: per (file_year, variable) the value equal
to ``from_code`` (NULL matches NULL) becomes ``coalesce(to_code, value)`` - a
recode to NULL is impossible; variables missing from the data are skipped;
an ambiguous crosswalk (one ``from_code`` with two ``to_code``) raises.

The crosswalk is prepared once, in Spark: years, codes and values are compared as
text in one form, ambiguity is one aggregate. Then the caller's ``strategy``
applies it. ``"map"``: one Column expression per variable, a literal map per
group of years sharing the same codes (no join, no exchange). ``"join"``: one
equi-join per variable on (year, code). ``"year"``: the crosswalk as one row per year that
holds every variable's codes, joined once whatever the number of variables. All give equal rows.
"""

from __future__ import annotations

import logging
import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearweave.operators._common import check_strategy, whole_number_text
from yearweave.operators.crosswalk import validate_recode_crosswalk
from yearweave.session import ensure_checkpoint_dir

log = logging.getLogger("yearweave")

# A control character (removed from real values by text normalization) that
# starts the join-key salt of NULL values: it can never equal a crosswalk code.
_SALT_PREFIX = "\u0000"


def codes_once(cw: DataFrame) -> DataFrame:
    """The crosswalk's different codes as text, written to the session's shared folder and read back.

    A crosswalk may be a query over all data; what recode asks of it (ambiguity, variables, size, codes) are several jobs,
    which read these rows instead of working it out again. Equal rows are combined by hash before the shuffle.
    """
    codes = cw.select(*[F.col(c).cast("string").alias(c) for c in ("file_year", "variable", "from_code", "to_code")]).distinct()
    path = f"{ensure_checkpoint_dir(cw.sparkSession)}/recode-codes-{uuid.uuid4().hex}"
    codes.write.parquet(path)
    return cw.sparkSession.read.schema(codes.schema).parquet(path)


def prepared_crosswalk(cw: DataFrame) -> DataFrame:
    """One row per (file_year, variable, from_code), all text; where codes are ambiguous, the least ``to_code``."""
    text = cw.select(
        whole_number_text(F.col("file_year")).alias("file_year"), F.col("variable").cast("string").alias("variable"),
        F.col("from_code").cast("string").alias("from_code"), F.col("to_code").cast("string").alias("to_code"))
    return text.groupBy("file_year", "variable", "from_code").agg(F.min("to_code").alias("to_code"))


def recode_expression(value: Column, year: Column, pairs) -> Column:
    """``coalesce(mapped, value)``: a literal map per group of years that share
    the same codes, chosen by a test on the year, plus a per-year arm
    for the NULL code (map keys cannot be NULL).

    Spark looks a key up in a literal map by scanning its entries, so one map
    keyed by ``year|value`` would cost (years x codes) string compares per
    row; grouping by year costs at most (groups) int compares + (codes)
    string compares, and needs no key concatenation.
    """
    by_year, null_arm = defaultdict(dict), {}
    for p in pairs:
        if p["file_year"] is None:
            continue  # a crosswalk row without a year applies to no row
        if p["from_code"] is None:
            null_arm[p["file_year"]] = p["to_code"]
        else:
            by_year[p["file_year"]][p["from_code"]] = p["to_code"]
    groups = defaultdict(list)  # identical code mappings share one map
    for y, mapping in sorted(by_year.items()):
        groups[tuple(sorted(mapping.items()))].append(y)
    mapped = None
    for items, years in groups.items():
        cond = year == F.lit(years[0]) if len(years) == 1 else year.isin(years)
        m = F.create_map(*[F.lit(x) for kv in items for x in kv])
        arm = F.try_element_at(m, value)
        mapped = F.when(cond, arm) if mapped is None else mapped.when(cond, arm)
    if null_arm:
        arm = None
        for y, to in sorted(null_arm.items()):
            cond = value.isNull() & (year == F.lit(y))
            arm = F.when(cond, F.lit(to)) if arm is None else arm.when(cond, F.lit(to))
        mapped = arm if mapped is None else F.coalesce(arm, mapped)
    return value if mapped is None else F.coalesce(mapped, value)


#: A year's codes are dealt by hash into maps of about this many entries, since Spark looks a key up by scanning its map.
CODES_PER_MAP = 4
#: Crosswalks of up to so many bytes of codes are broadcast by ``strategy="year"``.
BROADCAST_BYTES = 16 << 20


def _slot(code: Column, maps: Column) -> Column:
    return F.pmod(F.xxhash64(code), maps.cast("long")).cast("int")


def year_table(pairs: DataFrame, variables: list[str]) -> DataFrame:
    """One row per ``__rc_year``; columns ``__rc_0``, ``__rc_1``... hold the codes of ``variables`` in that year.

    Such a column is ``struct<maps array<map>, missing>``: the map at the place of a code's hash leads from codes to
    new codes; ``missing`` is the new code of NULL. It is NULL where a variable has no row in that year.
    """
    codes = pairs.filter(F.col("file_year").isNotNull() & F.col("to_code").isNotNull())
    of = ["file_year", "variable"]
    sizes = codes.groupBy(*of).agg(
        F.ceil(F.greatest(F.count("from_code"), F.lit(1)) / CODES_PER_MAP).cast("int").alias("maps"),
        F.max(F.when(F.col("from_code").isNull(), F.col("to_code"))).alias("missing"))
    entries = codes.filter(F.col("from_code").isNotNull()).join(sizes, of).groupBy(
        *of, _slot(F.col("from_code"), F.col("maps")).alias("slot")).agg(
        F.collect_list(F.struct("from_code", "to_code")).alias("entries"))
    slots = sizes.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("maps") - 1)))
    none = F.array().cast("array<struct<from_code:string,to_code:string>>")
    dealt = slots.join(entries, [*of, "slot"], "left").groupBy(*of).agg(
        F.max("missing").alias("missing"),
        F.sort_array(F.collect_list(F.struct("slot", F.coalesce("entries", none).alias("entries")))).alias("slots"))
    held = F.struct(F.transform("slots", lambda m: F.map_from_entries(m["entries"])).alias("maps"), F.col("missing"))
    return dealt.withColumn("held", held).groupBy(F.col("file_year").alias("__rc_year")).agg(
        *[F.first(F.when(F.col("variable") == v, F.col("held")), ignorenulls=True).alias(f"__rc_{i}") for i, v in enumerate(variables)])


def _recode_by_year(df: DataFrame, pairs: DataFrame, year: Column, variables: list[str]) -> DataFrame:
    """One join with the table of years. A table under ``BROADCAST_BYTES`` is broadcast; a larger one is repeated under
    as many salts as there are shuffle partitions, and each row's hash is dealt one, so that a year's rows spread over all tasks
    (rows equal in all columns share one; adaptive execution splits such a task, as its other side is one row a year)."""
    table = year_table(pairs, variables)
    size = pairs.agg(F.sum(F.octet_length(F.concat_ws("", "from_code", "to_code")) + 32).alias("n")).first()["n"] or 0
    keyed = df.withColumn("__rc_row_year", year)
    if size <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(table), F.col("__rc_row_year") == F.col("__rc_year"), "left")
    else:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hashable = [F.col(c) for c, t in df.dtypes if "map<" not in t]
        keyed = keyed.withColumn("__rc_row_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
        salted = table.withColumn("__rc_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = keyed.join(salted, (F.col("__rc_row_year") == F.col("__rc_year")) & (F.col("__rc_row_salt") == F.col("__rc_salt")), "left")
    out = {}
    for i, v in enumerate(variables):
        text, held = F.col(v).cast("string"), F.col(f"__rc_{i}")
        found = F.try_element_at(F.get(held["maps"], _slot(text, F.size(held["maps"]))), text)
        out[v] = F.coalesce(F.when(text.isNull(), held["missing"]).otherwise(found), text)
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])


def recode(
    df: DataFrame,
    cw: DataFrame,
    year_col: str = "file_year",
    validate: bool = True,
    strategy: str = "map",
) -> DataFrame:
    """Recode every crosswalk variable present in ``df`` for all years in one pass.

    Recoded variables become text, whatever they were. ``validate=False`` takes the least of
    several targets of a code instead of raising. ``strategy`` is how, never what: see the module. ``"join"`` and
    ``"year"`` keep the crosswalk's codes in the folder that ``spark.checkpoint.dir`` names.
    """
    check_strategy(strategy, ("map", "join", "year"))
    if strategy != "map":
        cw = codes_once(cw)
    if validate:
        validate_recode_crosswalk(cw)
    prepared = prepared_crosswalk(cw)
    if strategy == "map":
        rows = [r.asDict() for r in prepared.collect()]
        variables = sorted({r["variable"] for r in rows})
    else:
        variables = sorted(r["variable"] for r in prepared.select("variable").distinct().collect())
    present = [v for v in variables if v in df.columns]
    for v in sorted(set(variables) - set(present)):
        log.info("recode: no column %s in the data; its crosswalk rows are not used", v)
    if not present:
        return df
    year = whole_number_text(F.col(year_col))
    text = {v: F.col(v).cast("string") for v in present}
    pairs = prepared.filter(F.col("to_code").isNotNull())  # coalesce(NULL, value) keeps the value
    if strategy == "map":
        of = defaultdict(list)
        for r in rows:
            if r["to_code"] is not None:
                of[r["variable"]].append(r)
        return df.withColumns({v: recode_expression(text[v], year, of[v]) for v in present})

    if strategy == "year":
        return _recode_by_year(df, pairs, year, present)

    # One join per variable on (year, code). The NULL code (at most one target per year and variable) is an
    # expression; in the join key a NULL value or year is a per-row salt that matches nothing, so such
    # rows spread over all tasks of a shuffle join instead of sharing one hash key.
    null_rows = defaultdict(list)
    for r in pairs.filter(F.col("from_code").isNull()).collect():
        null_rows[r["variable"]].append(r.asDict())
    hashable = [c for c, t in df.dtypes if not t.startswith(("map", "array", "struct"))]
    salt = F.concat(F.lit(_SALT_PREFIX), F.xxhash64(*[df[c] for c in hashable]).cast("string"))
    df = df.withColumns({"__rc_row_year": F.coalesce(year, salt), "__rc_salt": salt})
    for v in present:
        codes = pairs.filter((F.col("variable") == v) & F.col("from_code").isNotNull()).select(
            F.col("file_year").alias("__rc_year"), F.col("from_code").alias("__rc_from"), F.col("to_code").alias("__rc_to"))
        key = F.coalesce(df[v].cast("string"), df["__rc_salt"])
        df = df.join(codes, (df["__rc_row_year"] == codes["__rc_year"]) & (key == codes["__rc_from"]), "left")
        value = F.coalesce(F.col("__rc_to"), F.col(v).cast("string"))
        if null_rows[v]:
            null_code = recode_expression(F.lit(None).cast("string"), F.col("__rc_row_year"), null_rows[v])
            value = F.when(F.col(v).isNull(), null_code).otherwise(value)
        df = df.withColumn(v, value).drop("__rc_year", "__rc_from", "__rc_to")
    return df.drop("__rc_row_year", "__rc_salt")
