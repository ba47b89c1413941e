"""County / state geography rules (K1-K12), applied in the reference's order.

Each rule is a ``when`` chain whose NULL conditions fall through (case_when
semantics), so the whole block is one projection inside one codegen stage;
the two lookup folds (K2, K4) are literal-map lookups for a county-sized map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearweave.functions.logic import null_string
from yearweave.functions.strings import last_n, pad_left, remove_first
from yearweave.operators.guards import settle
from yearweave.operators.lookup import LookupPair, apply_lookup_pairs, prefetch_lookup

Y = "file_year"

# The county code columns and the state literal the rules test.
WA_CODE_COLUMNS = ("residence_county_wa_code", "death_county_wa_code", "injury_county_wa_code")
HOME_STATE_NAME = "WASHINGTON"
HOME_STATE_ABBREV = "WA"
HOME_STATE_CODE_OLD = "48"   # state code used by vintages 2010-2015
HOME_STATE_FIPS_PREFIX = "53"
OUT_OF_STATE = "00"
UNKNOWN_WA_CODE = "99"


def _in_years(lo: int, hi: int) -> Column:
    return F.col(Y).between(lo, hi)


def k1_pad_wa_codes(df: DataFrame, cols: Sequence[str] = WA_CODE_COLUMNS) -> DataFrame:
    """Pad WA county codes to 2, then the unknown code '99' -> NULL."""
    out = {}
    for c in cols:
        padded = pad_left(c, 2)
        out[c] = F.when(padded == UNKNOWN_WA_CODE, null_string()).otherwise(padded)
    return df.withColumns(out)


def k2_wa_to_fips(df: DataFrame, county_map: DataFrame, column_pairs: Sequence[tuple[str, str, int]], on_unmatched="raise",
                  prefetched=None) -> DataFrame:
    """For each (wa_col, fips_col, threshold): FIPS from the WA code before the threshold year."""
    pairs = [LookupPair(wa, fips, int(thr)) for wa, fips, thr in column_pairs]
    return apply_lookup_pairs(df, pairs, county_map, "county_wa_code", "county_fips_code", Y, on_unmatched,
                              "county code to FIPS", prefetched)


def k3_null_out_of_state(df: DataFrame) -> DataFrame:
    """'00' -> NULL for death/injury FIPS before 2022 and residence FIPS before 2016."""
    def rule(c, before):
        return F.when((F.col(Y) < before) & (F.col(c) == OUT_OF_STATE), null_string()).otherwise(F.col(c))
    return df.withColumns({
        "death_county_fips": rule("death_county_fips", 2022),
        "injury_county_fips": rule("injury_county_fips", 2022),
        "residence_county_fips": rule("residence_county_fips", 2016),
    })


def k4_fips_to_names(df: DataFrame, county_map: DataFrame, literal_pairs: Sequence[tuple[str, str, int]], on_unmatched="raise",
                     prefetched=None) -> DataFrame:
    """For each (fips_col, literal_col, threshold): upper-cased county name before the threshold year."""
    pairs = [LookupPair(f, lit, int(thr), F.upper) for f, lit, thr in literal_pairs]
    return apply_lookup_pairs(df, pairs, county_map, "county_fips_code", "county_fips_label", Y, on_unmatched,
                              "county FIPS to name", prefetched)


def k5_death_fips_last3(df: DataFrame) -> DataFrame:
    c = "death_county_fips"
    return df.withColumn(c, F.when(_in_years(2022, 2023), pad_left(last_n(c, 3), 3)).otherwise(F.col(c)))


def k6_death_state(df: DataFrame) -> DataFrame:
    c = "death_state"
    cond = _in_years(2010, 2015) & (F.col(c) == HOME_STATE_CODE_OLD)
    return df.withColumn(c, F.when(cond, F.lit(HOME_STATE_NAME)).otherwise(F.col(c)))


def k7_residence_out_of_state(df: DataFrame) -> DataFrame:
    c = "residence_county_fips"
    cond = (F.col(Y) >= 2016) & (F.col("residence_state_fips_code") != HOME_STATE_ABBREV)
    return df.withColumn(c, F.when(cond, F.lit(OUT_OF_STATE)).otherwise(F.col(c)))


def k8_residence_pad(df: DataFrame) -> DataFrame:
    c = "residence_county_fips"
    cond = (F.col(Y) >= 2016) & (F.col(c) != OUT_OF_STATE)
    return df.withColumn(c, F.when(cond, pad_left(c, 3)).otherwise(F.col(c)))


def k9_residence_strip_state(df: DataFrame) -> DataFrame:
    c = "residence_county_fips"
    return df.withColumn(c, F.when(_in_years(2016, 2023), remove_first(c, "^" + HOME_STATE_FIPS_PREFIX)).otherwise(F.col(c)))


def k10_residence_state(df: DataFrame) -> DataFrame:
    c = "residence_state_fips_code"
    cond = _in_years(2010, 2015) & (F.col(c) == HOME_STATE_CODE_OLD)
    return df.withColumn(c, F.when(cond, F.lit(HOME_STATE_ABBREV)).otherwise(F.col(c)))


def k11_injury_fips(df: DataFrame) -> DataFrame:
    c, st, co = "injury_county_fips", F.col("injury_state"), F.col("injury_county")
    yrs = _in_years(2022, 2023)
    first = (
        F.when(yrs & st.isNull() & co.isNull(), null_string())
        .when(yrs & (st == HOME_STATE_NAME) & co.isNull(), null_string())
        .when(yrs & (st != HOME_STATE_NAME), F.lit(OUT_OF_STATE))
        .otherwise(F.col(c))
    )
    df = df.withColumn(c, first)
    return df.withColumn(c, F.when(yrs & (F.col(c) != OUT_OF_STATE), pad_left(last_n(c, 3), 3)).otherwise(F.col(c)))


def k12_injury_fips_recent(df: DataFrame) -> DataFrame:
    c = "injury_county_fips"
    cond = (F.col(Y) > 2023) & (F.col("injury_state") != HOME_STATE_NAME)
    return df.withColumn(c, F.when(cond, F.lit(OUT_OF_STATE)).otherwise(F.col(c)))


def clean_geography(
    df: DataFrame,
    county_map: DataFrame,
    column_pairs: Sequence[tuple[str, str, int]],
    literal_pairs: Sequence[tuple[str, str, int]],
    on_unmatched: str = "raise",
) -> DataFrame:
    """All geography rules K1-K12 in order; later rules see earlier results. ``on_unmatched`` as for the lookups: with
    ``"raise"`` the guards of both folds are settled together, after the last rule."""
    rows = prefetch_lookup(county_map)  # a county-sized map is read once for both folds
    raises = on_unmatched == "raise"
    on_unmatched = "observe" if raises else on_unmatched
    df = k1_pad_wa_codes(df)
    df = k2_wa_to_fips(df, county_map, column_pairs, on_unmatched, rows)
    df = k3_null_out_of_state(df)
    df = k4_fips_to_names(df, county_map, literal_pairs, on_unmatched, rows)
    for rule in (k5_death_fips_last3, k6_death_state, k7_residence_out_of_state, k8_residence_pad,
                 k9_residence_strip_state, k10_residence_state, k11_injury_fips, k12_injury_fips_recent):
        df = rule(df)
    return settle(df) if raises else df


def county_map_from_rule(spark, n_counties: int = 39) -> DataFrame:
    """A county map shaped like the reference's code set, generated by its rule:
    '00' -> '00' (out of state / unknown), else WA code n -> FIPS ``2n-1`` padded to 3.
    Labels are synthetic ("COUNTY 01"), for tests and the driver queries."""
    codes = spark.range(0, n_counties + 1).select(F.col("id").cast("int").alias("n"))
    wa = F.lpad(F.col("n").cast("string"), 2, "0")
    fips = F.when(F.col("n") == 0, F.lit(OUT_OF_STATE)).otherwise(F.lpad((F.col("n") * 2 - 1).cast("string"), 3, "0"))
    label = F.when(F.col("n") == 0, F.lit("Non-State or Unknown")).otherwise(F.concat(F.lit("County "), wa))
    return codes.select(
        wa.alias("county_wa_code"), label.alias("county_wa_label"), fips.alias("county_fips_code"), label.alias("county_fips_label")
    )
