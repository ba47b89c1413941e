"""K-d tree partitioning of a table into shards of near equal bytes, from DataFrame operations alone.

A node of the tree splits at the weighted median of its widest metadata dimension, until a leaf
holds the target bytes. Medians are exact to a tolerance and found without sorting: each round
sums the bytes of a node's rows over a histogram of the order key, keeps the bin in which the
median falls, and looks closer. Ties on a dimension go on by text hash. A cut falls between groups of
equal texts, at the nearer edge, if the group at the median holds at most ``GROUP_SHARE`` of a shard; a
larger group is cut for balance, by a hash of its rows' places, so that equal rows part as well.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

_DIM_BITS, _TEXT_BITS, _ID_BITS = 20, 18, 20
_KEY_BITS = _DIM_BITS + _TEXT_BITS + _ID_BITS
#: Histogram rows that one round brings to the driver, at most.
HISTOGRAM_ROWS = 1 << 18
#: A median is settled once the bin that holds it has this share of the node's bytes.
TOLERANCE = 1e-4
#: A group of equal texts of up to this share of a shard's bytes is never cut.
GROUP_SHARE = 0.1
#: Independent windows in which a shard's slots are numbered.
SLOT_WINDOWS = 256


@dataclass
class _Node:
    """``leaves`` leaves from ``first`` on; the cut lies in [low, low + 2**bits) and wants ``rest`` bytes below."""

    first: int
    leaves: int
    dim: int = 0
    weight: int = 0
    rest: float = 0.0
    low: int = 0
    bits: int = _KEY_BITS
    settled: bool = False


def _ordinal(df: DataFrame, col: str) -> Column:
    """A metadata column as a number: numeric as it is, text by hash; null is 0."""
    kind = df.schema[col].dataType.typeName()
    value = F.col(col).cast("double") if kind not in ("string", "char", "varchar") else F.xxhash64(col).cast("double")
    return F.when(F.isnan(value) | value.isNull(), 0.0).otherwise(value)


def kd_shards(
    df: DataFrame, size: Column, text_hash: Column, id_col: str, dims: list[str], *,
    leaves: int | None = None, target_bytes: int | None = None, keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Give every row a ``shard`` (0 to leaves - 1) and a gapless ``slot`` in it.

    Name the number of ``leaves``, or ``target_bytes`` for as many as the total takes. Returns
    ``id_col``, ``size``, the ``keep`` columns, ``shard`` and ``slot``, one row per input row. Null
    dimension values sort as 0; an empty table gives an empty result; there may be fewer rows than leaves, then some shards stay empty. Columns not
    named are not read, so clashing names do no harm. Only node tables (``leaves`` rows) are broadcast.
    """
    keep = keep or {}
    rows = stage(df.select(
        F.col(id_col), size.cast("long").alias("size"), *[c.alias(n) for n, c in keep.items()],
        F.array(*[_ordinal(df, d) for d in dims]).alias("__at"),
        ((F.abs(text_hash % (1 << _TEXT_BITS)) * (1 << _ID_BITS))
         + F.abs(F.xxhash64(F.col(id_col), F.monotonically_increasing_id()) % (1 << _ID_BITS))).alias("__tie"),  # settled by staging
    ), "kd-rows")
    bounds = rows.agg(
        F.sum("size").alias("bytes"),
        *[f(F.col("__at")[i]).alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("low", F.min), ("high", F.max))],
    ).first()
    total = bounds["bytes"] or 0
    if leaves is None:
        leaves = max(1, math.ceil(total / target_bytes))
    scale = [(bounds[f"low{i}"] or 0.0, (bounds[f"high{i}"] or 0.0) - (bounds[f"low{i}"] or 0.0)) for i in range(len(dims))]
    top = float((1 << _DIM_BITS) - 1)
    at = F.array(*[
        F.floor((F.col("__at")[i] - low) / width * top).cast("long") if width else F.lit(0).cast("long")
        for i, (low, width) in enumerate(scale)])
    placed = rows.withColumn("__at", at).withColumn("shard", F.lit(0))
    nodes = [_Node(0, leaves)] if total else []
    while open_nodes := [n for n in nodes if n.leaves > 1]:
        _choose_dimensions(placed, open_nodes, len(dims))
        keyed = placed.join(F.broadcast(_table(df, open_nodes, "dim")), "shard").withColumn("__key", _key())
        while unsettled := [n for n in open_nodes if not n.settled]:
            _refine(keyed, unsettled)
        cuts = F.broadcast(_table(df, open_nodes, "dim", "low", "leaves"))
        below = F.col("dim").isNull() | (_key() < F.col("low"))
        placed = placed.join(cuts, "shard", "left").withColumn(
            "shard", F.when(below, F.col("shard")).otherwise(F.col("shard") + F.floor(F.col("leaves") / 2)).cast("int"),
        ).drop("dim", "low", "leaves")
        nodes = [child for n in open_nodes for child in (
            _Node(n.first, n.leaves // 2), _Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2))]
    return _slots(placed.select(id_col, "size", *keep, "shard", "__tie"), id_col)


def _key() -> Column:
    return F.element_at("__at", F.col("dim") + 1) * (1 << (_TEXT_BITS + _ID_BITS)) + F.col("__tie")


def _table(df: DataFrame, nodes: list[_Node], *fields: str) -> DataFrame:
    rows = [{"shard": n.first, **{f: getattr(n, f) for f in fields}} for n in nodes]
    return _rows(df, rows, "shard int, " + ", ".join(f"{f} long" if f in ("low", "high") else f"{f} int" for f in fields))


def _rows(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """A small table from driver values, made by a JVM expression (a local list would start Python workers)."""
    kind = "array<struct<" + schema.replace(" ", ":").replace(",:", ",") + ">>"
    return df.sparkSession.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def _choose_dimensions(placed: DataFrame, nodes: list[_Node], n_dims: int) -> None:
    """The widest dimension of each node (the first of equals), and the bytes its left part should get."""
    widths = [F.max(F.col("__at")[i]) - F.min(F.col("__at")[i]) for i in range(n_dims)]
    stats = {r["shard"]: r for r in placed.groupBy("shard").agg(
        F.sum("size").alias("bytes"), F.array(*widths).alias("widths")).collect()}
    for n in nodes:
        if n.first in stats:
            r = stats[n.first]
            n.dim, n.weight = r["widths"].index(max(r["widths"])), r["bytes"]
            n.rest = n.weight * (n.leaves // 2) / n.leaves
        else:
            n.settled = True  # no rows


def _refine(keyed: DataFrame, nodes: list[_Node]) -> None:
    """One look closer: the bin of each node's key range in which its median lies."""
    step = max(1, min(10, (HISTOGRAM_ROWS // len(nodes)).bit_length() - 1))
    shifts = {n.first: max(n.bits - step, _ID_BITS if n.bits > _ID_BITS else 0) for n in nodes}  # one round ends at whole groups
    ranges = _rows(keyed, [
        {"shard": n.first, "__low": n.low, "__high": n.low + (1 << n.bits), "__shift": shifts[n.first]}
        for n in nodes], "shard int, __low long, __high long, __shift int")
    histogram = (
        keyed.join(F.broadcast(ranges), "shard")
        .filter((F.col("__key") >= F.col("__low")) & (F.col("__key") < F.col("__high")))
        .groupBy("shard", F.expr("shiftright(__key - __low, __shift)").cast("int").alias("bin"))
        .agg(F.sum("size").alias("bytes")).collect())
    bins: dict[int, list[tuple[int, int]]] = {}
    for shard, b, weight in histogram:
        bins.setdefault(shard, []).append((b, weight))
    for n in nodes:
        shift = shifts[n.first]
        whole = GROUP_SHARE * n.weight / n.leaves if shift == _ID_BITS else 0  # the bin is one group
        for b, weight in sorted(bins[n.first]):
            if weight >= n.rest:
                n.low, n.bits = n.low + (b << shift), shift
                if shift == 0 or weight <= max(TOLERANCE * n.weight, whole):
                    n.settled = True
                    n.low += (1 << shift) * (n.rest > weight / 2)  # the nearer edge of the bin
                break
            n.rest -= weight
        else:
            n.settled = True


def _slots(placed: DataFrame, id_col: str) -> DataFrame:
    """Gapless slots: numbered in hashed windows of a shard, then moved up by the rows of the windows before."""
    others = [c for c in placed.columns if c not in ("shard", "__tie")]
    rows = placed.withColumn("__window", F.pmod(F.xxhash64("__tie"), F.lit(SLOT_WINDOWS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("__window").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "__window").agg(F.count("*").alias("__n")).select(
        "shard", "__window", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__window").orderBy(id_col, "__tie")
    return (
        rows.withColumn("slot", F.row_number().over(within).cast("long") - 1)
        .join(starts, ["shard", "__window"])
        .select(*others, "shard", (F.col("slot") + F.col("__start")).alias("slot")))


def document_shards(docs: DataFrame, leaves: int = 16, dims: tuple[str, ...] = ("n_chars", "lang")) -> DataFrame:
    """Shards of documents by UTF-8 bytes of the text plus one (a null text has none), over their metadata.

    The default dimensions are the ones that equal texts share: a group of copies stays in one
    shard unless it is larger than ``GROUP_SHARE`` of one and a cut for equal bytes falls inside it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "text", *[d for d in dims if d not in ("doc_id", "text")])
    return kd_shards(
        rows, size=F.octet_length(text) + 1, text_hash=F.xxhash64(text), id_col="doc_id", dims=list(dims),
        leaves=leaves, keep={"text_crc32": F.crc32(text.cast("binary"))},
    ).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
