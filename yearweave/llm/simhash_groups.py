"""Near-duplicate documents by SimHash fingerprints that differ in few bits.

Linking embeds a fingerprint as the bit counts of its 32 two-bit segments. The Manhattan distance of
two embeddings never exceeds the Hamming distance of the fingerprints, so a range join under it finds
every link. Its grid: the segments form ``blocks`` axes groups; of two embeddings at distance r or less, at
least ``blocks - r`` groups agree wholly, so equal cells over some choice of groups meet every pair.
A cell's pairs are held against the Manhattan bound first, then against the exact bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Groups of segments the grid is made of.
BLOCKS = 8
#: Members of a cell that are compared in one task; larger cells are cut into pairs of tiles.
TILE = 8192


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """A-Z in lower case, words between white space, each shingle's XXH64: a bit is set if more than half set it."""
    words = text.lower().split()  # of bytes: ASCII letters, and white space 0x20 and 0x09 to 0x0d
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, k = ends - lengths, min(shingle_words, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[:len(words) - k].tolist(), ends[k:].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, columns: list[str], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``columns`` and ``fp long`` (the 64 bits, signed), one row per input row; a null text counts as empty: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py() or b"", shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*columns, "fp"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, F.col("text").cast("string").alias("__text")).mapInArrow(run, f"{kinds}, fp long")


def _star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n indices reaches over the edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_edges = label[a] != label[b]
        a, b = a[open_edges], b[open_edges]
    return label


def _link_cells(fp: np.ndarray, counts: np.ndarray, cell: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within cells: never more than the members. ``cell`` is sorted."""
    found_a, found_b, held = [], [], 0
    label = np.arange(len(fp))
    at = np.arange(len(fp) - 1)
    gap = 1
    while len(at := at[at + gap < len(fp)]) and len(at := at[cell[at] == cell[at + gap]]):
        to = at + gap
        near = np.bitwise_count(counts[at] ^ counts[to]) <= max_bits  # the Manhattan distance of the embeddings
        a, b = at[near], to[near]
        linked = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        found_a.append(a[linked])
        found_b.append(b[linked])
        held += len(found_a[-1])
        if held > 1 << 20:
            label = _star(len(fp), np.concatenate([*found_a, np.arange(len(fp))]), np.concatenate([*found_b, label]))
            found_a, found_b, held = [], [], 0
        gap += 1
    label = _star(len(fp), np.concatenate([*found_a, np.arange(len(fp))]), np.concatenate([*found_b, label]))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` that connect distinct fingerprints (column ``fp``) as all links of ``max_bits`` bits do.

    Each fingerprint goes to one cell for every choice of groups. Cells over ``TILE`` members are cut:
    members fall into tiles by hash, and every pair of tiles is compared in a task of its own.
    """
    low = F.lit(0x5555555555555555).cast("long")
    upper = F.shiftrightunsigned("fp", 1)
    # a two-bit segment's count in unary (0: 00, 1: 01, 2: 11): the Manhattan distance is then the bits that differ
    unary = F.col("fp").bitwiseOR(upper).bitwiseAND(low).bitwiseOR(
        F.shiftleft(F.col("fp").bitwiseAND(upper).bitwiseAND(low), 1))
    width = 64 // BLOCKS
    masks = [sum(((1 << width) - 1) << (width * k) for k in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    members = distinct.select("fp", unary.alias("counts")).select(
        "fp", "counts", F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "cell"))
    large = members.groupBy("choice", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > TILE).select(
        "choice", "cell", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiled = members.join(large, ["choice", "cell"], "left").select(
        "fp", "counts", "choice", "cell",
        F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(
            F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                        lambda t: F.least(t, own) * F.col("tiles") + F.greatest(t, own)))).alias("tile"))
    place = F.xxhash64("choice", "cell", "tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # place, fp and counts of members whose cell may go on in the next batch

        def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _link_cells(rows[1].view(np.uint64), rows[2].view(np.uint64), rows[0], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                rows = [np.concatenate(both) for both in zip(held, rows)]
            if len(rows[0]):
                cut = np.searchsorted(rows[0], rows[0][-1])
                yield linked([c[:cut] for c in rows])
                held = [c[cut:] for c in rows]
        if held:
            yield linked(held)

    dealt = tiled.select(place.alias("place"), "fp", "counts").repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(run, "a long, b long")


def with_components(fps: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``component_id``, the smallest id that a row reaches over links. ``fps`` has the id and ``fp``."""
    distinct = stage(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    roots = connected_components(links(distinct, max_bits))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    # few fingerprints have links: only theirs go through the join over roots
    named = linked.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, one row per input row.

    Null and empty texts have fingerprint zero, which is linked like any other. A null id is
    larger than any; a component of null ids alone has a null component_id. Repeated rows share
    a fingerprint. Only ``doc_id`` and ``text`` are read, so other columns' names do no harm.
    """
    fps = stage(with_fingerprints(docs, ["doc_id"]), "simhash")
    return with_components(fps).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """One document of each component stays, that of the smallest id (of rows that repeat it, one); all columns kept."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in names.items()], "text", F.monotonically_increasing_id().alias("__row"))
    rows = stage(with_fingerprints(rows, [*names.values(), "__row"]), "simhash-rows")
    fps = rows.select(F.col(names["doc_id"]).alias("doc_id"), "__row", "fp")
    grouped = with_components(fps)
    kept = grouped.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("__alone")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("__first")).select("__first.__row")
    return rows.join(kept, "__row").select(*[F.col(n).alias(c) for c, n in names.items()])
