"""Exact substring de-duplication by bounded interval expansion on a Burrows-Wheeler transform.

Every run of ``LENGTH`` bytes (a window) that starts anywhere else as well is removed. The work is dealt
out by content: a window's anchor is the least-hashed of its ``ANCHOR``-byte substrings (the leftmost of
equals), so equal windows have equal anchors at equal places. Neighbouring windows with one anchor form a
segment. An anchor seen once holds no repeat. Segments that repeat as a whole are settled by counting;
where an anchor stands in different segments, these go to a task together. There a Burrows-Wheeler
transform of the segments is expanded breadth-first: all intervals of strings one byte longer come from
backward extension of the present ones, boundaries between suffixes get their common-prefix length in
increasing order, and the expansion stops at ``LENGTH``: boundaries left open join equal windows.

An anchor in very many different segments (the edge of a passage that many documents share) would
be one large task; its windows are told apart by content hash instead, in a pre-aggregated count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

LENGTH, ANCHOR = 200, 32
#: Different segments of one key that go to one task; bytes of segments that are expanded together.
KEY_SEGMENTS, TOGETHER_BYTES = 1024, 1 << 17
#: Windows that are hashed at a time, whatever the length of a text.
PIECE = 1 << 20

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(0, 1 << 61)) * 8 + 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all substrings of ``width`` bytes (a power of two), by doubling."""
    h, n = _BYTE[data], 1
    while n < width:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    return h


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[:len(values) - (width - n)], values[width - n:]) if width > n else values


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Start, number of windows, place of the anchor, anchor hash and content hash of each segment of a text."""
    out = []
    for at in range(0, max(0, len(text) - length + 1), PIECE):
        data = np.frombuffer(text, np.uint8, count=min(len(text) - at, PIECE + length - 1), offset=at)
        grams = _gram_hashes(data, ANCHOR)
        order = (_mixed(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        anchor_at = _sliding_least(order, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)
        start = np.flatnonzero(np.append(True, anchor_at[1:] != anchor_at[:-1]))
        count = np.diff(np.append(start, len(anchor_at)))
        sums = np.append(np.uint64(0), np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), dtype=np.uint64))
        content = (sums[start + count + length - 1] - sums[start]) * _powers(_INVERSE, len(data))[start]
        out.append((
            start + at, count, anchor_at[start].astype(np.int64) - start, _mixed(grams[anchor_at[start].astype(np.int64)]).view(np.int64),
            _mixed(content + count.astype(np.uint64) * _MIX).view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*out))


def _suffix_order(symbols: np.ndarray, to_end: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Symbol 0 ends a string and differs from all others; ``to_end`` is a suffix's
    distance to it. Ranks of eight symbols, then doubled until no string is longer."""
    n = len(symbols)
    padded = np.append(symbols.astype(np.uint64), np.zeros(8, np.uint64))
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(to_end >= k, padded[k:n + k], 0)
    order = np.argsort(key, kind="stable")
    ended = to_end < 8
    new = np.append(True, (key[order][1:] != key[order][:-1]) | ended[order][1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    depth, longest = 8, int(to_end.max()) + 1
    while depth < longest and rank[order[-1]] < n - 1:
        pair = rank * (n + 1) + np.append(rank[depth:], np.zeros(depth, np.int64)) + 1
        order = np.argsort(pair, kind="stable")
        rank[order] = np.cumsum(np.append(True, pair[order][1:] != pair[order][:-1])) - 1
        depth *= 2
    return order


def repeated_starts(bodies: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Over the bodies, each followed by an end mark: whether the ``length`` bytes from a place start elsewhere too."""
    sizes = np.array([len(b) + 1 for b in bodies])
    ends = np.cumsum(sizes) - 1
    joined = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    symbols = joined.astype(np.int16) + 1
    symbols[ends] = 0
    n = len(symbols)
    to_end = np.repeat(ends, sizes) - np.arange(n)
    suffix = _suffix_order(symbols, to_end)
    transform = symbols[suffix - 1]
    by_symbol = np.argsort(transform, kind="stable")
    extended = np.empty(n, np.int64)  # backward extension: the rank of a suffix with the byte before it
    extended[by_symbol] = np.arange(n)
    first = symbols[suffix]
    open_boundary = np.ones(n + 1, bool)  # between ranks r - 1 and r: no common-prefix length found yet
    open_boundary[: len(bodies) + 1] = open_boundary[n] = False  # the end marks come first, each an interval
    low, high = np.array([0]), np.array([n])
    for depth in range(length):
        size = high - low
        rank = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        owner = np.repeat(np.arange(len(low)), size)
        real = transform[rank] != 0
        to = extended[rank[real]]
        order = np.argsort(to)
        to, owner = to[order], owner[real][order]
        if not len(to):
            break
        cut = np.flatnonzero((to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[to[1:]] != first[to[:-1]]))
        low, high = to[np.append(0, cut + 1)], to[np.append(cut, len(to) - 1)] + 1
        fresh = open_boundary[high]  # else a shorter prefix ended here already
        low, high = low[fresh], high[fresh]
        open_boundary[high] = False  # these prefixes have depth bytes in common with what follows
        if depth == 0:
            low = np.concatenate([np.arange(len(bodies)), low])
            high = np.concatenate([np.arange(len(bodies)) + 1, high])
        if not len(low):
            break
    joined_up = open_boundary[:-1] | open_boundary[1:]
    out = np.zeros(n, bool)
    out[suffix[joined_up]] = True
    return out


def _ranges(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


def _segment_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(2)]
            found = [segments(t, length) for t in texts]
            counts = [len(f[0]) for f in found]
            row = np.repeat(np.arange(len(texts)), counts)
            start, count, place, anchor, content = (np.concatenate([f[i] for f in found]) for i in range(5))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(start, pa.int64()),
                pa.array(count, pa.int16()), pa.array(place, pa.int16()), pa.array(anchor), pa.array(content)],
                names=["doc_id", "th", "start", "windows", "place", "anchor", "content"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.filter(F.octet_length("body") >= length).mapInArrow(
        run, f"doc_id {kind}, th long, start long, windows short, place short, anchor long, content long")


def _halves(rows: DataFrame, length: int) -> DataFrame:
    """Each row's windows in two families by the anchor's place in a window, in ``low`` to ``high``.

    ``place`` is the anchor's in the segment, ``shift`` that of the first window, ``body`` the windows'
    bytes. ``key`` is the hash of what all windows of the family hold, ``s1`` and ``s2`` that of the new body."""
    mid = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    family = F.explode(F.array(F.struct(F.col("low").alias("l"), mid.alias("h")), F.struct((mid + 1).alias("l"), F.col("high").alias("h"))))
    most = F.least("f.h", F.col("place") - F.col("shift"))
    least = F.greatest("f.l", F.col("place") - F.col("shift") - F.col("windows") + 1)
    split = rows.select("*", family.alias("f")).filter("f.l <= f.h").select(
        "anchor", "content", "place", F.col("f.l").alias("low"), F.col("f.h").alias("high"), "body",
        F.col("shift").alias("was"), (F.col("place") - most).alias("shift"), (most - least + 1).alias("windows")).filter("windows > 0")
    split = split.withColumn("body", F.substring("body", F.col("shift") - F.col("was") + 1, F.col("windows") + (length - 1))).drop("was")
    held = F.substring("body", F.col("place") - F.col("low") - F.col("shift") + 1, length - (F.col("high") - F.col("low")))
    return split.select(
        "*", F.xxhash64("low", "high", held).alias("key"), F.xxhash64("body").alias("s1"), F.xxhash64(F.lit(2), "body").alias("s2"))


def _expanded(dealt: DataFrame, length: int) -> DataFrame:
    """Repeated window ranges of each segment; keys are dealt out and met in order within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def settled() -> pa.RecordBatch:
            flags = repeated_starts([h[3] for h in held], length)
            out, at = [], 0
            for anchor, content, shift, body in held:
                low, high = _ranges(flags[at:at + len(body) - length + 1])
                at += len(body) + 1
                out += [(anchor, content, shift + a, shift + b) for a, b in zip(low, high)]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["anchor", "content", "low", "high"])

        last = None
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > TOGETHER_BYTES and key != last:
                    yield settled()
                    held.clear()
                    size = 0
                held.append(tuple(row))
                size += len(row[3])
                last = key
        if held:
            yield settled()

    return dealt.select("key", "anchor", "content", "shift", "body").mapInArrow(
        run, "anchor long, content long, low int, high int")


def _repeated_ranges(bodies: DataFrame, length: int) -> DataFrame:
    """anchor, content, low, high: the windows of different segments of one anchor that repeat."""
    found = []
    rows = bodies.select("*", F.lit(0).alias("low"), F.lit(length - ANCHOR).alias("high"), F.lit(0).alias("shift"))
    while True:
        rows = stage(_halves(rows, length), "halves")
        keys = rows.groupBy("key").agg(F.count("*").alias("n"), *[
            f(c).alias(f"{n}_{c}") for c in ("s1", "s2") for n, f in (("least", F.min), ("most", F.max))]).filter("n > 1")
        live = rows.join(keys, "key").withColumn("alike", F.expr("least_s1 = most_s1 AND least_s2 = most_s2"))
        live = stage(live.drop("least_s1", "most_s1", "least_s2", "most_s2"), "live-halves")
        whole = lambda df: df.select("anchor", "content", F.col("shift").alias("low"), (F.col("shift") + F.col("windows")).alias("high"))
        rest = live.filter("NOT alike")
        others = [c for c in rows.columns if c not in ("key", "s1", "s2")]
        different = stage(rest.groupBy("key", "s1", "s2").agg(
            *[F.first(c).alias(c) for c in others], F.count("*").alias("copies")), "different-halves")
        repeated = different.filter("copies > 1").select("key", "s1", "s2")
        crowded = different.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > KEY_SEGMENTS).select("key")
        few = different.join(crowded, "key", "left_anti")
        found += [
            whole(live.filter("alike")), whole(rest.join(repeated, ["key", "s1", "s2"], "left_semi")),
            stage(_expanded(few.repartition("key").sortWithinPartitions("key"), length), "ranges")]
        rows = different.join(crowded, "key", "left_semi").select(*others)
        if crowded.isEmpty():
            out = found[0]
            for more in found[1:]:
                out = out.unionByName(more)
            return out


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else.

    Texts are taken as UTF-8 bytes; strings do not cross documents, overlaps count, and all are
    judged on the input. Returns, one row per input row, ``doc_id``, ``n_bytes``, ``kept binary``
    (the remaining bytes) and ``spans array<struct<start,end>>``, the maximal removed runs. A null
    or short text keeps all it has; repeated rows are copies of each other, so long ones lose all;
    ids may be null or repeat. Other columns are not read.
    """
    body = text_or_empty("text")
    rows = docs.select("doc_id", F.xxhash64(body).alias("th"), body.cast("binary").alias("body"))
    found = stage(_segment_rows(rows, length), "segments")
    anchors = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")).filter("n > 1")
    live = stage(found.join(anchors, "anchor").select(
        "doc_id", "th", "start", "windows", "place", "anchor", "content", (F.col("least") == F.col("most")).alias("alike")), "live")
    different = stage(live.filter(~F.col("alike")).groupBy("anchor", "content").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "th", "start", "windows", "place")], F.count("*").alias("copies")), "different")
    of_text = lambda other: rows["doc_id"].eqNullSafe(other["doc_id"]) & (rows["th"] == other["th"])
    # rows that repeat a document give a body each: one of them is enough
    bodies = stage(rows.join(different, of_text(different)).select(
        "anchor", "content", F.col("place").cast("int").alias("place"), F.col("windows").cast("int").alias("windows"),
        F.substring("body", F.col("start").cast("int") + 1, F.col("windows") + (length - 1)).alias("body")
    ).dropDuplicates(["anchor", "content"]), "bodies")
    ranges = _repeated_ranges(bodies, length).unionByName(different.filter("copies > 1").select(
        "anchor", "content", F.lit(0).alias("low"), F.col("windows").cast("int").alias("high")))
    at = lambda window: F.col("start") + window
    whole = live.filter("alike").select("doc_id", "th", at(0).alias("low"), at(F.col("windows") + (length - 1)).alias("high"))
    partly = live.filter("NOT alike").join(ranges, ["anchor", "content"]).select(
        "doc_id", "th", at(F.col("low")).alias("low"), at(F.col("high") + (length - 1)).alias("high"))
    covered = stage(whole.unionByName(partly).groupBy("doc_id", "th").agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")), "covered")
    return _cut(rows.join(covered, of_text(covered), "left").select(rows["doc_id"], rows["body"], "lows", "highs"))


def _cut(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            kept, spans = [], []
            for body, lows, highs in zip(*(batch.column(i) for i in (1, 2, 3))):
                text, merged, out = body.as_py(), [], []
                for low, high in sorted(zip(lows.as_py() or [], highs.as_py() or [])):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(high, merged[-1][1])
                    else:
                        merged.append([low, high])
                at = 0
                for low, high in merged:
                    out.append(text[at:low])
                    at = high
                kept.append(b"".join([*out, text[at:]]))
                spans.append([{"start": low, "end": high} for low, high in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, batch.column(1).to_pylist()), pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                names=["doc_id", "n_bytes", "kept", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start:bigint,end:bigint>>")


def removal_digest(cut: DataFrame) -> DataFrame:
    """Counts and the digest of ``without_repeats``' rows."""
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
