"""Periodic runs of words, found on a grammar.

The word ids of a block of documents are compressed by Re-Pair: pairs of neighbouring symbols that occur
twice or more become nonterminals, the most frequent first; pairs that do not overlap are replaced in one
round. What no pair compresses any more is closed by a balanced binary tree per document. So each document has a
binary derivation, and the lowest node that covers a run holds it across the boundary of its two children.

The runs across the boundary of a nonterminal are computed once, with the repetition search of two
Z-functions a side, and translated to every position that the nonterminal was put at; intervals of one
period that overlap by a period or more are merged, which leaves the maximal ones.

Most nodes hold no such run: a run of length max(24, 3 periods) across a boundary has, on its longer side, four
words next to the boundary that recur one period further. Nodes without such a recurrence are not searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: A run has at least this many words, and at least this many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words next to a boundary that must recur; 24 words and three periods imply it for any period.
_SEED = 4
#: Words of the documents that share a grammar (a longer document has one of its own).
BLOCK_WORDS = 300_000


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def grammar(symbols: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Nodes of the derivations, as tables (nonterminal, start, boundary, end) of at least ``MIN_WORDS`` words.

    ``starts`` are the words' positions; words are neighbours where they differ by one, so documents are kept
    apart by a gap. A pair is replaced wherever it is more frequent than the pairs that it overlaps (ties: in
    a random order, so that few rounds do; no result depends on it); in a chain of equal symbols every second pair is.
    A pair that occurs once can never become part of a repeated one, so symbols between two such pairs leave the rounds.
    """
    ends, nodes, frozen, shuffle = starts + 1, [], [], np.random.default_rng(0)
    top = int(symbols.max()) + 1 if len(symbols) else 0
    while len(symbols) > 1:
        joined = np.flatnonzero(ends[:-1] == starts[1:])
        which, kinds = pd.factorize(symbols[joined] * top + symbols[joined + 1])
        count = np.bincount(which, minlength=len(kinds))
        key = np.full(len(symbols) + 1, -1)  # of the pair that begins at a symbol; one place more, so that key[-1] is -1
        key[joined] = np.where(count >= 2, count * len(kinds) + shuffle.permutation(len(kinds)), -1)[which]
        stays = (key[:-1] >= 0) | (np.concatenate(([-1], key[:-2])) >= 0)
        if not stays.all():
            frozen.append((starts[~stays], ends[~stays]))
            symbols, starts, ends = symbols[stays], starts[stays], ends[stays]
            key = np.append(key[:-1][stays], -1)
        if not len(symbols):
            break
        chain = np.flatnonzero(np.diff(key, prepend=-2))  # begins of chains of equal keys
        size = np.diff(chain, append=len(key))
        rank = key[chain]
        wins = (rank >= 0) & (rank > np.concatenate(([-1], rank[:-1]))) & (rank > np.append(rank[1:], -1))
        begin, size = chain[wins], (size[wins] + 1) // 2
        at = np.repeat(begin, size) + 2 * (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
        new = top + np.repeat(pd.factorize(rank[wins])[0], size)
        long = ends[at + 1] - starts[at] >= MIN_WORDS
        nodes.append((new[long], starts[at][long], ends[at][long], ends[at + 1][long]))
        symbols[at], ends[at] = new, ends[at + 1]
        top = int(new.max()) + 1
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        symbols, starts, ends = symbols[left], starts[left], ends[left]
    starts, ends = (np.concatenate([x, *(f[i] for f in frozen)]) for i, x in enumerate((starts, ends)))
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    while len(starts) > 1:
        joined = ends[:-1] == starts[1:]
        if not joined.any():
            break
        begin = np.flatnonzero(np.concatenate(([True], ~joined)))
        offset = np.arange(len(starts)) - np.repeat(begin, np.diff(begin, append=len(starts)))
        at = np.flatnonzero(joined & (offset[:-1] % 2 == 0))
        long = at[ends[at + 1] - starts[at] >= MIN_WORDS]
        nodes.append((top + np.arange(len(long)), starts[long], ends[long], ends[long + 1]))
        top += len(long)
        ends[at] = ends[at + 1]
        left = np.ones(len(starts), bool)
        left[at + 1] = False
        starts, ends = starts[left], ends[left]
    return nodes


def _recurrences(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every position, the next and the last one before where the same ``_SEED`` words begin (far off if none)."""
    n = len(words)
    after, before = np.full(n + 1, 4 * n + 8), np.full(n + 1, -4 * n - 8)
    if n >= _SEED:
        pair, kinds = pd.factorize(words[:-1] * (int(words.max()) + 1) + words[1:])
        four, kinds = pd.factorize(pair[:-2] * len(kinds) + pair[2:])
        often = np.flatnonzero(np.bincount(four, minlength=len(kinds))[four] >= 2)
        often = often[np.argsort(four[often], kind="stable")]
        same = four[often[:-1]] == four[often[1:]]
        after[often[:-1][same]], before[often[1:][same]] = often[1:][same], often[:-1][same]
    return after, before


def _z(pattern: list, text: list, first: int, last: int, own: list | None) -> list[int]:
    """Lengths of the common prefixes of ``pattern`` and ``text[i:]`` for ``first <= i < last``.

    ``own`` holds those of the pattern with itself (from 0 on); none: the pattern's own are computed.
    """
    out, low, high, n, m = [], first, first, len(text), len(pattern)
    known = out if own is None else own
    shift = first if own is None else 0
    for i in range(first, last):
        k = 0
        if i < high:
            k = known[i - low - shift] if i - low >= shift else m
            if k > high - i:
                k = high - i
        if k >= high - i or i >= high:
            while k < m and i + k < n and pattern[k] == text[i + k]:
                k += 1
            if i + k > high:
                low, high = i, i + k
        out.append(k)
    return out


def _rightward(left: list, right: list, most: int) -> np.ndarray:
    """Stretches of period p up to ``most`` around a boundary that hold the first p + 1 words right of it: columns
    are p, words left of the boundary, words right of it."""
    most = min(most, len(right) - 1)
    if most < 1:
        return np.empty((0, 3), np.int64)
    ahead = _z(right, right, 1, most + 1, None)
    mirrored = left[::-1]
    own = [len(mirrored), *_z(mirrored, mirrored, 1, min(most + 1, len(mirrored)), None)]
    back = _z(mirrored, right[most - 1::-1] + mirrored, 0, most, own)[::-1]  # at index p - 1: matches that end p words on
    p = np.arange(1, most + 1)
    return np.column_stack([p, back, p + ahead])


def boundary_runs(left: list, right: list, ahead: bool = True, behind: bool = True) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs across the boundary, maximal within the two sides, period smallest."""
    most, found = (len(left) + len(right)) // MIN_PERIODS, {}
    sides = []
    if ahead:
        sides.append((1, _rightward(left, right, most)))
    if behind:
        sides.append((-1, _rightward(right[::-1], left[::-1], most)))
    for direction, t in sides:
        t = t[t[:, 1] + t[:, 2] >= np.maximum(MIN_WORDS, MIN_PERIODS * t[:, 0])]
        for p, back, on in t.tolist():  # by rising period, so the smallest one stays
            span = (len(left) - back, len(left) + on) if direction > 0 else (len(left) - on, len(left) + back)
            found.setdefault(span, p)
    return [(s, e, p) for (s, e), p in found.items()]


def block_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Of each document (word ids), its runs as rows (start, length, period), by start, then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    at = np.cumsum(sizes + 1) - sizes - 1  # one place is left free between documents
    total = int((sizes + 1).sum())
    words = np.empty(total, np.int64)
    inside = np.ones(total, bool)
    inside[at + sizes] = False
    words[inside] = np.concatenate(documents) if documents else 0
    kinds = int(words[inside].max()) + 1 if inside.any() else 0
    words[~inside] = kinds + np.arange(len(documents))  # gaps equal nothing
    none = [np.empty((0, 3), np.int64)] * len(documents)
    nodes = grammar(words[inside], np.flatnonzero(inside))
    if not nodes:
        return none
    name, start, mid, end = (np.concatenate([n[i] for n in nodes]) for i in range(4))
    _, first = np.unique(name, return_index=True)
    after, before = _recurrences(words)
    low, m, high = start[first], mid[first], end[first]
    most = (high - low) // MIN_PERIODS
    ahead = (after[m] - m <= most) & (after[m] + _SEED <= high)
    back = np.maximum(m - _SEED, 0)
    behind = (m - _SEED >= low) & (back - before[back] <= most) & (before[back] >= low)
    found = []
    for k in np.flatnonzero(ahead | behind):
        left, right = words[low[k]:m[k]].tolist(), words[m[k]:high[k]].tolist()
        found += [(name[first[k]], *r) for r in boundary_runs(left, right, bool(ahead[k]), bool(behind[k]))]
    if not found:
        return none
    found = np.array(found, np.int64)
    order = np.argsort(name, kind="stable")
    low = np.searchsorted(name[order], found[:, 0])
    times = np.searchsorted(name[order], found[:, 0], "right") - low
    rule = np.repeat(np.arange(len(found)), times)
    place = start[order[np.repeat(low - np.cumsum(times) + times, times) + np.arange(len(rule))]]
    start, end, period = place + found[rule, 1], place + found[rule, 2], found[rule, 3]
    order = np.lexsort((end, start, period))
    merged: list[list[int]] = []
    for s, e, p in zip(start[order].tolist(), end[order].tolist(), period[order].tolist()):
        if merged and merged[-1][2] == p and s + p <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e, p])
    runs = np.array(sorted((s, p, e) for s, e, p in merged), np.int64)
    owner = np.searchsorted(at, runs[:, 0], "right") - 1
    rows = np.column_stack([runs[:, 0] - at[owner], runs[:, 2] - runs[:, 0], runs[:, 1]])
    cuts = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def collapse_runs(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Of each text: ``columns`` (default ``doc_id``), ``n_words long``, ``runs array<struct<start, length, period>>``
    (by start, then period, in words) and ``collapsed string``, the kept words joined by one space.

    Words are what ASCII white space separates. A run is a stretch of consecutive words of smallest period q and
    at least max(24, 3 q) words that no neighbour extends. A null or empty text has no words and no runs; repeated rows
    each return; an empty table gives an empty result. A task holds the words of ``BLOCK_WORDS``, or of one longer
    text, at a time. Input columns named like the results may not be among ``columns``.
    """
    columns = columns or ["doc_id"]
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def solved(texts: list[list[bytes]], ids: list[np.ndarray]) -> tuple[list, list, list]:
        runs = block_runs(ids)
        return ([len(t) for t in texts], [[dict(zip(("start", "length", "period"), r)) for r in rows.tolist()] for rows in runs],
                [b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, runs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_at = batch.column(batch.num_columns - 1)
            low, size, vocabulary, texts, ids = 0, 0, _Ids(), [], []
            for i in range(batch.num_rows):
                words = texts_at[i].as_buffer().to_pybytes().split()  # splits at ASCII white space
                texts.append(words)
                ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size >= BLOCK_WORDS or i + 1 == batch.num_rows:
                    counts, runs, rest = solved(texts, ids)
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(low, len(texts)) for c in batch.columns[:-1]),
                         pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(rest, pa.string())],
                        names=[*columns, "n_words", "runs", "collapsed"])
                    low, size, vocabulary, texts, ids = i + 1, 0, _Ids(), [], []

    rows = docs.select(*columns, text_or_empty("text").alias("__text"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(
        run, f"{kinds}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where every tenth text (by the id's hash) repeats words from some place on.

    With h the crc32 of the decimal id, g = h div 10, n > 0 words and h mod 10 = 0: a = g mod n,
    p = 1 + (n - a) div (3 + g mod 8), and each word i >= a becomes word a + (i - a) mod p. Other texts
    are left as they are, those of null ids as well.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text_or_empty("text"), r"[ \t-\r]+"), lambda w: w != "")
    planted = docs.select("doc_id", "text", F.floor(h / 10).alias("__g"), F.when(h % 10 == 0, words).alias("__words"))
    n = F.size("__words")
    planted = planted.withColumn("__a", F.when(n > 0, F.col("__g") % n).cast("int"))
    p: Column = F.lit(1) + ((n - F.col("__a")) / (3 + F.col("__g") % 8)).cast("int")
    planted = planted.withColumn("__p", F.when(n > 0, p).cast("int"))
    repeated = F.concat(
        F.slice("__words", F.lit(1), F.col("__a")),
        F.transform(F.sequence(F.lit(0), n - F.col("__a") - 1),
                    lambda i: F.get(F.col("__words"), (F.col("__a") + i % F.col("__p")).cast("int"))))
    return planted.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Count, most repeated run (exact length over period; ties: smallest start, then period) and digests of a result."""
    runs = F.col("runs")

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        by_place = F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(
            a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
        return F.when(x > y, -1).when(x < y, 1).otherwise(by_place)

    best = F.get(F.array_sort(runs, order), F.lit(0))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"), "n_words")
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")
