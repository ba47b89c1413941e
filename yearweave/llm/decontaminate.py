"""Benchmark decontamination: training passages query a BM25 index of test items with block-max WAND.

The index scores an item by BM25 with the passage as the query, divided by what the item itself would
score: the share of an item's weight that the passage covers. Terms of an item come in the order of
their document frequency; those before the pivot, whose weights together stay under the threshold,
cannot lift an item over it alone and need no postings. Items lie in blocks. A passage sums the block
maxima of the postings it meets and the block's largest weight before the pivot; only blocks that can
reach the threshold are opened. There each item has a bound of its own, and what still can reach the
threshold is scored in full. Every item at or over the threshold
is then verified by the overlap of five-word shingles with its question and its answer.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

K1, B = 1.2, 0.75
#: Share of an item's BM25 weight from which a passage is verified, and the shingle overlap that counts as a leak.
THRESHOLD, OVERLAP, SHINGLE_WORDS = 0.5, 0.8, 5
#: Items of one block, and items of one broadcast index; further items go into further indexes.
BLOCK_ITEMS, INDEX_ITEMS = 8, 20_000
MIN_STRIDE = 64

words_of = re.compile(r"\w+").findall


def _shingles(words: list[str], n: int = SHINGLE_WORDS) -> set[str]:
    if not words:
        return set()
    return {" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's last line is its answer; without line breaks, its last sentence; the rest is the question."""
    body = text.strip()
    for mark in ("\n", ". "):
        head, _, tail = body.rpartition(mark)
        if words_of(head) and words_of(tail):
            return head, tail
    return body, ""


@dataclass
class Index:
    """Postings after the pivot by block, and the items for full scores and verification."""

    terms: dict[str, int] = field(default_factory=dict)
    starts: np.ndarray = None  # of a term's postings by block
    blocks: np.ndarray = None
    maxima: np.ndarray = None
    rest: np.ndarray = None  # of a block: the largest weight before the pivot
    item_starts: np.ndarray = None  # of a term's postings by item
    items: np.ndarray = None
    impacts: np.ndarray = None
    item_rest: np.ndarray = None
    weights: list[dict[int, float]] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    question: list[set[str]] = field(default_factory=list)
    answer: list[set[str]] = field(default_factory=list)
    stride: int = MIN_STRIDE


def build_index(items: list[tuple[int, str, dict[str, float], dict[str, int]]], threshold: float) -> Index:
    """``items``: id, text, the terms' weights as shares of the item's own score, and their document frequencies."""
    index = Index()
    postings: dict[int, dict[int, float]] = {}
    by_item: dict[int, list[tuple[int, float]]] = {}
    rest: Counter = Counter()
    item_rest = []
    for i, (item_id, text, shares, frequency) in enumerate(items):
        block, before = i // BLOCK_ITEMS, 0.0
        index.ids.append(item_id)
        question, answer = question_and_answer(text)
        index.question.append(_shingles(words_of(question.lower())))
        index.answer.append(_shingles(words_of(answer.lower())))
        index.stride = max(index.stride, len(words_of(text)))
        weights = {}
        after_pivot = False
        for term in sorted(shares, key=lambda t: (-frequency[t], t)):
            t = index.terms.setdefault(term, len(index.terms))
            weights[t] = shares[term]
            after_pivot = after_pivot or before + shares[term] >= threshold - 1e-9
            if after_pivot:
                at = postings.setdefault(t, {})
                at[block] = max(at.get(block, 0.0), shares[term])
                by_item.setdefault(t, []).append((i, shares[term]))
            else:
                before += shares[term]
        rest[block] = max(rest[block], before)
        item_rest.append(before)
        index.weights.append(weights)
    n_blocks = (len(items) + BLOCK_ITEMS - 1) // BLOCK_ITEMS
    index.rest = np.array([rest[b] for b in range(n_blocks)])
    index.item_rest = np.array(item_rest)

    def flat(lists: list[list[tuple[int, float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (np.cumsum([0, *map(len, lists)]), np.array([k for one in lists for k, _ in one], np.int64),
                np.array([v for one in lists for _, v in one]))

    n = len(index.terms)
    index.starts, index.blocks, index.maxima = flat([sorted(postings.get(t, {}).items()) for t in range(n)])
    index.item_starts, index.items, index.impacts = flat([by_item.get(t, []) for t in range(n)])
    return index


def _met(starts: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the terms' postings one after another: which of the terms, and where the posting is."""
    size = starts[term + 1] - starts[term]
    return np.repeat(np.arange(len(term)), size), (
        np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[term], size))


def matches(index: Index, texts: list[str], threshold: float, overlap: float) -> list[list[tuple[int, float, float, float]]]:
    """For each whole text: (item id, score, question overlap, answer overlap) of every verified item."""
    found: list[dict[int, tuple]] = [{} for _ in texts]
    stride, n_blocks = index.stride, len(index.rest)
    if not n_blocks:
        return [[] for _ in texts]
    documents = [words_of(t.lower()) for t in texts]
    # passages are two strides long and start every stride: each word is in the one that starts in
    # its stride and in the one before; any run of up to a stride lies wholly in one of them
    of_text = [max(1, -(-len(w) // stride)) for w in documents]
    first = np.cumsum([0, *of_text])
    term_of, get = array("q"), index.terms.get
    for words in documents:
        term_of.extend([get(w, -1) for w in words])
    term = np.array(term_of, np.int64)
    lengths = np.array([len(w) for w in documents])
    text_start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = (np.arange(len(term)) - text_start) // stride
    passage = np.repeat(first[:-1], lengths) + own
    posted = (term >= 0) & (np.append(np.diff(index.starts), 0)[term] > 0)
    here, earlier = posted, posted & (own > 0)
    n_terms = len(index.terms)
    pairs = np.unique(np.concatenate([
        passage[here] * n_terms + term[here], (passage[earlier] - 1) * n_terms + term[earlier]]))
    if not len(pairs):
        return [[] for _ in texts]
    p, t = np.divmod(pairs, n_terms)
    which, at = _met(index.starts, t)
    cell, inverse = np.unique(p[which] * n_blocks + index.blocks[at], return_inverse=True)
    bound = np.bincount(inverse, index.maxima[at])
    opened = cell[bound + index.rest[cell % n_blocks] >= threshold - 1e-9]
    which, at = _met(index.item_starts, t)
    inside = np.isin(p[which] * n_blocks + index.items[at] // BLOCK_ITEMS, opened)
    which, at = which[inside], at[inside]
    n_items = len(index.ids)
    cell, inverse = np.unique(p[which] * n_items + index.items[at], return_inverse=True)
    bound = np.bincount(inverse, index.impacts[at], len(cell))
    cell = cell[bound + index.item_rest[cell % n_items] >= threshold - 1e-9]
    last, terms, shingles = -1, set(), None
    for p, i in zip((cell // n_items).tolist(), (cell % n_items).tolist()):
        if p != last:
            d = int(np.searchsorted(first, p, "right") - 1)
            begin = (p - int(first[d])) * stride
            words = documents[d][begin:begin + 2 * stride]
            last, terms, shingles = p, {get(w) for w in words}, None
        score = sum(w for t, w in index.weights[i].items() if t in terms)
        if score < threshold - 1e-9:
            continue
        if shingles is None:
            shingles = {n: _shingles(words, n) for n in range(1, SHINGLE_WORDS + 1)}
        question, answer = (_share(part, shingles) for part in (index.question[i], index.answer[i]))
        n_q, n_a = len(index.question[i]), len(index.answer[i])
        if (question * n_q + answer * n_a) / max(1, n_q + n_a) >= overlap:
            best = found[d].get(i)
            if best is None or score > best[1]:
                found[d][i] = (index.ids[i], min(1.0, score), question, answer)
    return [[f[i] for i in sorted(f)] for f in found]


def _share(part: set[str], shingles: dict[int, set[str]]) -> float:
    """The share of an item's shingles (shorter ones, where a part is shorter than a shingle) in a passage."""
    return sum(s in shingles[s.count(" ") + 1] for s in part) / len(part) if part else 0.0


def _weighted_terms(items: DataFrame) -> DataFrame:
    """``item_key``, ``text`` and its terms with their BM25 weight as a share of the item's own score."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k.as_py(), t, n) for k, text in zip(batch.column(0), batch.column(1))
                    for t, n in Counter(words_of(text.as_py().lower())).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64()))],
                names=["item_key", "term", "tf"])

    counted = items.select("item_key", "text").mapInArrow(terms, "item_key long, term string, tf long")
    lengths = counted.groupBy("item_key").agg(F.sum("tf").alias("length"))
    totals = lengths.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    frequency = counted.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    weighted = (
        counted.join(frequency, "term").join(lengths, "item_key").join(F.broadcast(totals))  # totals: one row
        .select("item_key", "term", "df", impact.alias("weight")))
    return weighted.groupBy("item_key").agg(
        F.sum("weight").alias("own"), F.collect_list(F.struct("term", "df", "weight")).alias("terms")).join(items, "item_key")


def contaminated_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per input row: the columns of ``docs`` as ``__c0``, ``__c1`` and so on, and ``__items``, the
    benchmark items that the text holds (item_id, score, question_overlap, answer_overlap).

    Null and empty texts hold no item; items without words match nothing; repeated items each
    match; empty tables give empty results or empty lists. Item ids are integers. An index is
    broadcast for about ``INDEX_ITEMS`` items; a larger benchmark takes one index, and one more
    look at each passage, per so many.
    """
    items = stage(benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), text_or_empty("text").alias("text"),
        F.monotonically_increasing_id().alias("item_key")), "items")
    parts = -(-items.count() // INDEX_ITEMS)
    terms = stage(_weighted_terms(items), "index")
    indexes = []
    for part in range(parts):
        rows = terms.filter(F.pmod(F.xxhash64("item_key"), F.lit(parts)) == part).orderBy("item_key").collect()
        index = build_index([(
            r["item_id"], r["text"], {t["term"]: t["weight"] / r["own"] for t in r["terms"]},
            {t["term"]: t["df"] for t in r["terms"]}) for r in rows], threshold)
        indexes.append(docs.sparkSession.sparkContext.broadcast(index))
    names = [f"__c{i}" for i in range(len(docs.columns))]
    fields = ("item_id", "score", "question_overlap", "answer_overlap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(f, pa.int64() if f == "item_id" else pa.float64()) for f in fields]))
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                found = [[] for _ in texts]
                for index in indexes:
                    for mine, more in zip(found, matches(index.value, texts, threshold, overlap)):
                        mine += [dict(zip(fields, m)) for m in more]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], names=[*names, "__items"])

    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], text_or_empty("text").alias("__text"))
    kinds = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for c, n in zip(docs.columns, names))
    return rows.mapInArrow(
        run, f"{kinds}__items array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>")


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``contaminated boolean``, ``item_ids array<bigint>`` (ascending) and the best ``score``."""
    found = contaminated_items(docs.select("doc_id", "text"), benchmark)
    return found.select(
        F.col("__c0").alias("doc_id"), (F.size("__items") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("__items.item_id")).alias("item_ids"),
        F.array_max("__items.score").alias("best_score"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept."""
    found = contaminated_items(docs, benchmark).filter(F.size("__items") == 0)
    return found.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
