"""Toxicity of documents by multiple-instance learning.

Labels mark whole documents; what offends is a sentence. A sentence's logit is the sum of its words'
weights, a document's score the noisy-or of its sentences, 1 - prod(1 - p). Training lowers the
document loss, so the sentence model learns from document labels alone, and scoring can then name
the sentences. A word's weight is the mean over its hashed features (the word and its character
3- to 5-grams), which lets inflected forms share what one form has taught.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

FEATURES = 1 << 18
#: Bound of the training sample: labelled rows of each class, and bytes of the longest text in it.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_TEXT_BYTES = 1800, 3000, 1 << 17
EPOCHS, LEARNING_RATE, DECAY = 200, 0.1, 1e-7
#: Share that counts of a word's evidence against: many harmless words excuse no offending one.
AGAINST = 0.02
_REMEMBERED_WORDS = 600_000

_sentences = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+").finditer
_words = re.compile(r"\w+").findall


def word_features(word: str) -> list[int]:
    marked = f"<{word}>"
    grams = {marked} | {marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode()) % FEATURES for g in sorted(grams)]


@dataclass
class SentenceModel:
    """Feature weights and the bias of a sentence; small and of fixed size, so it is broadcast."""

    weights: np.ndarray
    bias: float

    def word_weight(self, word: str) -> float:
        evidence = float(self.weights[word_features(word)].mean())
        return evidence if evidence > 0 else evidence * AGAINST


def train(texts: list[str], toxic: np.ndarray, sample_weight: np.ndarray) -> SentenceModel:
    """Fit by Adam on the noisy-or loss over whole texts. Without both classes: all weights zero."""
    model = SentenceModel(np.zeros(FEATURES), -8.0)
    if len(set(toxic.tolist())) < 2:
        return model
    vocabulary: dict[str, int] = {}
    sentence_of, word_at, document_of = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for m in _sentences(text.lower()):
            words = _words(m.group())
            if words:
                word_at.extend(vocabulary.setdefault(w, len(vocabulary)) for w in words)
                sentence_of.extend([len(document_of)] * len(words))
                document_of.append(d)
    flat, sizes = array("i"), array("i")
    for w in vocabulary:
        grams = word_features(w)
        flat.extend(grams)
        sizes.append(len(grams))
    n_words, n_sentences, n_docs = len(vocabulary), len(document_of), len(texts)
    del vocabulary
    sizes, feature, sentence_of, word_at, document_of = (  # views, not copies: this runs on the driver
        np.frombuffer(a, np.int32) for a in (sizes, flat, sentence_of, word_at, document_of))
    owner = np.repeat(np.arange(n_words, dtype=np.int32), sizes)
    sample_weight = sample_weight / sample_weight.sum()
    bias = -4.0
    moments = [[np.zeros(FEATURES), np.zeros(FEATURES)], [0.0, 0.0]]

    def step(value, gradient, moment, t):
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        return value - LEARNING_RATE * (moment[0] / (1 - 0.9**t)) / (np.sqrt(moment[1] / (1 - 0.99**t)) + 1e-8)

    for t in range(1, EPOCHS + 1):
        evidence = np.bincount(owner, model.weights[feature], n_words) / sizes
        slope = np.where(evidence > 0, 1.0, AGAINST)
        word_weight = evidence * slope
        logit = bias + np.bincount(sentence_of, word_weight[word_at], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        none = np.bincount(document_of, -np.logaddexp(0, logit), n_docs)  # log of "no sentence offends"
        clean = np.exp(none)
        pull = np.where(toxic == 1, -clean / np.maximum(1 - clean, 1e-6), 1.0) * sample_weight
        by_sentence = pull[document_of] * p
        by_word = np.bincount(word_at, by_sentence[sentence_of], n_words) * slope / sizes
        gradient = np.bincount(feature, by_word[owner], FEATURES) + DECAY * model.weights
        model.weights = step(model.weights, gradient, moments[0], t)
        bias = step(bias, by_sentence.sum(), moments[1], t)
    model.bias = float(bias)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> pd.DataFrame:
    """A bounded sample of labelled documents outside the held-out fold, in the order of a hash.

    Repeated labels of an id count once, toxic if any is. Each row carries the weight that restores
    the classes' shares among all labelled rows. Rows with a null id, label or text are left out.
    """
    train_rows = labels.filter(~held_out()).groupBy("doc_id").agg(F.max(F.col(label_col).cast("int")).alias("label"))
    counts = {r["label"]: r["n"] for r in train_rows.filter("label IN (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id"), F.lit("toxicity sample"))
    picked = [
        train_rows.filter(F.col("label") == label).orderBy(order, "doc_id").limit(most)
        for label, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))]
    texts = docs.select("doc_id", F.col("text").cast("string")).filter(F.octet_length("text") <= TRAIN_TEXT_BYTES)
    rows = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").dropDuplicates(["doc_id"]).toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    seen = rows["label"].value_counts().to_dict()
    rows["weight"] = rows["label"].map(lambda y: counts[y] / seen[y]).astype(float)
    return rows


def held_out():
    """The fold that labels are never learned from: crc32 of the id as text, modulo 5, is 0; a null id is in it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> SentenceModel:
    sample = training_sample(docs, labels)
    return train(sample["text"].tolist(), sample["label"].to_numpy(int), sample["weight"].to_numpy(float))


class _WordWeights(dict):
    def __init__(self, model: SentenceModel):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > _REMEMBERED_WORDS:
            self.clear()
        self[word] = weight = self.model.word_weight(word)
        return weight


def score_text(text: str, weights: _WordWeights, bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """The noisy-or score, and (start, end, score) of every sentence that scores 0.5 or more."""
    spans, logits, get = [], [], weights.__getitem__
    lower = text.lower()
    if len(lower) != len(text):  # a few letters change their length; offsets must hold in the text itself
        lower = "".join(c if len(k := c.lower()) != 1 else k for c in text)
    for m in _sentences(lower):
        words = _words(m.group())
        if words:
            spans.append(m.span())
            logits.append(bias + sum(map(get, words)))
    if not logits:
        return 0.0, []
    z = np.array(logits)
    score = -np.expm1(-np.logaddexp(0, z).sum())
    return float(score), [(*spans[i], float(1 / (1 + np.exp(-z[i])))) for i in np.flatnonzero(z >= 0)]


def score_documents(docs: DataFrame, model: SentenceModel, columns: list[str] | None = None) -> DataFrame:
    """Score whole texts. Returns ``columns`` (default: ``doc_id``) with ``score double`` and
    ``sentences array<struct<start, end, score>>``, the offending ones, offsets in characters.

    A null or empty text, or one without words, scores 0; repeated rows score alike; an empty table
    gives an empty result. Input columns named like the results may not be among ``columns``.
    """
    columns = columns or ["doc_id"]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _WordWeights(held.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scored = [score_text(t, weights, held.value.bias) for t in batch.column(batch.num_columns - 1).to_pylist()]
            found = [[dict(zip(("start", "end", "score"), s)) for s in spans] for _, spans in scored]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([s for s, _ in scored], pa.float64()), pa.array(found, kind)],
                names=[*columns, "score", "sentences"])

    rows = docs.select(*columns, text_or_empty("text").alias("__text"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, f"{kinds}, score double, sentences array<struct<start:int,end:int,score:double>>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled folds, then score every document."""
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under 0.5, all columns kept."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("text"))
    kept = score_documents(rows, fit(docs, labels), list(names.values())).filter("score < 0.5")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
