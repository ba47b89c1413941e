"""Quality rules: a decision list learned by sequential covering.

Every text is reduced to a few statistics, once. From those of labelled documents, rules are learned one after
another: a rule is a conjunction of thresholds that marks low quality. It is grown on two thirds of the rows
still uncovered, by the threshold of the greatest information gain until no good row is left in it, and pruned on
the other third, where trailing conditions go that do not pay. A rule that is right on the pruning rows stays, and
the rows that it covers leave; the first one that is not ends the list. The list is a Spark expression, ``when``
after ``when``, so that it applies to any table of statistics, and prints as text.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty
from .toxicity import held_out

#: Bound of the training sample, in rows of each class; their statistics are a dozen numbers a row.
TRAIN_ROWS = 20_000
#: Share of the rows that rules are grown on; the precision a rule needs on the others; the most conditions and rules.
GROW_SHARE, PRECISION, MOST_CONDITIONS, MOST_RULES = 2 / 3, 0.9, 4, 32
#: A rule must cover this many low-quality rows when grown.
LEAST_COVERED = 4
#: Documents of fewer words, or of a greater share of repeated words (in per cent), fail before any rule is asked.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Counts of a text, in the order of the statistics table.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits",
          "n_marks", "n_distinct_words", "longest_word")
#: What rules look at: shares of the counts, so that a threshold means the same for short and long texts.
FEATURES = {
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "duplicate_line_share": "n_dup_lines / n_lines",
    "repeated_word_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / n_letters",
    "letter_share": "n_letters / word_chars",
    "digit_share": "n_digits / word_chars",
    "marks_per_word": "n_marks / n_words",
    "distinct_word_share": "n_distinct_words / n_words",
    "words_per_line": "n_words / n_lines",
    "longest_word": "longest_word",
    "n_words": "n_words",
}

#: Kinds of characters, as bits.
_LETTER, _UPPER, _DIGIT, _SYMBOL, _MARK, _SPACE = (1 << i for i in range(6))
_ASCII_SPACE = " \t\n\x0b\f\r"


@cache
def _kinds() -> np.ndarray:
    """The kinds of every code point, built once a worker."""
    def kind(c: str) -> int:
        return (_LETTER * c.isalpha() | _UPPER * c.isupper() | _DIGIT * c.isdigit() | _SYMBOL * (c in "#*$%&|<>")
                | _MARK * (c in "!?:;.,") | _SPACE * (c in _ASCII_SPACE))

    return np.fromiter(map(kind, map(chr, range(sys.maxunicode + 1))), np.uint8, sys.maxunicode + 1)


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one text; words are what ASCII white space separates."""
    words = text.encode().split()  # bytes split at ASCII white space only
    n = len(words)
    ids: dict[bytes, int] = {}
    at = [ids.setdefault(w, len(ids)) for w in words]
    by_kind = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=64)
    letters, upper, digits, symbols, marks, spaces = (
        int(by_kind[[k for k in range(64) if k & bit]].sum()) for bit in (_LETTER, _UPPER, _DIGIT, _SYMBOL, _MARK, _SPACE))
    repeated = 0
    if n >= 3:
        windows = list(zip(at, at[1:], at[2:]))
        times = Counter(windows)
        if len(times) < len(windows):
            until = 0  # first word not yet counted
            for i, w in enumerate(windows):
                if times[w] > 1:
                    repeated += i + 3 - max(i, until)
                    until = i + 3
    lines = [line for line in text.split("\n") if line.strip(_ASCII_SPACE)]
    return (n, len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated, len(lines), upper, letters, digits,
            marks, len(ids), max((len(w.decode()) for w in ids), default=0))


def text_statistics(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default ``doc_id``) and the ``COUNTS`` of every whole text, as longs.

    A null or empty text has zeros throughout; repeated rows each return; an empty table gives an empty result.
    Input columns named like a count may not be among ``columns``.
    """
    columns = columns or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            counts = np.array(rows, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(counts[:, i]) for i in range(len(COUNTS)))], names=[*columns, *COUNTS])

    rows = docs.select(*columns, text_or_empty("text").alias("__text"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, f"{kinds}, {', '.join(f'{c} long' for c in COUNTS)}")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"

    def of(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.feature] > self.threshold) == self.above


@dataclass(frozen=True)
class Rule:
    """A conjunction that marks low quality, with what it covered when learned."""

    conditions: tuple[Condition, ...]
    low: int
    good: int

    def __str__(self) -> str:
        return f"if {' and '.join(map(str, self.conditions))} then low ({self.low} low, {self.good} good)"


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def number(self) -> Column:
        """Number of the first rule that a row of statistics meets, from 1; 0 where none does."""
        out: Column | None = None
        for k, rule in enumerate(self.rules, 1):
            meets = F.lit(True)
            for c in rule.conditions:
                x = feature(c.feature)
                meets &= (x > c.threshold) if c.above else (x <= c.threshold)
            out = F.when(meets, k) if out is None else out.when(meets, k)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "\n".join([*map(str, self.rules), "else good"])


def feature(name: str) -> Column:
    """A feature over the columns of ``COUNTS``; a share of nothing is 0."""
    top, _, base = FEATURES[name].partition(" / ")
    x = F.col(top).cast("double")
    return x if not base else F.when(F.col(base) > 0, x / F.col(base)).otherwise(0.0)


def _best_condition(x: dict[str, np.ndarray], low: np.ndarray) -> Condition | None:
    """The threshold of the greatest gain: low rows kept times the rise of their log share. Ties: first by feature."""
    base, best, best_gain = np.log2(low.mean()), None, 1e-9
    for name, values in x.items():
        order = np.argsort(values, kind="stable")
        v, hits = values[order], np.cumsum(low[order])
        cut = np.flatnonzero(v[:-1] < v[1:])
        for above in (True, False):
            p = (hits[-1] - hits[cut]) if above else hits[cut]
            n = (len(v) - 1 - cut) if above else cut + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0.0)
            if len(gain) and gain.max() > best_gain:
                k = int(gain.argmax())
                best_gain, best = float(gain[k]), Condition(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best


def _grown(x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    conditions: list[Condition] = []
    while len(conditions) < MOST_CONDITIONS and low.any() and not low.all():
        condition = _best_condition(x, low)
        if condition is None:
            break
        inside = condition.of(x)
        x, low = {k: v[inside] for k, v in x.items()}, low[inside]
        conditions.append(condition)
    return conditions if low.sum() >= LEAST_COVERED else []


def _covered(conditions: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    inside = np.ones(n, bool)
    for c in conditions:
        inside &= c.of(x)
    return inside


def _pruned(conditions: list[Condition], x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    """The leading conditions of the greatest (low - good) / (low + good) on the pruning rows; ties: fewer conditions."""
    worth = []
    for k in range(1, len(conditions) + 1):
        inside = _covered(conditions[:k], x, len(low))
        p, n = int(low[inside].sum()), int(inside.sum())
        worth.append(((2 * p - n) / n if n else -1.0, -k))
    return conditions[:-max(worth)[1]] if worth else []


def learn(sample: pd.DataFrame, label_col: str = "low") -> DecisionList:
    """Sequential covering over a table of features and a 0/1 label that marks low quality.

    Rows count in the order given: of three rows, two grow and one prunes. Without both classes there are no rules.
    """
    low = sample[label_col].to_numpy(bool)
    x = {name: sample[name].to_numpy(float) for name in FEATURES}
    grows = np.arange(len(low)) % 3 < round(3 * GROW_SHARE)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and low.any() and not low.all():
        part = {k: v[grows] for k, v in x.items()}
        conditions = _grown(part, low[grows])
        conditions = _pruned(conditions, {k: v[~grows] for k, v in x.items()}, low[~grows])
        if not conditions:
            break
        inside = _covered(conditions, x, len(low))
        held = low[inside & ~grows]
        if not len(held) or held.mean() < PRECISION:
            break
        rules.append(Rule(tuple(conditions), int(low[inside].sum()), int((~low[inside]).sum())))
        x, low, grows = {k: v[~inside] for k, v in x.items()}, low[~inside], grows[~inside]
    return DecisionList(rules)


def training_rows(statistics: DataFrame, labels: DataFrame, label_col: str = "quality") -> pd.DataFrame:
    """Features and label of labelled documents outside the held-out fold that pass the base checks, at most
    ``TRAIN_ROWS`` a class.

    They come in the order of a hash. Repeated labels of an id count
    once, low if any is; null labels and ids do not count. Rows of one id count each.
    """
    marks = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.min(label_col) == 0).alias("low"))
    rows = statistics.filter(~held_out() & ~base_failed()).join(marks, "doc_id").select(
        "doc_id", "low", *[feature(name).alias(name) for name in FEATURES])
    order = [F.xxhash64(F.lit("quality sample"), "doc_id"), F.col("doc_id"), *map(F.col, FEATURES)]
    parts = [rows.filter(F.col("low") == low).orderBy(*order).limit(TRAIN_ROWS) for low in (True, False)]
    return parts[0].unionByName(parts[1]).orderBy(*order).toPandas()


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, the ``COUNTS``, ``base_failed``, ``rule`` (number of the rule that rejects it, else 0) and ``kept``.

    Texts are read once; their counts are staged, and both learning and verdicts read those. Null and empty texts fail
    the base checks. Without labels of both classes no rule is learned, and the base checks decide alone.
    Repeated rows each return; an empty table gives an empty result.
    """
    statistics = stage(text_statistics(docs), "statistics")
    rules = learn(training_rows(statistics, labels))
    rows = statistics.withColumn("base_failed", base_failed()).withColumn("rule", rules.number())
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
