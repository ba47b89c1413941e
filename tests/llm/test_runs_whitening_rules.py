"""Periodic runs, whitening and quality rules against brute force, and on nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, runs int, words int, id string"
SF = "/root/testdata/sf0.001"


def prose(r, n):
    return " ".join(f"w{r.randint(0, 400)}" for _ in range(n))


def corpus():
    r = random.Random(8)
    texts = [prose(r, r.randint(1, 120)) for _ in range(60)]
    phrase = prose(r, 7)
    texts += [" ".join([phrase] * 9) + "\n" + prose(r, 40), prose(r, 30) + " " + " ".join([phrase] * 4), "ha " * 200, "a b " * 12 + "a",
              "", None, " \t\n", "x", texts[0], texts[0], "é b c d " * 9, " ".join("ab"[bin(i).count("1") % 2] for i in range(300)),
              ("\n".join([prose(r, 12)] * 3) + "\n") * 60]
    rows = [(i, t, "en", "s", len(t or ""), 1, 2, "x") for i, t in enumerate(texts)]
    return [*rows, rows[60], (None, texts[60], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- 11 --------------------------------------------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w):
    found = {}
    for p in range(1, len(w) // 3 + 1):
        i, n = 0, len(w) - p
        while i < n:
            j = i
            while j < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = max(i + 1, j)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def planted_words(doc_id, text):
    w = words_of(text)
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def expected_row(doc_id, text):
    w = planted_words(doc_id, text)
    runs = brute_runs(w)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-(r[1] * 10**12 // r[2]), r[0], r[2]), default=None)
    listing = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    most = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *most, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_block_runs_equal_brute_force_on_random_words():
    from yearweave.llm.periodic_runs import block_runs
    r = random.Random(5)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    runs = 0
    for k in range(120):
        block = [fib[-1], [], [1]] if k % 20 == 0 else []
        for _ in range(r.randint(1, 10)):
            kinds, n = r.choice([1, 2, 2, 3, 5, 50]), r.randint(0, 150)
            w = [r.randrange(kinds) for _ in range(n)]
            for _ in range(r.randint(0, 3) if n else 0):
                a, q, m = r.randrange(n), 1 + r.randrange(r.choice([12, 40])), r.randint(10, 120)
                for i in range(a + q, min(n, a + m)):
                    w[i] = w[i - q]
            block += [w, w] if r.random() < 0.1 else [w]
        got = block_runs([np.array(w, np.int64) for w in block])
        for w, rows in zip(block, got):
            want = brute_runs(w)
            runs += len(want)
            assert [tuple(x) for x in rows.tolist()] == want
    assert runs > 300


def test_long_texts_take_time_in_proportion():
    from yearweave.llm.periodic_runs import block_runs
    assert [x.tolist() for x in block_runs([np.zeros(200_000, np.int64)])] == [[[0, 200_000, 1]]]
    r = np.random.default_rng(1)
    period = r.integers(0, 1000, 30_000)
    assert [x.tolist() for x in block_runs([np.tile(period, 7)])] == [[[0, 210_000, 30_000]]]


def test_run_query_on_edge_cases(docs, empty):
    from yearweave.llm.periodic_runs import collapse_runs, run_digest, with_planted_runs
    got = run_digest(collapse_runs(with_planted_runs(docs))).drop("n_words")
    want = Counter(expected_row(r[0], r[1]) for r in corpus())
    assert Counter(map(tuple, got.collect())) == want
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60)) > 2
    assert run_digest(collapse_runs(with_planted_runs(empty))).count() == 0


def test_collapsed_texts_and_runs_are_real(docs):
    from yearweave.llm.periodic_runs import collapse_runs
    rows = {r.doc_id: r for r in collapse_runs(docs, ["doc_id", "lang", "id"]).collect()}
    assert rows[62].collapsed == "ha" and [tuple(x) for x in rows[62].runs] == [(0, 200, 1)]
    assert rows[63].collapsed == "a b" and [tuple(x) for x in rows[63].runs] == [(0, 25, 2)]
    assert rows[0].lang == "en" and rows[0].id == "x" and rows[64].n_words == 0 and rows[64].collapsed == ""


def test_run_query_on_the_table(spark):
    from yearweave.llm.registry import QUERIES
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[:8] for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    short = [r for r in texts if len(words_of(r.text)) <= 400]
    assert len(got) == len(texts) and len(short) > 50
    for r in short:
        assert got[r.doc_id] == expected_row(r.doc_id, r.text)


# -- 12 --------------------------------------------------------------------------------------------------------------


def check_whitening(rows, vectors, components=32):
    """Rows of the operator against the covariance of all usable vectors, by numpy."""
    c = np.array([v for _, v in vectors], np.float64)
    x = np.floor(64 * c) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((e > e[0] * 1e-14).sum()))
    assert len(rows) == n * k and set(rows["n"]) == {n} and rows["identity_error"].max() < 1e-9
    assert np.allclose(rows.groupby("component")["explained"].first(), e[:k] / e.sum(), rtol=1e-8)
    white = rows.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    if len({i for i, _ in vectors}) == n:
        axes = np.linalg.lstsq(centred, white * np.sqrt(e[:k]), rcond=None)[0]
        assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-7)
        assert np.allclose(v @ axes, axes * e[:k], atol=1e-8 * e[0])
    ints = [[int(np.floor(64 * a)) + 1_000_000 for a in row] for row in c.tolist()]
    sums = [sum(col) for col in zip(*ints)]
    exact = Counter((i, sum((n * a - s) ** 2 for a, s in zip(row, sums))) for (i, _), row in zip(vectors, ints))
    assert Counter(zip(*rows[rows["component"] == 1][["vec_id", "deviation"]].T.to_numpy().tolist())) == exact


def test_whitening_of_the_table(spark):
    from yearweave.llm.registry import QUERIES
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
               if r.embedding is not None and all(a is not None and np.isfinite(a) for a in r.embedding)]
    check_whitening(QUERIES["op12_whitening"](spark, SF).toPandas(), vectors)


@pytest.mark.parametrize("kind", ["equal values", "steep", "few rows"])
def test_whitening_of_hard_spectra(spark, kind):
    from yearweave.llm.whitening import whiten
    r = np.random.default_rng(2)
    m = {"equal values": np.vstack([np.eye(5), -np.eye(5)]), "steep": r.standard_normal((200, 6)) * 10.0 ** -np.arange(0, 3, 0.5) * 1e3,
         "few rows": r.standard_normal((4, 9))}[kind]
    vectors = [(i, [float(a) for a in row]) for i, row in enumerate(m)]
    check_whitening(whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).toPandas(), vectors)


def test_whitening_edge_cases(spark):
    from yearweave.llm.whitening import whiten
    kind = "vec_id string, embedding array<float>, n int, component string, rows int"
    r = np.random.default_rng(3)
    good = [(f"v{i % 7}", [float(np.float32(a)) for a in r.standard_normal(3)]) for i in range(9)]
    bad = [("a", None), ("b", []), ("c", [1.0, None, 2.0]), ("d", [1.0, float("nan"), 0.0]), ("e", [float("inf"), 0.0, 0.0]), ("f", [1.0])]
    frame = spark.createDataFrame([(*row, 1, "x", None) for row in [*good, *bad]], kind)
    rows = whiten(frame).toPandas()
    assert list(rows.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(rows, good)
    assert len(whiten(frame, components=1).toPandas()) == 9
    assert whiten(frame.limit(0)).count() == 0
    assert whiten(spark.createDataFrame([("a", [1.0, 2.0], 1, "", 1)] * 3, kind)).count() == 0  # no variance


# -- 13 --------------------------------------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = words_of(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(repeated))


def test_counts_and_base_checks(spark, docs, empty):
    from yearweave.llm.quality_rules import COUNTS, quality_verdicts
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_verdicts(docs.withColumn("n_words", docs.n_chars), labels)
    rows = [(r.doc_id, *(r[c] for c in COUNTS[:5]), r.base_failed, r.kept) for r in got.collect()]
    want = Counter()
    for i, text, *_ in corpus():
        n, *rest = brute_counts(text)
        failed = n < 50 or 100 * rest[-1] > 50 * n
        want[(i, n, *rest, failed, not failed)] += 1
    assert Counter(rows) == want
    assert quality_verdicts(empty, labels).count() == 0


def test_counts_of_any_characters():
    from yearweave.llm.quality_rules import text_counts
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice("ab#*$%&|<> \t\n\r\x0b\x0c\x1c\x85  é😀A1!") for _ in range(r.randint(0, 80)))
        assert text_counts(text)[:5] == brute_counts(text)
    assert text_counts("Ab c1! 日本")[5:] == (1, 1, 5, 1, 1, 3, 3)


def sample(n, seed=0):
    """Low quality: many symbols, or short words in few lines. A row in fifty carries the wrong label."""
    from yearweave.llm.quality_rules import FEATURES
    r = np.random.default_rng(seed)
    x = pd.DataFrame({name: r.random(n) for name in FEATURES})
    truth = (x["symbols_per_word"] > 0.8) | ((x["word_length"] <= 0.3) & (x["words_per_line"] > 0.6))
    return x.assign(low=truth ^ (r.random(n) < 0.02)), truth


def test_rules_find_what_marks_low_quality():
    from yearweave.llm.quality_rules import learn
    train, _ = sample(3000)
    rules = learn(train)
    assert {tuple(sorted({c.feature for c in r.conditions})) for r in rules.rules} >= {("symbols_per_word",)}
    assert any({"word_length", "words_per_line"} <= {c.feature for c in r.conditions} for r in rules.rules)
    test, truth = sample(3000, seed=1)
    said = np.zeros(3000, bool)
    for rule in rules.rules:
        said |= np.logical_and.reduce([c.of({f: test[f].to_numpy() for f in test}) for c in rule.conditions])
    assert (said == truth).mean() > 0.97 and "then low" in str(rules)


def test_rules_without_both_classes_or_signal():
    from yearweave.llm.quality_rules import learn
    train, _ = sample(300)
    for low in (np.zeros(300, bool), np.ones(300, bool), np.random.default_rng(5).random(300) < 0.3):
        assert learn(train.assign(low=low)).rules == []
    assert learn(train.iloc[:0]).rules == []


def test_expression_equals_rules_row_by_row(spark):
    from yearweave.llm.quality_rules import COUNTS, FEATURES, Condition, DecisionList, Rule, feature, text_counts
    rules = DecisionList([Rule((Condition("symbols_per_word", True, 0.2),), 1, 0),
                          Rule((Condition("n_words", False, 60.0), Condition("digit_share", True, 0.3)), 1, 0)])
    texts = [t or "" for _, t, *_ in corpus()] + ["a# b# c"]
    rows = spark.createDataFrame([text_counts(t) for t in texts], ", ".join(f"{c} long" for c in COUNTS))
    got = rows.select(rules.number().alias("rule"), *[feature(f).alias(f) for f in FEATURES]).toPandas()
    for _, row in got.iterrows():
        met = [all((row[c.feature] > c.threshold) == c.above for c in r.conditions) for r in rules.rules]
        assert row["rule"] == (met.index(True) + 1 if any(met) else 0)
    assert set(got["rule"]) == {0, 1, 2}


def test_verdicts_on_held_out_labels(spark):
    from yearweave.llm.quality_rules import quality_verdicts
    from yearweave.llm.toxicity import held_out
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    labels = labels.unionByName(labels.limit(5)).unionByName(spark.createDataFrame([(None, 0, 0), (1, None, None)], labels.schema))
    rows = quality_verdicts(docs, labels).join(labels.filter("quality IS NOT NULL"), "doc_id").filter(held_out()).filter("NOT base_failed").toPandas()
    low = rows["quality"] == 0
    assert low.sum() > 20 and (~rows["kept"][low]).mean() > 0.95 and rows["kept"][~low].mean() > 0.99
