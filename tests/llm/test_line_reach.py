"""Line dedup where a segment is shared by very many different lines, and columns whose names could clash."""

import random

import pytest

from yearweave.llm import line_dedup


def within(a: str, b: str) -> bool:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1] <= min(2, min(len(a), len(b)) // 6)


def templated(r: random.Random, count: int) -> list[str]:
    return [f"Order number {r.randrange(10 ** 6):06d} was confirmed by the warehouse team today" for _ in range(count)]


@pytest.mark.parametrize("hot", [1, 4, 128])
def test_hot_segments_lose_no_pair(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_KEY", hot)
    r = random.Random(hot)
    lines = templated(r, 150) + [f"Page {n} of {m}" for n in range(1, 40, 7) for m in (9, 10, 200)] + ["No. 5", "No. 6", "Item 12", "Item 13", "Item 1", "12", "123456", "123457", "1234567"]
    for _ in range(150):  # digits lost, added, turned into letters, and edits elsewhere
        line = list(r.choice(lines))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(line))
            line[at:at + r.randint(0, 1)] = r.choice(["", "7", "x", "31"])
        lines.append("".join(line) or "-")
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i:3 * i + 3])) for i in range(len(lines) // 3)]
    got = {x.doc_id: x.removed_lines for x in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, want = [], {}
    for i, t in rows:
        want[i] = []
        for no, line in enumerate(t.split("\n")):
            if any(c.isalnum() for c in line):
                if any(abs(len(s) - len(line)) <= 2 and within(s, line) for s in seen):
                    want[i].append(no)
                seen.append(line)
    assert got == want and sum(map(len, want.values())) > 50


def test_lines_of_one_template_do_not_all_pair(spark):
    """Lines that differ in their digits alone: what is staged is near the pairs in reach, far from all pairs."""
    staged = {}
    for count in (1000, 2000):
        rows = [(i, t) for i, t in enumerate(dict.fromkeys(templated(random.Random(3), count)))]
        different = line_dedup.stage(line_dedup.different_lines(line_dedup._lines(
            spark.createDataFrame(rows, "doc_id long, text string")), 2), "different-lines")
        staged[count] = line_dedup.candidate_pairs(different, 2).count()
    assert staged[1000] <= 5 * 1000 and staged[2000] <= 5 * 2000


def test_column_names_may_clash(spark):
    rows = [(i, t, "mine", i, i, "th", 7) for i, t in enumerate(["the same line twice\nand one more", "the same line twice\nother", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key string, __no int, `no` int, th string, `a.b` int")
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()))
    assert got == [(0, rows[0][1], "mine", 0, 0, "th", 7), (1, "other", "mine", 1, 1, "th", 7), (2, None, "mine", 2, 2, "th", 7)]


def test_texts_of_few_lines_are_found_without_moving_all(spark):
    """Of the lines that no near pair needs, next to none goes on to the shuffle that finds the texts."""
    rows = [(None if i == 7 else i, "\n".join(f"line {k} of document {i}" for k in range(10))) for i in range(2000)]
    docs = spark.createDataFrame([*rows, (2000, None)], "doc_id long, text string")
    lines = line_dedup._split_lines(docs)
    wanted = line_dedup.stage(lines.filter("coalesce(doc_id, 7) % 50 = 7 and no % 4 = 1").selectExpr(
        "monotonically_increasing_id() as line_id", "struct(doc_id, no, th) as first"), "wanted-lines")
    likely = {(r.doc_id, r.no): r.line for r in line_dedup.likely_lines(docs, wanted).collect()}
    places = {(r["first"].doc_id, r["first"].no) for r in wanted.collect()}
    assert len(places) == 120 and places <= likely.keys() and (None, 1) in places
    assert all(line == f"line {no} of document {7 if doc is None else doc}" for (doc, no), line in likely.items())
    assert len(likely) <= len(places) + 0.05 * len(rows) * 10
    assert line_dedup.likely_lines(docs, wanted.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1, 2])
def test_a_full_filter_loses_no_line(spark, monkeypatch, most):
    r = random.Random(5)
    rows = [(i, "\n".join(templated(r, 4) + [f"Item {r.randrange(300)} of the list"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, line_dedup.line_report(docs).collect()))
    monkeypatch.setattr(line_dedup, "MAX_WORDS", most)
    assert sorted(map(tuple, line_dedup.line_report(docs).collect())) == want and sum(x[2] for x in want) > 100
