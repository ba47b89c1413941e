"""The ten operators against brute force, and on nulls, empty and long texts, ties, repeats and clashing names."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, no int, th long, id string"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, a long text, empty, null, unusual characters, repeated rows, a null id."""
    r = random.Random(4)
    shared = prose(r, 60)
    long = "\n".join(prose(r, 40) for _ in range(200))
    texts = [prose(r, r.randint(1, 80)) + "\n" + prose(r, 12) for _ in range(30)]
    texts += [texts[0], texts[0], texts[1].replace("1", "2", 1), shared + "\n" + prose(r, 20), prose(r, 30) + "\n" + shared,
              "", None, long, long + "x", "   ", "\n\n", "ab" * 500, "naïve 😀 日本語 \u0000 ▁ <0x0A>  two  spaces", "a" * 400]
    rows = [(i, t, "en", "s", len(t or ""), 0.5, 1, 2, "x") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, texts[5], "en", "s", 1, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ids_texts():
    return [(r[0], r[1] or "") for r in corpus()]


def key(v):
    return (v[0] is not None, v)


# -- 1 ---------------------------------------------------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_sentencepiece_equals_library(docs, empty):
    from yearweave.llm.sentencepiece_codec import encode_decode, token_digest
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = token_digest(encode_decode(docs, MODEL)).collect()
    want = Counter()
    for i, t in ids_texts():
        ids = library.encode(t)
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(library.decode(ids).encode()).hexdigest(), True)] += 1
    assert Counter(map(tuple, got)) == want
    assert encode_decode(empty, MODEL).count() == 0


def test_agenda_on_random_strings():
    from yearweave.llm.sentencepiece_codec import AgendaEncoder
    with open(MODEL, "rb") as f:
        encoder = AgendaEncoder(f.read())
    r = random.Random(1)
    texts = ["".join(r.choice("ab \n\t<0x>é日▁😀theInr#*.\u0000") for _ in range(r.randint(0, 120))) for _ in range(800)]
    texts += ["".join(r.choice("inthesaror") for _ in range(n)) for n in range(1, 90)] + ["", " ", "  ", "▁"]
    for i in range(0, len(texts), 100):
        got = [np.frombuffer(b, np.int32).tolist() for b in encoder.encode(texts[i:i + 100])]
        assert got == encoder.library.encode(texts[i:i + 100])


def test_a_text_that_the_library_reads_otherwise_takes_its_ids():
    """The agenda's ids are returned; with a library that gives others for one text, that text alone takes them, and says so."""
    from yearweave.llm.sentencepiece_codec import AgendaEncoder, encode_texts
    with open(MODEL, "rb") as f:
        encoder = AgendaEncoder(f.read())
    texts = ["one two", "three four", "", "日本 five"]
    true = encoder.library

    class Other:
        def __getattr__(self, name):
            return getattr(true, name)

        def encode(self, given, num_threads=1):
            return [true.encode(t)[::-1] if t.startswith("three") else true.encode(t) for t in given]

    encoder.library = Other()
    packed, decoded, same = encode_texts(encoder, texts)
    got = [np.frombuffer(p, np.int32).tolist() for p in packed]
    assert same == [True, False, True, True]
    assert got == [true.encode(t)[::-1] if t.startswith("three") else true.encode(t) for t in texts]
    assert decoded == [true.decode(ids) for ids in got]


# -- 2 ---------------------------------------------------------------------------------------------------------------

def removed_by_brute_force(texts, length):
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [1024, 1])
def test_suffix_dedup_equals_brute_force(docs, empty, monkeypatch, crowd):
    from yearweave.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "KEY_SEGMENTS", crowd)  # 1: every key is halved to the last window
    got = suffix_dedup.removal_digest(suffix_dedup.without_repeats(docs)).collect()
    want = removed_by_brute_force([t.encode() for _, t in ids_texts()], 200)
    assert Counter(map(tuple, got)) == Counter((i, *w) for (i, _), w in zip(ids_texts(), want))
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_interval_expansion_on_small_alphabets():
    from yearweave.llm.suffix_dedup import repeated_starts
    r = random.Random(3)
    for length in (3, 5, 12):
        for _ in range(60):
            bodies = [bytes(r.choice(b"ab") for _ in range(r.randint(length, 30))) for _ in range(r.randint(1, 12))]
            counts = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
            want = [i + length <= len(b) and counts[b[i:i + length]] > 1 for b in bodies for i in range(len(b) + 1)]
            assert repeated_starts(bodies, length).tolist() == want


def test_segments_cover_every_window_once_in_pieces(monkeypatch):
    from yearweave.llm import suffix_dedup
    text = prose(random.Random(2), 500).encode()
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    start, count, *_ = suffix_dedup.segments(text)
    assert [w for s, n in zip(start, count) for w in range(s, s + n)] == list(range(len(text) - 199))


# -- 3 ---------------------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, record_type string, payload binary"


def test_warc_round_trip(spark):
    from yearweave.llm.warc_bundles import read_bundles, with_roles, write_bundles
    html = ["<p>a</p>", "<p>a</p>", "", None, "x" * 700_000, "ünï\r\n\r\nheaders: no", "<p>a</p>", "<p>a</p>"]
    ids = [1, 2, 3, 4, 5, 6, 2, None]
    urls = ["http://a/ b\r\nX: y", None, "é", "u", "u", "u", "u", ""]
    pages = spark.createDataFrame([(i, u, h, "clash", b"clash") for i, u, h in zip(ids, urls, html)], PAGES)
    records = read_bundles(write_bundles(with_roles(pages))).collect()
    newest = {}
    for i, h in zip(ids, html):
        newest[h or ""] = max(newest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, h in zip(ids, html):
        payload = (h or "").encode()
        first = i == newest[h or ""]
        want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                     "response" if first else "revisit", None if first else newest[h or ""], payload if first else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in records]
    assert Counter(got) == Counter(want)
    assert read_bundles(write_bundles(with_roles(pages.limit(0)))).count() == 0
    assert with_roles(pages, min_payload=9).filter("refers_to IS NOT NULL").count() == 0


def test_warc_footer_finds_records(spark):
    from yearweave.llm.warc_bundles import BundleReader, parse_record, with_roles, write_bundles
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 20_000, "", b"") for i in range(12)], PAGES)
    for row in write_bundles(with_roles(pages).coalesce(1)).collect():
        reader = BundleReader(bytes(row.content))
        assert len(reader.frames) > 1 and sum(p for _, p, _ in reader.frames) < len(row.content)
        name = reader.map[-1][0]
        (record,) = reader.records({name})
        fields, payload = parse_record(record)
        assert fields["WARC-Record-ID"] == name and payload.startswith(b"<p>")


# -- 4 ---------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}).encode())
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i:i + 4]), seed=42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, ids, bits=4):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = np.array([2**62 if i is None else i for i in ids])
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_simhash_groups(docs, empty):
    from yearweave.llm.simhash_groups import simhash_dedup, simhash_groups
    rows = ids_texts()
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps, [i for i, _ in rows])
    got = simhash_groups(docs).collect()
    assert Counter(map(tuple, got)) == Counter((i, format(f, "016x"), c) for (i, _), f, c in zip(rows, fps, roots))
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))
    assert simhash_groups(empty).count() == simhash_dedup(empty).count() == 0


@pytest.mark.parametrize("tile", [8192, 8])
def test_simhash_links_of_planted_bits(spark, monkeypatch, tile):
    from yearweave.llm import simhash_groups
    monkeypatch.setattr(simhash_groups, "TILE", tile)  # 8: most cells of the cluster are cut
    r = random.Random(8)
    centre = r.getrandbits(64)
    fps = [centre]
    for _ in range(60):
        fps.append(r.choice(fps) ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    fps += [r.getrandbits(64) for _ in range(60)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {x.doc_id: x.component_id for x in simhash_groups.with_components(table).collect()}
    assert [got[i] for i in range(len(fps))] == plain_components(fps, range(len(fps)))


def test_components_of_a_long_chain(spark):
    from yearweave.llm.components import connected_components
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (95, 100)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


# -- 5 ---------------------------------------------------------------------------------------------------------------

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, extra string"
SCHEMAS = {"add": {"a": ("number", True), "b": ("integer", False), "tags": ("array", False)}}


def test_tool_calls(spark):
    from yearweave.llm.tool_chat import link_calls
    calls = spark.createDataFrame([
        (1, "x", 1, "add", '{"b": 2, "a": 1.50}', ""), (1, "x", 1, "add", '{"b": 2, "a": 1.50}', ""),  # repeated row
        (1, "y", 2, "add", '{"a": "${x}", "zz": 1}', ""),
        (1, "z", 3, "none", "{}", ""), (1, "w", 4, "add", "not json", ""), (1, "v", 5, "add", None, ""),
        (1, "u", 6, "add", '{"a": 1, "b": 1.5, "tags": {}}', ""), (1, "t", 7, "add", '{"a": "${gone}"}', ""),
        (2, "p", 1, "add", '{"a": "${q}"}', ""), (2, "q", 2, "add", '{"a": 1}', ""),  # refers to a later call
        (3, "p", 1, "add", '{"a": "${q}"}', ""), (3, "q", 2, "add", '{"a": "${p}"}', ""), (3, "s", 3, "add", '{"a": 1}', ""),
        (4, "d", 1, "add", '{"a": 1}', ""), (4, "d", 2, "add", '{"a": 2}', ""), (None, None, 1, "add", '{"a": 1}', "")], CALLS)
    results = spark.createDataFrame(
        [(1, "x", 2, "late"), (1, "x", 1, "3\n\"q\""), (1, "lost", 9, None), (2, "q", 3, "ok")], "conv_id long, call_id string, turn long, content string")
    rows = {(r.conv_id, r.call_id, r.turn): r for r in link_calls(calls, results, SCHEMAS).collect()}
    assert len(rows) == 16
    x = rows[1, "x", 1]
    assert x.errors == [] and x.n_results == 2
    assert x.message == '{"arguments":{"a":1.5,"b":2},"id":"x","name":"add","result":"3\\n\\"q\\""}'
    assert rows[1, "y", 2].errors == ["a is not number", "unknown zz", "no result"]
    assert rows[1, "z", 3].errors == ["unknown tool", "no result"]
    assert rows[1, "w", 4].errors == rows[1, "v", 5].errors == ["malformed arguments", "no result"]
    assert rows[1, "u", 6].errors == ["b is not integer", "tags is not array", "no result"]
    assert "unknown reference gone" in rows[1, "t", 7].errors
    assert [rows[2, c, t].level for c, t in (("p", 1), ("q", 2))] == [1, 0]
    assert [rows[3, c, t].level for c, t in (("p", 1), ("q", 2), ("s", 3))] == [None, None, 0]
    assert "cyclic references" in rows[3, "p", 1].errors and "cyclic references" not in rows[3, "s", 3].errors
    assert all("identifier used twice" in rows[4, "d", t].errors for t in (1, 2))
    assert rows[1, "lost", 9].errors == ["result without a call"]
    assert rows[None, None, 1].errors == ["no result"]
    assert link_calls(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def test_chat_turns_with_nulls_and_repeats(spark):
    from yearweave.llm.tool_chat import linked_chat
    chat = spark.createDataFrame([
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", None), (1, 0, "user", "hi"), (1, 5, "assistant", "x"),
        (None, 0, "user", "n"), (2, None, "user", "n"), (3, 0, None, "n")], "conv_id long, turn long, role string, text string")
    rows = {(r.conv_id, r.turn): r for r in linked_chat(chat).collect()}
    assert rows[1, 0].errors == [] and rows[1, 2].errors == ["missing text", "no result"]
    assert '"after":"${turn-0}"' in rows[1, 2].message and rows[1, 5].errors == ["result without a call"]
    assert len(rows) == 5


# -- 6 ---------------------------------------------------------------------------------------------------------------

def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_banded_distance(spark):
    from yearweave.llm.line_dedup import edit_distance
    r = random.Random(1)
    pairs = []
    for _ in range(300):
        a = [r.choice("abc😀") for _ in range(r.randint(3, 14))]
        b = a[:]
        for _ in range(r.randint(0, 4)):
            at = r.randrange(len(b)) if b else 0
            b[at:at + r.randint(0, 1)] = r.choice(["", "c", "a"])
        a, b = sorted(("".join(a), "".join(b)), key=len, reverse=True)
        if b and len(a) - len(b) <= 2:
            pairs.append((a, b))
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", edit_distance(F.split("a", ""), F.split("b", ""), 2).alias("d"))
    assert all(min(r.d, 3) == min(distance(r.a, r.b), 3) for r in rows.collect())


def test_line_dedup_equals_brute_force(spark, docs, empty):
    from yearweave.llm.line_dedup import line_report, without_repeated_lines
    r = random.Random(6)
    base = [prose(r, 9) for _ in range(25)]
    lines = list(base)
    for _ in range(60):  # chains and bundles of near lines, and lines of the least length
        line = list(r.choice(lines))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(line))
            line[at:at + r.randint(0, 1)] = r.choice(["", "x", "yz"])
        lines.append("".join(line))
    lines += ["a" * n for n in (1, 1, 2, 5, 6, 7, 11, 12, 13, 31, 31, 32, 33, 34, 35)]
    r.shuffle(lines)
    texts = ["\n".join(lines[i:i + 4]) for i in range(0, len(lines), 4)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, ""), (901, None), (902, texts[0])]
    got = {x.doc_id: x for x in line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, want = [], {}
    for i, t in rows:
        want[i] = []
        for no, line in enumerate((t or "").split("\n")):
            if line:
                if any(distance(s, line) <= min(2, min(len(s), len(line)) // 6) for s in seen):
                    want[i].append(no)
                seen.append(line)
    assert {i: x.removed_lines for i, x in got.items()} == want
    assert got[901].n_lines == 1 and got[902].n_removed == len([x for x in texts[0].split("\n") if x])
    kept = without_repeated_lines(docs)
    assert kept.columns == docs.columns and line_report(docs).count() == docs.count()
    by_id = {x.doc_id: x for x in kept.collect()}
    assert all(x.n_chars == len(x.text) for x in by_id.values() if x.doc_id == 34)
    assert 30 not in by_id and {35, 36, 39} <= set(by_id)  # a copy goes; empty, null and blank texts stay
    assert line_report(empty).count() == without_repeated_lines(empty).count() == 0


def test_registered_line_dedup_finds_short_lines(spark, tmp_path):
    from yearweave.llm.registry import QUERIES
    r = random.Random(8)
    base = ["All rights reserved.", "Subscribe to our newsletter", "abcdefghijkl", "Un.", "To.", "日本", "}", "---", "", "  ", "😀", "-" * 40]
    lines = list(base)
    for _ in range(120):
        line = list(r.choice(base[:3] + [prose(r, 2), prose(r, 4)]))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(line))
            line[at:at + r.randint(0, 1)] = r.choice(["", "x", "yz"])
        lines.append("".join(line))
    lines += base
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i:4 * i + 4])) for i in range(len(lines) // 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.removed_lines for x in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()}
    seen, want = [], {}
    for i, t in rows:
        want[i] = []
        for no, line in enumerate(t.split("\n")):
            if any(c.isalnum() or c == "😀" for c in line):
                if any(distance(s, line) <= min(2, min(len(s), len(line)) // 6) for s in seen):
                    want[i].append(no)
                seen.append(line)
    assert got == want and sum(map(len, want.values())) > 40


def test_short_lines_under_a_repeated_line_stay(spark):
    from yearweave.llm.line_dedup import without_repeated_lines
    header = "one header line that many of these documents share"
    texts = [header + "\nmilk\neggs", header + "\nbread\n\nsalt", header + "\n日本", header + "\n😀", header, header + "\n---\n }", "\n---"]
    rows = [(i, t, len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.text, r.n_chars) for r in without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    want = {0: texts[0], 1: "bread\n\nsalt", 2: "日本", 3: "😀", 6: "\n---"}  # no content is left of 4 and 5; 6 loses nothing
    assert got == {i: (t, len(t)) for i, t in want.items()}


# -- 7 ---------------------------------------------------------------------------------------------------------------

def test_toxicity_learns_and_locates(spark):
    from yearweave.llm.toxicity import toxicity, without_toxic
    r = random.Random(7)
    rows, labels = [], []
    for i in range(700):
        sentences = [prose(r, 6) + "." for _ in range(r.randint(1, 8))]
        toxic = int(r.random() < 0.3)
        if toxic:
            sentences.insert(r.randrange(len(sentences) + 1), f"You utter {r.choice(['snorkfool', 'snorkhead', 'grumblenit'])}!")
        rows.append((i, " ".join(sentences), "en", "s", 1, 0.1, 1, 1, "x"))
        labels.append((i, 1, toxic))
    rows += [(800, None, "", "", 0, 0.0, 0, 0, ""), (801, "", "", "", 0, 0.0, 0, 0, ""), (802, "İİ " * 9000, "", "", 0, 0.0, 0, 0, ""),
             (None, "fine words", "", "", 0, 0.0, 0, 0, ""), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (5, 1, None), (None, 1, 1), labels[0]], "doc_id long, quality int, toxic int")
    scored = toxicity(docs, marks).collect()
    truth, texts = {i: t for i, _, t in labels}, {row[0]: row[1] for row in rows}
    assert len(scored) == len(rows)
    for x in scored:
        if x.doc_id is not None:
            assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5)
    held = [x for x in scored if x.held_out and x.doc_id in truth]
    assert sum(x.predicted == truth[x.doc_id] for x in held) / len(held) > 0.95
    found = [texts[x.doc_id][s.start:s.end] for x in held if x.predicted and truth[x.doc_id] for s in x.sentences]
    assert sum("utter" in f for f in found) / len(found) > 0.9
    empties = [x.score for x in scored if x.doc_id in (800, 801)]
    assert empties == [0.0, 0.0]
    kept = without_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(1 - x.predicted for x in scored)
    none = marks.limit(0)
    assert {x.score < 0.5 for x in toxicity(docs.limit(9), none).collect()} == {True}
    assert toxicity(docs.limit(0), none).count() == 0


# -- 8 ---------------------------------------------------------------------------------------------------------------

def test_nearest_neighbours(spark, monkeypatch):
    from yearweave.llm import hnsw_search
    monkeypatch.setattr(hnsw_search, "SHARD_VECTORS", 300)
    r = np.random.default_rng(5)
    v = r.normal(size=(900, 24)) * r.uniform(0.5, 2, size=(900, 1))
    v[100:400] = v[100]  # a large group of one vector
    rows = [(i, x.tolist(), "clash") for i, x in enumerate(v)]
    rows += [(2000, None, ""), (2020, [0.0] * 24, ""), (2040, [float("nan")] * 24, ""), (2060, [1.0, None], ""), (2080, [], ""),
             rows[7], rows[20], (None, [1.0] * 24, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = hnsw_search.nearest(table, 10, lambda i: i % 20 == 0).collect()
    by_query = {}
    for x in sorted(got, key=lambda x: (x.query_id, x["rank"])):
        by_query.setdefault(x.query_id, []).append((x.vec_id, x.score, x["rank"]))
    assert set(by_query) == set(range(0, 900, 20))
    hits = 0
    for q, found in by_query.items():
        s = v @ v[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-round(s[i], 9), i))[:10]
        hits += len({i for i, _, _ in found} & set(order))
        assert [k for _, _, k in found] == list(range(1, 11)) and q not in {i for i, _, _ in found}
        assert all(abs(score - s[i]) < 1e-9 for i, score, _ in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits / (10 * len(by_query)) >= 0.95
    few = hnsw_search.nearest(table.filter("vec_id IN (0, 1, 2)"), 10, lambda i: i % 20 == 0)
    assert [x.vec_id for x in few.orderBy("rank").collect()] == sorted([1, 2], key=lambda i: -(v[i] @ v[0]))
    assert hnsw_search.nearest(table.limit(0), 10, lambda i: i % 20 == 0).count() == 0


# -- 9 ---------------------------------------------------------------------------------------------------------------

def test_decontamination(spark):
    from yearweave.llm.decontaminate import contaminated_items, decontaminated, decontamination_report
    r = random.Random(9)
    items = [prose(r, r.randint(8, 40)) + "\n" + prose(r, r.randint(1, 8)) for _ in range(40)] + [prose(r, 30), "", None]
    rows, want = [], {}
    for i in range(120):
        text, hits = [prose(r, r.randint(0, 400))], set()
        for _ in range(r.choice([0, 0, 1, 2])):
            k = r.randrange(41)
            text += [items[k].upper().replace(" ", "  ") if r.random() < 0.5 else items[k], prose(r, r.randint(0, 90))]
            hits.add(k)
        if r.random() < 0.2:
            text.append(items[r.randrange(41)][:30])  # a piece alone is no leak
        rows.append((i, " ".join(text), "", "", 0, 0.0, 0, 0, ""))
        want[i] = sorted(hits)
    rows += [(500, None, "", "", 0, 0.0, 0, 0, ""), (501, "", "", "", 0, 0.0, 0, 0, ""), rows[0]]
    want |= {500: [], 501: []}
    docs = spark.createDataFrame(rows, DOCS)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination_report(docs, benchmark).collect()
    assert len(got) == len(rows) and {x.doc_id: x.item_ids for x in got} == want
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {i for i, k in want.items() if not k}
    twice = contaminated_items(docs, benchmark.unionByName(benchmark)).collect()
    assert all(len(x["__items"]) == 2 * len(want[x["__c0"]]) for x in twice)
    assert decontamination_report(docs, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontamination_report(docs.limit(0), benchmark).count() == 0


def test_block_bound_never_loses_an_item():
    """Every passage and item at or over the threshold in full scores is verified, whatever the blocks hold."""
    from yearweave.llm import decontaminate as d
    r = random.Random(3)
    items = []
    for i in range(50):
        words = [f"w{int(r.paretovariate(1))}" for _ in range(r.randint(3, 20))]
        weight = {w: r.random() for w in set(words)}
        total = sum(weight.values())
        items.append((i, " ".join(words), {w: x / total for w, x in weight.items()}, {w: int(w[1:] < "3") * 9 + 1 for w in weight}))
    index = d.build_index(items, 0.5)
    for _ in range(200):
        words = [f"w{int(r.paretovariate(1))}" for _ in range(60)]
        full = {i for i, _, shares, _ in items if sum(s for t, s in shares.items() if t in words) >= 0.5}
        found = d.matches(index, [" ".join(words)], 0.5, 0.0)[0]
        assert {f[0] for f in found} == full


# -- 10 --------------------------------------------------------------------------------------------------------------

def test_kd_shards(spark, docs, empty):
    from yearweave.llm.kd_shards import document_shards, kd_shards
    r = random.Random(10)
    rows = [(i, prose(r, r.randint(1, 60)), r.choice(["en", "de", None]), "s", r.randint(0, 900), 0.0, 0, 0, "") for i in range(3000)]
    rows += [(5000 + i, "the same text", "en", "s", 13, 0.0, 0, 0, "") for i in range(1500)]  # a third are copies
    rows += [(9000, None, None, None, None, None, None, None, None), rows[0], (None, "x", "en", "s", 1, 0.0, 0, 0, "")]
    x = document_shards(spark.createDataFrame(rows, DOCS)).toPandas()
    assert sorted(x["size"]) == sorted(len((t[1] or "").encode()) + 1 for t in rows)
    assert x.groupby("shard")["slot"].apply(lambda s: sorted(s) == list(range(len(s)))).all()
    weights = x.groupby("shard")["size"].sum()
    assert len(weights) == 16 and weights.max() / weights.min() < 1.05
    crc = dict(zip(x.doc_id, x.text_crc32))
    assert all(crc[i] == zlib.crc32((t or "").encode()) for i, t, *_ in rows if i is not None)
    assert set(x.law) == {"bytes"} and x.grown_shard.isna().all()
    texts = {i: t for i, t, *_ in rows if i is not None and i < 5000}
    groups = x[x.doc_id < 5000].assign(text=lambda y: y.doc_id.map(texts)).groupby("text").shard.nunique()
    assert (groups > 1).sum() <= 2
    small = document_shards(docs.limit(3)).toPandas()
    assert len(small) == 3 and small.shard.between(0, 15).all()
    assert document_shards(empty).count() == 0
    five = kd_shards(spark.createDataFrame(rows, DOCS), F.lit(10), F.lit(0).cast("long"), "doc_id", ["n_chars", "lang"], target_bytes=9010).toPandas()
    sizes = five.groupby("shard").size()
    assert len(sizes) == 5 and sizes.max() - sizes.min() < 60


def test_kd_shards_keep_groups_and_spread_repeated_rows(spark):
    from yearweave.llm.kd_shards import GROUP_SHARE, document_shards
    r = random.Random(11)
    rows = [(i, prose(r, 30), "en", "s", 200, 0.0, 0, 0, "") for i in range(1600)]
    texts = [prose(r, 40) for _ in range(90)]  # groups of up to a tenth of a shard, all alike in length and language
    rows += [(2000 + i, texts[i % 90], "en", "s", 200, 0.0, 0, 0, "") for i in range(600)]
    x = document_shards(spark.createDataFrame(rows, DOCS)).toPandas()
    weights = x.groupby("shard")["size"].sum()
    assert len(weights) == 16 and weights.max() / weights.min() < 1.2
    groups = x[x.doc_id >= 2000].groupby("text_crc32").agg(size=("size", "sum"), shards=("shard", "nunique"))
    small = groups[groups["size"] <= GROUP_SHARE * weights.sum() / 16 * 0.9]
    assert len(small) == 90 and (small.shards == 1).all()
    same = [(7, "one and the same row " * 200, "en", "s", 4200, 0.0, 0, 0, "")] * 500 + rows[:20]
    y = document_shards(spark.createDataFrame(same, DOCS)).toPandas()
    assert len(y) == 520 and y.groupby("shard")["slot"].apply(lambda s: sorted(s) == list(range(len(s)))).all()
    weights = y.groupby("shard")["size"].sum()
    assert len(weights) == 16 and weights.max() / weights.min() < 1.2
