"""The corpus pipeline on the smallest tables, stage by stage against what each stage may do."""

import hashlib
import unicodedata
from collections import Counter

import public_tokenizers
import sentencepiece

SF = "/root/testdata/sf0.001"


def test_pipeline_end_to_end(spark):
    import corpus_pipeline
    from yearweave.llm.decontaminate import decontamination_report
    from yearweave.llm.line_dedup import without_repeated_lines
    from yearweave.llm.simhash_groups import simhash_groups
    from yearweave.llm.toxicity import toxicity

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    keep = {r.doc_id for r in toxicity(docs, labels).filter("predicted = 0").collect()}
    after = stages["toxicity"](spark, docs, SF).cache()
    assert {r.doc_id for r in after.collect()} == keep and after.columns == docs.columns
    lines = stages["line_dedup"](spark, after, SF).cache()
    assert lines.columns == docs.columns
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, without_repeated_lines(after).collect()))
    unique = stages["simhash"](spark, lines, SF).cache()
    assert {r.doc_id for r in unique.collect()} == {r.component_id for r in simhash_groups(lines).collect()}
    clean = stages["decontamination"](spark, unique, SF).cache()
    leaks = {r.doc_id for r in decontamination_report(unique, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in unique.collect()} - leaks and leaks
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in clean.collect():
        ids = library.encode(r.text)
        want[r.doc_id] = (len(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_on_empty_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name


def _in_reach(a, b):
    reach = min(2, min(len(a), len(b)) // 6)
    if abs(len(a) - len(b)) > 2 or sum(((Counter(a) - Counter(b)) | (Counter(b) - Counter(a))).values()) > 4:
        return False
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1] <= reach


def test_line_stage_equals_plain_python(spark):
    """Expected rows without the library: a line goes after an equal one, or after one within two edits, one at most
    for every six characters of the shorter; a document goes if it lost lines and none with content is left."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    top = max(r.doc_id for r in docs.select("doc_id").collect())
    header = "a header line that several documents of short lines share"
    added = [(top + k, f"{header}\n{rest}") for k, rest in enumerate(("milk\neggs", "bread\nsalt", "---", "milk\neggs"), 1)]
    more = spark.createDataFrame(added, "doc_id long, text string").selectExpr(f"cast(doc_id as {docs.schema['doc_id'].dataType.simpleString()}) doc_id", "text")
    docs = docs.unionByName(more, allowMissingColumns=True)
    content = lambda line: any(unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "So" for c in line)
    seen, by_length, want = set(), {}, {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        lines, kept = (r.text or "").split("\n"), []
        for line in lines:
            if not content(line):
                kept.append(line)
                continue
            near = any(_in_reach(s, line) for n in range(max(6, len(line) - 2), len(line) + 3) for s in by_length.get(n, ()))
            if line not in seen and not near:
                kept.append(line)
            if line not in seen:
                seen.add(line)
                by_length.setdefault(len(line), []).append(line)
        if len(kept) == len(lines):
            want[r.doc_id] = r.text
        elif content("".join(kept)):
            want[r.doc_id] = "\n".join(kept)
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()}
    assert got == want
    assert want[top + 2] == "bread\nsalt" and top + 3 not in want and top + 4 not in want
