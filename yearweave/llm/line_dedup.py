"""Line de-duplication within an edit distance, from DataFrame operations alone.

A line goes if an earlier line (smaller document id, then line number) of the table lies within reach:
at most ``MAX_EDITS`` edits, and at most one for every ``CHARS_PER_EDIT`` characters of the shorter of the two. Equal
lines are the case of none, and found by their hashes alone. That one rule holds for lines of every
length; lines without content (``CONTENT``) stay. Two lines within ``t`` edits share, cut into
``t + 1`` segments, at least one segment whole, near its own place: every different line is indexed by
its segments and length, and probes the index with the substrings that can match, for its own and each
shorter length in reach. What shares a segment is first held against a bound from letter counts, inside
the join, then verified by a bit-parallel edit distance that follows a band around the diagonal.

A segment that more than ``HOT_KEY`` different lines have (a template with numbers in it) is no key by itself: both sides
are split on by a segment of the line's digits, for these too lie within the edits of the whole, and so are held
against each other inside the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

MAX_EDITS = 2
#: Characters of the shorter line for each edit within reach: two edits are at most a sixth of a line.
CHARS_PER_EDIT = 6
#: Different lines of one segment beyond which it is split by digits as well. Decides the way, never the result.
HOT_KEY = 128
#: What a line with content has: a letter, a digit or a pictograph. Blank lines, rules and lone brackets have none.
CONTENT = r"[\p{L}\p{N}\p{So}]"
#: Letters whose counts bound the distance: an edit changes at most two counts by one.
COUNTED = "eatnrioshldc"
#: Bits of a count; it goes round, and so does the distance of two counts.
COUNT_BITS = 5
#: Characters of the pieces that must agree before a pair's edit distance is worked out.
PIECE_CHARS = 6
#: Lines for each word of the filter that finds lines by their places, and the most words it has, since it is broadcast.
#: A fuller filter lets more other lines pass. Decides the way, never the result.
LINES_PER_WORD, MAX_WORDS = 4, 1 << 19


def _split_lines(docs: DataFrame) -> DataFrame:
    """Every line with its place."""
    text = text_or_empty("text")
    return docs.select("doc_id", F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n", -1)).alias("no", "line"))


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with content, with its place and a 128-bit identity."""
    return _split_lines(docs).filter(F.col("line").rlike(CONTENT)).withColumn("n", F.char_length("line")).withColumn(
        "h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit("line"), F.col("line")))


def _reach(n: Column, max_edits: int) -> Column:
    """Edits within reach of a line of ``n`` characters."""
    return F.greatest(F.lit(0), F.least(F.lit(max_edits), F.floor(n / CHARS_PER_EDIT).cast("int")))


def _probes(max_edits: int, least: int = 0) -> list[tuple[int, int, int]]:
    """(how much shorter, segment, shift): all places where a segment of a text in reach can lie."""
    return [
        (less, j, shift) for less in range(least, max_edits + 1) for j in range(max_edits + 1)
        for shift in range(max(-j, less - (max_edits - j)), min(j, less + max_edits - j) + 1)]


def _segment(n: Column, j: int, parts: Column) -> tuple[Column, Column]:
    """Start and length of segment ``j`` of a text of ``n`` characters: the longer segments come last."""
    short = F.floor(n / parts).cast("int")
    longer = n - short * parts
    return j * short + F.greatest(F.lit(0), F.lit(j) - parts + longer), short + F.when(F.lit(j) >= parts - longer, 1).otherwise(0)


def _keys(max_edits: int) -> Column:
    """The hash of each probe's substring, with the length and segment it stands for. Lengths without such a probe are left
    out when the array is exploded: a condition here would keep the places from being worked out once for all probes."""
    keys = []
    for less, j, shift in _probes(max_edits):
        n = F.col("n") - less
        start, size = _segment(n, j, _reach(n, max_edits) + 1)
        keys.append(F.xxhash64(F.substring(F.col("line"), start + (shift + 1), size), n, F.lit(j)))
    return F.array(*keys)


def _least_chars(max_edits: int) -> Column:
    """For each probe the least characters of a line that has it: so many edits are within reach of the line it asks for."""
    return F.array(*[F.lit(less + CHARS_PER_EDIT * max(j, less, 1)) for less, j, _ in _probes(max_edits)])


def _digits() -> Column:
    """The digits of the line, in order: an edit of the line is at most one of them."""
    return F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", "[^0-9]+", "")).otherwise(F.lit(""))


def _digit_keys(digits: str, max_edits: int, probing: bool) -> Column:
    """Hashes of the digits' own segments, or of all substrings that can equal one, each with the number of digits it stands for."""
    t = max_edits
    probes = _probes(t, -t) if probing else [(0, j, 0) for j in range(t + 1)]
    keys = []
    for less, j, shift in probes:
        n = F.char_length(digits) - less
        start, size = _segment(n, j, F.lit(t + 1))
        part = F.substring(F.col(digits), F.greatest(start + (shift + 1), F.lit(1)), size)
        keys.append(F.when(n >= 0, F.xxhash64("key", part, n, F.when(size > 0, j).otherwise(-1))))
    return F.explode(F.array_distinct(F.array(*keys)))


def _letter_counts() -> Column:
    """Counts of letters modulo 32, twelve in one number."""
    count = lambda c: (F.octet_length("line") - F.octet_length(F.replace("line", F.lit(c), F.lit("")))).cast("long")
    parts = [F.shiftleft(count(c).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)), COUNT_BITS * k) for k, c in enumerate(COUNTED)]
    return reduce(Column.bitwiseOR, parts)


def _count_distance(a: str, b: str) -> Column:
    """At most the sum of the differences of the counts themselves."""
    part = lambda c, k: F.shiftright(c, COUNT_BITS * k).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))
    apart = [F.abs(part(a, k) - part(b, k)) for k in range(len(COUNTED))]
    return reduce(Column.__add__, [F.least(d, (1 << COUNT_BITS) - d) for d in apart])


def edit_distance(a: Column, b: Column, max_edits: int) -> Column:
    """The distance of two character arrays if it is at most ``max_edits``, else more than that.

    One column of the table per character of ``b``, its differences down the band held in two numbers
    of ``2 * max_edits + 1`` bits. Lengths may differ by ``max_edits`` and ``a`` has at least as many.
    """
    t, width = max_edits, 2 * max_edits + 1
    every = (1 << width) - 1
    mask = lambda c: c.bitwiseAND(F.lit(every))
    invert = lambda c: c.bitwiseXOR(F.lit(every))
    n = F.size(a)
    equal = lambda i, k: F.when(F.get(a, i + (k - t)) == F.get(b, i), 1 << k).otherwise(0)
    bits = F.transform(F.sequence(F.lit(0), F.size(b) - 1), lambda i: F.struct(
        i.alias("i"), sum((equal(i, k) for k in range(1, width)), equal(i, 0)).alias("x")))
    bind = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)

    def column(state: Column, at: Column) -> Column:
        def with_diagonal(s: Column) -> Column:
            d0, hp, hn, d = s["d0"], s["hp"], s["hn"], state["d"]
            low = n - 1 - at["i"] + t  # the bit of the last row of the table
            bit = lambda c: (F.call_function("shiftright", c, low)).bitwiseAND(F.lit(1))
            down = F.when(at["i"] < n - t, 1 - F.shiftright(d0, width - 1).bitwiseAND(F.lit(1))).otherwise(bit(hp) - bit(hn))
            half = F.shiftright(d0, 1)
            return F.struct(
                hn.bitwiseOR(invert(half.bitwiseOR(hp))).alias("vp"), half.bitwiseAND(hp).alias("vn"), (d + down).alias("d"))

        vp, vn, x = state["vp"], state["vn"], at["x"]
        d0 = mask((x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn))
        return bind(d0, lambda v: bind(
            F.struct(v.alias("d0"), vn.bitwiseOR(invert(v.bitwiseOR(vp))).alias("hp"), v.bitwiseAND(vp).alias("hn")), with_diagonal))

    start = F.struct(F.lit(every ^ ((1 << t) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(t).alias("d"))
    return F.aggregate(bits, start, column)["d"]


def _beyond_common_start(a: Column, b: Column, max_edits: int) -> tuple[Column, Column]:
    """Both character arrays from their first difference on (``max_edits`` characters at least): the distance stays."""
    same = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False) - 1
    skip = F.greatest(F.lit(0), F.least(F.when(same < 0, F.size(b)).otherwise(same), F.size(b) - max_edits - 1)).cast("int")
    return F.slice(a, skip + 1, F.size(a)), F.slice(b, skip + 1, F.size(b))


def _pieces_agree(a: Column, b: Column, max_edits: int) -> Column:
    """Of ``a`` in pieces of a few characters, all but ``max_edits`` lie in ``b``, at most as many places off:
    an edit spoils one piece. Holds for every pair within the distance, and for few others."""
    pieces = F.sequence(F.lit(0), F.greatest(F.floor(F.char_length(a) / PIECE_CHARS).cast("int") - 1, F.lit(0)))
    at = lambda i: i * PIECE_CHARS + 1
    spoiled = F.filter(pieces, lambda i: ~F.contains(
        F.substring(b, F.greatest(at(i) - max_edits, F.lit(1)), F.lit(PIECE_CHARS + 2 * max_edits)),
        F.substring(a, at(i), F.lit(PIECE_CHARS))))
    return F.size(spoiled) <= max_edits


def different_lines(lines: DataFrame, max_edits: int) -> DataFrame:
    """Each different line once: its first place, copies, length, letter counts, digits and keys."""
    place = F.struct("doc_id", "no", "th")
    kept = ("n", "counts", "digits", "keys")
    return lines.select(
        "h1", "h2", place.alias("place"), "n", _letter_counts().alias("counts"), _digits().alias("digits"),
        _keys(max_edits).alias("keys")).groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"), *[
            F.first(c).alias(c) for c in kept]).withColumn("line_id", F.monotonically_increasing_id())


def candidate_pairs(different: DataFrame, max_edits: int) -> DataFrame:
    """``a`` (never the longer) and ``b``, each pair once: all lines within reach of each other, and few others."""
    probes = _probes(max_edits)
    own = F.array(*[F.lit(less == 0 and shift == 0) for less, _, shift in probes])
    has_probe = F.col("n") >= F.get(_least_chars(max_edits), F.col("probe"))
    index = different.select(
        F.col("line_id").alias("a"), F.col("counts").alias("counts_a"), _reach(F.col("n"), max_edits).alias("reach"),
        F.col("digits").alias("digits_a"), "n", F.posexplode("keys").alias("probe", "key")).filter(
        F.get(own, F.col("probe")) & has_probe).drop("n", "probe")
    asked = different.select(
        F.col("line_id").alias("b"), F.col("counts").alias("counts_b"), F.col("digits").alias("digits_b"),
        "n", F.posexplode("keys").alias("probe", "key")).filter(has_probe).withColumn(
        "same_length", F.col("probe") < sum(less == 0 for less, _, _ in probes)).drop("n", "probe")
    apart = (F.col("a") != F.col("b")) & (~F.col("same_length") | (F.col("a") < F.col("b"))) & (
        _count_distance("counts_a", "counts_b") <= 2 * F.col("reach"))
    hot = stage(index.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > HOT_KEY).select("key"), "hot-keys")
    # a hash join: neither the many probes nor the index need sorting, and no key has more than HOT_KEY lines in it
    # what is alike in many rows stands first and ids last: the shuffled blocks are packed better
    rest = index.join(hot, "key", "left_anti").select("reach", "key", "counts_a", "a")
    probing = asked.select("same_length", "key", "counts_b", "b")
    near = rest.hint("shuffle_hash").join(probing, (rest["key"] == probing["key"]) & apart).select("a", "b")
    split = index.join(hot, "key", "left_semi").withColumn("part", _digit_keys("digits_a", max_edits, False)).drop("key")
    probing = asked.join(hot, "key", "left_semi").withColumn("part", _digit_keys("digits_b", max_edits, True)).drop("key")
    among_hot = split.hint("merge").join(probing, (split["part"] == probing["part"]) & apart & (
        F.levenshtein("digits_a", "digits_b", max_edits) >= 0)).select("a", "b")
    return near.union(among_hot).distinct()


def _word_and_bits(words: int, *place: str) -> tuple[Column, Column]:
    """Where a place lies in a filter of so many words of 64 bits: its word, and three bits of that."""
    h = F.xxhash64(F.lit("place"), *place)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(F.shiftright(h, 18), F.lit(words)), bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))


def likely_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines (``doc_id``, ``th``, ``no``, ``line``) at the places ``first`` of ``wanted``, and few others.

    The wanted places are marked in a Bloom filter of 64-bit words, which is broadcast: of all other lines' texts next to none is shuffled."""
    words = max(1, min(MAX_WORDS, wanted.count() // LINES_PER_WORD))
    word, bits = _word_and_bits(words, "first.doc_id", "first.th", "first.no")
    marked = wanted.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("marked"))
    word, bits = _word_and_bits(words, "doc_id", "th", "no")
    asked = _split_lines(docs).select("*", word.alias("word"), bits.alias("bits"))
    return asked.join(F.broadcast(marked), "word").filter(F.col("marked").bitwiseAND(F.col("bits")) == F.col("bits")).select(
        "doc_id", "th", "no", "line")


def repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """``doc_id``, ``th`` (the text's hash) and ``no``, the numbers (from 0, ascending) of the lines to drop.

    Only texts with a line to drop have a row. Null texts have no lines. Rows that repeat a document id and text are judged
    alike: none is earlier than the other. Null ids come first.
    """
    lines = _lines(docs)
    places = stage(lines.select("doc_id", "no", "th", "h1", "h2"), "lines")
    different = stage(different_lines(lines, max_edits), "different-lines")
    pairs = stage(candidate_pairs(different, max_edits), "line-pairs")

    wanted = pairs.select(F.col("a").alias("line_id")).union(pairs.select("b")).distinct()
    located = stage(different.join(wanted, "line_id").select("line_id", "first"), "wanted-lines")
    likely = likely_lines(docs, located)
    found = likely.join(located, likely["doc_id"].eqNullSafe(located["first.doc_id"]) & (
        likely["th"] == located["first.th"]) & (likely["no"] == located["first.no"])).select(
        "line_id", "first", "line").dropDuplicates(["line_id"])
    found = stage(found, "line-texts")
    a, b = (found.select(*[F.col(c).alias(f"{c}_{s}") for c in found.columns]) for s in "ab")
    verified = pairs.join(a, pairs["a"] == a["line_id_a"]).join(b, pairs["b"] == b["line_id_b"])
    longer, shorter = F.col("line_b"), F.col("line_a")  # a line probes for its own and shorter lengths
    later = F.when(F.col("first_a") > F.col("first_b"), F.col("a")).otherwise(F.col("b"))
    kept = ("a", "b", "first_a", "first_b", "reach")
    agreeing = stage(verified.filter(_pieces_agree(longer, shorter, max_edits)).withColumn(
        "reach", _reach(F.char_length(shorter), max_edits)).select(*kept, F.split(longer, "").alias("chars_b"), F.split(shorter, "").alias("chars_a")), "agreeing-lines")
    for _ in range(2):  # what both lines begin with, and what they end with, needs no table
        b_rest, a_rest = _beyond_common_start(F.col("chars_b"), F.col("chars_a"), max_edits)
        agreeing = stage(agreeing.select(*kept, *[
            F.reverse(c).alias(n) for c, n in ((b_rest, "chars_b"), (a_rest, "chars_a"))]), "verified-lines")
    close = agreeing.filter(edit_distance(F.col("chars_b"), F.col("chars_a"), max_edits) <= F.col("reach")).select(
        later.alias("line_id")).distinct().withColumn("close", F.lit(True))
    judged = different.join(close, "line_id", "left").filter(F.col("close") | (F.col("copies") > 1)).select(
        "h1", "h2", "first", F.coalesce("close", F.lit(False)).alias("close"))  # other lines stay
    return places.join(judged, ["h1", "h2"]).filter(
        F.col("close") | (F.struct("doc_id", "no") > F.struct("first.doc_id", "first.no"))).groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set("no")).alias("no"))


def line_report(docs: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and ``removed_lines`` of every row; a null text has one empty line."""
    text = text_or_empty("text")
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), F.size(F.split(text, "\n", -1)).alias("n_lines"))
    removed = repeated_lines(docs, max_edits).select(F.col("doc_id").alias("__doc_id"), F.col("th").alias("__th"), "no")
    none = F.array().cast("array<int>")
    return rows.join(removed, rows["doc_id"].eqNullSafe(F.col("__doc_id")) & (rows["th"] == F.col("__th")), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("no"), F.lit(0)).alias("n_removed"), F.coalesce("no", none).alias("removed_lines"))


def without_repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """The documents without the lines to drop; ``n_chars`` follows the text. A document goes if it lost lines and
    none with content is left, of whatever length; one without a line to drop stays as it is.

    All columns pass through, whatever their names: the input row travels as one struct."""
    removed = repeated_lines(docs, max_edits).select(F.col("doc_id").alias("of"), F.col("th").alias("removed_th"), "no")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text_or_empty("text")).alias("th"))
    joined = rows.join(removed, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("removed_th")), "left")
    lines = F.split("row.text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("no"))
    new = F.when(F.col("no").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    out = joined.withColumn("new", new).filter(F.col("no").isNull() | F.col("new").rlike(CONTENT))
    values = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.char_length("new").cast(docs.schema["n_chars"].dataType)
    return out.select(*[values.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
