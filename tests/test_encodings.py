"""Files that are not UTF-8: found, counted, and read in the charset named for them."""

import pytest
from pyspark.sql import functions as F

from yearweave.sources import csv_scan, encodings

TEXT = 'N\u00c4ME,NOTE\n"caf\u00e9 \u20ac","\u201cquoted\u201d"\nplain,"a ""b"" \u00ff"\n'
BROKEN = 'N\u00c4ME,NOTE\n"line\none \u00e9","\u0160"\nplain,x\n'


def write(tmp_path, name, text, charset):
    path = tmp_path / name
    path.write_bytes(text.encode(charset))
    return str(path)


@pytest.mark.parametrize("charset", ["windows-1252", "utf-8"])
@pytest.mark.parametrize("text", [TEXT, BROKEN])
@pytest.mark.parametrize("options", [{}, {"multiLine": "true"}])
def test_a_file_reads_alike_in_both_charsets(spark, tmp_path, charset, text, options):
    path = write(tmp_path, "a.csv", text, charset)
    df = csv_scan.read_csv_strings(spark, path, options, "windows-1252")
    assert df.columns == ["N\u00c4ME", "NOTE"]
    want = [("caf\u00e9 \u20ac", "\u201cquoted\u201d"), ("plain", 'a "b" \u00ff')] if text is TEXT else [("line\none \u00e9", "\u0160"), ("plain", "x")]
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_a_quote_after_a_cut_character_counts(spark, tmp_path):
    """0xE9 opens a UTF-8 character of three bytes: the quotes and the comma behind it are no part of it."""
    path = write(tmp_path, "a.csv", 'A,B\n"\u00e9","x\ny"\n', "latin-1")
    assert encodings.line_facts(spark, [path]) == (True, True)
    assert [tuple(r) for r in csv_scan.read_csv_strings(spark, path, None, "latin-1").collect()] == [("\u00e9", "x\ny")]


def test_without_a_fallback_nothing_changes(spark, tmp_path):
    path = write(tmp_path, "a.csv", "A\ncaf\u00e9\n", "latin-1")
    assert [r.A for r in csv_scan.read_csv_strings(spark, path).collect()] == ["caf\ufffd"]


def test_invalid_bytes_are_counted_by_file(spark, tmp_path):
    bad = write(tmp_path, "bad.csv", "A\n\u00e9 \u00e9\nplain\n\u00ff\n", "latin-1")
    good = write(tmp_path, "good.csv", "A\n\u00e9 \ufffd\n\n", "utf-8")
    got = encodings.invalid_bytes_report(spark, {2014: [bad], 2015: [good]}).select(
        "file_year", F.substring_index("file", "/", -1).alias("file"), "n_lines", "n_invalid_lines", "n_invalid_sequences")
    assert sorted(map(tuple, got.collect())) == [(2014, "bad.csv", 4, 2, 3), (2015, "good.csv", 3, 0, 0)]
    assert encodings.invalid_bytes_report(spark, {}).collect() == []


@pytest.mark.parametrize("charset", ["utf-8", "utf-16", "gbk", "cp037", "shift_jis"])
def test_other_charsets_are_refused(charset):
    with pytest.raises(ValueError, match="single-byte"):
        encodings.upper_half(charset)


def test_undefined_bytes_are_marked():
    assert encodings.upper_half("windows-1252")[0x80 - 128] == "\u20ac" and encodings.upper_half("windows-1252")[0x81 - 128] == "\ufffd"
