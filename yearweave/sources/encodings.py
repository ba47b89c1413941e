"""Files that are not UTF-8 (J1): which vintages hold invalid bytes, and reading those in another charset.

A single-byte charset is read as ISO-8859-1, which names a character for each byte and which Spark reads in splits, and its
upper half is then translated. Bytes that the charset leaves undefined become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The charset in which Spark reads bytes one by one.
BYTES = "ISO-8859-1"
_UPPER = "".join(map(chr, range(128, 256)))


def upper_half(charset: str) -> str:
    """The characters of bytes 128 to 255. Raises for charsets of several bytes a character, and those without ASCII."""
    every = bytes(range(256)).decode(charset, "replace")
    if len(every) != 256 or every[:128] != bytes(range(128)).decode("ascii") or every[128:].count("�") > 64:
        raise ValueError(f"{charset} is no single-byte charset with ASCII in its lower half")
    return every[128:]


def translated(c: Column, charset: str) -> Column:
    """Text that was read as :data:`BYTES`, as ``charset`` means it."""
    return F.translate(c, _UPPER, upper_half(charset))


def translated_name(name: str, charset: str) -> str:
    return name.translate(str.maketrans(_UPPER, upper_half(charset)))


def line_facts(spark: SparkSession, paths: Sequence[str], quote: str = '"') -> tuple[bool, bool]:
    """Whether a line has an odd number of quotes, and whether one is not valid UTF-8: one splittable text pass."""
    r = spark.read.text(list(paths)).agg(
        F.bool_or(odd_quotes(F.col("value"), quote)).alias("odd"), F.bool_or(~F.is_valid_utf8("value")).alias("invalid")).first()
    return bool(r["odd"]), bool(r["invalid"])


def odd_quotes(line: Column, quote: str = '"') -> Column:
    """Counted in bytes, so that characters cut short by a wrong charset swallow no quote."""
    gone = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(quote), F.lit("")))
    return (gone / len(quote.encode())).cast("long") % 2 == 1


def invalid_bytes_report(spark: SparkSession, vintages: Mapping[int, Sequence[str]]) -> DataFrame:
    """``file_year, file, n_lines, n_invalid_lines, n_invalid_sequences`` of every file of ``{year: paths}``, headers included.

    A sequence is what a UTF-8 reader replaces by one U+FFFD. One aggregate over text read in splits.
    """
    empty = spark.createDataFrame([], "file_year int, file string, n_lines long, n_invalid_lines long, n_invalid_sequences long")
    if not vintages:
        return empty
    lines = [spark.read.text(list(paths)).select(F.lit(int(year)).alias("file_year"), F.col("_metadata.file_path").alias("file"), "value")
             for year, paths in sorted(vintages.items())]
    marks = lambda c: (F.octet_length(c) - F.octet_length(F.replace(c, F.lit("�"), F.lit("")))) / 3
    valid, value = F.is_valid_utf8("value"), F.col("value")
    replaced = F.when(valid, 0).otherwise(marks(F.make_valid_utf8(value)) - marks(value))
    return reduce(DataFrame.unionByName, lines).groupBy("file_year", "file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~valid).alias("n_invalid_lines"),
        F.sum(replaced).cast("long").alias("n_invalid_sequences"))
