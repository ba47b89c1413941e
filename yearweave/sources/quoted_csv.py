"""CSV files whose quoted values run over line ends, read by many tasks.

Spark's ``multiLine`` reader makes a file one task. Here the lines of a file are read in splits, as text, and the records
are found again from the quotes: a line end closes a record unless an odd number of quotes stands before it. That
number is even or odd by three sums: within the line, over the earlier lines of its block (a window over the block),
and over the earlier blocks of its file (a window over the small table of blocks). Lines that are records by themselves,
nearly all, go on as they are; only lines of records that run on are put together.

One scan and one exchange by block: the table of blocks is summed from the same exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearweave.operators._common import SchemaMismatch
from yearweave.sources.encodings import BYTES


def csv_records(spark: SparkSession, paths: Sequence[str], quote: str = '"', encoding: str = "UTF-8") -> DataFrame:
    """Every record as ``file, number, record``: ``number`` counts from 0 in its file, line ends within quotes are kept.

    Lines end with a line feed, or, where a file's first line does, with carriage return and line feed, which is then one
    line feed within quotes too, as for Spark's reader. Blank records are left out,
    but numbered. ``encoding`` is UTF-8 or ISO-8859-1. A file whose quotes do not pair up ends in a record of all that follows the last open one.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (F.decode(F.col("value").cast("binary"), encoding) if encoding == BYTES else F.col("value")).alias("text"))
    odd = (F.char_length("text") - F.char_length(F.replace("text", F.lit(quote), F.lit("")))) % 2
    lines = lines.withColumn("odd", odd).repartition("file", "block")
    of_block = Window.partitionBy("file", "block")
    before = of_block.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # A block's own starts depend on whether it begins inside quotes: both counts are summed, and the table picks one.
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("flips"), F.count_if(F.col("inside") == 0).alias("even"), F.count_if(F.col("inside") == 1).alias("uneven"),
        F.min_by(F.endswith("text", F.lit("\r")), "line").alias("returns"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("open", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("returns", F.first("returns").over(earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    starts = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("uneven"))
    blocks = blocks.withColumn("first", F.coalesce(F.sum(starts).over(earlier), F.lit(0))).select("file", "block", "open", "first", "returns")
    lines = lines.join(blocks, ["file", "block"])
    lines = lines.withColumn("text", F.when(F.col("returns"), F.regexp_replace("text", r"\r$", "")).otherwise(F.col("text")))
    lines = lines.withColumn("inside", (F.col("inside") + F.col("open")) % 2)
    upto = of_block.orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("number", F.col("first") + F.count_if(F.col("inside") == 0).over(upto) - 1)
    alone = lines.filter("inside = 0 AND odd = 0").select("file", "number", F.col("text").alias("record"))
    parts = lines.filter("inside = 1 OR odd = 1").groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "text"))), lambda p: p["text"]), "\n").alias("record"))
    return alone.unionByName(parts).filter(F.trim("record") != "")


def read_quoted_csv(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    """All columns as strings, equal to Spark's ``multiLine`` reader for files whose quotes stand around values only.

    ``options`` are the CSV reader's. With a header, the first record of each file names the columns; files that
    name others than the first raise.
    """
    options = {k: v for k, v in options.items() if k not in ("multiLine", "inferSchema", "enforceSchema")}
    header = str(options.pop("header", "false")).lower() == "true"
    names = spark.read.options(**options, header=str(header).lower(), multiLine="true").csv(paths[0]).columns
    records = csv_records(spark, paths, options.get("quote", '"'), options.get("encoding", "UTF-8"))
    # Line ends within quotes are only left as they are in this mode.
    parsing = {**{k: v for k, v in options.items() if k != "encoding"}, "multiLine": "true"}
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    if header:
        heads = records.filter("number = 0").select("file", "record").distinct()
        if len(paths) > 1:
            found = [tuple(r["names"].asDict().values()) for r in heads.select(F.from_csv("record", ddl, parsing).alias("names")).distinct().collect()]
            if len(found) > 1:
                raise SchemaMismatch(f"{len(paths)} files name their columns in {len(found)} ways: {', '.join(map(str, found))}")
        records = records.filter("number > 0")
    return records.select(F.from_csv("record", ddl, parsing).alias("r")).select("r.*")
