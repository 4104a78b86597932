"""Readers: raw grids, canonical tables, report text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _file_path():
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")


#: Encodings whose line break is the single byte 10, so that a file can be cut anywhere and read from the next one.
WIDE_UNITS = ("UTF-16", "UTF-32", "UCS-2", "UCS-4")


#: Lines of a split that meet their split's sums together.
LINES_DEALT = 65_536


def file_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(source_file, line, text, quotes_before) for every line of the files below ``path``.

    Files are read in splits, so one of any size is spread over tasks. Lines get their number, and
    the quotes that stand before them, from what one small row per split adds up to; inside a split
    they are counted while it is read, so its lines are not sorted and never held together.
    ``_opens`` is the last line of the split, up to this one, that leaves a quote open.
    """
    if encoding.upper().startswith(WIDE_UNITS):
        raise ValueError(f"{encoding} has line breaks of several bytes; convert the files first")
    source = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    lines = source.select(
        _file_path().alias("source_file"), F.col("_metadata.file_block_start").alias("_split"), F.regexp_replace(text, "\r$", "").alias("text")
    ).withColumn("_marks", F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit(""))))
    keys = ["source_file", "_split"]
    sums = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_marks").alias("_m"))
    earlier = W.partitionBy("source_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    # a row for every so many lines: however the join is made, the lines of a split are dealt to many tasks
    sums = sums.select(
        *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_lines0"), F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_marks0"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_n") / F.lit(LINES_DEALT)))).alias("_deal"),
    )
    schema = T.StructType([*lines.schema.fields, *[T.StructField(c, T.LongType()) for c in ("_k", "_m", "_open0", "_open1")]])
    counted = lines.mapInArrow(_counter(), schema).withColumn("_deal", F.floor(F.col("_k") / F.lit(LINES_DEALT)))
    opens = F.when(F.col("_marks0") % 2 == 0, F.col("_open0")).otherwise(F.col("_open1"))
    return counted.join(sums, [*keys, "_deal"]).select(
        *keys, (F.col("_lines0") + F.col("_k")).alias("line"), "text", "_marks", (F.col("_marks0") + F.col("_m")).alias("quotes_before"),
        F.when(opens > 0, F.col("_lines0") + opens).alias("_opens"),
    )


def _counter():
    """Adds to the lines of a task, which come split by split in their order: the line's number in its split, the quotes
    before it there, and the last line so far that leaves a quote open, if an even or an odd number stands before the split."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        at, k0, m0, open0 = None, 0, 0, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files, splits = batch.column("source_file").dictionary_encode(), batch.column("_split").to_numpy()
            marks = batch.column("_marks").to_numpy().astype("int64")
            new = np.r_[(files[0].as_py(), int(splits[0])) != at, (np.diff(files.indices.to_numpy()) != 0) | (np.diff(splits) != 0)]
            row = np.arange(n)
            start = np.maximum.accumulate(np.where(new, row, -1))  # -1: the split of the batch before goes on
            before = np.cumsum(marks) - marks
            goes_on = start < 0
            k = np.where(goes_on, k0 + row + 1, row - start + 1)
            m = np.where(goes_on, m0 + before, before - before[start])
            opens = []
            for parity in (0, 1):
                last = np.maximum.accumulate(np.where((marks % 2 == 1) & (m % 2 == parity), row, -1))
                opens.append(np.where((last >= 0) & (last >= start), k[last], np.where(goes_on, open0[parity], 0)))
            at, k0, m0, open0 = (files[-1].as_py(), int(splits[-1])), int(k[-1]), int(m[-1] + marks[-1]), [int(o[-1]) for o in opens]
            columns = [*batch.columns, *[pa.array(c.astype("int64")) for c in (k, m, *opens)]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_k", "_m", "_open0", "_open1"])

    return count


def file_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(source_file, line, text) for every record: a line break inside quotes belongs to its record.

    Only the lines of records with such a break are put together, by the record's first line. That line
    is the last one before with a quote left open, in the same split or else in the nearest one before.
    """
    lines = file_lines(spark, path, encoding)
    inside, odd = F.col("quotes_before") % 2 == 1, F.col("_marks") % 2 == 1
    single = lines.filter(~inside & ~odd).select("source_file", "line", "text")
    parts = lines.filter(inside | odd)
    keys = ["source_file", "_split"]
    last = parts.groupBy(*keys).agg(F.max("_opens").alias("_last"))
    earlier = W.partitionBy("source_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select(*keys, F.max("_last").over(earlier).alias("_carried"))
    first = F.coalesce(F.col("_opens"), F.col("_carried"))
    joined = (
        parts.join(carried, keys).groupBy("source_file", first.alias("_first"))
        .agg(F.sort_array(F.collect_list(F.struct("line", "text"))).alias("_lines"))
        .select("source_file", F.col("_first").alias("line"), F.array_join(F.col("_lines.text"), "\n").alias("text"))
    )
    return single.unionByName(joined)


def split_cells(text: Column, sep: str = ",") -> Column:
    """The cells of a record. A separator inside quotes belongs to its cell; doubled quotes stand for one."""
    gap = re.escape(sep)
    other = f"[^{gap}]*" if len(sep) == 1 else f"(?:(?!{gap}).)*"
    # every cell has a separator before it, the first one as well, so a blank first cell is a match like any other
    found = F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(f'(?s){gap}(?:"[^"]*+(?:""[^"]*+)*+"|{other})'), F.lit(0))
    cells = F.transform(found, lambda c: F.substr(c, F.lit(len(sep) + 1)))
    quoted = lambda c: c.startswith('"') & c.endswith('"') & (F.length(c) > 1)
    return F.transform(
        cells, lambda c: F.when(quoted(c), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    )


def read_grid(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Headerless delimited files as a grid of any width, all cells text, blank cells empty.

    Rows keep the number of their first line in the file; a line break inside quotes belongs to its
    cell. Files of any size are read in splits (see :func:`file_lines`), so no file is ever one value.
    """
    return file_records(spark, path, encoding).select(
        "source_file",
        F.regexp_extract("source_file", r"([^/]+?)(\.[^./]+)?$", 1).alias("source_sheet"),
        F.col("line").cast("bigint").alias("source_row"),
        split_cells(F.col("text"), sep).alias("cells"),
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited observation files with a header; unreadable lines are kept in ``_corrupt_record``."""
    declared = schema.simpleString()[7:-1].replace(":", " ") if isinstance(schema, T.StructType) else schema
    return (
        spark.read.schema(f"{declared}, _corrupt_record string")
        .option("header", "true").option("sep", sep).option("encoding", encoding)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", "true")
        .csv(path)
    )


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw report text, one report per line, unchanged, with its file."""
    return (
        spark.read.option("recursiveFileLookup", "true").text(path)
        .select(F.col("value").alias("report"), _file_path().alias("source_file"))
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)
