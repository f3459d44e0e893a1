"""File readers for the two feeds: every column read as text, never inferred.

* Daily feed: one delimited text file (or a directory of them) with a header,
  ISO-8859-1 by default.  Columns come from each file's own header as strings;
  type inference is off, so nothing is re-typed behind our back.
* Historical feed: a workbook of several sheets, supplied as one file or
  directory per sheet (CSV or Parquet), read in sheet order and tagged
  `<book>:<sheet>`.  Binary spreadsheet decoding is out of scope.

Load order: a struct (sheet index, file path, split start, row position) that
sorts like the order of lines in the files.  Within one input split Spark
reads lines in file order, and split start orders the splits of one file, so
the struct is stable however the files are split across tasks.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.functions.text import na_to_null
from ledgerstar.schemas import (
    DAILY_COLUMN_MAP,
    DAILY_SOURCE_FILE,
    HISTORICAL_COLUMN_MAP,
    RANK_DAILY,
    RANK_HISTORICAL,
    RAW_COLUMNS,
)


WHOLE_LINE = "_whole_line"


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a path (a file, a folder or a pattern), by name."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(hadoop_path) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s.getPath().toString() for s in inside if s.isFile() and s.getPath().getName()[0] not in "._"]
    if not found:
        raise FileNotFoundError(f"no files at {path}")
    return sorted(found)


def _header(spark: SparkSession, path: str, encoding: str) -> tuple[str, ...]:
    """The names in a file's first line, read alone; none for an empty file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(hadoop_path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
        line = reader.readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()


def header_groups(spark: SparkSession, path: str, encoding: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header.  One short read per file, many at a
    time; no data line is looked at."""
    files = _files(spark, path)
    with ThreadPoolExecutor(max_workers=min(32, len(files))) as pool:
        headers = list(pool.map(lambda f: _header(spark, f, encoding), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers, strict=True):
        groups.setdefault(names, []).append(file)
    if len(groups) > 1:
        groups.pop((), None)  # empty files beside others have nothing to read
    return groups


def _read_text_csv(spark: SparkSession, path: str, encoding: str, multi_line: bool,
                   wanted: Iterable[str]) -> list[DataFrame]:
    """Header CSV with every column as text, one frame per header; type inference
    is off.

    Files are grouped by their header row and each group is read with its own
    names (and checked against them), so files of a folder may order their
    columns differently or have columns of their own.  A header without one of
    the wanted columns is an error that names the file.  A line with too many or
    too few cells keeps its whole text in WHOLE_LINE, and staging rejects it with
    that text.  Empty cells and the other missing-value tokens become NULL in
    `_to_raw`."""
    frames = []
    for names, files in header_groups(spark, path, encoding).items():
        missing = [c for c in wanted if names.count(c) != 1]
        if missing:
            raise ValueError(f"the header of {files[0]} ({len(files)} files have it) does not name {', '.join(missing)} once")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, WHOLE_LINE]])
        frames.append(
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("encoding", encoding)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .option("enforceSchema", False).option("columnNameOfCorruptRecord", WHOLE_LINE)
            .option("columnPruning", False).schema(schema).csv(files)
        )
    return frames


def _load_order(sheet_index: int, position: Column) -> Column:
    return F.struct(
        F.lit(sheet_index).alias("sheet"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        position.alias("pos"),
    )


def _to_raw(df: DataFrame, column_map: dict[str, str], source_file: Column, rank: int,
            sheet_index: int, position: Column, na_tokens: bool) -> DataFrame:
    cols = []
    for src, dst in column_map.items():
        c = F.col(f"`{src}`").cast("string")
        cols.append((na_to_null(c) if na_tokens else c).alias(dst))
    whole = F.col(WHOLE_LINE) if WHOLE_LINE in df.columns else F.lit(None).cast("string")
    out = df.select(
        *cols,
        whole.alias("raw_line"),
        source_file.alias("source_file"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(rank).alias("src_rank"),
        _load_order(sheet_index, position).alias("load_order"),
    )
    return out.select(*RAW_COLUMNS, "raw_line", "source_file", "loaded_at", "src_rank", "load_order")


def read_daily_csv(
    spark: SparkSession,
    path: str,
    encoding: str = "ISO-8859-1",
    multi_line: bool = False,
    column_map: dict[str, str] = DAILY_COLUMN_MAP,
    source_file: str = DAILY_SOURCE_FILE,
    na_tokens: bool = True,
) -> DataFrame:
    """raw.sales_daily from a header CSV; missing-value tokens become NULL."""
    frames = _read_text_csv(spark, path, encoding, multi_line, column_map)
    return reduce(DataFrame.unionByName, [
        _to_raw(df, column_map, F.lit(source_file), RANK_DAILY, 0, F.monotonically_increasing_id(), na_tokens) for df in frames])


def read_sheets(
    spark: SparkSession,
    book: str,
    sheets: list[tuple[str, str]],
    fmt: str = "csv",
    encoding: str = "UTF-8",
    column_map: dict[str, str] = HISTORICAL_COLUMN_MAP,
    na_tokens: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """raw.sales_historical: the union of the sheets, in the given order.

    `sheets` is a list of (sheet name, path).  Each line's source_file is
    `<book>:<sheet>`.  CSV sheets are read as text; Parquet sheets are cast to
    text column by column."""
    out = None
    for i, (sheet, path) in enumerate(sheets):
        if fmt == "csv":
            frames = _read_text_csv(spark, path, encoding, multi_line, column_map)
            pos = F.monotonically_increasing_id()
        elif fmt == "parquet":
            frames = [spark.read.parquet(path)]
            pos = F.col("_metadata.row_index")
        else:
            raise ValueError(f"unsupported sheet format {fmt!r}")
        for df in frames:
            raw = _to_raw(df, column_map, F.lit(f"{book}:{sheet}"), RANK_HISTORICAL, i, pos, na_tokens)
            out = raw if out is None else out.unionByName(raw)
    if out is None:
        raise ValueError("no sheets given")
    return out
