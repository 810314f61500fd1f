"""A folder of CSV files whose headers differ: which file has which header, and one typed scan per header."""

from __future__ import annotations

import csv as csv_text
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators.keyed import union_all
from cardlens.schema import TRANSACTION_FIELDS
from cardlens.sources.files import CORRUPT, read_under_header, split_corrupt

SOURCE_FILE = "source_file"


@dataclass(frozen=True)
class HeaderGroup:
    """Files that begin with the same line."""

    names: tuple[str, ...]
    files: tuple[str, ...]


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of every file that has one.

    Only the part of a file that begins at its first byte is looked at, and of that each task keeps one line; Spark numbers
    lines in the order in which it reads them.  The text is read once, nothing of it is shuffled but one line a file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value"), F.monotonically_increasing_id().alias("place")
    )
    return lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))


def header_census(spark: SparkSession, path: str) -> list[HeaderGroup]:
    """The different headers of a folder with the files that have them, by header; the driver holds one path a file, as for any listing."""
    grouped = header_lines(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = sorted((row["header"], row["files"]) for row in grouped.collect())
    return [HeaderGroup(tuple(next(csv_text.reader([header]), [])), tuple(literal_path(f) for f in files)) for header, files in found]


def literal_path(uri: str) -> str:
    """A path that names one file, from the form in which Spark reports it: unescaped, and with no sign taken as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def read_csv_folder(spark: SparkSession, *paths: str, keep_corrupt: bool = False) -> DataFrame:
    """All files of the folders with the record's fixed types, each under its own header.

    Columns are told by name, in whatever order a file has them; the result has the record's columns, NULL where a
    file lacks one, and no others.  A file whose header holds none of the record's names, or one of them twice, is an error that names
    it: its first line is data or belongs to another table.  Files without a line give no rows, and no file at all gives an empty table.
    ``keep_corrupt`` adds the text of lines that do not fit, and the file they stand in.
    """
    scans = [_read_group(spark, group, keep_corrupt) for path in paths for group in header_census(spark, path)]
    columns = [*TRANSACTION_FIELDS, *([CORRUPT, SOURCE_FILE] if keep_corrupt else [])]
    kinds = {**{n: k.simpleString() for n, k in TRANSACTION_FIELDS.items()}, CORRUPT: "string", SOURCE_FILE: "string"}
    nothing = spark.createDataFrame([], ", ".join(f"`{c}` {kinds[c]}" for c in columns))
    return union_all(nothing, *scans).select(*columns) if scans else nothing


def _read_group(spark: SparkSession, group: HeaderGroup, keep_corrupt: bool) -> DataFrame:
    known = [name for name in group.names if name in TRANSACTION_FIELDS]
    if not known or len(set(known)) < len(known):
        raise ValueError(f"no header of transactions in {group.files[0]}: {','.join(group.names)[:200]}")
    df = read_under_header(spark, list(group.names), list(group.files), strict_header=False, keep_corrupt=keep_corrupt)
    if not keep_corrupt:
        return df.select(*known)
    return df.select(*known, CORRUPT, F.col("_metadata.file_path").alias(SOURCE_FILE))


def good_and_bad(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a folder that fit the record, and the lines that do not with the files they stand in; parsed once."""
    return split_corrupt(read_csv_folder(spark, *paths, keep_corrupt=True), SOURCE_FILE)
