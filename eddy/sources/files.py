"""File sources and sinks.

CSV input keeps quoted newlines and doubled quotes (``multiLine``).  A
multi-line CSV file cannot be split, so give large inputs as many files, or
write them to Parquet once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.schema import COMMENT_CSV

CSV_READ = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
# Header of the comments file: the unnamed index column, text ("1"), comment id
# ("2") and creation time ("5"), in any order and among other columns.
COMMENT_HEADER = {"row_index": "", "text": "1", "comment_id": "2", "created_utc": "5"}


def read_comments_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comments CSV, columns found by their header names.

    Every file's own header counts: files of one folder may differ in the order
    and number of their columns, and files of one header are read together.
    Values are read as text; the index and the time are cast (null where they
    are no numbers).  A column a file lacks is null; all others are kept under
    their own names, or as ``other_<name>`` where that is one of the four.  Spark
    calls an unnamed column ``_c`` and its position; the first is the index.
    """
    out = None
    for files in _by_header(spark, path):
        part = _named(spark.read.options(**CSV_READ).csv(files))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _by_header(spark: SparkSession, path: str) -> list[str | list[str]]:
    """The files of ``path`` in groups of equal header lines: the path itself where
    there is one header, else lists of file names (as a listing of a scan has)."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.rtrim("value").alias("line"))
    # The header is in a file's first block, which one task reads in order.
    heads = lines.groupBy("file").agg(F.min_by("line", F.struct("block", "at")).alias("line"))
    kinds = [r.line for r in heads.select("line").distinct().limit(2).collect()]
    if len(kinds) < 2:
        return [path]
    groups: dict[str, list[str]] = {}
    for r in heads.orderBy("file").toLocalIterator():
        groups.setdefault(r.line, []).append(r.file)
    return list(groups.values())


def _named(raw: DataFrame) -> DataFrame:
    named = {("" if re.fullmatch(r"_c\d+", c) else c): c for c in reversed(raw.columns)}
    own = {f.name: named.get(COMMENT_HEADER[f.name]) for f in COMMENT_CSV.fields}
    cols = [(F.col(f"`{own[f.name]}`") if own[f.name] else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in COMMENT_CSV.fields]
    rest = [c for c in raw.columns if c not in own.values()]
    return raw.select(*cols, *[F.col(f"`{c}`").alias(f"other_{c}" if c.lower() in own else c) for c in rest])


def write_comments_csv(df: DataFrame, path: str) -> None:
    """Write comment rows, in the frame's column order, under the file's header."""
    cols = [F.col(c).alias(COMMENT_HEADER.get(c, c)) for c in df.columns]
    df.select(*cols).write.mode("overwrite").options(**CSV_WRITE).csv(path)
