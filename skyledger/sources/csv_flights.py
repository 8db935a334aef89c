"""Historical flight CSV files."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Read of a file at a time in search of its header.
HEAD_BYTES = 16 << 10
# Stores that a task can open a file of, without Spark.
OPENED_SCHEMES = {"file", "hdfs", "s3", "s3a", "gs"}

_JUNK = re.compile(r"_c\d+")


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name and size of every CSV file of a folder, without reading the files."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("source_file"), "length")
        .filter(F.lower("source_file").endswith(".csv"))
    )


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that Spark names ``_c<n>`` after a trailing comma in the header."""
    return df.drop(*[name for name in df.columns if _JUNK.fullmatch(name)])


def _first_line(path: str) -> str | None:
    """The first line of a file that is not blank, reading no more of the file than that takes."""
    if path.startswith("file:"):
        files, place = fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    else:
        files, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    held = b""
    with files.open_input_stream(place, compression=None, buffer_size=0) as file:
        while True:
            more = file.read(HEAD_BYTES)
            held += more
            lines = held.splitlines(keepends=True)
            # The last line may go on in what is not read yet.
            for line in lines if not more else lines[:-1]:
                if line.strip():
                    return line.decode("utf-8", "replace").lstrip("\ufeff").rstrip("\r\n")
            if not more:
                return None
            held = lines[-1] if lines else b""


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "header": [_first_line(path) for path in batch["path"]]})


def _scanned_headers(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The same by Spark's text reader, which reads every file whole, for stores that only Spark can open."""
    lines = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").text(folder)
    lines = lines.select(
        "value",
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("full"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    # One line per split is kept before the shuffle, and one per file after it. Only the number of
    # slashes after the scheme differs between the two ways to write a path.
    plain = lambda path: F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    first = (
        lines.filter(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
        .groupBy(plain(F.col("full")).alias("plain"))
        .agg(F.min_by("value", F.struct("block", "place")).alias("header"))
    )
    return files.withColumn("plain", plain(F.col("path"))).join(first, "plain", "left").select("path", "header")


def _headers(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths of the CSV files by header line, the first one that is not blank, found in one job.

    The beginning of each file is read by itself, spread over tasks; the driver sees one line per file. A
    non-empty file without such a line is refused.
    """
    files = list_csv_files(spark, folder).filter("length > 0").select("path")
    schemes = {row.scheme for row in files.select(F.regexp_extract("path", "^([^:/]*):", 1).alias("scheme")).distinct().collect()}
    if schemes <= OPENED_SCHEMES:
        spread = files.repartition(spark.sparkContext.defaultParallelism)
        found = spread.mapInPandas(_first_lines, "path string, header string")
    else:
        found = _scanned_headers(spark, folder, files)
    by_header: dict[str, list[str]] = defaultdict(list)
    for row in found.orderBy("path").toLocalIterator():
        if row.header is None:
            raise ValueError(f"{row.path} has no header")
        by_header[row.header].append(row.path)
    return by_header


def scan_flight_csvs(spark: SparkSession, folder: str, one_header: bool = False) -> DataFrame:
    """All CSV files of a folder, bound by column name, every column as text, plus ``source_file``.

    Spark binds CSV columns by position, so files are grouped by their header line and each group
    is read on its own. The header is the first line that is not blank. Only the beginning of a file is
    read ahead, and every file once as a whole. With ``one_header`` the caller states that all headers are
    equal: no header is read ahead, and Spark fails the job on a file that differs.
    """
    if one_header:
        groups = [[f"{folder.rstrip('/')}/*.[cC][sS][vV]"]]
    else:
        groups = list(_headers(spark, folder).values())
    if not groups:
        raise FileNotFoundError(f"no CSV file with a header in {folder}")

    def read(paths: list[str]) -> DataFrame:
        reader = spark.read.option("header", True).option("inferSchema", False)
        if one_header:
            reader = reader.option("enforceSchema", False)
        rows = reader.csv(paths)
        return drop_junk_columns(rows.withColumn("source_file", F.col("_metadata.file_name")))

    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), map(read, groups))
