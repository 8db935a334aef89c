"""Versions of a table: published whole, read as of a number, compared by digests, and removed when unused.

A version is a folder of rows in hash buckets of the key, next to the digests of its buckets. It counts
from the moment its numbered note appears, in one step, among the notes of the table; readers take the
note of the greatest number, or of one they name.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import create_file, make_folder, remove
from .tables import change_feed

BUCKET = "_bucket"
_NOTE = "number long, path string, key array<string>, buckets int, columns string, published_at double"
_HOLD = "number long, until double, id string"
_DIGEST = f"{BUCKET} int, row_count long, low decimal(38,0), high decimal(38,0)"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias(BUCKET)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a row, in which nulls and places of values count."""
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.sha2(F.to_json(F.struct(*columns), exact), 256)


def bucket_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Digest of each bucket of ``rows``, whatever the order of its rows: sums of two parts of their digests.

    Only sums per task and bucket are shuffled.
    """
    part = lambda start: F.conv(F.substring("_digest", start, 15), 16, 10).cast("decimal(20,0)")
    return (
        rows.select(BUCKET, row_digest(columns).alias("_digest"))
        .groupBy(BUCKET)
        .agg(F.count("*").alias("row_count"), F.sum(part(1)).cast("decimal(38,0)").alias("low"), F.sum(part(16)).cast("decimal(38,0)").alias("high"))
    )


def _notes(spark: SparkSession, folder: str) -> dict[int, dict]:
    rows = spark.read.schema(_NOTE).json(make_folder(spark, f"{folder}/_versions")).collect()
    return {row.number: row.asDict() for row in rows}


def publish_version(df: DataFrame, folder: str, key: Sequence[str], buckets: int = 256) -> int:
    """Write a full copy of ``df`` as the next version of the table in ``folder``; its number.

    Readers see it when all of it is there. Of two publishers at a time both succeed, one after the
    other. A bucket is a task and a file, so take as many that one fits a task.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    path = f"{folder}/{uuid.uuid4().hex}"
    columns = df.columns
    rows = df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(buckets, BUCKET)
    rows.write.partitionBy(BUCKET).parquet(f"{path}/rows")
    written = _rows(spark, path, df.schema)
    bucket_digests(written, columns).coalesce(1).write.parquet(f"{path}/digests")
    number = max(_notes(spark, folder), default=0)
    while True:
        number += 1
        note = {"number": number, "path": path, "key": list(key), "buckets": buckets, "columns": df.schema.json(), "published_at": time.time()}
        if create_file(spark, f"{folder}/_versions/{number:012d}.json", json.dumps(note)):
            return number


def _rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{path}/rows")


def _note(spark: SparkSession, folder: str, number: int | None) -> dict:
    notes = _notes(spark, folder)
    number = max(notes, default=None) if number is None else number
    if number not in notes:
        raise ValueError(f"{folder} has no version {'yet' if number is None else number}")
    return notes[number]


def _version_rows(spark: SparkSession, note: dict) -> DataFrame:
    return _rows(spark, note["path"], T.StructType.fromJson(json.loads(note["columns"])))


def version_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions there are."""
    return sorted(_notes(spark, folder.rstrip("/")))


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """Rows of a version, or of the newest one."""
    return _version_rows(spark, _note(spark, folder.rstrip("/"), number)).drop(BUCKET)


def version_changes(spark: SparkSession, folder: str, old: int, new: int) -> DataFrame:
    """``change_feed`` from one version to another, reading and shuffling only the buckets that differ.

    The digests tell which these are: a bucket without changes is neither read nor joined. Versions
    of unlike keys, numbers of buckets or columns are compared whole.
    """
    folder = folder.rstrip("/")
    before, after = _note(spark, folder, old), _note(spark, folder, new)
    old_rows, new_rows = _version_rows(spark, before), _version_rows(spark, after)
    if any(before[name] != after[name] for name in ("key", "buckets", "columns")):
        common = [name for name in new_rows.columns if name in old_rows.columns and name != BUCKET]
        return change_feed(old_rows.select(*common), new_rows.select(*common), after["key"])
    digests = [spark.read.schema(_DIGEST).parquet(f"{note['path']}/digests") for note in (before, after)]
    one, other = (digest.select(BUCKET, F.struct("row_count", "low", "high").alias(name)) for digest, name in zip(digests, ("_old", "_new")))
    # At most as many numbers as there are buckets.
    differing = [row[0] for row in one.join(other, BUCKET, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(BUCKET).collect()]
    return change_feed(*(rows.filter(F.col(BUCKET).isin(differing)).drop(BUCKET) for rows in (old_rows, new_rows)), after["key"])


@contextmanager
def held_version(spark: SparkSession, folder: str, number: int | None = None, hours: float = 24) -> Iterator[DataFrame]:
    """Rows of a version that is not removed while they are in use, for at most ``hours``.

    A reader that dies holds it until then.
    """
    folder = folder.rstrip("/")
    make_folder(spark, f"{folder}/_held")
    number = _note(spark, folder, number)["number"]
    hold = uuid.uuid4().hex
    create_file(spark, f"{folder}/_held/{hold}.json", json.dumps({"number": number, "until": time.time() + 3600 * hours, "id": hold}))
    try:
        yield read_version(spark, folder, number)
    finally:
        remove(spark, f"{folder}/_held/{hold}.json")


def expire_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Remove versions other than the newest ``keep`` that no reader holds; their numbers.

    The note goes first, so no reader begins with a version that is being removed.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    folder = folder.rstrip("/")
    notes = _notes(spark, folder)
    old = sorted(notes)[:-keep]
    removed = []
    for number in old:
        # Asked again for each version, so that holds taken meanwhile count.
        holds = spark.read.schema(_HOLD).json(make_folder(spark, f"{folder}/_held"))
        if holds.filter((F.col("number") == number) & (F.col("until") > time.time())).isEmpty():
            remove(spark, f"{folder}/_versions/{number:012d}.json")
            remove(spark, notes[number]["path"])
            removed.append(number)
    return removed
