"""Folders and small files of whatever store Spark reads."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


# Stores that a task can open a file of, without Spark.
OPENED_SCHEMES = {"file", "hdfs", "s3", "s3a", "gs"}


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and what makes paths for it."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def folders_of(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that a pattern matches; none unless it has a wildcard, matches folders only, and tasks can open them."""
    if not set(pattern) & set("*?[{"):
        return []
    files, make = file_system(spark, pattern)
    found = files.globStatus(make(pattern)) or []
    paths = [status.getPath().toString() for status in found if status.isDirectory()]
    openable = all(path.split(":", 1)[0] in OPENED_SCHEMES for path in paths)
    return paths if openable and len(paths) == len(found) else []


def hidden(name: str) -> bool:
    """Whether Spark passes over a file of this name."""
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, for use without Spark in a task, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def make_folder(spark: SparkSession, path: str) -> str:
    """Creates a folder where there is none."""
    files, make = file_system(spark, path)
    files.mkdirs(make(path))
    return path


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file whole, or not at all where there is one."""
    files, make = file_system(spark, path)
    target = make(path)
    if files.exists(target):
        return False
    aside = make(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(aside, target):
        files.delete(aside, False)
        return False
    return True


def write_each(rows: DataFrame, folder: str, per_folder: int | None = None) -> None:
    """Writes each row (extension, content as binary) to a file of its own in a folder that is there.

    Tasks write the files, on any store that Arrow opens, for many small ones: Spark's writers start a
    process or two per file on a local disk. Names are those of the row's place, so that a task that is
    run again writes the same files; each appears whole. With ``per_folder`` every task makes folders of
    its own below ``folder``, of that many files each: tasks that write to one folder wait for each other,
    and the driver lists one folder alone.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task, number, place = TaskContext.get(), 0, root
        part = f"{task.partitionId():05d}"
        for batch in batches:
            for extension, content in zip(batch.column("extension").to_pylist(), batch.column("content")):
                if per_folder and number % per_folder == 0:
                    place = f"{root}/{part}-{number // per_folder:06d}"
                    store.create_dir(place)
                aside = f"{place}/.{part}-{task.taskAttemptId()}"
                with store.open_output_stream(aside, compression=None) as out:
                    out.write(content.as_buffer() or b"")
                store.move(aside, f"{place}/part-{part}-{number:09d}-{run}.{extension}")
                number += 1
        yield pa.record_batch([pa.array([number], pa.int64())], names=["files"])

    run = uuid.uuid4().hex[:8]
    rows.select("extension", "content").mapInArrow(write, "files long").agg({"files": "sum"}).collect()


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds."""
    files, make = file_system(spark, path)
    files.delete(make(path), True)
