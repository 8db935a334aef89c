from __future__ import annotations

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators.state import bucketed_history, compact_history, fold_into_buckets, live_rows
from skyledger.session import work_dir
from skyledger.sources.files import create_file, make_folder
from skyledger.sources.tables import change_feed
from skyledger.sources.versions import (
    BUCKET, _note, bucket_digests, expire_versions, held_version, publish_version, read_version, version_changes, version_numbers,
)

AT = datetime.datetime(2026, 10, 1, 12, 30)
ROWS = "id int, a string, b string, at timestamp, list array<int>"


def rows(draw, size):
    text = lambda: draw.choice(["x", "y", "", None])
    return [(n, text(), text(), AT + datetime.timedelta(microseconds=n), [1, None]) for n in range(size)]


def feed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_are_read_by_number(spark):
    folder = work_dir(spark, "versions")
    make = lambda *ids: spark.createDataFrame([(n, str(n)) for n in ids], "id int, a string")
    with pytest.raises(ValueError, match="no version yet"):
        read_version(spark, folder)
    assert [publish_version(make(*ids), folder, ["id"], 4) for ids in ([1, 2], [2, 3, 4], [])] == [1, 2, 3]
    assert [read_version(spark, folder, n).count() for n in (1, 2, 3, None)] == [2, 3, 0, 0]
    assert read_version(spark, folder, 2).columns == ["id", "a"]
    with pytest.raises(ValueError, match="no version 9"):
        read_version(spark, folder, 9)


def test_changes_are_found_in_buckets_that_differ(spark):
    draw = random.Random(2)
    old = rows(draw, 400)
    new = [row for row in old if row[0] % 97 != 5]
    new[7] = (*new[7][:1], new[7][2], new[7][1], *new[7][3:])  # values trade places, as a null may
    new[9] = (*new[9][:3], new[9][3] + datetime.timedelta(microseconds=1), new[9][4])
    new[11] = (*new[11][:4], [None, 1])
    new += [(9000, None, "new", AT, [])]
    before, after = (spark.createDataFrame(part, ROWS) for part in (old, new))
    folder = work_dir(spark, "feed")
    one, two = (publish_version(df, folder, ["id"], 64) for df in (before, after))
    changes = version_changes(spark, folder, one, two)
    assert feed(changes) == feed(change_feed(before, after, ["id"]))
    assert version_changes(spark, folder, two, two).count() == 0
    assert feed(version_changes(spark, folder, two, one)) == feed(change_feed(after, before, ["id"]))
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_few_rows_are_shuffled_for_few_changes(spark):
    old = spark.range(20_000).select(F.col("id").cast("int"), F.col("id").cast("string").alias("a"))
    new = old.withColumn("a", F.when(F.col("id") == 77, "other").otherwise(F.col("a")))
    folder = work_dir(spark, "few")
    one, two = (publish_version(df, folder, ["id"], 100) for df in (old, new))
    changes = version_changes(spark, folder, one, two)
    assert feed(changes) == [(77, "77", "update_preimage"), (77, "other", "update_postimage")]
    differing = [row[0] for row in spark.read.parquet(f"{_note(spark, folder, one)['path']}/digests").exceptAll(
        spark.read.parquet(f"{_note(spark, folder, two)['path']}/digests")).collect()]
    assert len(differing) == 1


def test_unlike_versions_are_compared_whole(spark):
    folder = work_dir(spark, "unlike")
    before = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    after = before.withColumn("extra", F.lit(1)).filter("id = 1")
    publish_version(before, folder, ["id"], 4)
    publish_version(after, folder, ["id"], 8)
    assert feed(version_changes(spark, folder, 1, 2)) == [(2, "y", "delete")]


def test_digests_do_not_depend_on_order_but_on_copies(spark):
    df = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "a")], f"{BUCKET} int, id int, a string")
    some = lambda rows: {row[BUCKET]: row[1:] for row in bucket_digests(rows, ["id", "a"]).collect()}
    assert some(df.repartition(5)) == some(df.orderBy(F.desc("id")))
    assert some(df)[0] != some(df.unionByName(df))[0]


def test_held_versions_stay(spark):
    folder = work_dir(spark, "held")
    make = lambda n: spark.range(n)
    for n in (1, 2, 3, 4):
        publish_version(make(n), folder, ["id"], 2)
    with held_version(spark, folder, 2) as two:
        assert expire_versions(spark, folder, keep=1) == [1, 3]
        assert version_numbers(spark, folder) == [2, 4]
        assert two.count() == 2
    with held_version(spark, folder, 2, hours=-1):  # a reader that died long ago
        assert expire_versions(spark, folder, keep=1) == [2]
    assert read_version(spark, folder).count() == 4
    assert publish_version(make(5), folder, ["id"], 2) == 5
    assert len([name for name in os.listdir(folder) if not name.startswith("_")]) == 2
    with pytest.raises(ValueError):
        expire_versions(spark, folder, keep=0)


def test_a_file_is_created_once(spark):
    folder = make_folder(spark, work_dir(spark, "files"))
    assert create_file(spark, f"{folder}/note", "one") and not create_file(spark, f"{folder}/note", "two")
    assert open(f"{folder}/note").read() == "one"


HISTORY = "id int, value int, _pg_change_type string, _timestamp timestamp"


def test_batches_touch_their_buckets_only(spark):
    draw = random.Random(7)
    folder = work_dir(spark, "buckets")
    made = [(draw.randrange(40), n, draw.choice(["insert", "update", "update", "delete", "update_preimage"]), AT + datetime.timedelta(seconds=draw.randrange(500)))
            for n in range(300)]
    batches = [made[:200], made[200:203], made[203:], []]

    def files():
        return {os.path.join(root, name): os.path.getmtime(os.path.join(root, name))
                for root, _, names in os.walk(folder) for name in names if name.startswith("part-")}

    done = []
    for number, batch in enumerate(batches):
        before = files()
        touched = fold_into_buckets(folder, spark.createDataFrame(batch, HISTORY), ["id"], ["value"], buckets=16)
        done += batch
        untouched = {path for path in before if int(path.split(f"{BUCKET}=")[1].split("/")[0]) not in touched}
        assert all(files().get(path) == before[path] for path in untouched)
        if number == 1:
            assert len(touched) <= 3 and untouched
            # Folded once more, as after a failure, it changes nothing.
            fold_into_buckets(folder, spark.createDataFrame(batch, HISTORY), ["id"], ["value"], buckets=16)
        wanted = compact_history(spark.createDataFrame(done, HISTORY), ["id"], ["value"])
        found = bucketed_history(spark, folder, wanted.schema).drop(BUCKET)
        assert sorted(found.collect(), key=repr) == sorted(wanted.collect(), key=repr)
    assert live_rows(found).count() < 40
