"""Sessions for streams, and running a stream over the input there is."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def stream_session(spark: SparkSession) -> SparkSession:
    """A session whose shuffles have two partitions per core at most.

    Shuffles of a stream are not resized at run time, and the first batch fixes their number for the
    life of the checkpoint.
    """
    session = spark.newSession()
    wanted = 2 * spark.sparkContext.defaultParallelism
    if int(session.conf.get("spark.sql.shuffle.partitions")) > wanted:
        session.conf.set("spark.sql.shuffle.partitions", wanted)
    return session


def drain(query: StreamingQuery, rows: int, stall_seconds: float = 600) -> None:
    """Stop ``query`` once it has committed ``rows`` input rows, or fail when it stands still.

    A query with a processing-time timeout never ends by itself, so its progress is watched. It may
    take any time as long as a batch ends every ``stall_seconds``.
    """
    seen: dict[int, int] = {}
    latest, moved = -1, time.monotonic()
    try:
        while time.monotonic() < moved + stall_seconds:
            if query.exception() is not None:
                raise query.exception()
            for progress in query.recentProgress:
                seen[progress.batchId] = max(seen.get(progress.batchId, 0), progress.numInputRows)
            if sum(seen.values()) >= rows:
                return
            if max(seen, default=-1) > latest:
                latest, moved = max(seen), time.monotonic()
            time.sleep(0.2)
        raise TimeoutError(f"{sum(seen.values())} of {rows} rows read, and no batch ended in {stall_seconds} s")
    finally:
        query.stop()


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run a stream over the input there is, from its checkpoint on; the query has ended when this returns.

    Not for streams with a timeout in processing time, which keep such a run alive.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
