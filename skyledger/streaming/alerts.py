"""Alerts fired by landing events.

Two streams, so that what a micro-batch costs does not depend on what was fired before: the first
matches landings with the alerts that wait at that moment, the second lets every alert through once, by
keyed state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.state import match_alerts
from ..sources.files import make_folder
from ..sources.tables import FILES_PER_BATCH, read_folder_stream
from .sinks import BATCH, batch_sink


def alert_sink(load_watches: Callable[[], DataFrame], load_alerts: Callable[[], DataFrame], folder: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that commits the alerts which the landings of a batch match.

    ``load_watches`` and ``load_alerts`` give the current rows when a batch runs. A batch that is run
    again after a failure keeps what it committed.
    """
    return batch_sink(folder, lambda batch: match_alerts(batch, load_watches(), load_alerts()))


def match_writer(
    events: DataFrame, load_watches: Callable[[], DataFrame], load_alerts: Callable[[], DataFrame], folder: str
) -> DataStreamWriter:
    """Match a stream of events with ``alert_sink``; start the returned writer."""
    return events.writeStream.foreachBatch(alert_sink(load_watches, load_alerts, folder))


def first_matches(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The stream of alerts fired: of the rows committed by ``match_writer``, the first of each alert.

    The state is one key per alert ever fired. It belongs to the checkpoint of the query that runs this
    stream; the stream before it may begin with a new one, and no alert fires again.
    """
    make_folder(spark, folder)
    found = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    return read_folder_stream(spark, folder, found, files_per_batch, [BATCH]).drop(BATCH).dropDuplicates(["alert_id"])


def fired_schema(watches: DataFrame, alerts: DataFrame, events: DataFrame) -> T.StructType:
    """Columns of fired alerts."""
    empty = events.sparkSession.createDataFrame([], events.schema)
    return match_alerts(empty, watches, alerts).schema
