"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for. Adaptive execution resizes shuffle
# partitions, splits skewed join partitions and turns a join side whose measured
# size is below the threshold into a broadcast; nothing is broadcast by hand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_own_work_dirs: dict[str, str] = {}


def build_session(app_name: str = "skyledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` takes settings with ``__`` for each dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a machine-local folder would be invisible to the other executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _own_work_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="skyledger-"))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared work folder."""
    return f"{work_root(spark)}/skyledger/{purpose}-{uuid.uuid4().hex}"
