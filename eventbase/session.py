"""Session settings the engine relies on, and the shared folder it writes in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings (all changeable at run time).
SETTINGS = {
    # Times in messages carry no zone; they are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts, join strategies and skewed partitions are settled from run-time sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sessions of one key are merged per task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # A JSON object may repeat a name; the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def create_session(master: str | None = None, app_name: str = "eventbase", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written tables and checkpoints, visible to every executor.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session may go without that
    setting: there the driver's temporary folder is seen by all of its tasks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="eventbase-")
        root = _local_folders[application]
    return f"{root.rstrip('/')}/eventbase-{uuid.uuid4().hex}"
