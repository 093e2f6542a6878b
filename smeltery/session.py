"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants unless spark-submit, spark-defaults or the session name others. Master,
# memory, executors and shuffle partitions are theirs to name.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

_local_folders: dict[str, str] = {}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings; defaults fill in only what nobody has set.

    What spark-defaults names is known once the JVM runs, so defaults are looked at after that.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    named = spark.conf.getAll
    for key, value in DEFAULTS.items():
        if not given.contains(key) and key not in named:
            spark.conf.set(key, value)
    return spark


@contextmanager
def overriding(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Change runtime settings for the actions inside the block, then put them back."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def listing_folders(spark: SparkSession) -> Iterator[None]:
    """Keep the job that lists a table's folders to a few tasks per core, not one per folder."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = min(int(spark.conf.get(key)), 4 * spark.sparkContext.defaultParallelism)
    with overriding(spark, {key: str(tasks)}):
        yield


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master, where driver
    and executors are one process, may go without it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="smeltery-")
            atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
        base = _local_folders[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
