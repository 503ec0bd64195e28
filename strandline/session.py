"""Session settings the library is designed for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. All can be changed on a live session.
RUNTIME_SETTINGS = {
    # One wall clock for month buckets and for every comparison with SQL.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Partition counts, join strategy and skewed joins are settled at run time
    # from real shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A text of many megabytes (a prompt with all facilities) fills a page by itself: the
    # writer looks at the size after each row, and guesses nothing from the rows before. Of
    # the row group it always guesses, from a short first row it would for 10,000 rows:
    # this is the most rows it may go on before it looks again.
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "10",
    "parquet.page.size.check.estimate": "false",
    # Keyed streaming state lives off-heap and is checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Of a batch's state the changes are written, and whole files in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    Tasks in Python import this package from where the driver has it, unless it
    is installed on the workers or sent to them.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` uses ``__`` for dots (``spark__ui__enabled``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared directory the cluster names.

    The directory comes from ``spark.checkpoint.dir``. Only a local-mode
    session may fall back to the machine's temporary folder: on a cluster the
    other nodes could not see it.
    """
    base = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # one process, no other nodes
            raise ValueError(f"set {CHECKPOINT_DIR_KEY} to a folder every node can reach")
        base = os.path.join(tempfile.gettempdir(), "strandline-local")
    return f"{base.rstrip('/')}/strandline/{purpose}-{uuid.uuid4().hex}"
