"""Session defaults and the shared folder jobs may write to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_SESSION_DEFAULTS = {
    # Wall-clock values are TIMESTAMP_NTZ everywhere; the zone only matters
    # where an instant with an offset is turned into a wall clock.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size-checked broadcast: Catalyst and AQE broadcast a side only when its
    # measured size is below this bound, and fall back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # HotSpot never compiles methods above 8000 bytes of bytecode. Wide cleaning
    # projections exceed that, and run faster as split, non-fused projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed state of streams lives on disk, not on the heap, and only changes are stored.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Call-site capture doubles the time to build wide plans from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Keeps HMAC pads (64-byte binary literals) out of printed plans.
    "spark.sql.redaction.string.regex": "[0-9A-Fa-f]{128}",
}


def build_session(app: str = "tillmart", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the defaults above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> str:
    """Sends this package to the executors, where it is not installed; path of the archive.

    Needed when Python workers start in another folder: the training-data operators run
    functions of the package there. Spark copies the archive to every executor.
    """
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tillmart-')}/tillmart", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    return archive


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tillmart-")
    return _local_dirs[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tillmart/{label}-{uuid.uuid4().hex[:12]}"
