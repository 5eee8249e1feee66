"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Initial shuffle partitions off local mode; AQE coalesces them to the advisory size.
CLUSTER_PARTITIONS = 2000


def get_spark(app: str = "flight_engine", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on.

    On a cluster ``master`` stays None so spark-submit decides; locally
    tests pass ``local[N]``.  AQE re-plans joins and coalesces shuffle
    partitions at runtime; skew-join splitting covers hot aircraft.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    # a small fixed number only on one machine; a cluster starts high and lets AQE merge
    parts = shuffle_partitions or int(os.environ.get("FE_SHUFFLE_PARTITIONS", "0"))
    if not parts and (master or "").startswith("local"):
        parts = 8
    # split size of file scans and the size AQE aims for after a shuffle; on a
    # cluster set FE_SHUFFLE_PARTITIONS ~ shuffled bytes / advisory size
    split = os.environ.get("FE_MAX_PARTITION_BYTES", str(128 * 1024 * 1024))
    advisory = os.environ.get("FE_ADVISORY_PARTITION_BYTES", str(128 * 1024 * 1024))
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts or CLUSTER_PARTITIONS))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.files.maxPartitionBytes", split)
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config(STATE_STORE, ROCKSDB))
    event_log = os.environ.get("FE_EVENT_LOG_DIR")
    if event_log:  # stage/task timings without any UI: Spark's JSON event log
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders made for local sessions whose setting is unset, by application.
_OWN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when it is
    unset (local runs, tests) do we create one of our own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            if not (spark.sparkContext.master or "").startswith("local"):
                raise RuntimeError(
                    f"{CHECKPOINT_CONF} is not set: on a cluster checkpoints, staging folders and "
                    "stream sinks must live in a shared folder; set it to one.")
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="fe-ckpt-")  # single machine: local is shared
        root = _OWN_ROOTS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    import uuid
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
