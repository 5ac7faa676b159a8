"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Runtime settings every flow relies on. Broadcast joins are never forced on data tables: Catalyst compares
# the side's size with spark.sql.autoBroadcastJoinThreshold, AQE re-checks the measured size, and a
# sort-merge join whose hot partitions AQE splits takes over beyond it.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Also the size of the files that writes after a shuffle leave behind.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where an operator above the join then needs its rows shuffled again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state lives on local disk with a small memory footprint, backed by the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seriesflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Aimed-at size of a shuffle partition, and the number beyond which more partitions cost the driver and the
# shuffle service more than larger ones cost the tasks, which spill.
_PARTITION_BYTES = 256 * 1024 * 1024
_MOST_PARTITIONS = 50_000


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to suit an input of this size; it is never lowered.

    AQE merges partitions that turn out small, but splits only some that turn out large, so the number has
    to start high enough.
    """
    wanted = min(-(-input_bytes // _PARTITION_BYTES), _MOST_PARTITIONS)
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# A write is not cut into pieces below this size.
_LEAST_PIECE_BYTES = 8 * 1024 * 1024


def _as_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * "_kmgtp".index(unit or "_")


@contextmanager
def spread_writes(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Let every core take a share of a rebalanced write of this size, also where all its rows have one key.

    AQE cuts a key's partition only beyond the advisory size: a smaller one is one task, whatever the cores.
    """
    advisory = spark.conf.get(_ADVISORY)
    share = max(_LEAST_PIECE_BYTES, -(-input_bytes // spark.sparkContext.defaultParallelism))
    spark.conf.set(_ADVISORY, str(min(_as_bytes(advisory), share)))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, advisory)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, the storage all executors share.

    Only a local-mode session without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="seriesflow-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; its content is not read."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
