"""Session helpers.

The library never picks a master or a cluster size: it takes the caller's
session and only sets the SQL options its results depend on (UTC session
zone) plus the adaptive-execution switches that let Spark re-plan joins and
aggregations from runtime statistics.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Options every query relies on. All are runtime SQL confs, so they can be set
# on an existing session without restarting it.
RUNTIME_CONF = {
    # every date/hour string in the engine is a UTC rendering of the event time
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, turn joins into broadcast joins
    # only when the *measured* side is small, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # a retried micro-batch replaces only its own output partition
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a repeated key of a JSON object counts with its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # partition values (days "2024-01-01", hours "05") stay strings on read
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def cluster_conf(input_bytes: int, executor_cores: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Submit-time settings sized to the input (never applied by the library;
    pass them to ``spark-submit --conf``).

    The initial shuffle partition count gives ~``target_partition_bytes`` of
    shuffle input per task, so partitions fit executor memory and spill
    rarely; AQE then coalesces small partitions to the advisory size and
    splits skewed join partitions (threshold = 4 advisory sizes)."""
    parts = max(200, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        # a broadcast side must be small in *measured* bytes
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.executor.cores": str(executor_cores),
        # shuffle files outlive a lost executor
        "spark.shuffle.service.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_PRIVATE_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (it must
    be on shared storage). Only when the session names none -- local tests --
    is a private temporary folder used."""
    global _PRIVATE_ROOT
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage; "
                               "a machine-local folder does not survive a lost executor")
        if _PRIVATE_ROOT is None:
            _PRIVATE_ROOT = tempfile.mkdtemp(prefix="shopflow-ckpt-")
        root = _PRIVATE_ROOT
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def local_session(cores: int = 8, shuffle_partitions: int = 8,
                  app: str = "shopflow") -> SparkSession:
    """Session for tests and the local bench (never used by the library)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
