"""Session construction and shared scratch locations.

Intermediate tables (landed files, stream checkpoints, sinks written by
the round-trip queries) go below ``spark.checkpoint.dir``: on a cluster
that setting names the shared folder every executor can reach.  Only when
it is unset (local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Shuffle width of a local session that sets none (a cluster's comes from its submission).
LOCAL_SHUFFLE_PARTITIONS = 8

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Settings that must be known when the driver's JVM starts; under ``spark-submit`` it already runs.
LAUNCH_CONF = {
    "spark.driver.memory": os.environ.get("HAZARDPANEL_DRIVER_MEMORY", "16g"),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hazardpanel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; the library's defaults apply only where
    neither the submission, ``spark-defaults`` nor a running session set a value.

    ``shuffle_partitions`` and ``extra`` are explicit wishes of the caller and do
    override; leave them out under ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if "PYSPARK_GATEWAY_PORT" not in os.environ:        # this process starts the JVM
        for k, v in LAUNCH_CONF.items():
            if k not in submitted:
                builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    defaults = dict(DEFAULT_CONF)
    if _one_machine(spark.sparkContext.master):
        defaults["spark.sql.shuffle.partitions"] = str(LOCAL_SHUFFLE_PARTITIONS)
    for k, v in defaults.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    checkpoint_root(spark)
    return spark


def _one_machine(master: str) -> bool:
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local master (one machine) gets a temporary
    one where it is unset, and that one is removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not _one_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hazardpanel-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)      # ours alone, ends with this process
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/hazardpanel/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a Parquet table in the shared scratch
    folder and reading it back: columnar, compressed, and with file statistics
    the optimizer and AQE can size joins from (a ``checkpoint()`` scan has none)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # schema given: empty tables read back too


def scale_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of raw feeds.

    * scan splits of ``target_partition_bytes`` so a task's input fits easily
      in executor memory;
    * an initial shuffle width of max(4 x cores, input / target) so the first
      exchange of the raw detections does not spill, which AQE then coalesces
      towards the advisory size for the much smaller downstream stages;
    * skew splitting above 4 x the advisory size (a hot cell, day or key);
    * runtime broadcast of materialised join sides up to 64 MB.
    """
    width = max(4 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
