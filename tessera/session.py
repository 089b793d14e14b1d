"""Session construction and shared scratch locations.

Scratch data (upsert staging, checkpoints, stream state) lives under the
folder the cluster names in ``spark.checkpoint.dir``; that folder is shared by
all executors, so a lost executor never takes staged data with it. Only when
the setting is absent (a laptop or a unit test) do we pick a fresh local one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces/splits
# shuffle partitions from runtime statistics; the session zone is pinned to
# UTC because days are cut from UTC event time.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_spark(
    app: str = "tessera",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect.

    Without ``master`` the one that was submitted holds (``spark-submit
    --master``, ``spark.master`` in the defaults); only a plain ``local[*]`` is
    narrowed to ``$BENCH_CPUS`` threads. With ``input_bytes`` (and the
    cluster's ``total_cores``) shuffles and scans are sized by ``conf_for_scale``.
    """
    SparkContext._ensure_initialized()
    submitted = SparkConf().get("spark.master", os.environ.get("SPARK_MASTER") or "local[*]")
    if master is None and submitted == "local[*]" and "BENCH_CPUS" in os.environ:
        master = f"local[{os.environ['BENCH_CPUS']}]"
    builder = SparkSession.builder.appName(app).master(master or submitted)
    conf = dict(BASE_CONF)
    if input_bytes is not None:
        conf.update(conf_for_scale(input_bytes, total_cores or os.cpu_count() or 1))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


MiB = 1 << 20


def conf_for_scale(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.25,
                   partition_bytes: int = 256 * MiB) -> dict[str, str]:
    """Settings sized from the data, for a cluster run (``get_spark(input_bytes=...)``).

    Shuffle partitions start from the expected shuffle volume
    (``shuffle_fraction`` of the input: the models shuffle projected, pre-
    aggregated rows) at ``partition_bytes`` each, never below 2x the cores;
    AQE then coalesces small ones and splits skewed ones. Scan splits use the
    same size, so a task's input and output both fit executor memory. The
    broadcast bound stays small and fixed: it must not grow with the data.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    parts = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MiB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MiB),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. One is set only where it is unset and all tasks run on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tessera/{purpose}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str, under: str) -> bool:
    """Recursively delete ``path`` through the Hadoop FileSystem of the path.

    Refuses anything not strictly inside ``under`` (a scratch or warehouse
    root), so only folders the library created itself can be removed.
    """
    root = under.rstrip("/") + "/"
    if not path.startswith(root) or path.rstrip("/") == under.rstrip("/"):
        raise ValueError(f"refusing to delete {path!r} outside {under!r}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera"
