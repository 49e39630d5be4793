"""Session helpers: local sessions for tests/bench, and a shared checkpoint
directory for lineage cuts.

On a cluster the checkpoint directory is whatever the cluster configured in
``spark.checkpoint.dir`` (a shared, fault-tolerant filesystem).  Only when it
is unset (local tests) do we point it at a fresh local scratch folder.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "docsmith", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, "spark.driver.memory": "8g", **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.  A local one is made only for
    a local master without the setting; on a cluster it must be set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="docsmith-ckpt-", dir=os.environ.get("DOCSMITH_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what :func:`materialize` wrote inside.  For jobs
    that have written their own output by then; a DataFrame that is returned
    unread must not depend on files of a scope that has ended."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint directory and
    read it back: the returned DataFrame's lineage starts at those files, so a
    lost executor re-reads them instead of recomputing everything upstream.
    The checkpoint directory is the cluster's shared one when configured."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on ``cores``
    executor cores.  Shuffle partitions are sized so a partition holds about
    ``partition_bytes`` (AQE coalesces smaller ones and splits skewed ones);
    scan splits are kept at the same size so a task's window buffers (one
    document's lines at a time) and sort spills stay small.  The checkpoint
    directory is not set here: it is the cluster's shared folder."""
    shuffle = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.sources.bucketing.enabled": "true",
    }
