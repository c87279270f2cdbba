"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (the
# size check behind automatic broadcasts) and splits skewed partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",  # tables of a layer run that are built at once share the cluster
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "contrail", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; tests use
    ``local[N]`` with ``spark.sql.shuffle.partitions`` sized to the cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Jobs cut lineage or stage intermediate data only under this folder. When
    it is unset we create one, but only in local mode (tests); on a cluster a
    machine-local folder would be invisible to other executors.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = sc.getCheckpointDir()  # a folder of its own, below the one that was set
        if held:
            return held
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        base = tempfile.mkdtemp(prefix="contrail-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return os.path.join(shared_dir(spark), "contrail", f"{name}-{uuid.uuid4().hex}")


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the written files instead of
    replaying the upstream joins) and lets later scans prune columns, which
    an RDD checkpoint cannot. Never uses a machine-local folder on a cluster.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
