"""Session and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampType

from lansight.functions.timefn import to_ntz


def build_session(app: str = "lansight", master: str | None = None, partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for jobs, tests and the bench.  On a cluster pass ``master=None``
    and let spark-submit supply master, partitions and the checkpoint folder."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.metricsEnabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when none is configured on a local master (tests, laptops) a private
    one is created and registered, so ``DataFrame.checkpoint()`` works; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            base = None
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[[^,\]]*(,[^,\]]*)?\])?", master):  # local-cluster[...] is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        base = tempfile.mkdtemp(prefix="lansight-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:
            pass
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, unique per call."""
    return f"{shared_dir(spark)}/lansight/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever the shared storage is, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set runtime SQL settings for a block and restore them afterwards."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def at_boundary(df: DataFrame) -> DataFrame:
    """Convert TIMESTAMP columns to TIMESTAMP_NTZ holding UTC wall time (driver contract)."""
    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df  # nothing to convert: no extra projection
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            cols.append(to_ntz(df[f"`{f.name}`"]).alias(f.name))
        else:
            cols.append(df[f"`{f.name}`"])
    return df.select(*cols)
