"""Session construction and the shared work folder.

All intermediate files (rendered inputs, staging tables, stream checkpoints)
live under the folder the cluster names in ``spark.checkpoint.dir``. On a
cluster that setting points at shared storage; it is read from the session
and only set here when it is missing (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app: str = "fundlake", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:  # otherwise as the cluster sets it
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediates."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="fundlake-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/work/{name}-{uuid.uuid4().hex[:10]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def counted(df):
    """``df`` with its rows counted on the way. Counting is an operator of its own, so what
    is projected before and after it is compiled apart: in one method of over 8 KB of
    bytecode the JVM would interpret all of it, row by row."""
    return df.observe(unique_name("rows"), F.count(F.lit(1)).alias("n"))


def materialize(df, name: str):
    """Write ``df`` once to the shared work folder and read it back, so
    several consumers do not each recompute it (and lineage is cut)."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one work folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def plan_bytes(df) -> int:
    """Bytes that Spark expects of ``df``, from the sizes of the files it reads; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write in here deletes its shuffle files when it has ended, so that they do not
    stay on the executors' disks beside those of the next."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
