"""Session construction and lineage cutting.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names (a shared
file system).  Only a local-mode session without that setting gets a private folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "lakemeter",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE with skew handling, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one is made only for an unset local session."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context here: use the conf only
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get(_CKPT_KEY, None) \
        or (sc.getConf().get(_CKPT_KEY, None) if sc else None)
    if not current:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="lakemeter-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(_CKPT_KEY, current)
    if sc and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder and read it back.

    One job (an RDD checkpoint would compute its input twice unless cached), columnar and
    compressed, and the read-back plan carries real file sizes, so later join choices use
    measured statistics.  Survives executor loss: nothing lives only on one machine.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/lakemeter-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_all(*dfs: DataFrame) -> list[DataFrame]:
    """``materialize`` several independent frames as concurrent Spark jobs."""
    if len(dfs) <= 1:
        return [materialize(df) for df in dfs]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(materialize, dfs))


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint: Spark removes its files with the frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.  For small results that outlive the
    function that makes them; large intermediate frames belong in a ``Scratch``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Scratch:
    """Intermediate frames of one computation; leaving the ``with`` block removes their folders.

    Nothing that is still to be evaluated may read them afterwards: ``settle`` the result first."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/lakemeter-scratch-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *error) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
