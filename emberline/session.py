"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here wants: adaptive execution (runtime coalescing,
# skew-join splitting, broadcast decided on measured sizes), UTC session zone
# so zone-less timestamps print as stored, Arrow for pandas exchange.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove RDD checkpoint files once their frames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# scoring and gradient projections generate wide methods; let the JIT compile
# them instead of interpreting their bytecode
JIT_WIDE_METHODS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, app: str = "emberline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, jit_wide_methods: bool = True) -> SparkSession:
    """A session with the settings above.

    ``jit_wide_methods`` adds the JIT flag to the driver and executor JVM
    options, but only where no options are configured yet: a cluster's own
    ``extraJavaOptions`` are never replaced (add the flag there instead).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if jit_wide_methods:
        from pyspark import SparkConf
        preset = SparkConf()
        for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
            if not preset.get(key, None) and key not in (extra or {}):
                conf[key] = JIT_WIDE_METHODS
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master (a
    laptop or a test run, where every task shares the driver's disk) may go
    without; there a private temporary folder is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="emberline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed once, read often,
    and there whatever happens to an executor."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
