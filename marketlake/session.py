"""Session construction and the few settings correctness depends on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (not tuning): all timestamps are UTC and
# Hive-style partition values (dt, symbol, exchange) stay strings.
CORRECTNESS_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Tuning defaults for a fresh session.  On a cluster these come from the
# job submission; we only fill them in where the session leaves them unset.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # streaming state (dedup keys, open windows) lives in RocksDB on local
    # disk instead of the JVM heap, so large state does not exhaust memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "marketlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time, AQE and no UI server."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**TUNING_CONF, **CORRECTNESS_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the correctness settings to an existing session (idempotent)."""
    for k, v in CORRECTNESS_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


_LOCAL_ROOT: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this names a
    shared filesystem).  Only when it is unset and everything runs in this
    process (``local[...]``, tests) a private folder is created once; a
    cluster without the setting is refused, as executors cannot see such a
    folder.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="marketlake-ckpt-"))
        root = _LOCAL_ROOT[0]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for one job's output."""
    root = checkpoint_root(spark)
    return f"{root}/marketlake-scratch/{name}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: computed
    once, fixed for all later uses, and safe from the loss of an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
