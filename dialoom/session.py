"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "dialoom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables, as named by `spark.checkpoint.dir`.

    A session without the setting uses a folder below its warehouse, which every executor can reach too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _files(spark: SparkSession, path: str):
    """A path in the JVM and the file system it is on."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def work_path(spark: SparkSession, name: str) -> str:
    """A folder below the work root that no other run uses; it goes when the session's JVM ends."""
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path, files = _files(spark, path)
    files.mkdirs(jvm_path.getParent())
    files.deleteOnExit(jvm_path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, files = _files(spark, path)
    return files.exists(jvm_path)


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path, files = _files(spark, path)
    files.mkdirs(jvm_path)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Moves a written folder to the place where readers look, so that they see all of its files or none."""
    source, files = _files(spark, written)
    target, _ = _files(spark, path)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"could not move {written} to {path}")


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for stateful streams: RocksDB state, one state partition per core.

    The number of state partitions is fixed when a query first starts, so it follows the cluster and not
    the batch setting of the caller's session, which stays untouched.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return sibling
