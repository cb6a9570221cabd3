"""Session defaults and the shared folder in which streams and staged tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tierflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on; `conf` entries use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Folders by bucket are many and small to list: a job for them costs more than listing a few hundred in place.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "256")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local path
    would lose staged data together with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tierflow-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_area(spark: SparkSession, label: str) -> str:
    """A folder name under the shared root that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
