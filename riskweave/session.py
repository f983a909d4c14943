"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on.  ANSI stays on: bad casts must be explicit.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a hash join only where every partition of its build side is proven small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # streaming state lives on disk, not in executor memory
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "riskweave", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, where no such folder is configured, a temporary one is made and
    remembered in the session; a cluster without the setting gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("riskweave.work.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="riskweave-")
        spark.conf.set("riskweave.work.dir", root)
    return os.path.join(root, "riskweave", f"{label}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system that Spark uses for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making; nothing happens where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def child_paths(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, one level deep."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return [f.getPath().toString() for f in found]


def staged(df: DataFrame, label: str, group_mb: int | None = None) -> DataFrame:
    """``df`` written once to the work folder and read back: computed once, lineage cut.

    A task reads whole row groups, by default up to a file each.  Smaller ones, of ``group_mb``, let all
    cores share the rows of costly steps, however few tasks wrote them.
    """
    path = work_path(df.sparkSession, label)
    sizes = {"parquet.block.size": str(group_mb << 20)} if group_mb else {}
    df.write.options(**sizes).parquet(path)
    return df.sparkSession.read.parquet(path)
