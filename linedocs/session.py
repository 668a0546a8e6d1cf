"""Session helpers.

Library functions take a ``SparkSession`` and never build one; ``local_session``
exists for tests, the bench and the command line.  ``work_dir`` resolves the
shared folder used for written intermediate tables (lineage cuts, reconcile
read-back): it is the cluster's ``spark.checkpoint.dir``; only a local-mode
session without that setting gets a scratch folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.
#  - speculation off: a speculative copy of a write task would emit the same
#    documents twice (deterministic ids make that harmless, but it wastes work)
#  - AQE: coalesces small shuffle partitions, splits skewed ones, and turns a
#    sort-merge join into a broadcast join only when the *measured* side is
#    below the broadcast threshold
#  - UTC: event timestamps are compared with an oracle that has no time zone
BASE_CONF = {
    "spark.speculation": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "linedocs", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (the conf key, or a directory already set
    on the context).  When unset, a local-mode session gets a new scratch
    folder; a cluster session raises, because a machine-local folder is not
    visible to the executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="linedocs-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    sub = f"{name or 'tbl'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub


def drop_work_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``work_dir`` named, through the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
