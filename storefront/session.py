"""Spark session settings shared by the library, the tests and the bench.

The library itself never creates a session: every operator takes DataFrames and
returns DataFrames.  These helpers exist for scripts (``bench.py``, tests) and for
the few operators that must cut lineage (``checkpoint_dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that make results reproducible and plans scale-friendly.
#  * UTC session time zone: day arithmetic (recency, windows) must not depend on
#    the machine's zone.
#  * AQE with partition coalescing and skew-join splitting: hot keys (one customer
#    or product with a third of all rows) are split at run time.
#  * Broadcast only below a size the planner has measured (default 10 MB; AQE
#    re-checks with runtime statistics).
#  * Runtime bloom filters: a selective filter on one join side prunes the other
#    side's scan before the shuffle.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # a filtered dimension side (e.g. orders of the last 90 days) builds a bloom
    # filter that prunes the fact side (lineitem) before the join shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "storefront", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave as is
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this points at shared storage and is read, never overridden.
    Only when it is unset (local runs, tests) a scratch folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    local = tempfile.mkdtemp(prefix="storefront-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the checkpoint folder and read back.

    For rows that several passes read: each pass would run the joins before them again.
    The folder is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed: Spark sends it once as a zip."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="storefront-package-")) / "storefront-library.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
