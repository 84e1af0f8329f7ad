"""Reading the corpus tables and cutting lineage on shared storage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of one Arrow batch.  Texts are long; the session's usual 10,000 rows would be
#: tens of MB for every running task, in the JVM and again in its Python worker.
BATCH_ROWS = 1_000


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed: Spark sends it once as a zip."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="corpus-package-")) / "storefront-package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's later jobs by ``BATCH_ROWS``; ship the package."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, ``spark.checkpoint.dir``.

    The setting is read from the session.  Only where it is unset (tests, one
    machine) a temporary folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = tempfile.mkdtemp(prefix="corpus-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation.
    The folder is removed when the application ends.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/corpus/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int, limit_bytes: int = 48 << 20) -> DataFrame:
    """Mark a side for broadcast when its measured size is under the limit.

    ``rows`` is a count that the caller has taken.  Beyond the limit the frame is
    returned as it is, and Spark joins it by a shuffle with the same result.
    """
    return F.broadcast(df) if rows * row_bytes <= limit_bytes else df


def doc_crc(col) -> F.Column:
    """crc32 of a document id written as text: the fold of the labelled rows."""
    return F.crc32(col.cast("string").cast("binary"))
