"""Session settings this package is written for, the shared folder for cut lineage, and files that go when they are used."""

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The settings the plans are designed around. Joins carry no broadcast hints on
# tables, so the size check of autoBroadcastJoinThreshold (static and adaptive) decides.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wide projections of parsed columns generate methods over 8,000 bytes, which the JVM leaves
    # uncompiled; beyond this limit Spark uses its smaller generated pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows written to cut lineage go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def builder(app_name: str = "starmart") -> SparkSession.Builder:
    """A session builder with the recommended settings."""
    configured = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        configured = configured.config(key, value)
    return configured


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that is one process (``local``, ``local[n]``) gets a temporary folder without the
    setting; with executors of their own, ``local-cluster`` included, the setting is required, as
    rows in a folder that one machine alone can see are lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="starmart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written rows."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside remove their shuffle files as they end, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all tables in it, wherever it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
