"""Session construction, shared storage and code shipping.

Everything that must outlive one task is written below ``spark.checkpoint.dir``,
the one folder that driver and executors share.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow switched on."""
    builder = (
        SparkSession.builder.master(master)
        .appName("nephos")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a plain local session, whose threads share one disk, may fall back to a
    temporary folder; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="nephos-shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    base = f"file://{folder}"
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder ``name`` of this application in the shared folder, made if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/nephos/{spark.sparkContext.applicationId}/{name}")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)
    return path.toString()


def write_shared(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder, compressed by the session's codec or ``codec``, and return a reader of it.

    Cuts lineage: a lost executor makes Spark reread files, not recompute.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/nephos/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_shared(df: DataFrame) -> None:
    """Delete the files of a table made by ``write_shared`` once nothing reads it."""
    spark = df.sparkSession
    for uri in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/nephos/" in uri:
            path = spark._jvm.org.apache.hadoop.fs.Path(uri)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def clear_shared(spark: SparkSession) -> None:
    """Delete all tables that this application has left in the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/nephos/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_SHIPPED: set[str] = set()


#: Arrow bytes that go to a Python worker at a time, unless the session sets its own.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application.

    A session that sets no limit for Arrow batches gets a small one: workers keep
    what a batch has taken while they wait for the next stage, beside the JVM.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="nephos-code-"), "nephos_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, f"{root.name}/{source.relative_to(root)}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
