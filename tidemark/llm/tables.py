"""Reading input tables and cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Whether shuffle files go when a query ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch of rows on its way to or from a Python task. Texts are long, so the usual 64 MB
#: (several times over, in the JVM and in Python) would take more memory than the work itself.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit on such batches; a lower one stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "64m").rstrip("bB")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a folder of our own, for a master on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The files outlive lost executors, and later readers prune columns. They
    hold hashes and texts, where dictionaries of values gain nothing. What
    the write shuffled is removed once it is done, as nothing reads it again.
    The folder stays behind until ``drop``, or the cluster's policy for
    ``spark.checkpoint.dir``, removes it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.cut_path = path
    return found


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing reads them any more."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.cut_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
