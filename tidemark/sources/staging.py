"""Tables written in the shared folder between the steps of a job."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below the cluster's ``spark.checkpoint.dir``; where that is unset, below a temporary one, for a master on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as a table and read back: its lineage ends there, and lost executors lose nothing of it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


def removed(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` wrote, once nothing reads them any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
