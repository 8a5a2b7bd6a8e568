"""The folder the cluster shares between executors, for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name below the session's checkpoint folder.

    Only where the session names none and runs on this machine alone (tests) is one made, and set for later
    calls; a cluster without a shared folder is an error, as its executors see no folder of the driver.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tickloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table: computed once, however often they are read.

    Later stages survive lost executors without going back to the sources. ``forget`` deletes it.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote; nothing that still reads them may run afterwards.

    Shuffle files go with the plans that wrote them, so the driver is asked to collect those too.
    """
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()
