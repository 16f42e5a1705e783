"""Lineage cuts and work folders in the shared folder of the cluster."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors must share.

    Where it is unset a session on one machine gets a folder of its own; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        application = spark.sparkContext.applicationId
        folder = _own_folders.setdefault(application, "") or tempfile.mkdtemp(prefix="assortment-")
        _own_folders[application] = folder
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder of this application in the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/assortment-{application}/{name}-{uuid.uuid4().hex}"


def remove_work(spark: SparkSession) -> None:
    """Delete the work folder of this application; tables cut from it can no longer be read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_path(spark, "x")).getParent()
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local(df: DataFrame) -> DataFrame:
    """`df` as rows of the plan; only for rows whose number a parameter bounds. Nothing is written."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from there.

    The files survive lost executors, and later joins plan with the real size of the rows.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """`df` for joins that shuffle it: for tables with a row per product, or nearly.

    Catalyst takes the bytes of files for those of rows. Columns of few values make small files of very many rows, that
    the driver would then collect and build for a broadcast.
    """
    return df.hint("merge")
