"""Where jobs write what must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local master, whose executor is the driver's own process, may go without one and gets a temporary folder;
    on a cluster a missing setting raises, as each machine would write to a disk of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut in the shared folder, which is set first where no session has one."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: cuts the lineage and survives lost executors.

    ``options`` go to the writer. The table stays until ``forget`` is called with what this returns, or ``forget_all`` for the session's folder."""
    path = f"{shared_folder(df.sparkSession)}/tables-{df.sparkSession.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def forget(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made, once nothing that is still to run reads them."""
    for df in tables:
        delete(df.sparkSession, df.written_path)


def forget_all(spark: SparkSession) -> None:
    """Removes all tables that this application has written; results that are still to be read from them are lost."""
    delete(spark, f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}")
