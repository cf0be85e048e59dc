"""Where intermediate tables go: the folder the cluster shares."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, as every executor can read it and it outlives them.

    A local session without the setting gets a temporary folder. On a cluster a
    machine-local folder would be wrong, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barloom-"))
    return spark.sparkContext.getCheckpointDir()


#: Paths given out in this process and not yet cleared.
_given: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    _given.append(f"{shared_folder(spark)}/barloom/{label}-{uuid.uuid4().hex}")
    return _given[-1]


def clear(spark: SparkSession) -> int:
    """Delete the intermediate tables this process has written; how many there were.

    For the end of a job or of one query: frames that read them can't be used after.
    """
    sc, cleared = spark.sparkContext, 0
    while _given:
        path = sc._jvm.org.apache.hadoop.fs.Path(_given.pop())
        cleared += path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    return cleared


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: later steps neither recompute nor lose it."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
