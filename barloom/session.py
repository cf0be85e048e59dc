"""A local session for tests and the bench. On a cluster, use the cluster's own."""

from pyspark.sql import SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
