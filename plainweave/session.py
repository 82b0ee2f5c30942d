"""A local session for tests and the bench; on a cluster use the given one."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", name: str = "plainweave", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.plainweave.inputPartitions", cpus)  # the given tables are single files
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
