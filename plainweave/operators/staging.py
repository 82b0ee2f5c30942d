"""Written tables between two passes over expensive or order-dependent data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_written: dict[str, list[str]] = {}  # by application
_local_root: list[str] = []


def stage_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local session without one
    gets a temporary folder: executors elsewhere could not read it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="plainweave-"))
    return _local_root[0]


def new_path(spark: SparkSession) -> str:
    path = f"{stage_root(spark).rstrip('/')}/plainweave/{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write once, read back: cuts the lineage, freezes anything that depends
    on the partitioning, and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict]:
    """The same, and aggregates of the rows, taken while they are written."""
    measured = Observation()
    written = stage(df.observe(measured, *[c.alias(name) for name, c in sums.items()]))
    return written, measured.get


def release_stages(spark: SparkSession) -> int:
    """Delete what this session staged, once its results have been written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for written in _written.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(written)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
