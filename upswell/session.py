"""Session settings and the one shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "upswell", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster the deployment sets master, memory and shuffle partitions;
    nothing here pins them.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="spark-")
    sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, store in the shared folder, cut the lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: lineage is cut there, and later reads take only the columns they need, and
    of a frame stored in parts ``by`` some columns only the parts they ask for."""
    path = f"{shared_folder(df.sparkSession)}/frames/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when a scan gives fewer tasks than the session can run.

    One file with one row group is one task however large the machine. A table of
    many files already has enough tasks and passes through unchanged.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
