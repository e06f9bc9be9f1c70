"""Session defaults, table reading and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark").config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> None:
    """Settings that change no result. Spark 4.1 plans a union of differently partitioned inputs as if they were partitioned alike, and adaptive execution then fails to join it."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by name. Times are read and shown in UTC, which the session is set to."""
    prepare(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Only a local session may go without: a machine's own folder would lose what other machines write."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tidemark-shared")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. What is written there is deleted when this process ends; state that must outlive it is given a path of its own."""
    prepare(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def clear_scratch() -> None:
    """Delete every scratch path of this process whose session still runs; frames read from them can't be used any more."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended: its folder goes with the job
            return


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: what follows no longer depends on executors that computed it."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
