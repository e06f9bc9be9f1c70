"""Partitioned storage with a replacing commit, quarantine and run summaries."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..sources.records import RECORD

FIELDS = [x.strip().split(" ")[0] for x in RECORD.replace("array<string>", "a").split(",")]


def write_processed(df: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Replace the table at ``path`` by ``df``, partitioned by UTC date and tag. A failed run leaves the old table."""
    out = df.select(*FIELDS).withColumns({"date": F.date_format("created_at", "yyyy-MM-dd"), "hashtag": F.col("source_hashtag")})
    tmp = f"{path}.tmp"
    out.write.mode("overwrite").partitionBy("date", "hashtag").option("maxRecordsPerFile", settings.rows_per_file).option("compression", settings.compression).parquet(tmp)
    replace_directory(df.sparkSession, tmp, path)


def replace_directory(spark: SparkSession, new: str, path: str) -> None:
    """Put ``new`` in the place of ``path``; files whose name starts with a dot move over. Two renames: between them only the backup exists."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(conf)
    backup = f"{path}.bak"
    fs.delete(at(backup), True)
    if fs.exists(at(path)):
        for status in fs.listStatus(at(path)):
            name = status.getPath().getName()
            if name.startswith(".") and not name.endswith(".crc") and not fs.exists(at(f"{new}/{name}")):
                fs.rename(status.getPath(), at(f"{new}/{name}"))
        fs.rename(at(path), at(backup))
    fs.rename(at(new), at(path))
    fs.delete(at(backup), True)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The processed table with its partition columns as text."""
    return spark.read.schema(f"{RECORD}, date string, hashtag string").parquet(path)


def backfill(spark: SparkSession, path: str, now: datetime, hours: float) -> DataFrame:
    """The last ``hours`` of the processed table; a missing or empty folder has no rows. The date partitions are pruned."""
    try:
        table = read_processed(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)
    cutoff = F.lit(now) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
    return table.where((F.col("date") >= F.date_format(cutoff, "yyyy-MM-dd")) & (F.col("created_at") >= cutoff)).select(*FIELDS)


def write_rejects(classified: DataFrame, path: str) -> None:
    """Rejected lines as JSON, a folder per kind of fault; the raw line is kept."""
    rows = classified.where("outcome = 'rejected'").select("raw_line", F.col("reject_reason").alias("_reject_reason"), "reject_bucket")
    rows.write.mode("overwrite").partitionBy("reject_bucket").json(path)


def counters(classified: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: in, out, rejected, out_of_window, deduped (what is left of in)."""
    c = classified.agg(F.count("*").alias("records_in"), F.count_if(F.col("outcome") == "rejected").alias("records_rejected"), F.count_if(F.col("outcome") == "out_of_window").alias("records_out_of_window"))
    out = kept.agg(F.count("*").alias("records_out"))
    both = c.withColumn("one", F.lit(1)).join(F.broadcast(out.withColumn("one", F.lit(1))), "one").drop("one")
    return both.withColumn("records_deduped", F.col("records_in") - F.col("records_out") - F.col("records_rejected") - F.col("records_out_of_window"))


def write_run_summary(folder: str, phase: str, summary: dict) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{phase}_{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"phase": phase, **summary}, f, default=str)
    return path


def append_raw(df: DataFrame, folder: str, run: str) -> None:
    """Add a run's raw records as JSON lines, a folder per tag and run."""
    df.withColumns({"tag": F.col("source_hashtag"), "run": F.lit(run)}).write.mode("append").partitionBy("tag", "run").json(folder)


def write_signals(signals: DataFrame, rollups: dict[str, DataFrame], folder: str) -> None:
    """Replace the signals and every rollup window's table, each as a whole."""
    for name, df in {"signals": signals, **{f"rollup_{k.replace(' ', '_')}": v for k, v in rollups.items()}}.items():
        df.write.mode("overwrite").parquet(f"{folder}/.{name}.tmp")
        replace_directory(df.sparkSession, f"{folder}/.{name}.tmp", f"{folder}/{name}")


def log_line(message: str, level: str = "INFO", **fields) -> str:
    """One structured log line: time, level, message and the extra fields, as JSON."""
    return json.dumps({"timestamp": datetime.now(timezone.utc).isoformat(), "level": level, "message": message, **fields}, default=str, ensure_ascii=False)
