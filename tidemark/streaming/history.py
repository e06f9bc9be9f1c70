"""What subscribers and charts read: sealed history, live rows, and the frames behind the three charts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, sampling
from .sealed import SEALED


def append_sealed(rows: DataFrame, path: str) -> None:
    """Sealed rows join the history; a folder per day of the bucket lets reads and clean-ups skip the rest."""
    rows.select(*[c.split(" ")[0] for c in SEALED.split(", ")], F.substring("bucket_start", 1, 10).alias("day")).write.mode("append").partitionBy("day").parquet(path)


def sealed_history(spark: SparkSession, path: str, now: datetime, hours: float) -> DataFrame:
    """Buckets of the last ``hours``, in order; a missing history is empty."""
    cutoff = F.lit(now) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
    try:
        rows = spark.read.schema(f"{SEALED}, day string").parquet(path)
    except Exception:  # nothing was ever sealed
        return spark.createDataFrame([], SEALED)
    recent = rows.where((F.col("day") >= F.date_format(cutoff, "yyyy-MM-dd")) & (F.col("bucket_start").cast("timestamp") >= cutoff))
    return recent.drop("day").orderBy("hashtag", "bucket_start")


def push(rows: DataFrame, sinks: Iterable[Callable[[DataFrame], None]]) -> int:
    """Give sealed rows to every sink; one that fails doesn't keep them from the others. Returns how many failed."""
    failed = 0
    for sink in sinks:
        try:
            sink(rows)
        except Exception:  # a subscriber's fault is its own
            failed += 1
    return failed


def signal_series(signals: DataFrame) -> DataFrame:
    """The signal chart: scored buckets per tag in local time."""
    rows = signals.where("composite_signal IS NOT NULL")
    return rows.select("hashtag", features.display_time(F.col("bucket_start")).alias("shown_at"), "composite_signal", "ci_lower", "ci_upper").orderBy("hashtag", "shown_at")


def volume_series(signals: DataFrame) -> DataFrame:
    """The volume chart: posts per tag and bucket in local time."""
    at = features.display_time(F.col("bucket_start")).alias("shown_at")
    return signals.groupBy("hashtag", at).agg(F.sum("tweet_count").cast("long").alias("tweet_count")).orderBy("hashtag", "shown_at")


def engagement_sample(posts: DataFrame, k: int, key: str = "tweet_id", seed: int = 42) -> DataFrame:
    """The engagement chart: counts and means of a uniform sample of ``k`` posts."""
    return features.engagement(sampling.reservoir_sample(posts, k, key, seed))
