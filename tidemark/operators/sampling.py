"""Uniform samples of a fixed size, caps, and the stale-run cut-off."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reservoir_sample(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """``k`` rows, each as likely as any other, the same for the same seed: the lowest keyed hashes, kept per task before they meet."""
    return df.withColumn("tm_r", F.xxhash64(F.lit(seed), F.col(key))).orderBy("tm_r", key).limit(k).drop("tm_r")


def newest(df: DataFrame, k: int, ts: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(ts), tie).limit(k)


def until_distinct_target(df: DataFrame, target: int, id_col: str, order: str) -> DataFrame:
    """Rows in ``order`` up to the one that brings the ``target``-th distinct id. Only first occurrences are ranked, and only the first ``target`` of them."""
    firsts = df.groupBy(id_col).agg(F.min(order).alias("tm_at")).orderBy("tm_at").limit(target)
    last = firsts.agg(F.max("tm_at").alias("tm_last"), F.lit(1).alias("tm_one"))
    return df.withColumn("tm_one", F.lit(1)).join(F.broadcast(last), "tm_one").where(F.col(order) <= F.col("tm_last")).drop("tm_one", "tm_last")


def stale_run_cutoff(df: DataFrame, page: list[str], order: str, stale: str, run: int = 5) -> DataFrame:
    """Rows of each page before its first run of ``run`` stale rows is complete; a page without one is kept whole. Stale rows themselves are left out, as they are beyond the window."""
    w = Window.partitionBy(*page).orderBy(order)
    rows = df.withColumn("tm_island", F.sum(F.when(F.col(stale), 0).otherwise(1)).over(w))
    inside = Window.partitionBy(*page, "tm_island").orderBy(order)
    rows = rows.withColumn("tm_k", F.sum(F.when(F.col(stale), 1).otherwise(0)).over(inside))
    stops = rows.where(F.col("tm_k") >= run).groupBy(*page).agg(F.min(order).alias("tm_stop"))
    kept = rows.join(stops, page, "left").where((F.col("tm_stop").isNull() | (F.col(order) < F.col("tm_stop"))) & ~F.col(stale))
    return kept.drop("tm_island", "tm_k", "tm_stop")
