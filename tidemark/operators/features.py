"""Per-post features and their dataset-wide normalisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Lexicon
from ..functions import sentiment


def bucket_start(ts: Column, minutes: int) -> Column:
    """``ts`` floored to whole buckets since the epoch."""
    return F.window(ts, f"{minutes} minutes")["start"]


def bucket_in_hour(ts: Column, minutes: int) -> Column:
    """``ts`` with its minute of the hour floored: the same for a number that divides 60."""
    return F.date_trunc("hour", ts) + F.make_dt_interval(mins=(F.floor(F.minute(ts) / minutes) * minutes).cast("int"))


def market_hours(ts: Column, zone: str = "Asia/Kolkata") -> Column:
    """Monday to Friday, 09:15 to 15:30 in ``zone``, both ends included, to the microsecond."""
    local = F.from_utc_timestamp(ts, zone)
    micros = F.unix_micros(local) - F.unix_micros(F.date_trunc("day", local))
    return (F.weekday(local) < 5) & micros.between(33_300_000_000, 55_800_000_000)


def display_time(ts: Column, zone: str = "Asia/Kolkata") -> Column:
    """Local time without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def collection_window(ts: Column, now: datetime, hours: float, offset_hours: float = 0.0) -> Column:
    """Inside [end - hours, end + 5 minutes] where end is ``now`` less the offset; null is outside."""
    end = F.lit(now) - F.make_dt_interval(secs=F.lit(offset_hours * 3600.0))
    return F.coalesce(ts.between(end - F.make_dt_interval(secs=F.lit(hours * 3600.0)), end + F.make_dt_interval(mins=F.lit(5))), F.lit(False))


def virality(likes: Column, retweets: Column, replies: Column) -> Column:
    """ln(1 + likes + 2 retweets + replies), missing counts as 0."""
    n = [F.coalesce(c.cast("long"), F.lit(0)) for c in (likes, retweets, replies)]
    return F.log1p((n[0] + 2 * n[1] + n[2]).cast("double"))


def with_scalars(df: DataFrame, *aggregates: Column, over: DataFrame | None = None) -> DataFrame:
    """``df`` with dataset-wide aggregates of ``over`` (default: itself) on every row. One row is sent, whatever the data."""
    one = (over if over is not None else df).agg(*aggregates)
    return df.withColumn("tm_one", F.lit(1)).join(F.broadcast(one.withColumn("tm_one", F.lit(1))), "tm_one").drop("tm_one")


def min_max(x: Column, lo: Column, hi: Column) -> Column:
    """``x`` scaled to [0, 1]; all 0 where there is no range."""
    return (x - lo) / F.coalesce(F.nullif(hi - lo, F.lit(0.0)), F.lit(1.0))


def feature_frame(df: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """``df`` with virality, virality_norm, sentiment and sentiment_matched."""
    rows = df.withColumn("virality", virality(F.col("likes"), F.col("retweets"), F.col("replies")))
    rows = with_scalars(rows, F.min("virality").alias("tm_lo"), F.max("virality").alias("tm_hi"))
    rows = rows.withColumn("virality_norm", min_max(F.col("virality"), F.col("tm_lo"), F.col("tm_hi"))).drop("tm_lo", "tm_hi")
    rows = sentiment.with_polarity(rows, "tm_p", lexicon, F.col("text_normalized"), F.col("lang_hint"))
    return rows.withColumns({"sentiment": sentiment.score(F.col("tm_p")), "sentiment_matched": sentiment.matched(F.col("tm_p"))}).drop("tm_p")


def momentum(df: DataFrame, targets: list[str], bucket: str = "bucket_start") -> DataFrame:
    """(source_hashtag, bucket) -> momentum_raw: over posts whose target tags hold the group's own tag, the mean number of other target tags; 0 without such posts."""
    tags = F.array_intersect(F.coalesce("hashtags", F.array().cast("array<string>")), F.array(*(F.lit(t) for t in targets)).cast("array<string>"))
    rows = df.withColumn("tm_t", tags)
    others = F.when(F.array_contains("tm_t", F.col("source_hashtag")), F.size("tm_t") - 1)
    return rows.groupBy("source_hashtag", bucket).agg(F.coalesce(F.avg(others), F.lit(0.0)).alias("momentum_raw"))


def momentum_norm(groups: DataFrame) -> DataFrame:
    rows = with_scalars(groups, F.min("momentum_raw").alias("tm_lo"), F.max("momentum_raw").alias("tm_hi"))
    return rows.withColumn("momentum_norm", min_max(F.col("momentum_raw"), F.col("tm_lo"), F.col("tm_hi"))).drop("tm_lo", "tm_hi")


def engagement(df: DataFrame, tag: str = "source_hashtag") -> DataFrame:
    """Per tag: posts and their mean total engagement."""
    total = sum((F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("likes", "retweets", "replies")), F.lit(0).cast("long"))
    return df.groupBy(tag).agg(F.count("*").alias("sample_count"), F.avg(total).alias("mean_engagement"))
