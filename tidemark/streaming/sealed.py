"""The incremental signal over a stream of posts.

``sealed_counts`` uses Spark's own operators: watermark, dedup within it, windowed aggregation, append mode; a bucket is
sealed when event time passes its end by the grace. ``StreamingSignal`` is the exact form: foreachBatch increments on
state in a shared folder, with a dedup horizon of its own, live snapshots and sealing by a given clock. Its formulas are
the live ones: no virality; momentum is the mean number of other target tags, over the number there could be; the
interval is that of a bounded reservoir, times the multiplier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Lexicon, Settings
from ..functions import sentiment
from ..functions.text import content_hash
from ..operators.signal import bootstrap_interval
from ..session import scratch

RESERVOIR = 256
SEALED = "hashtag string, bucket_start string, tweet_count int, sentiment_coverage double, sealed_at string, composite_signal double, ci_lower double, ci_upper double, suppressed boolean"


def sealed_counts(stream: DataFrame, settings: Settings = Settings(), lexicon: Lexicon | None = None) -> DataFrame:
    """(hashtag, bucket_start, tweet_count, sentiment_coverage), each bucket once it is sealed."""
    grace, text = f"{settings.seal_grace_seconds} seconds", F.coalesce("text_normalized", "text")
    ok = stream.where("tweet_id IS NOT NULL AND source_hashtag IS NOT NULL AND created_at IS NOT NULL")
    rows = ok.withColumn("tm_hash", content_hash(text, F.col("username"), F.col("source_hashtag"))).withWatermark("created_at", grace)
    rows = rows.dropDuplicatesWithinWatermark(["tweet_id", "source_hashtag"]).dropDuplicatesWithinWatermark(["tm_hash", "source_hashtag"])
    rows = sentiment.with_polarity(rows, "tm_p", lexicon or settings.lexicon, text, F.lit("en"))
    window = F.window("created_at", f"{settings.bucket_minutes} minutes")
    out = rows.groupBy(F.col("source_hashtag").alias("hashtag"), window).agg(F.count("*").alias("tweet_count"), F.avg(sentiment.matched(F.col("tm_p")).cast("int")).alias("sentiment_coverage"))
    return out.select("hashtag", F.col("window.start").alias("bucket_start"), "tweet_count", F.round("sentiment_coverage", 4).alias("sentiment_coverage"))


def deduplicated(stream: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The posts of a stream without repeats, by (id, tag) and then by content, within the dedup horizon. State older than the horizon is dropped by the watermark."""
    text = F.coalesce("text_normalized", "text")
    ok = stream.where("tweet_id IS NOT NULL AND source_hashtag IS NOT NULL AND created_at IS NOT NULL")
    rows = ok.withColumn("tm_hash", content_hash(text, F.col("username"), F.col("source_hashtag"))).withWatermark("created_at", f"{settings.dedup_ttl_seconds} seconds")
    return rows.dropDuplicatesWithinWatermark(["tweet_id", "source_hashtag"]).dropDuplicatesWithinWatermark(["tm_hash", "source_hashtag"]).drop("tm_hash")


class StreamingSignal:
    """State: accepted posts of live buckets with their scores, and the keys seen within the dedup horizon; older keys are dropped.

    Versions lie under ``path`` and count once their marker is written: a new process given the same folder goes on from
    the last one, and a step that failed half-way is written again. ``number``, a micro-batch's, makes an ingest happen once.
    """

    def __init__(self, spark: SparkSession, targets: list[str], settings: Settings = Settings(), path: str | None = None):
        self.spark, self.targets, self.settings = spark, [t.lower() for t in targets], settings
        self.path = (path or scratch(spark, "stream")).rstrip("/")
        done = self._marks("done-")
        self.version, self.batches = max(done, default=0), self._marks("batch-")

    def _place(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _marks(self, kind: str) -> set[int]:
        fs, where = self._place("")
        return {int(n[len(kind) :]) for x in (fs.listStatus(where) if fs.exists(where) else []) if (n := x.getPath().getName()).startswith(kind)}

    def _commit(self, version: int, number: int | None = None) -> None:
        for name in [f"done-{version}"] + ([f"batch-{number}"] if number is not None else []):
            fs, where = self._place(name)
            fs.create(where, True).close()
        self.version = version
        if number is not None:
            self.batches.add(number)

    def _read(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/{name}-{self.version}") if self.version else None

    def ingest(self, batch: DataFrame, now: datetime, number: int | None = None) -> StreamingSignal:
        """One micro-batch: invalid posts, posts behind a sealed bucket and posts seen before are left out."""
        if number in self.batches:
            return self
        s = self.settings
        horizon = F.lit(now) - F.make_dt_interval(secs=F.lit(float(s.dedup_ttl_seconds)))
        text = F.coalesce("text_normalized", "text")
        tags = F.transform(F.coalesce("hashtags", F.array().cast("array<string>")), lambda t: F.lower(t))
        own = F.lower("source_hashtag")
        known = F.array(*(F.lit(t) for t in self.targets)).cast("array<string>")
        latin = Lexicon(s.lexicon.bullish, s.lexicon.bearish, (), ())
        rows = sentiment.with_polarity(batch.where("tweet_id IS NOT NULL AND source_hashtag IS NOT NULL AND created_at IS NOT NULL"), "tm_p", latin, text, F.lit("en")).select(
            "tweet_id", own.alias("hashtag"), "created_at", F.window("created_at", f"{s.bucket_minutes} minutes")["start"].alias("bucket_start"),
            content_hash(text, F.col("username"), own).alias("hash"), F.greatest(F.lit(0), F.size(F.array_union(F.array_intersect(tags, known), F.array(own))) - 1).alias("others"),
            F.col("tm_p").alias("p"),
        )
        rows = rows.withColumns({"sentiment": sentiment.score(F.col("p")), "matched": sentiment.matched(F.col("p"))}).drop("p")
        open_from = F.lit(now) - F.make_dt_interval(secs=F.lit(float(s.seal_grace_seconds + 60 * s.bucket_minutes)))
        rows = rows.where(F.col("bucket_start") > open_from)
        order = F.struct("created_at", "tweet_id", "hash")
        for key in (["tweet_id", "hashtag"], ["hash"]):
            first = rows.groupBy(*key).agg(F.min(order).alias("f"))
            rows = rows.join(first, key).where(F.struct("created_at", "tweet_id", "hash") == F.col("f")).drop("f").dropDuplicates(key)
            if (seen := self._read("seen")) is not None:
                rows = rows.join(seen.where(F.col("seen_at") > horizon).select(*key).distinct(), key, "left_anti")
        rows = rows.withColumn("seen_at", F.lit(now))
        new = self.version + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/new-{new}")
        rows = self.spark.read.parquet(f"{self.path}/new-{new}")
        posts, seen = rows.drop("hash", "seen_at"), rows.select("tweet_id", "hashtag", "hash", "seen_at")
        if self.version:
            posts = self._read("posts").unionByName(posts)
            seen = self._read("seen").where(F.col("seen_at") > horizon).unionByName(seen)
        posts.write.mode("overwrite").parquet(f"{self.path}/posts-{new}")
        seen.write.mode("overwrite").parquet(f"{self.path}/seen-{new}")
        self._commit(new, number)
        return self

    def _rows(self, posts: DataFrame, sealed_at: str | None) -> DataFrame:
        s, most = self.settings, max(1, len(self.targets) - 1)

        def one(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values(["created_at", "tweet_id"])
            values = g["sentiment"].to_numpy(float)
            # A uniform reservoir: the lowest keyed hashes of the ids.
            kept = values
            if len(values) > RESERVOIR:
                kept = values[np.argsort([hashlib.blake2b(f"{s.random_seed}:{i}".encode(), digest_size=8).digest() for i in g["tweet_id"]], kind="stable")[:RESERVOIR]]
            multiplier = s.weights.sentiment * (1 + s.weights.momentum * min(1.0, float(g["others"].mean()) / most))
            own = float(values.std(ddof=1)) if len(values) > 1 else 0.0
            lo, hi = bootstrap_interval(kept, own, s.n_resamples, s.confidence_level, s.random_seed)
            thin = len(g) < s.min_bucket_tweets
            signal = [None] * 3 if thin else [round(float(x) * multiplier, 6) for x in (values.mean(), lo, hi)]
            return pd.DataFrame({"hashtag": [key[0]], "bucket_start": [key[1].isoformat()], "tweet_count": [len(g)], "sentiment_coverage": [round(float(g["matched"].mean()), 4)], "sealed_at": [sealed_at], "composite_signal": [signal[0]], "ci_lower": [signal[1]], "ci_upper": [signal[2]], "suppressed": [thin]})

        return posts.groupBy("hashtag", "bucket_start").applyInPandas(one, SEALED)

    def _due(self, now: datetime):
        wait = timedelta(minutes=self.settings.bucket_minutes, seconds=self.settings.seal_grace_seconds)
        return F.col("bucket_start") <= F.lit(now - wait)

    def seal(self, now: datetime) -> DataFrame:
        """Rows of the buckets due at ``now``, which leave the live state; later posts of theirs are dropped."""
        if not self.version:
            return self.spark.createDataFrame([], SEALED)
        new = self.version + 1
        posts = self._read("posts")
        self._rows(posts.where(self._due(now)), now.isoformat()).write.mode("overwrite").parquet(f"{self.path}/sealed-{new}")
        posts.where(~self._due(now)).write.mode("overwrite").parquet(f"{self.path}/posts-{new}")
        self._read("seen").write.mode("overwrite").parquet(f"{self.path}/seen-{new}")
        self._commit(new)
        return self.spark.read.parquet(f"{self.path}/sealed-{new}")

    def snapshot(self) -> DataFrame:
        """Provisional rows of the live buckets, in order; empty before the first batch."""
        if not self.version:
            return self.spark.createDataFrame([], SEALED)
        return self._rows(self._read("posts"), None).orderBy("hashtag", "bucket_start")


def run_live(stream: DataFrame, state: StreamingSignal, clock: Callable[[], datetime], history_path: str, checkpoint: str, backfill: DataFrame | None = None, sinks: Iterable[Callable[[DataFrame], None]] = (), on_connect: bool = True) -> StreamingQuery:
    """The live pipeline: backfill first, then each micro-batch is ingested, due buckets are sealed, join the history and go to the sinks.

    Sinks get the history of the last ``backfill_hours`` when they connect. The backfill passes the same dedup as the stream.
    """
    from . import history

    sinks, spark = list(sinks), state.spark
    if backfill is not None:
        state.ingest(backfill, clock(), number=-1)
    if on_connect:
        history.push(history.sealed_history(spark, history_path, clock(), state.settings.backfill_hours), sinks)

    def step(batch: DataFrame, number: int) -> None:
        state.ingest(batch, clock(), number)
        rows = state.seal(clock())
        if not rows.isEmpty():
            history.append_sealed(rows, history_path)
            history.push(rows, sinks)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newer_than_mark(posts: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts whose numeric id is above their tag's mark, the new marks): marks (source_hashtag, last_id) are those of the last non-empty poll. Ids that are no numbers are left out."""
    rows = posts.withColumn("tm_id", F.col("tweet_id").try_cast("long")).where("tm_id IS NOT NULL")
    new = rows.join(marks, "source_hashtag", "left").where("last_id IS NULL OR tm_id > last_id").drop("last_id")
    polled = rows.groupBy("source_hashtag").agg(F.max("tm_id").alias("polled"))
    after = marks.join(polled, "source_hashtag", "full").select("source_hashtag", F.coalesce("polled", "last_id").alias("last_id"))
    return new.drop("tm_id"), after


def ingest_metrics(log: DataFrame, lag: str = "lag_seconds", duplicate: str = "was_duplicate") -> DataFrame:
    """Per tag of an ingest log: rows, median lag, the lag at the nearest rank to 95 %, duplicate rate.

    The rank is found in counts of whole milliseconds, merged before the shuffle: a hot tag is a histogram, not its rows.
    """
    rows = log.where(F.col(lag).isNotNull()).select("source_hashtag", F.round(F.greatest(F.lit(0.0), F.col(lag)) * 1000).cast("long").alias("ms"), F.col(duplicate).cast("int").alias("dup"))
    counts = rows.groupBy("source_hashtag", "ms").agg(F.count("*").alias("n"), F.sum("dup").alias("dups"))
    w = Window.partitionBy("source_hashtag").orderBy("ms")
    ranked = counts.withColumns({"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy("source_hashtag"))})
    at = lambda r: F.min(F.when(F.col("upto") > r, F.col("ms")))
    last = F.col("all") - 1
    out = ranked.groupBy("source_hashtag").agg(F.max("all").alias("samples"), at(F.floor(last / 2)).alias("lo"), at(F.ceil(last / 2)).alias("hi"), at(F.rint(last * 0.95)).alias("p95"), F.sum("dups").alias("dups"))
    return out.select("source_hashtag", "samples", F.round((F.col("lo") + F.col("hi")) / 2000, 3).alias("lag_p50"), F.round(F.col("p95") / 1000, 3).alias("lag_p95"), F.round(F.col("dups") / F.col("samples"), 3).alias("dedup_hit_rate"))


def live_metrics(log: DataFrame, now: datetime, minutes: int = 5, at: str = "collected_at", ok: str = "poll_ok") -> DataFrame:
    """Per tag of an ingest log: posts a minute over the last ``minutes``, share of polls that went well, and seconds since the last post."""
    since = F.lit(now) - F.make_dt_interval(mins=F.lit(minutes))
    recent = F.count_if((F.col(at) > since) & (F.col(at) <= F.lit(now)))
    stale = (F.unix_micros(F.lit(now)) - F.unix_micros(F.max(at))) / 1e6
    return log.groupBy("source_hashtag").agg(F.round(recent / minutes, 3).alias("posts_per_minute"), F.round(F.avg(F.col(ok).cast("int")), 3).alias("poll_success"), F.round(stale, 3).alias("stale_seconds"))
