from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.streaming import history, sealed

START = datetime(2026, 8, 4, 6, tzinfo=timezone.utc)
SCHEMA = "tweet_id string, source_hashtag string, username string, created_at timestamp, text string, text_normalized string, hashtags array<string>"


def post(i, text="buy it", at=0, tag="nifty", tags=("nifty",)):
    return (str(i), tag, f"u{i}", START + timedelta(seconds=at), text, None, list(tags))


def state(spark, **changes):
    return sealed.StreamingSignal(spark, ["nifty", "sensex"], replace(Settings(), **changes))


def test_suppressed_and_scored(spark):
    s = state(spark).ingest(spark.createDataFrame([post(i) for i in range(3)] + [post(10 + i, tag="sensex") for i in range(8)], SCHEMA), START)
    live = {r["hashtag"]: r for r in s.snapshot().collect()}
    assert live["nifty"]["suppressed"] and live["nifty"]["composite_signal"] is None and live["nifty"]["sealed_at"] is None
    assert live["sensex"]["composite_signal"] > 0 and live["sensex"]["sentiment_coverage"] == 1


def test_cross_tags_lift(spark):
    rows = [post(i, tags=("nifty",)) for i in range(8)] + [post(20 + i, tag="sensex", tags=("NIFTY",)) for i in range(8)]
    live = {r["hashtag"]: r["composite_signal"] for r in state(spark).ingest(spark.createDataFrame(rows, SCHEMA), START).snapshot().collect()}
    assert live["sensex"] > live["nifty"]


def test_seals_after_grace_and_drops_late(spark):
    end = START + timedelta(minutes=15)
    s = state(spark).ingest(spark.createDataFrame([post(i) for i in range(6)], SCHEMA), START)
    assert s.seal(end + timedelta(seconds=60)).count() == 0
    (r,) = s.seal(end + timedelta(seconds=121)).collect()
    assert r["tweet_count"] == 6 and r["sealed_at"]
    s.ingest(spark.createDataFrame([post(99)], SCHEMA), end + timedelta(seconds=300))
    assert s.snapshot().count() == 0


def test_dedup_by_id_and_content_across_batches(spark):
    bad = [(None, "nifty", "u", START, "x", None, None), ("5", None, "u", START, "x", None, None), ("6", "nifty", "u", None, "x", None, None)]
    s = state(spark, min_bucket_tweets=1).ingest(spark.createDataFrame([post(1), post(1), post(2), *bad], SCHEMA), START)
    again = [post(1, "changed text"), ("7", "nifty", "u2", START, "buy it", None, None), post(3)]
    s.ingest(spark.createDataFrame(again, SCHEMA), START + timedelta(seconds=30))
    assert s.snapshot().first()["tweet_count"] == 3


def test_watermark_form_counts(spark, tmp_path):
    rows = [post(i, at=i) for i in range(6)] + [post(1, at=1), post(50, at=3600)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    q = sealed.sealed_counts(stream).writeStream.format("memory").queryName("sealed_test").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    (r,) = spark.sql("SELECT * FROM sealed_test").collect()
    assert (r["hashtag"], r["tweet_count"], r["sentiment_coverage"]) == ("nifty", 6, 1.0)


def test_metrics(spark):
    df = spark.createDataFrame([("a", float(x), x % 2 == 0) for x in range(1, 21)] + [("b", -3.0, False), ("b", None, True)], "source_hashtag string, lag_seconds double, was_duplicate boolean")
    got = {r["source_hashtag"]: r for r in sealed.ingest_metrics(df).collect()}
    assert (got["a"]["lag_p50"], got["a"]["lag_p95"], got["a"]["dedup_hit_rate"]) == (10.5, 19.0, 0.5)
    assert (got["b"]["samples"], got["b"]["lag_p50"]) == (1, 0.0)
    assert sealed.ingest_metrics(df.limit(0)).where(F.col("samples") > 0).count() == 0


def test_history_and_sinks(spark, tmp_path):
    s = state(spark).ingest(spark.createDataFrame([post(i) for i in range(6)] + [post(20 + i, at=90_000) for i in range(6)], SCHEMA), START)
    rows = s.seal(START + timedelta(days=3))
    path = f"{tmp_path}/h"
    assert history.sealed_history(spark, path, START, 24).count() == 0
    history.append_sealed(rows, path)
    assert history.sealed_history(spark, path, START + timedelta(hours=30), 48).count() == 2
    (r,) = history.sealed_history(spark, path, START + timedelta(hours=30), 24).collect()
    assert r["tweet_count"] == 6 and r["composite_signal"] > 0
    seen = []
    assert history.push(rows, [lambda d: 1 / 0, lambda d: seen.append(d.count())]) == 1 and seen == [2]


def test_backfill_passes_the_same_dedup(spark):
    old, live = spark.createDataFrame([post(i) for i in range(6)], SCHEMA), spark.createDataFrame([post(i) for i in range(4, 9)], SCHEMA)
    assert state(spark).ingest(old, START).ingest(live, START).snapshot().first()["tweet_count"] == 9


def test_state_goes_on_in_a_new_process(spark, tmp_path):
    path = f"{tmp_path}/s"
    one = sealed.StreamingSignal(spark, ["nifty"], replace(Settings(), min_bucket_tweets=1), path)
    one.ingest(spark.createDataFrame([post(1), post(2)], SCHEMA), START, number=0)
    two = sealed.StreamingSignal(spark, ["nifty"], replace(Settings(), min_bucket_tweets=1), path)
    two.ingest(spark.createDataFrame([post(1), post(2)], SCHEMA), START, number=0)  # the same micro-batch again
    two.ingest(spark.createDataFrame([post(2), post(3)], SCHEMA), START, number=1)
    assert two.snapshot().first()["tweet_count"] == 3 and two.version == 2


def test_keys_beyond_the_horizon_are_dropped(spark):
    s = state(spark, dedup_ttl_seconds=60).ingest(spark.createDataFrame([post(1)], SCHEMA), START)
    s.ingest(spark.createDataFrame([post(2)], SCHEMA), START + timedelta(seconds=90))
    assert [r["tweet_id"] for r in s._read("seen").collect()] == ["2"]
    assert sealed.StreamingSignal(spark, ["nifty"]).snapshot().count() == 0


def test_live_pipeline(spark, tmp_path):
    spark.createDataFrame([post(i) for i in range(4, 9)], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    times, seen = iter([START] * 3 + [START + timedelta(minutes=20)] * 3), []
    q = sealed.run_live(stream, state(spark), lambda: next(times), f"{tmp_path}/history", f"{tmp_path}/cp", backfill=spark.createDataFrame([post(i) for i in range(6)], SCHEMA), sinks=[lambda d: seen.append([r["tweet_count"] for r in d.collect()])])
    q.awaitTermination(60)
    assert seen == [[], [9]] and history.sealed_history(spark, f"{tmp_path}/history", START, 24).first()["tweet_count"] == 9


def test_high_water_marks(spark):
    marks = spark.createDataFrame([("nifty", 5), ("gold", 1)], "source_hashtag string, last_id long")
    new, after = sealed.newer_than_mark(spark.createDataFrame([post(4), post(7), post("x"), post(2, tag="sensex")], SCHEMA), marks)
    assert sorted(r["tweet_id"] for r in new.collect()) == ["2", "7"]
    assert {r[0]: r[1] for r in after.collect()} == {"nifty": 7, "gold": 1, "sensex": 2}


def test_live_metrics(spark):
    log = spark.createDataFrame([("a", START - timedelta(seconds=30 * k), k > 0) for k in range(20)], "source_hashtag string, collected_at timestamp, poll_ok boolean")
    (r,) = sealed.live_metrics(log, START).collect()
    assert (r["posts_per_minute"], r["poll_success"], r["stale_seconds"]) == (2.0, 0.95, 0.0)
