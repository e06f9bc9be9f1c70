"""Queries of problem 4 over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lateness import LateAggregates
from ..session import scratch, table
from ..streaming.late import stream_late_aggregates

COLUMNS = ("tweet_id", "source_hashtag", "created_at", "collected_at", "likes")


def _streamed(spark: SparkSession, d: str, name: str, state: LateAggregates) -> LateAggregates:
    """The state after the table was read as a stream of its files."""
    source = table(spark, d, name)
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/{name}.parque[t]").select(*COLUMNS)  # a pattern, as a stream takes a single file only by one
    query, now = stream_late_aggregates(stream, state, COLUMNS, scratch(spark, "late-stream"))
    query.awaitTermination()
    return now()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = _streamed(spark, d, "tweets", LateAggregates(spark)).read("arrivals").where("verdict <> 'on_time'")
    return found.select(F.col("id").alias("tweet_id"), F.col("key").alias("source_hashtag"), "verdict")


def p4_periods(spark: SparkSession, d: str) -> DataFrame:
    """The aggregates per tag and hour: first result, final result, posts left out; history and batches as two streams into one state."""
    state = _streamed(spark, d, "tweet_batches", _streamed(spark, d, "tweets", LateAggregates(spark)))
    return state.read("periods").select("key", "period_start", "first_count", "final_count", "final_amount", "dropped", "updated_at")


QUERIES = {f.__name__: f for f in (p4_found, p4_periods)}


def _judged(source: str) -> str:
    return f"""
WITH rows AS ({source}),
one AS (SELECT tweet_id, source_hashtag, min(struct_pack(c := collected_at, e := created_at, a := coalesce(likes, 0))) AS f FROM rows
        WHERE created_at IS NOT NULL AND collected_at IS NOT NULL GROUP BY ALL),
timed AS (SELECT tweet_id, source_hashtag, f.c AT TIME ZONE 'UTC' AS c, f.a AS a, date_trunc('hour', f.e AT TIME ZONE 'UTC') AS period_start FROM one),
judged AS (SELECT *, CASE WHEN c <= period_start + INTERVAL 70 MINUTE THEN 'on_time' WHEN c <= period_start + INTERVAL 49 HOUR THEN 'corrected' ELSE 'too_late' END AS verdict FROM timed)"""


_ROWS = "SELECT tweet_id, source_hashtag, created_at, collected_at, likes FROM tweets"
ORACLE = {
    "p4_found": _judged(_ROWS) + " SELECT tweet_id, source_hashtag, verdict FROM judged WHERE verdict <> 'on_time'",
    "p4_periods": _judged(_ROWS + " UNION ALL SELECT tweet_id, source_hashtag, created_at, collected_at, likes FROM tweet_batches")
    + """
SELECT source_hashtag AS key, period_start, count(*) FILTER (verdict = 'on_time') AS first_count, count(*) FILTER (verdict <> 'too_late') AS final_count,
       coalesce(sum(a) FILTER (verdict <> 'too_late'), 0)::BIGINT AS final_amount, count(*) FILTER (verdict = 'too_late') AS dropped, max(c) FILTER (verdict <> 'too_late') AS updated_at
FROM judged GROUP BY ALL""",
}
