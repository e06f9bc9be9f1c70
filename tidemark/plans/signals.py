"""Queries of the signal engine's own operators over the driver's tables, with the same results in SQL."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BEARISH, BEARISH_DEVANAGARI, BULLISH, BULLISH_DEVANAGARI, NEGATION, Settings
from ..functions import sentiment
from ..functions import text as T
from ..operators import dedup, features, sampling, signal, store, tfidf
from ..session import scratch, table
from ..sources import records
from ..streaming import history, sealed

NOW = datetime(2026, 1, 7, tzinfo=timezone.utc)
HOURLY = replace(Settings(), bucket_minutes=60, filter_market_hours=False)


def _tweets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tweets")


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return records.clean(records.parse(table(spark, d, "raw_records")))


def _targets(spark: SparkSession, d: str) -> list[str]:
    return [r[0] for r in table(spark, d, "hashtag_targets").orderBy("hashtag").collect()]


def _normal() -> Column:
    return F.coalesce("text_normalized", F.lower("text"))


def _hint() -> Column:
    return T.lang_hint(F.col("text"))


def _posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts in the processed shape: a missing normalised text is made up for and the hint is that of the scripts."""
    return _tweets(spark, d).withColumns({"text_normalized": _normal(), "lang_hint": _hint()})


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    rows = records.parse(table(spark, d, "raw_records")).where("k_text = 'STRING'")
    return rows.select("raw_id", T.clean_text(F.col("j_text")).alias("clean"), T.normalize_for_features(T.clean_text(F.col("j_text"))).alias("normalized"))


def lang_hint(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).select("rec_id", _hint().alias("hint"))


def validate_rejects(spark: SparkSession, d: str) -> DataFrame:
    return records.classify(_cleaned(spark, d)).where("outcome = 'rejected'").groupBy("reject_bucket").agg(F.count("*").alias("n"))


def valid_records(spark: SparkSession, d: str) -> DataFrame:
    rows = records.classify(_cleaned(spark, d)).where("outcome = 'valid'")
    return rows.select("raw_id", "tweet_id", "username", "created_at", "collected_at", "text", "likes", "retweets", "replies", F.size("mentions").alias("n_mentions"), F.concat_ws(",", "hashtags").alias("hashtags"), "source_hashtag", "lang_hint")


def lookback_filter(spark: SparkSession, d: str) -> DataFrame:
    return records.classify(_cleaned(spark, d), NOW, 24).groupBy("outcome").agg(F.count("*").alias("n"))


def _kept(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    classified = records.classify(_cleaned(spark, d), NOW, 24)
    return classified, dedup.dedup_records(classified.where("outcome = 'valid'"), Settings().near_duplicate_fields, "raw_id")


def dedup_two_tier(spark: SparkSession, d: str) -> DataFrame:
    rows = _posts(spark, d)
    return dedup.dedup_records(rows, Settings().near_duplicate_fields, "rec_id").select("rec_id", "tweet_id", "source_hashtag")


def dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.counters(*_kept(spark, d))


def market_hours(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).where(features.market_hours(F.col("created_at"))).select("rec_id")


def bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _tweets(spark, d).where("created_at IS NOT NULL")
    return rows.groupBy("source_hashtag", features.bucket_start(F.col("created_at"), 15).alias("bucket_start")).agg(F.count("*").alias("tweet_count"))


def virality_norm(spark: SparkSession, d: str) -> DataFrame:
    rows = _tweets(spark, d).withColumn("virality", features.virality(F.col("likes"), F.col("retweets"), F.col("replies")))
    rows = features.with_scalars(rows, F.min("virality").alias("lo"), F.max("virality").alias("hi"))
    return rows.select("rec_id", F.round("virality", 6).alias("virality"), F.round(features.min_max(F.col("virality"), F.col("lo"), F.col("hi")), 6).alias("virality_norm"))


def momentum(spark: SparkSession, d: str) -> DataFrame:
    rows = _tweets(spark, d).where("created_at IS NOT NULL").withColumn("bucket_start", features.bucket_start(F.col("created_at"), 60))
    out = features.momentum_norm(features.momentum(rows, _targets(spark, d)))
    return out.select("source_hashtag", "bucket_start", F.round("momentum_raw", 6).alias("momentum_raw"), F.round("momentum_norm", 6).alias("momentum_norm"))


def sentiment_score(spark: SparkSession, d: str) -> DataFrame:
    rows = sentiment.with_polarity(_posts(spark, d), "p", Settings().lexicon, F.col("text_normalized"), F.col("lang_hint"))
    return rows.select("rec_id", F.col("p.bull").alias("bull"), F.col("p.bear").alias("bear"), F.round(sentiment.score(F.col("p")), 6).alias("sentiment"))


def sentiment_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = sentiment.with_polarity(_posts(spark, d), "p", Settings().lexicon, F.col("text_normalized"), F.col("lang_hint"))
    return rows.groupBy("source_hashtag").agg(F.round(F.avg(sentiment.matched(F.col("p")).cast("int")), 6).alias("coverage"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("composite_signal", "ci_lower", "ci_upper", "sentiment_coverage")})


def composite_signal(spark: SparkSession, d: str) -> DataFrame:
    """Hourly buckets of all hours."""
    return _rounded(signal.analytic_signals(_posts(spark, d), HOURLY, _targets(spark, d)))


def signal_analytic_ci(spark: SparkSession, d: str) -> DataFrame:
    """The default buckets of the market session."""
    return _rounded(signal.analytic_signals(_posts(spark, d), Settings(), _targets(spark, d)))


def signal_bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(signal.bootstrap_signals(_posts(spark, d), HOURLY, _targets(spark, d)))


def signal_bootstrap_bounds(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every bootstrap interval: it has the signal in its middle and is no narrower than the normal one."""
    posts, targets = _posts(spark, d), _targets(spark, d)
    normal = signal.analytic_signals(posts, HOURLY, targets).select("hashtag", "bucket_start", (F.col("ci_upper") - F.col("ci_lower")).alias("least"))
    both = signal.bootstrap_signals(posts, HOURLY, targets).join(normal, ["hashtag", "bucket_start"])
    middle = F.abs(F.col("ci_upper") + F.col("ci_lower") - 2 * F.col("composite_signal")) < 1e-9
    return both.select("hashtag", "bucket_start", F.round("composite_signal", 6).alias("composite_signal"), "tweet_count", middle.alias("centred"), (F.col("ci_upper") - F.col("ci_lower") > F.col("least") - 1e-9).alias("wide_enough"))


def signal_summary(spark: SparkSession, d: str) -> DataFrame:
    return signal.signal_summary(table(spark, d, "signal_buckets"))


def _rollup(window: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _rounded(signal.rollup(table(spark, d, "signal_buckets"), window))

    return run


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    out = tfidf.tfidf(table(spark, d, "documents"), "doc_id", "text", tfidf.english_stopwords())
    return out.select(F.col("id").alias("doc_id"), "term", "tf", F.round("weight", 6).alias("weight"))


def tfidf_top_terms(spark: SparkSession, d: str) -> DataFrame:
    out = tfidf.tfidf(table(spark, d, "documents"), "doc_id", "text", tfidf.english_stopwords())
    return tfidf.top_terms(out).select("term", F.round("total_weight", 4).alias("total_weight"))


def tfidf_sparsity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    out = tfidf.tfidf(docs, "doc_id", "text", tfidf.english_stopwords())
    return tfidf.sparsity(out, docs.count()).withColumn("sparsity", F.round("sparsity", 6))


def hashtag_mention_extract(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).select("rec_id", F.concat_ws(",", T.hashtags(F.col("text"))).alias("hashtags"), F.concat_ws(",", T.mentions(F.col("text"))).alias("mentions"))


def parse_count(spark: SparkSession, d: str) -> DataFrame:
    """Counts written short and read again: 1234 as 1.2K, every third with separators, others as plain decimals, which lose their fraction."""
    n = F.col("likes") * 37
    short = F.when(F.col("rec_id") % 3 == 0, F.format_number(n, 0)).when(n >= 1000, F.concat(F.format_string("%.1f", F.floor(n / 100) / 10), F.lit("K"))).otherwise(F.concat(n.cast("string"), F.lit(".7")))
    return _tweets(spark, d).where("likes IS NOT NULL").select("rec_id", T.parse_count(short).alias("n"))


def strip_markup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.strip_markup(F.col("text")).alias("plain"))


def collection_window(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).where(features.collection_window(F.col("created_at"), NOW, 6.25, 8.4)).select("rec_id")


def stale_run_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """Pages are the raw files; a row is stale when posted before noon of the first day."""
    rows = _cleaned(spark, d).where("created_at IS NOT NULL").withColumn("stale", F.col("created_at") < F.lit(datetime(2026, 1, 5, 12, tzinfo=timezone.utc)))
    return sampling.stale_run_cutoff(rows.select("raw_id", "run_file", "stale"), ["run_file"], "raw_id", "stale").select("raw_id", "run_file")


def engagement_distribution(spark: SparkSession, d: str) -> DataFrame:
    return features.engagement(_tweets(spark, d)).withColumn("mean_engagement", F.round("mean_engagement", 6))


def reservoir_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.reservoir_sample(_tweets(spark, d), 500, "rec_id").select("rec_id", "source_hashtag", "likes")


def display_time_ist(spark: SparkSession, d: str) -> DataFrame:
    return _tweets(spark, d).where("created_at IS NOT NULL").select("rec_id", features.display_time(F.col("created_at")).alias("shown_at"))


def distinct_target(spark: SparkSession, d: str) -> DataFrame:
    """Rows in order until 2,000 distinct posts are in, as per tag counts."""
    rows = sampling.until_distinct_target(_tweets(spark, d), 2000, "tweet_id", "rec_id")
    return rows.groupBy("source_hashtag").agg(F.count("*").alias("n_rows"), F.count_distinct("tweet_id").alias("distinct_posts"))


def collection_summary(spark: SparkSession, d: str) -> DataFrame:
    return signal.collection_summary(_tweets(spark, d))


def ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = _tweets(spark, d).where("created_at IS NOT NULL AND collected_at IS NOT NULL")
    firsts = rows.groupBy(F.col("tweet_id").alias("i"), F.col("source_hashtag").alias("h")).agg(F.min("rec_id").alias("first"))
    log = rows.join(firsts, (F.col("tweet_id") == F.col("i")) & (F.col("source_hashtag") == F.col("h")))
    log = log.select("source_hashtag", ((F.unix_micros("collected_at") - F.unix_micros("created_at")) / 1e6).alias("lag_seconds"), (F.col("rec_id") > F.col("first")).alias("was_duplicate"))
    return sealed.ingest_metrics(log)


def signal_series(spark: SparkSession, d: str) -> DataFrame:
    return history.signal_series(table(spark, d, "signal_buckets"))


def volume_series(spark: SparkSession, d: str) -> DataFrame:
    return history.volume_series(table(spark, d, "signal_buckets"))


def engagement_sample(spark: SparkSession, d: str) -> DataFrame:
    return history.engagement_sample(_tweets(spark, d), Settings().reservoir_size, "rec_id").withColumn("mean_engagement", F.round("mean_engagement", 6))


def stream_sealed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The tweets as a stream of one file, sealed by its watermark."""
    path, name = scratch(spark, "sealed"), "tm_sealed"
    source = table(spark, d, "tweets")
    ordered = f"{path}/in"
    source.where("created_at IS NOT NULL").write.parquet(ordered)
    stream = spark.readStream.schema(source.schema).parquet(ordered)
    query = sealed.sealed_counts(stream).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}/{name}").option("path", f"{path}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("hashtag string, bucket_start timestamp, tweet_count long, sentiment_coverage double").parquet(f"{path}/out")


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Posts a tag that pass the streaming dedup, the table read as a stream."""
    path, source = scratch(spark, "dedup"), table(spark, d, "tweets")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/tweets.parque[t]")
    week = replace(Settings(), dedup_ttl_seconds=40 * 86_400)
    out = sealed.deduplicated(stream, week).select("source_hashtag", "rec_id")
    out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}/cp").option("path", f"{path}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("source_hashtag string, rec_id long").parquet(f"{path}/out").groupBy("source_hashtag").agg(F.count("*").alias("n"))


def stream_signal(spark: SparkSession, d: str) -> DataFrame:
    """The exact streaming signal: history and batches as two increments, then all due buckets sealed."""
    state = sealed.StreamingSignal(spark, _targets(spark, d), replace(Settings(), bucket_minutes=60, dedup_ttl_seconds=10**8))
    early = datetime(2026, 1, 5, tzinfo=timezone.utc)
    state.ingest(_posts(spark, d), early).ingest(table(spark, d, "tweet_batches"), early)
    return state.seal(datetime(2027, 1, 1, tzinfo=timezone.utc))


_FUNCTIONS = (
    clean_text, lang_hint, validate_rejects, valid_records, lookback_filter, dedup_two_tier, dedup_counts, market_hours, bucket_counts, virality_norm, momentum, sentiment_score, sentiment_coverage, composite_signal, signal_analytic_ci,
    signal_bootstrap_ci, signal_bootstrap_bounds, signal_summary, tfidf_weights, tfidf_top_terms, tfidf_sparsity, hashtag_mention_extract, parse_count, strip_markup, collection_window, stale_run_cutoff, engagement_distribution, reservoir_sample, display_time_ist,
    distinct_target, collection_summary, ingest_metrics, signal_series, volume_series, engagement_sample, stream_sealed_counts, stream_dedup, stream_signal,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS} | {"rollup_1h": _rollup("1 hour"), "rollup_1d": _rollup("1 day")}

# The same in SQL -----------------------------------------------------------------------------------------------------

_WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f"
_W = r"\p{L}\p{N}_"
_collapse = lambda x: f"regexp_replace(regexp_replace({x}, '[{_WS}]+', ' ', 'g'), '^ | $', '', 'g')"
_clean = lambda x: _collapse(f"regexp_replace(nfc_normalize({x}), '(https?://|www\\.)[^{_WS}]+', '', 'g')")
_hint_sql = lambda x: f"CASE WHEN regexp_matches({x}, '[ऀ-ॿ]') AND regexp_matches({x}, '[A-Za-z]') THEN 'mixed' WHEN regexp_matches({x}, '[ऀ-ॿ]') THEN 'hi' ELSE 'en' END"
_ts = lambda x: f"({x} AT TIME ZONE 'UTC')"
_bucket = lambda x, minutes: f"time_bucket(INTERVAL {minutes} MINUTE, {_ts(x)})"


def _classified(hours: bool) -> str:
    text = "CASE WHEN json_type(j, '$.text') = 'VARCHAR' THEN " + _clean("json_extract_string(j, '$.text')") + " END"
    when = lambda f: f"CASE WHEN json_type(j, '$.{f}') = 'VARCHAR' AND regexp_matches(json_extract_string(j, '$.{f}'), '^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}(:\\d{{2}}(\\.\\d{{1,6}})?)?(Z|[+-]\\d{{2}}:?\\d{{2}})?)?$') THEN TRY_CAST(json_extract_string(j, '$.{f}') AS TIMESTAMPTZ) END"
    word = lambda f: f"CASE WHEN json_type(j, '$.{f}') = 'VARCHAR' THEN json_extract_string(j, '$.{f}') END"
    count = lambda f: f"CASE WHEN json_type(j, '$.{f}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR (json_type(j, '$.{f}') = 'VARCHAR' AND regexp_matches(trim(json_extract_string(j, '$.{f}')), '^[+-]?\\d+(\\.0+)?$')) THEN TRY_CAST(trim(json_extract_string(j, '$.{f}')) AS DOUBLE) END"
    bad = lambda f: f"list_position(list_transform(CASE WHEN json_type(j, '$.{f}') = 'ARRAY' THEN CAST(j->'$.{f}' AS JSON[]) END, lambda x: coalesce(json_type(x), 'NULL') <> 'VARCHAR'), true) - 1"
    fields = ", ".join([f"{word(f)} AS {f}" for f in ("tweet_id", "username", "source_hashtag")] + [f"{when(f)} AS {f}" for f in ("created_at", "collected_at")] + [f"{text} AS text"] + [f"{count(f)} AS {f}" for f in records.COUNTS] + [f"{bad(f)} AS bad_{f}, json_type(j, '$.{f}') AS k_{f}" for f in ("mentions", "hashtags")])
    empty = lambda f: f"WHEN {f} IS NULL OR {f} = '' THEN '{f}'"
    faults = " ".join([empty("tweet_id"), empty("username"), "WHEN created_at IS NULL THEN 'created_at'", "WHEN collected_at IS NULL THEN 'collected_at'", empty("text")] + [f"WHEN {f} IS NULL OR {f} <> floor({f}) OR {f} < 0 OR {f} > 2147483647 THEN '{f}'" for f in records.COUNTS] + [f"WHEN k_{f} IS DISTINCT FROM 'ARRAY' THEN '{f}' WHEN bad_{f} >= 0 THEN '{f}_' || bad_{f}" for f in ("mentions", "hashtags")] + [empty("source_hashtag")])
    inside = "coalesce(created_at >= TIMESTAMPTZ '2026-01-06 00:00:00+00', false)" if hours else "true"
    return f"""
WITH lines AS (SELECT *, CASE WHEN json_valid(raw_line) AND json_type(CASE WHEN json_valid(raw_line) THEN raw_line::JSON END) = 'OBJECT' THEN raw_line::JSON END AS j FROM raw_records WHERE raw_line IS NOT NULL AND {_collapse("raw_line")} <> ''),
typed AS (SELECT raw_id, run_file, j, {fields} FROM lines),
judged AS (SELECT *, CASE WHEN j IS NULL THEN 'malformed_json' {faults} END AS fault FROM typed),
classified AS (SELECT *, CASE WHEN j IS NULL THEN 'rejected' WHEN NOT {inside} THEN 'out_of_window' WHEN fault IS NOT NULL THEN 'rejected' ELSE 'valid' END AS outcome FROM judged)
"""


_TAIL = "SELECT source_hashtag, tweet_id, rec_id, row_number() OVER (PARTITION BY tweet_id, source_hashtag ORDER BY rec_id) AS k, sha256(coalesce(text_normalized, '') || chr(31) || coalesce(username, '') || chr(31) || coalesce(source_hashtag, '')) AS h"
_POSTS = f"SELECT * REPLACE (coalesce(text_normalized, lower(text)) AS text_normalized, {_hint_sql('text')} AS lang_hint) FROM tweets"
_DEDUPED = "ranked AS ({tail} FROM {source}), second AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY rec_id) AS k2 FROM ranked WHERE k = 1)"


def _polarity_sql() -> str:
    """(rec_id, bull, bear) of the posts: one row per (post, term found), then sums."""
    lists = [(t, up, dev) for terms, up, dev in ((BULLISH, 1, 0), (BEARISH, 0, 0), (BULLISH_DEVANAGARI, 1, 1), (BEARISH_DEVANAGARI, 0, 1)) for t in terms]
    values = ", ".join(f"('{t.lower()}', {up}, {dev})" for t, up, dev in lists)
    edge = _W + "ऀ-ॿ"
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in NEGATION)
    return f"""
lex(term, up, dev) AS (VALUES {values}),
hits AS (SELECT rec_id, up, regexp_extract(text_normalized, '^((?s:.*?)(?:^|[^{edge}]))' || term || '([^{edge}]|$)', 1) AS prefix
         FROM posts JOIN lex ON contains(text_normalized, term) AND (CASE lang_hint WHEN 'hi' THEN dev = 1 WHEN 'mixed' THEN true ELSE dev = 0 END)
         WHERE regexp_matches(text_normalized, '(^|[^{edge}])' || term || '([^{edge}]|$)')),
turned AS (SELECT rec_id, CASE WHEN list_has_any(list_transform(list_filter(regexp_split_to_array(prefix, '[{_WS}]+'), lambda w: w <> '')[-3:], lambda w: trim(w, '.,!?;:''"')), [{words}]) THEN 1 - up ELSE up END AS up FROM hits),
polarity AS (SELECT p.rec_id, coalesce(sum(up), 0)::INT AS bull, coalesce(sum(1 - up), 0)::INT AS bear FROM posts p LEFT JOIN turned t USING (rec_id) GROUP BY p.rec_id)"""


def _signal_sql(minutes: int, session: bool) -> str:
    local = "created_at AT TIME ZONE 'Asia/Kolkata'"
    hours = f"AND isodow({local}) <= 5 AND (epoch_us({local}) - epoch_us(date_trunc('day', {local}))) BETWEEN 33300000000 AND 55800000000" if session else ""
    z = NormalDist().inv_cdf(0.95)
    return f"""
WITH posts AS (SELECT *, {_bucket("created_at", minutes)} AS bucket_start, ln(1 + coalesce(likes, 0)::BIGINT + 2 * coalesce(retweets, 0)::BIGINT + coalesce(replies, 0)::BIGINT) AS v FROM ({_POSTS}) WHERE created_at IS NOT NULL {hours}),
{_polarity_sql()},
tagged AS (SELECT *, list_intersect(list_distinct(coalesce(hashtags, [])), (SELECT list(hashtag) FROM hashtag_targets)) AS t FROM posts),
mom AS (SELECT source_hashtag, bucket_start, coalesce(avg(len(t) - 1) FILTER (list_contains(t, source_hashtag)), 0.0) AS m FROM tagged GROUP BY ALL),
mnorm AS (SELECT source_hashtag, bucket_start, (m - min(m) OVER ()) / coalesce(nullif(max(m) OVER () - min(m) OVER (), 0), 1) AS mn FROM mom),
scored AS (SELECT p.source_hashtag AS hashtag, p.bucket_start, bull + bear > 0 AS hit,
             0.4 * coalesce((bull - bear) / nullif(bull + bear, 0)::DOUBLE, 0) * (1 + 0.35 * (v - min(v) OVER ()) / coalesce(nullif(max(v) OVER () - min(v) OVER (), 0), 1) + 0.25 * mn) AS c
           FROM posts p JOIN polarity USING (rec_id) JOIN mnorm n ON n.source_hashtag = p.source_hashtag AND n.bucket_start = p.bucket_start),
stats AS (SELECT hashtag, bucket_start, avg(c) AS s, stddev_samp(c) AS sd, count(*) AS n, avg(hit::INT) AS cov FROM scored GROUP BY ALL),
margins AS (SELECT *, {z!r} * (CASE WHEN n >= 2 AND sd >= 1e-12 THEN sd ELSE (SELECT coalesce(stddev_samp(c), 0) FROM scored) END) / sqrt(n) AS m FROM stats)
SELECT bucket_start, hashtag, CASE WHEN n >= 5 THEN round(s, 6) END AS composite_signal, CASE WHEN n >= 5 THEN round(s - m, 6) END AS ci_lower, CASE WHEN n >= 5 THEN round(s + m, 6) END AS ci_upper, n::INT AS tweet_count, round(cov, 6) AS sentiment_coverage FROM margins"""


def _rollup_sql(width: str) -> str:
    mean = lambda c: f"round(sum({c} * tweet_count) / nullif(sum(tweet_count) FILTER ({c} IS NOT NULL), 0), 6) AS {c}"
    return f"SELECT hashtag, time_bucket(INTERVAL {width}, {_ts('bucket_start')}) AS bucket_start, {mean('composite_signal')}, {mean('ci_lower')}, {mean('ci_upper')}, sum(tweet_count)::BIGINT AS tweet_count, {mean('sentiment_coverage')} FROM signal_buckets GROUP BY ALL"


def _tfidf_sql() -> str:
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in tfidf.english_stopwords())
    return f"""
WITH tokens AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[{_W}]{{2,}}'), lambda w: NOT list_contains([{stop}], w)) AS w FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM tokens),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
vocab AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf, sum(tf) AS total FROM counts GROUP BY term HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 5000),
raw AS (SELECT doc_id, term, tf, tf * idf AS w FROM counts JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
"""


def _oracle() -> dict[str, str]:
    tags = lambda mark, low: f"array_to_string(list_sort(list_distinct({'list_transform(' if low else ''}regexp_extract_all(text, '{mark}([{_W}]+)', 1){', lambda t: lower(t))' if low else ''})), ',')"
    local = "created_at AT TIME ZONE 'Asia/Kolkata'"
    lag = "greatest(0, (epoch_us(collected_at) - epoch_us(created_at)) / 1e6)"
    return {
        "clean_text": f"WITH lines AS (SELECT raw_id, CASE WHEN json_valid(raw_line) THEN raw_line::JSON END AS j FROM raw_records) SELECT raw_id, {_clean(chr(116))} AS clean, lower({_clean(chr(116))}) AS normalized FROM (SELECT raw_id, json_extract_string(j, '$.text') AS t FROM lines WHERE json_type(j, '$.text') = 'VARCHAR')",
        "lang_hint": f"SELECT rec_id, {_hint_sql('text')} AS hint FROM tweets",
        "validate_rejects": _classified(False) + "SELECT fault AS reject_bucket, count(*) AS n FROM classified WHERE outcome = 'rejected' GROUP BY ALL",
        "valid_records": _classified(False) + f"SELECT raw_id, tweet_id, username, {_ts('created_at')} AS created_at, {_ts('collected_at')} AS collected_at, text, likes::INT AS likes, retweets::INT AS retweets, replies::INT AS replies, json_array_length(j, '$.mentions')::INT AS n_mentions, array_to_string(CAST(j->'$.hashtags' AS VARCHAR[]), ',') AS hashtags, source_hashtag, {_hint_sql('text')} AS lang_hint FROM classified WHERE outcome = 'valid'",
        "lookback_filter": _classified(True) + "SELECT outcome, count(*) AS n FROM classified GROUP BY ALL",
        "dedup_two_tier": f"WITH posts AS ({_POSTS}), " + _DEDUPED.format(tail=_TAIL, source="posts") + " SELECT rec_id, tweet_id, source_hashtag FROM second WHERE k2 = 1",
        "dedup_counts": _classified(True) + ", v AS (SELECT *, raw_id AS rec_id, lower(text) AS text_normalized FROM classified WHERE outcome = 'valid'), " + _DEDUPED.format(tail=_TAIL, source="v") + ", o AS (SELECT count(*) AS n FROM second WHERE k2 = 1), c AS (SELECT count(*) AS i, count(*) FILTER (outcome = 'rejected') AS r, count(*) FILTER (outcome = 'out_of_window') AS w FROM classified) SELECT i AS records_in, r AS records_rejected, w AS records_out_of_window, n AS records_out, i - n - r - w AS records_deduped FROM c CROSS JOIN o",
        "market_hours": f"SELECT rec_id FROM tweets WHERE isodow({local}) <= 5 AND (epoch_us({local}) - epoch_us(date_trunc('day', {local}))) BETWEEN 33300000000 AND 55800000000",
        "bucket_counts": f"SELECT source_hashtag, {_bucket('created_at', 15)} AS bucket_start, count(*) AS tweet_count FROM tweets WHERE created_at IS NOT NULL GROUP BY ALL",
        "virality_norm": "WITH x AS (SELECT rec_id, ln(1 + coalesce(likes, 0)::BIGINT + 2 * coalesce(retweets, 0)::BIGINT + coalesce(replies, 0)::BIGINT) AS v FROM tweets) SELECT rec_id, round(v, 6) AS virality, round((v - min(v) OVER ()) / coalesce(nullif(max(v) OVER () - min(v) OVER (), 0), 1), 6) AS virality_norm FROM x",
        "momentum": f"WITH x AS (SELECT source_hashtag, {_bucket('created_at', 60)} AS bucket_start, list_intersect(list_distinct(coalesce(hashtags, [])), (SELECT list(hashtag) FROM hashtag_targets)) AS t FROM tweets WHERE created_at IS NOT NULL), m AS (SELECT source_hashtag, bucket_start, coalesce(avg(len(t) - 1) FILTER (list_contains(t, source_hashtag)), 0.0) AS m FROM x GROUP BY ALL) SELECT source_hashtag, bucket_start, round(m, 6) AS momentum_raw, round((m - min(m) OVER ()) / coalesce(nullif(max(m) OVER () - min(m) OVER (), 0), 1), 6) AS momentum_norm FROM m",
        "sentiment_score": f"WITH posts AS ({_POSTS}), {_polarity_sql()} SELECT rec_id, bull, bear, round(coalesce((bull - bear) / nullif(bull + bear, 0)::DOUBLE, 0), 6) AS sentiment FROM polarity",
        "sentiment_coverage": f"WITH posts AS ({_POSTS}), {_polarity_sql()} SELECT source_hashtag, round(avg((bull + bear > 0)::INT), 6) AS coverage FROM polarity JOIN posts USING (rec_id) GROUP BY ALL",
        "composite_signal": _signal_sql(60, False),
        "signal_analytic_ci": _signal_sql(15, True),
        "signal_bootstrap_bounds": f"SELECT hashtag, bucket_start, composite_signal, tweet_count, CASE WHEN tweet_count >= 5 THEN true END AS centred, CASE WHEN tweet_count >= 5 THEN true END AS wide_enough FROM ({_signal_sql(60, False)})",
        "signal_summary": "SELECT count(*) AS buckets, count(composite_signal) AS scored, count(*) - count(composite_signal) AS suppressed, count(DISTINCT hashtag) AS hashtags FROM signal_buckets",
        "stream_dedup": "SELECT source_hashtag, count(DISTINCT coalesce(text_normalized, text) || chr(31) || username) AS n FROM tweets WHERE created_at IS NOT NULL GROUP BY ALL",
        "rollup_1h": _rollup_sql("1 HOUR"),
        "rollup_1d": _rollup_sql("1 DAY"),
        "tfidf_weights": _tfidf_sql() + "SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights",
        "tfidf_top_terms": _tfidf_sql() + "SELECT term, round(sum(weight), 4) AS total_weight FROM weights GROUP BY term ORDER BY sum(weight) DESC, term LIMIT 10",
        "tfidf_sparsity": _tfidf_sql() + "SELECT count(DISTINCT term) AS n_terms, count(*) AS n_nonzero, round(1 - count(*) / ((SELECT count(*) FROM documents) * count(DISTINCT term))::DOUBLE, 6) AS sparsity FROM weights",
        "hashtag_mention_extract": f"SELECT rec_id, {tags('#', True)} AS hashtags, {tags('@', False)} AS mentions FROM tweets",
        "parse_count": "SELECT rec_id, CASE WHEN rec_id % 3 <> 0 AND likes * 37 >= 1000 THEN (likes * 37 // 100) * 100 ELSE likes * 37 END::BIGINT AS n FROM tweets WHERE likes IS NOT NULL",
        "strip_markup": f"SELECT doc_id, {_collapse('regexp_replace(text, ' + chr(39) + '<[^>]+>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS plain FROM documents",
        "collection_window": "SELECT rec_id FROM tweets WHERE created_at BETWEEN TIMESTAMPTZ '2026-01-07 00:00:00+00' - INTERVAL 30240 SECOND - INTERVAL 22500 SECOND AND TIMESTAMPTZ '2026-01-07 00:00:00+00' - INTERVAL 30240 SECOND + INTERVAL 5 MINUTE",
        "stale_run_cutoff": _classified(False) + ", r AS (SELECT raw_id, run_file, created_at < TIMESTAMPTZ '2026-01-05 12:00:00+00' AS stale FROM classified WHERE created_at IS NOT NULL), i AS (SELECT *, sum(CASE WHEN stale THEN 0 ELSE 1 END) OVER (PARTITION BY run_file ORDER BY raw_id) AS g FROM r), k AS (SELECT *, sum(stale::INT) OVER (PARTITION BY run_file, g ORDER BY raw_id) AS n FROM i), s AS (SELECT run_file, min(raw_id) AS stop FROM k WHERE n >= 5 GROUP BY ALL) SELECT raw_id, run_file FROM k LEFT JOIN s USING (run_file) WHERE NOT stale AND (stop IS NULL OR raw_id < stop)",
        "engagement_distribution": "SELECT source_hashtag, count(*) AS sample_count, round(avg(coalesce(likes, 0)::BIGINT + coalesce(retweets, 0) + coalesce(replies, 0)), 6) AS mean_engagement FROM tweets GROUP BY ALL",
        "display_time_ist": f"SELECT rec_id, {local} AS shown_at FROM tweets WHERE created_at IS NOT NULL",
        "signal_series": "SELECT hashtag, bucket_start AT TIME ZONE 'Asia/Kolkata' AS shown_at, composite_signal, ci_lower, ci_upper FROM signal_buckets WHERE composite_signal IS NOT NULL",
        "volume_series": "SELECT hashtag, bucket_start AT TIME ZONE 'Asia/Kolkata' AS shown_at, sum(tweet_count)::BIGINT AS tweet_count FROM signal_buckets GROUP BY ALL",
        "distinct_target": "WITH f AS (SELECT tweet_id, min(rec_id) AS first_rec FROM tweets GROUP BY ALL ORDER BY first_rec LIMIT 2000) SELECT source_hashtag, count(*) AS n_rows, count(DISTINCT tweet_id) AS distinct_posts FROM tweets WHERE rec_id <= (SELECT max(first_rec) FROM f) GROUP BY ALL",
        "collection_summary": f"SELECT source_hashtag, count(*) AS n_rows, count(DISTINCT tweet_id) AS distinct_posts, min({_ts('created_at')}) AS first_at, max({_ts('created_at')}) AS last_at FROM tweets GROUP BY ALL",
        "ingest_metrics": f"WITH l AS (SELECT source_hashtag, round({lag} * 1000)::BIGINT AS ms, rec_id > min(rec_id) OVER (PARTITION BY tweet_id, source_hashtag) AS dup FROM tweets WHERE created_at IS NOT NULL AND collected_at IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY source_hashtag ORDER BY ms) - 1 AS k, count(*) OVER (PARTITION BY source_hashtag) - 1 AS last FROM l) SELECT source_hashtag, count(*) AS samples, round((max(ms) FILTER (k = last // 2) + max(ms) FILTER (k = (last + 1) // 2)) / 2000, 3) AS lag_p50, round(max(ms) FILTER (k = round_even(last * 0.95, 0)) / 1000, 3) AS lag_p95, round(avg(dup::INT), 3) AS dedup_hit_rate FROM r GROUP BY ALL",
    }


ORACLE = _oracle()
