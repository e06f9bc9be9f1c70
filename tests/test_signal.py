import math
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings, distinct_tags, load_settings
from tidemark.functions import sentiment
from tidemark.operators import features, sampling, signal, tfidf

IN_SESSION = datetime(2026, 8, 4, 6, tzinfo=timezone.utc)
POST = "tweet_id string, source_hashtag string, created_at timestamp, text_normalized string, lang_hint string, likes int, retweets int, replies int, hashtags array<string>, username string, text string"


def posts(spark, n, text="buy the rally", at=IN_SESSION, tag="nifty", start=0, tags=("nifty",)):
    rows = [(str(start + i), tag, at + timedelta(seconds=i), f"{text}", "en", i, 0, 0, list(tags), f"u{i}", f"{text} {i}") for i in range(n)]
    return spark.createDataFrame(rows, POST)


CASES = [
    ("a breakout today", "en", 1), ("a crash today", "en", -1), ("nothing here", "en", 0), ("breakoutish", "en", 0), ("not a buy", "en", -1), ("don't sell", "en", 1), ("😀 never ever buy", "en", -1), ("no one two three buy", "en", 1), ("बाज़ार में तेजी है", "hi", 1), ("मंदीरा", "hi", 0), ("मंदी", "en", 0),
    ("buy मंदी", "mixed", 0), ("never buy, buy", "en", -1), (None, "en", 0), ("", None, 0), ("buy karo", "en", 1), ("rebuy buy_ buy", "en", 1), ("not.buy", "en", -1), ("not, buy", "en", -1), ("(never) buy", "en", 1), ("avoid\u00a0this\u3000buy", "en", -1), ("short covering rally, no crash", None, 1),
]


def test_sentiment_in_both_forms(spark):
    df = spark.createDataFrame([(i, t, g, "c") for i, (t, g, _) in enumerate(CASES)], "i int, t string, l string, text string")
    both = sentiment.with_polarity(df, "p", Settings().lexicon, F.col("t"), F.col("l")).withColumn("q", sentiment.polarity(Settings().lexicon, F.col("t"), F.col("l")))
    got = both.select("i", sentiment.score(F.col("p")).alias("p"), sentiment.score(F.col("q")).alias("q"), F.expr("p = q").alias("same")).orderBy("i").collect()
    assert [(r["p"], r["q"], r["same"]) for r in got] == [(w, w, True) for *_, w in CASES]
    none = sentiment.with_polarity(df, "p", replace(Settings().lexicon, bullish=(), bearish=(), bullish_devanagari=(), bearish_devanagari=()), F.col("t"), F.col("l"))
    assert none.where("p.bull + p.bear > 0").count() == 0 and none.where("p.bull = 0").count() == len(CASES)


def test_market_hours(spark):
    cases = [("2026-08-04 06:00:00", True), ("2026-08-04 03:00:00", False), ("2026-08-04 10:30:00", False), ("2026-08-08 06:00:00", False), ("2026-08-04 03:45:00", True), ("2026-08-04 10:00:00", True), ("2026-08-04 10:00:00.000001", False)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string").select(features.market_hours(F.col("t").cast("timestamp")))
    assert [r[0] for r in df.collect()] == [b for _, b in cases]


def test_buckets_agree_where_they_divide_the_hour(spark):
    df = spark.createDataFrame([("2026-08-04 06:37:12",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    for m in (5, 15, 30, 60):
        a, b = df.select(features.bucket_start(F.col("t"), m), features.bucket_in_hour(F.col("t"), m)).first()
        assert a == b


def test_virality_and_scaling(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (0, 0, 2), (2_000_000_000, 2_000_000_000, None)], "a int, b int, c int")
    v = [r[0] for r in df.select(features.virality(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert v[0] == 0 and v[1] == v[2] == pytest.approx(math.log(3)) and v[3] == pytest.approx(math.log1p(6e9))
    assert spark.range(1).select(features.min_max(F.lit(5.0), F.lit(5.0), F.lit(5.0))).first()[0] == 0


def test_signal_end_to_end(spark):
    s = Settings()
    (r,) = signal.bootstrap_signals(posts(spark, 20), s, ["nifty"]).collect()
    (a,) = signal.analytic_signals(posts(spark, 20), s, ["nifty"]).collect()
    assert r["tweet_count"] == 20 and r["ci_lower"] <= r["composite_signal"] <= r["ci_upper"] and r["sentiment_coverage"] == 1
    assert a["composite_signal"] == pytest.approx(r["composite_signal"])
    off = posts(spark, 20, at=datetime(2026, 8, 4, 20, tzinfo=timezone.utc))
    assert signal.analytic_signals(off, s, ["nifty"]).count() == 0
    assert signal.analytic_signals(off, replace(s, filter_market_hours=False), ["nifty"]).count() == 1
    assert signal.analytic_signals(off.limit(0), s, ["nifty"]).columns == signal.COLUMNS


def test_suppression_keeps_counts(spark):
    (r,) = signal.analytic_signals(posts(spark, 3), Settings(), ["nifty"]).collect()
    assert r["composite_signal"] is None and r["ci_lower"] is None and r["tweet_count"] == 3 and r["sentiment_coverage"] == 1


def test_contribution_is_multiplicative(spark):
    df = spark.createDataFrame([(0.5, 1.0, 1.0), (0.0, 1.0, 1.0), (-0.5, 1.0, 1.0)], "sentiment double, virality_norm double, momentum_norm double")
    c = [r[0] for r in df.select(signal.contribution(Settings().weights)).collect()]
    assert c[0] == pytest.approx(0.4 * 0.5 * 1.6) and c[1] == 0 and c[2] == -c[0]


def test_momentum(spark):
    rows = [("a", ["a", "b", "c", "x"]), ("a", ["a"]), ("a", ["b"]), ("d", ["b"]), ("d", None)]
    df = spark.createDataFrame([(h, t, 0) for h, t in rows], "source_hashtag string, hashtags array<string>, bucket_start int")
    got = {r["source_hashtag"]: r["momentum_raw"] for r in features.momentum(df, ["a", "b", "c", "d"]).collect()}
    assert got == {"a": 1.0, "d": 0.0}


@pytest.mark.parametrize("values", [[0.0] * 2, [0.0] * 5, [0.0] * 13, [0.4] * 7, [0.4] * 8, [0.1] * 7])
def test_interval_of_equal_values_has_width(values):
    lo, hi = signal.bootstrap_interval(np.array(values), 0.3, 500, 0.9, 42)
    assert hi - lo > 0.05 and lo <= values[0] <= hi


def test_interval_properties():
    x = np.random.default_rng(0).normal(size=400)
    wide, narrow = signal.bootstrap_interval(x[:8], 1.0, 500, 0.9, 1), signal.bootstrap_interval(x, 1.0, 500, 0.9, 1)
    assert wide[1] - wide[0] > narrow[1] - narrow[0]
    assert signal.bootstrap_interval(x, 1.0, 500, 0.9, 1) == narrow
    assert signal.bootstrap_interval(x[:0], 1.0, 500, 0.9, 1) == (0.0, 0.0)


def test_rollup_weights_and_nulls(spark):
    rows = [("a", datetime(2026, 8, 4, 6), 1.0, 1.0, 1.0, 90, 1.0), ("a", datetime(2026, 8, 4, 6, 15), 0.0, 0.0, 0.0, 10, 0.0), ("a", datetime(2026, 8, 4, 6, 30), None, None, None, 4, 0.5), ("b", datetime(2026, 8, 4, 6), None, None, None, 2, 0.0)]
    df = spark.createDataFrame(rows, "hashtag string, bucket_start timestamp, composite_signal double, ci_lower double, ci_upper double, tweet_count int, sentiment_coverage double")
    got = {r["hashtag"]: r for r in signal.rollup(df, "1 hour").collect()}
    assert got["a"]["composite_signal"] == pytest.approx(0.9) and got["a"]["tweet_count"] == 104
    assert got["b"]["composite_signal"] is None and got["b"]["tweet_count"] == 2


def test_tfidf(spark):
    docs = [(1, "alpha beta the alpha"), (2, "alpha gamma"), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "i int, t string")
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.tfidf(df, "i", "t", ["the"], min_df=1).collect()}
    assert set(k for k in got if k[0] == 1) == {(1, "alpha"), (1, "beta"), (1, "alpha beta"), (1, "beta alpha")}
    assert sum(v * v for k, v in got.items() if k[0] == 1) == pytest.approx(1)
    assert tfidf.tfidf(df, "i", "t", [], min_df=9).count() == 0
    assert tfidf.tfidf(df.limit(0), "i", "t", []).count() == 0


def test_reservoir_and_targets(spark):
    df = spark.range(20_000).withColumn("tag", F.col("id") % 7)
    one, two = (sampling.reservoir_sample(df, 500, "id").collect() for _ in range(2))
    assert len(one) == 500 and one == two and 8_000 < np.mean([r["id"] for r in one]) < 12_000
    rows = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "d")], "o long, i string")
    assert [r["o"] for r in sampling.until_distinct_target(rows, 3, "i", "o").orderBy("o").collect()] == [0, 1, 2, 3]


def test_stale_runs(spark):
    flags = [0, 1, 0, 1, 1, 1, 1, 1, 0, 0]
    rows = [("p", i, bool(s)) for i, s in enumerate(flags)] + [("q", i, i < 4) for i in range(6)]
    df = spark.createDataFrame(rows, "page string, o long, stale boolean")
    got = {(r["page"], r["o"]) for r in sampling.stale_run_cutoff(df, ["page"], "o", "stale").collect()}
    assert got == {("p", 0), ("p", 2), ("q", 4), ("q", 5)}


def test_phase_checks():
    good = signal.phase_checks({"distinct": 5, "target": 5, "attempted": {"a": 5}}, {"records_in": 3, "records_out": 1, "records_rejected": 1, "records_deduped": 1, "records_out_of_window": 0}, {"buckets": 2, "hashtags": 1})
    assert not any(good.values())
    assert all(signal.phase_checks({"distinct": 1, "target": 5, "attempted": {"a": 0}}, {"records_in": 3}, {}).values())


def test_settings(tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text("bucket_minutes: 30\nweights: {sentiment: 0.5}\n")
    s = load_settings(str(p))
    assert s.bucket_minutes == 30 and s.weights.sentiment == 0.5 and s.min_bucket_tweets == 5
    p2 = tmp_path / "bad.yaml"
    p2.write_text("nope: 1\n")
    with pytest.raises(ValueError):
        load_settings(str(p2))
    assert distinct_tags(["a", "b"], ["b", "c"]) == ["a", "b", "c"]


def test_bootstrap_of_a_split_bucket(spark):
    """Many parts give an interval like that of one part, the same each time."""
    df = posts(spark, 40, "buy the rally").unionByName(posts(spark, 40, "a crash", start=100)).unionByName(posts(spark, 3, "quiet", start=300, tag="sensex", tags=("sensex",)))
    got = [{r["hashtag"]: r for r in signal.bootstrap_signals(df, Settings(), ["nifty", "sensex"], part_values=k).collect()} for k in (50_000, 4, 4)]
    widths = [g["nifty"]["ci_upper"] - g["nifty"]["ci_lower"] for g in got]
    assert widths[1] == widths[2] and widths[1] == pytest.approx(widths[0], rel=0.25) and widths[0] > 0
    assert all(g["nifty"]["ci_lower"] < g["nifty"]["composite_signal"] < g["nifty"]["ci_upper"] and g["sensex"]["ci_lower"] is None for g in got)


def test_overall_deviation_from_bucket_moments(spark):
    rows = signal.scored_posts(posts(spark, 9, "buy", tag="a", tags=()).unionByName(posts(spark, 5, "crash", tag="b", start=50, tags=())), Settings(), ["a"])
    want = rows.agg(F.stddev_samp("contribution")).first()[0]
    assert {round(r["tm_all"], 12) for r in signal.with_overall_std(signal.bucket_stats(rows)).collect()} == {round(want, 12)}
    assert signal.mean_contribution(rows).first()[0] == pytest.approx(rows.agg(F.avg("contribution")).first()[0]) and signal.mean_contribution(rows.limit(0)).first()[0] == 0
