"""The composite signal per tag and bucket, its interval, suppression and coarser windows."""

from __future__ import annotations

import hashlib
from datetime import datetime
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings, Weights
from . import features

#: A deviation below this is none: floating-point noise of equal values must not stand for spread.
TINY = 1e-12
COLUMNS = ["bucket_start", "hashtag", "composite_signal", "ci_lower", "ci_upper", "tweet_count", "sentiment_coverage"]


def contribution(weights: Weights) -> Column:
    return F.lit(weights.sentiment) * F.col("sentiment") * (1.0 + F.lit(weights.virality) * F.col("virality_norm") + F.lit(weights.momentum) * F.col("momentum_norm"))


def scored_posts(df: DataFrame, settings: Settings, targets: list[str]) -> DataFrame:
    """Posts with their bucket, features and contribution."""
    rows = df.where(F.col("created_at").isNotNull())
    if settings.filter_market_hours:
        rows = rows.where(features.market_hours(F.col("created_at")))
    rows = features.feature_frame(rows, settings.lexicon).withColumn("bucket_start", features.bucket_start(F.col("created_at"), settings.bucket_minutes))
    groups = features.momentum_norm(features.momentum(rows, targets))
    return rows.join(groups, ["source_hashtag", "bucket_start"], "left").withColumn("contribution", contribution(settings.weights))


def bucket_stats(posts: DataFrame) -> DataFrame:
    c = F.col("contribution")
    return posts.groupBy(F.col("source_hashtag").alias("hashtag"), "bucket_start").agg(
        F.avg(c).alias("composite_signal"), F.stddev_samp(c).alias("tm_std"), F.count("*").cast("int").alias("tweet_count"), F.avg(F.col("sentiment_matched").cast("int")).alias("sentiment_coverage")
    )


def with_overall_std(stats: DataFrame) -> DataFrame:
    """``bucket_stats`` with the sample deviation of all posts in ``tm_all``, put together from the buckets' own moments: the posts aren't read again."""
    n, mean = F.col("tweet_count").cast("double"), F.col("composite_signal")
    sums = stats.agg(F.sum(n).alias("n"), F.sum(n * mean).alias("s"), F.sum((n - 1) * F.coalesce(F.col("tm_std"), F.lit(0.0)) ** 2).alias("inside"), F.sum(n * mean * mean).alias("q"))
    # Between the buckets: sum of n * mean^2 less the overall mean's share.
    square = F.greatest(F.lit(0.0), F.col("inside") + F.col("q") - F.try_divide(F.col("s") * F.col("s"), F.col("n")))
    one = sums.select(F.coalesce(F.when(F.col("n") > 1, F.sqrt(square / (F.col("n") - 1))), F.lit(0.0)).alias("tm_all"), F.lit(1).alias("tm_one"))
    return stats.withColumn("tm_one", F.lit(1)).join(F.broadcast(one), "tm_one").drop("tm_one")


def mean_contribution(posts: DataFrame) -> DataFrame:
    """One row: the mean contribution of all posts, 0 without any."""
    return posts.agg(F.coalesce(F.avg("contribution"), F.lit(0.0)).alias("composite_signal"))


def suppress(df: DataFrame, least: int) -> DataFrame:
    """Signal and interval null where a bucket has fewer than ``least`` posts; count and coverage stay."""
    enough = F.col("tweet_count") >= least
    return df.withColumns({c: F.when(enough, F.col(c)) for c in ("composite_signal", "ci_lower", "ci_upper")})


def analytic_signals(df: DataFrame, settings: Settings, targets: list[str]) -> DataFrame:
    """Signals with the normal interval, ordered by tag and time: all aggregation is partial before its shuffle."""
    posts = scored_posts(df, settings, targets)
    z = NormalDist().inv_cdf(1 - (1 - settings.confidence_level) / 2)
    stats = with_overall_std(bucket_stats(posts))
    half = F.lit(z) * _spread() / F.sqrt("tweet_count")
    rows = stats.withColumns({"ci_lower": F.col("composite_signal") - half, "ci_upper": F.col("composite_signal") + half})
    return suppress(rows, settings.min_bucket_tweets).select(COLUMNS).orderBy("hashtag", "bucket_start")


def bucket_seed(seed: int, hashtag: str, start: str) -> int:
    return int(hashlib.sha256(f"{seed}:{hashtag}:{start}".encode()).hexdigest()[:8], 16)


def resampled_sums(values: np.ndarray, counts: np.ndarray, draws: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """For each entry of ``draws`` the sum of so many values drawn with replacement, where ``values[i]`` is there ``counts[i]`` times: a multinomial draw over the distinct values."""
    block = max(1, 4_000_000 // len(values))
    share = counts / counts.sum()
    return np.concatenate([rng.multinomial(draws[i : i + block], share) @ values for i in range(0, len(draws), block)])


def margin(mean: float, n: int, std: float, means: np.ndarray | None, level: float) -> float:
    """Half the width of the symmetric interval: the normal one's, or that of the percentile bootstrap where it is wider."""
    tail = (1 - level) / 2
    normal = NormalDist().inv_cdf(1 - tail) * std / n**0.5
    if means is None:
        return normal
    low, high = np.quantile(means, [tail, 1 - tail])
    return float(max(normal, mean - low, high - mean))


def bootstrap_interval(values: np.ndarray, fallback_std: float, resamples: int, level: float, seed: int) -> tuple[float, float]:
    """The interval around the mean of ``values``. Without values it is (0, 0); one value, or equal ones, take ``fallback_std``."""
    n = len(values)
    if not n:
        return 0.0, 0.0
    distinct, counts = np.unique(values, return_counts=True)
    mean, own = float(values.mean()), float(values.std(ddof=1)) if n > 1 else 0.0
    means = resampled_sums(distinct, counts, np.full(resamples, n), np.random.default_rng(seed)) / n if n > 1 else None
    half = margin(mean, n, own if own >= TINY else fallback_std, means, level)
    return mean - half, mean + half


#: Most distinct values of a bucket that one task resamples.
PART_VALUES = 50_000


def bootstrap_signals(df: DataFrame, settings: Settings, targets: list[str], part_values: int = PART_VALUES) -> DataFrame:
    """Signals with the bootstrap interval, ordered by tag and time.

    Equal contributions of a bucket are counted before the shuffle. A bucket with many distinct ones is split by their
    hash: how many of each resample's draws fall into which part is one multinomial draw that all parts repeat from the
    bucket's seed, so the parts' sums add up to resamples of the whole bucket. Values are sorted, so results repeat.
    """
    posts = scored_posts(df, settings, targets)
    stats = with_overall_std(bucket_stats(posts)).withColumn("tm_label", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss'+00:00'"))
    by = ["hashtag", "bucket_start"]
    valued = posts.groupBy(F.col("source_hashtag").alias("hashtag"), "bucket_start", "contribution").agg(F.count("*").alias("n"))
    sizes = valued.groupBy(*by).agg(F.count("*").alias("distinct"))
    parted = valued.join(sizes, by).withColumn("part", F.expr(f"pmod(xxhash64(contribution), greatest(1L, distinct div {part_values}))"))
    layout = parted.groupBy(*by, "part").agg(F.sum("n").alias("n")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("layout"))
    resamples, level, base = settings.n_resamples, settings.confidence_level, settings.random_seed

    def draw(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("contribution")
        layout = g["layout"].iloc[0]
        size = np.array([x["n"] for x in layout], np.int64)
        at = [x["part"] for x in layout].index(key[2])
        seed = bucket_seed(base, key[0], g["tm_label"].iloc[0])
        draws = np.random.default_rng(seed).multinomial(np.full(resamples, size.sum()), size / size.sum())[:, at]
        sums = resampled_sums(g["contribution"].to_numpy(float), g["n"].to_numpy(np.int64), draws, np.random.default_rng([seed, at]))
        return pd.DataFrame({"hashtag": [key[0]], "bucket_start": [key[1]], "sums": [sums]})

    drawn = parted.join(layout, by).join(stats.where("tweet_count > 1").select(*by, "tm_label"), by).groupBy(*by, "part").applyInPandas(draw, "hashtag string, bucket_start timestamp, sums array<double>")
    # The parts' sums per resample; a bucket in one part, as nearly all are, has a list of one.
    whole = drawn.groupBy(*by).agg(F.collect_list("sums").alias("sums"))

    @F.pandas_udf("double")
    def half(mean: pd.Series, n: pd.Series, std: pd.Series, sums: pd.Series) -> pd.Series:
        return pd.Series([margin(m, k, s, None if x is None else sum(np.asarray(y, float) for y in x) / k, level) for m, k, s, x in zip(mean, n, std, sums)])

    rows = stats.join(whole, by, "left").withColumn("tm_half", half("composite_signal", "tweet_count", _spread(), "sums"))
    rows = rows.withColumns({"ci_lower": F.col("composite_signal") - F.col("tm_half"), "ci_upper": F.col("composite_signal") + F.col("tm_half")})
    return suppress(rows, settings.min_bucket_tweets).select(COLUMNS).orderBy("hashtag", "bucket_start")


def _spread() -> Column:
    """A bucket's own deviation, or that of all posts where it has none."""
    return F.when((F.col("tweet_count") >= 2) & (F.col("tm_std") >= TINY), F.col("tm_std")).otherwise(F.col("tm_all"))


def rollup(signals: DataFrame, window: str) -> DataFrame:
    """Signals over coarser windows, weighted by posts; suppressed buckets count in tweet_count alone."""
    at, n = F.window("bucket_start", window)["start"].alias("bucket_start"), F.col("tweet_count")

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(F.col(c) * n), F.sum(F.when(F.col(c).isNotNull(), n))).alias(c)

    return signals.groupBy("hashtag", at).agg(mean("composite_signal"), mean("ci_lower"), mean("ci_upper"), F.sum(n).cast("long").alias("tweet_count"), mean("sentiment_coverage")).orderBy("hashtag", "bucket_start")


def signal_summary(signals: DataFrame) -> DataFrame:
    scored = F.col("composite_signal").isNotNull()
    return signals.agg(F.count("*").alias("buckets"), F.count_if(scored).alias("scored"), F.count_if(~scored).alias("suppressed"), F.count_distinct("hashtag").alias("hashtags"))


def phase_checks(scraped: dict, processed: dict, signals: dict) -> dict[str, list[str]]:
    """What is wrong with each phase's summary; empty lists where all is well."""
    out: dict[str, list[str]] = {"scraper": [], "processing": [], "signals": []}
    if scraped.get("distinct", 0) < scraped.get("target", 0):
        out["scraper"].append("fewer distinct posts than the target")
    out["scraper"] += [f"nothing for {t}" for t, n in scraped.get("attempted", {}).items() if not n]
    parts = sum(processed.get(k, 0) for k in ("records_out", "records_rejected", "records_deduped", "records_out_of_window"))
    if processed.get("records_in", 0) != parts:
        out["processing"].append("the counts don't add up")
    if not processed.get("records_out", 0):
        out["processing"].append("nothing came out")
    if not signals.get("buckets", 0):
        out["signals"].append("no buckets")
    if not signals.get("hashtags", 0):
        out["signals"].append("no tags")
    return out


def collection_summary(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Per tag: rows, distinct posts, first and last time."""
    return df.groupBy("source_hashtag").agg(F.count("*").alias("n_rows"), F.count_distinct("tweet_id").alias("distinct_posts"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))
