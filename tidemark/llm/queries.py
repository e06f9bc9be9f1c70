"""The queries of problems 1-3 and 5-10 over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import charform, chunks, cooccur, fragments, language, leaks, lookalike, packing, pii, topics


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalike.lookalike_pairs(table(spark, d, "tweets").select("tweet_id", "text"), "tweet_id")
    return pairs.select(F.col("a").alias("tweet_id_a"), F.col("b").alias("tweet_id_b"))


def p1_canonical(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.canonical_forms(table(spark, d, "tweets").select("rec_id", "text")).select("rec_id", "canonical_text")


def _baskets(df: DataFrame) -> DataFrame:
    return cooccur.baskets(df, "tweet_id", F.col("hashtags"), F.array("source_hashtag"))


def _with_delta(state: cooccur.PairTable, first: DataFrame, new: DataFrame) -> cooccur.PairTable:
    """``state`` of the rows ``first`` after the rows ``new``: the baskets that occur in them change."""
    columns = ("tweet_id", "hashtags", "source_hashtag")
    merged = first.select(*columns).join(new.select("tweet_id").distinct(), "tweet_id", "left_semi").unionByName(new.select(*columns))
    return state.apply(_baskets(merged))


def _pair_table(spark: SparkSession, d: str) -> cooccur.PairTable:
    """The posts in two steps, as they came: the first half is loaded, the second changes it by signed deltas."""
    posts = table(spark, d, "tweets")
    middle = posts.agg(((F.min("rec_id") + F.max("rec_id")) / 2).cast("long")).first()[0] or 0
    first, new = posts.where(F.col("rec_id") <= middle), posts.where(F.coalesce(F.col("rec_id") > middle, F.lit(True)))
    return _with_delta(cooccur.PairTable(spark).apply(_baskets(first)), first, new)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _pair_table(spark, d).associated().select("tag_a", "tag_b")


def p2_scores(spark: SparkSession, d: str) -> DataFrame:
    """All pairs with their counts and lift."""
    return _pair_table(spark, d).scores().select("tag_a", "tag_b", "n", "n_a", "n_b", "n_baskets", F.round("lift", 6).alias("lift"))


def p2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same after the batches came as a further delta."""
    found = _with_delta(_pair_table(spark, d), table(spark, d, "tweets"), table(spark, d, "tweet_batches")).scores()
    return found.select("tag_a", "tag_b", "n", "n_a", "n_b", "n_baskets", F.round("lift", 6).alias("lift"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    finder = pii.Finder(pii.known_names(table(spark, d, "name_parts")))
    return finder.values(table(spark, d, "tweets"), "tweet_id", "text").select(F.col("id").alias("tweet_id"), "pii_type", "pii_text")


def p3_masked(spark: SparkSession, d: str) -> DataFrame:
    finder = pii.Finder(pii.known_names(table(spark, d, "name_parts")))
    return finder.masked(table(spark, d, "tweets").select("rec_id", "text"), "text")


def _language_model(spark: SparkSession, d: str) -> language.LanguageModel:
    """Trained on the samples, with the shares of the languages among the posts' own hints."""
    return language.fit_samples(table(spark, d, "lang_samples")).with_shares(language.label_counts(table(spark, d, "tweets"), F.col("lang_hint")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    hint = language.hint_form(F.col("lang_hint")).alias("hint")
    posts = table(spark, d, "tweets").select("rec_id", "text", hint)
    found = language.identify(posts, "rec_id", "text", _language_model(spark, d), "hint").where("lang IS NOT NULL")
    return found.where(f"hint IS NULL OR (hint <> lang AND confidence >= {language.SURE})").select(F.col("id").alias("rec_id"), "lang")


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(table(spark, d, "tweets"), "rec_id", "text", _language_model(spark, d)).withColumnRenamed("id", "rec_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = fragments.similar_ids(table(spark, d, "tweets"), "tweet_id")
    return pairs.select(F.col("a").alias("tweet_id_a"), F.col("b").alias("tweet_id_b"))


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """Each post with the class of its text and the number of other texts like it: the links without expanding copies."""
    return fragments.links(table(spark, d, "tweets"), "tweet_id").withColumnRenamed("id", "tweet_id")


def _post_text() -> Column:
    return F.coalesce("text_normalized", F.lower("text"))


#: Batches that are given to the chunk table in one call; rows of a call are ordered by ``rec_id``.
TOGETHER = 6


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The batches in order, some in a call, each call held against the table that the history and the calls before it made."""
    columns = ("tweet_id", "source_hashtag", "post_text", "rec_id")
    known = chunks.ChunkTable.begin(table(spark, d, "tweets").withColumn("post_text", _post_text()), *columns)
    batches = table(spark, d, "tweet_batches").withColumn("post_text", _post_text())
    last = batches.agg(F.max("batch_no")).first()[0] or 1
    call = F.coalesce(F.greatest(F.lit(1), F.col("batch_no")), F.lit(last))
    found = [known.check(batches.where(call.between(n, n + TOGETHER - 1)), *columns) for n in range(1, last + 1, TOGETHER)]
    return reduce(DataFrame.unionByName, found).select(F.col("seq").alias("rec_id"), "dup_kind")


def _capacities(spark: SparkSession, d: str) -> list[tuple[int, int]]:
    return [tuple(r) for r in table(spark, d, "pack_sizes").select("pack_id", F.col("capacity_tokens").cast("long")).orderBy("pack_id").collect()]


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    found = packing.pack_texts(table(spark, d, "documents"), "doc_id", "text", _capacities(spark, d))
    return found.withColumnRenamed("id", "doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: containers, tokens and the share of space used."""
    used = p8_containers(spark, d).groupBy("pack_id").agg(F.count_distinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"))
    return used.join(F.broadcast(table(spark, d, "pack_sizes").select("pack_id", "capacity_tokens")), "pack_id").withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    return leaks.without_passages(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    model, numbered = topics.fit(table(spark, d, "documents"), table(spark, d, "doc_labels"), areas=table(spark, d, "subject_areas"))
    return topics.assign(model, numbered).select(F.col("id").alias("doc_id"), "subject").distinct()


def p10_topics(spark: SparkSession, d: str) -> DataFrame:
    """Every topic with its subject and top terms, for inspection."""
    model, _ = topics.fit(table(spark, d, "documents"), table(spark, d, "doc_labels"), areas=table(spark, d, "subject_areas"))
    return spark.createDataFrame(model.report())


QUERIES = {f.__name__: f for f in (p1_found, p1_canonical, p2_found, p2_scores, p2_incremental, p3_found, p3_masked, p5_found, p5_segments, p6_found, p6_links, p7_found, p8_containers, p8_fill, p9_found, p9_clean, p10_found, p10_topics)}

_WIDE, _NORMAL = charform.WIDTH_FROM, charform.WIDTH_TO.replace("'", "''")


def _pair_sql(source: str) -> str:
    return f"""
WITH rows AS ({source}),
tags AS (SELECT DISTINCT tweet_id, regexp_replace(lower(nfc_normalize(translate(t, '{_WIDE}', '{_NORMAL}'))), '^[ #]+| +$', '', 'g') AS tag
         FROM (SELECT tweet_id, unnest(list_append(coalesce(hashtags, []), source_hashtag)) AS t FROM rows)),
kept AS (SELECT * FROM tags WHERE tag <> ''),
size AS (SELECT count(DISTINCT tweet_id) AS n_baskets FROM rows),
one AS (SELECT tag, count(*) AS n FROM kept GROUP BY tag),
pair AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n FROM kept a JOIN kept b ON a.tweet_id = b.tweet_id AND a.tag < b.tag GROUP BY ALL)
SELECT tag_a, tag_b, pair.n AS n, x.n AS n_a, y.n AS n_b, n_baskets, round(pair.n * n_baskets / (x.n::DOUBLE * y.n), 6) AS lift
FROM pair JOIN one x ON x.tag = tag_a JOIN one y ON y.tag = tag_b CROSS JOIN size"""


_FIRST = "SELECT tweet_id, hashtags, source_hashtag FROM tweets"
ORACLE: dict[str, str] = {
    "p2_scores": _pair_sql(_FIRST),
    "p2_incremental": _pair_sql(_FIRST + " UNION ALL SELECT tweet_id, hashtags, source_hashtag FROM tweet_batches"),
    "p2_found": f"SELECT tag_a, tag_b FROM ({_pair_sql(_FIRST)}) WHERE n >= 5 AND n * 500 >= n_baskets AND n * n_baskets >= 3 * n_a * n_b",
}
