"""Ordered two-tier dedup.

First the first row of each (tweet_id, source_hashtag), then, of those, the first row of each content hash. ``ordinal``
fixes the order. Minima are taken by aggregation, merged before the shuffle, and joined back by key, so a key that holds
a third of all rows is never sorted in one task.

Defined results: null keys and fields count as empty; rows must differ in ``ordinal``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, content_hash, normalize_for_features


def first_rows(df: DataFrame, key: Column, ordinal: str) -> DataFrame:
    """The rows of ``df`` that come first in their key."""
    keep = df.groupBy(key.alias("tm_key")).agg(F.min(ordinal).alias("tm_first")).select(F.col("tm_first").alias(ordinal))
    return df.join(keep, ordinal, "left_semi")


def dedup_records(df: DataFrame, fields: tuple[str, ...], ordinal: str, id_col: str = "tweet_id", tag_col: str = "source_hashtag") -> DataFrame:
    once = first_rows(df, content_hash(F.col(id_col), F.col(tag_col)), ordinal)
    return first_rows(once, content_hash(*(F.col(f) for f in fields)), ordinal)


def near_duplicate_key(text: Column, username: Column, tag: Column) -> Column:
    """The collector's key: cleaned lower-case text, user and tag."""
    return content_hash(normalize_for_features(clean_text(text)), username, tag)
