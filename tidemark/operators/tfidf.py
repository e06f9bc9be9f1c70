"""TF-IDF weights in long form.

Tokens are runs of at least two word characters; stop words go before n-grams are formed; terms need ``min_df``
documents; of these the ``max_features`` most frequent in the corpus stay (ties by term). idf = ln((1 + n)/(1 + df)) + 1,
and rows are scaled to length 1. Counts are merged before their shuffle; the vocabulary, at most ``max_features`` terms,
is the only thing sent to all tasks. An empty corpus gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The default stop words; any other list can be given.
STOPWORDS = """a about above after again against all am an and any are as at be because been before being below between both but by can
could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its
just me more most my no nor not now of off on once only or other our ours out over own same she should so some such than that the their
theirs them then there these they this those through to too under until up very was we were what when where which while who whom why will
with would you your yours rt amp via""".split()


def english_stopwords(extra: tuple[str, ...] = ()) -> list[str]:
    return sorted({*STOPWORDS, *extra})


def term_counts(df: DataFrame, id_col: str, text: str, stopwords: list[str], bigrams: bool = True) -> DataFrame:
    """(id, term, tf)."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))
    kept = F.filter(tokens, lambda t: ~t.isin(stopwords)) if stopwords else tokens
    rows = df.select(F.col(id_col).alias("id"), kept.alias("w"))
    pairs = F.when(F.size("w") > 1, F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    terms = F.concat("w", pairs) if bigrams else F.col("w")
    return rows.select("id", F.explode(terms).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, n_docs: int, max_features: int = 5000, min_df: int = 2) -> DataFrame:
    """(term, df, total, idf)."""
    by = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    return by.orderBy(F.desc("total"), "term").limit(max_features).withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def tfidf(df: DataFrame, id_col: str, text: str, stopwords: list[str], max_features: int = 5000, min_df: int = 2, bigrams: bool = True) -> DataFrame:
    """(id, term, tf, weight)."""
    counts = term_counts(df, id_col, text, stopwords, bigrams)
    vocab = vocabulary(counts, df.count(), max_features, min_df)
    raw = counts.join(F.broadcast(vocab.select("term", "idf")), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, "id").select("id", "term", "tf", (F.col("w") / F.col("norm")).alias("weight"))


def top_terms(weights: DataFrame, k: int = 10) -> DataFrame:
    return weights.groupBy("term").agg(F.sum("weight").alias("total_weight")).orderBy(F.desc("total_weight"), "term").limit(k)


def sparsity(weights: DataFrame, n_docs: int) -> DataFrame:
    """One row: terms, non-zeros, and the share of zeros in documents x terms."""
    one = weights.agg(F.count_distinct("term").alias("n_terms"), F.count("*").alias("n_nonzero"))
    return one.withColumn("sparsity", 1.0 - F.try_divide(F.col("n_nonzero"), F.lit(n_docs) * F.col("n_terms")))
