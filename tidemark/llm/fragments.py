"""Near-duplicate texts by vertical partitioning of the global token order (problem 6).

The order of all tokens, rare first, is cut at fixed ranks into ``FRAGMENTS`` fragments, and a record into its segments,
one a fragment. Segments are rows of their own, laid out by fragment and record. Pairs come from the rare end: a record's
prefix is as short as the threshold allows, so that two similar records must meet in it. For each pair the overlap is then
counted fragment by fragment, each (pair, fragment) in a row and task of its own, and the partial counts are summed per pair
and held against the threshold in whole numbers. Whole records never meet, so a very long text is compared piece by piece.

The join is exact for Jaccard similarity at ``num / den``: no pair is missed and none is cut off by a limit. Records are
distinct texts, so copies cost one row. A token that more than ``BLOCK`` records index is split: its postings go to as many
parts as it has blocks, and the records that look it up visit all of them, so no key holds more than that many.

Defined results: null texts and texts without tokens pair with nothing; repeated rows are one record. Records are keyed by
64-bit hashes of their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import order
from .charform import WORD_BREAK, skeleton, words

FRAGMENTS = 4
#: Most indexed postings of a token in one part of the join.
BLOCK = 5_000


def word_tokens(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingle_tokens(text: Column, n: int = 5) -> Column:
    """Distinct shingles of ``n`` words as hashes; a shorter text is one shingle."""
    w = F.filter(F.split(F.lower(skeleton(F.coalesce(text, F.lit("")))), WORD_BREAK), lambda x: x != "")
    spots = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (n - 1)))
    return F.when(F.size(w) == 0, F.array().cast("array<long>")).otherwise(F.array_distinct(F.transform(spots, lambda i: F.xxhash64(F.slice(w, i, n)))))


def _ceil(a: np.ndarray, b: int) -> np.ndarray:
    return -(-a // b)


def _prefixes(shared, num: int, den: int):
    """(key, tokens) -> one row per token of the longer, probing prefix; ``indexed`` marks those of the shorter one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: order.Order = shared.value
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            token, row, sizes = order.flat(batch.column(1))
            by, pos = order.positions(row, known.rank(token), token, sizes)
            size = np.repeat(sizes, sizes).astype(np.int64)
            keep = pos < size - _ceil(num * size, den) + 1
            indexed = pos < size - _ceil(2 * num * size, num + den) + 1
            bits = np.zeros(len(sizes), np.uint64)
            np.bitwise_or.at(bits, row, np.uint64(1) << (token.view(np.uint64) >> np.uint64(58)))
            yield pa.RecordBatch.from_arrays([pa.array(token[by][keep]), pa.array(key[row[keep]]), pa.array(size[keep].astype(np.int32)), pa.array(pos[keep].astype(np.int32)), pa.array(bits.view(np.int64)[row[keep]]), pa.array(indexed[keep])], names=["token", "key", "size", "pos", "bits", "indexed"])

    return run


def _segments(shared):
    """(key, tokens) -> a row per segment: the record's size, the fragment and the tokens in it. Fragment 0 has the tail of the order, the head is cut at fixed ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: order.Order = shared.value
        for batch in batches:
            token, row, sizes = order.flat(batch.column(1))
            rank = known.rank(token)
            fragment = np.where(rank < 0, 0, 1 + (rank - 1) * (FRAGMENTS - 1) // max(1, len(known.ranks)))
            by = np.argsort(row * FRAGMENTS + fragment, kind="stable")
            spot, first = np.unique((row * FRAGMENTS + fragment)[by], return_index=True)
            tokens = pa.ListArray.from_arrays(pa.array(np.append(first, len(by)).astype(np.int32)), pa.array(token[by]))
            at = spot // FRAGMENTS
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(sizes[at].astype(np.int32)), pa.array((spot % FRAGMENTS).astype(np.int32)), tokens], names=["key", "size", "fragment", "tokens"])

    return run


def candidates(postings: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """Pairs of keys whose counts in the prefixes, and what could still follow, allow the threshold: (x, y), y the smaller record.

    ``bits`` has one bit per token, 64 in all: bits in which two records differ are tokens that only one of them has, so
    most pairs that meet in a token by chance are dropped in the join.
    """
    hot = postings.where("indexed").groupBy("token").agg(F.count("*").alias("n")).where(f"n > {block}").select("token", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    hot = cut(hot, "hot")  # written, its size is known: a small table is sent and the postings aren't shuffled for it
    split = postings.join(hot, "token", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    p = split.select("token", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("key").alias("x"), F.col("size").alias("xs"), F.col("pos").alias("xp"), F.col("bits").alias("xb"))
    i = split.where("indexed").select("token", F.expr("CASE WHEN parts = 1 THEN 0 ELSE int(pmod(xxhash64(key), parts)) END").alias("part"), F.col("key").alias("y"), F.col("size").alias("ys"), F.col("pos").alias("yp"), F.col("bits").alias("yb"))
    rest = f"least(xs - xp, ys - yp) * {num + den} >= {num} * (xs + ys)"
    apart = f"(xs + ys - bit_count(xb ^ yb)) * {num + den} >= {2 * num} * (xs + ys)"
    met = p.join(i, ["token", "part"]).where(f"(ys < xs OR (ys = xs AND y < x)) AND {den} * ys >= {num} * xs AND {rest} AND {apart}")
    counted = met.groupBy("x", "y").agg(F.count("*").alias("shared"), F.max("xp").alias("xp"), F.max("yp").alias("yp"), F.first("xs").alias("xs"), F.first("ys").alias("ys"))
    return counted.where(f"(shared + least(xs - xp, ys - yp) - 1) * {num + den} >= {num} * (xs + ys)").select("x", "y")


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(x, y, shared, size_x, size_y) of every pair that shares a token: the overlap is counted for each fragment apart and summed per pair."""
    mine = segments.select(F.col("key").alias("x"), "fragment", F.col("size").alias("size_x"), F.col("tokens").alias("of_x"))
    other = segments.select(F.col("key").alias("y"), "fragment", F.col("size").alias("size_y"), F.col("tokens").alias("of_y"))
    partial = pairs.join(mine, "x").join(other, ["y", "fragment"]).select("x", "y", "fragment", F.size(F.array_intersect("of_x", "of_y")).alias("n"), "size_x", "size_y")
    return partial.groupBy("x", "y").agg(F.sum("n").alias("shared"), F.first("size_x").alias("size_x"), F.first("size_y").alias("size_y"))


def similar_records(df: DataFrame, tokens, text: str = "text", num: int = 7, den: int = 10, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(pairs, rows): pairs (x, y, shared, size_x, size_y) of different texts at least ``num / den`` alike, and ``df`` with each row's text in ``tm_key``.

    This is the result to keep: links between texts, and which rows have which text. Copies aren't expanded.
    """
    rows = df.where(F.col(text).isNotNull()).withColumn("tm_key", F.xxhash64(text))
    texts = rows.select("tm_key", F.col(text).alias("tm_text")).groupBy("tm_key").agg(F.first("tm_text").alias("tm_text"))
    sets = cut(texts.select("tm_key", tokens(F.col("tm_text")).alias("tokens")), "tokens")
    shared = df.sparkSession.sparkContext.broadcast(order.order_of(sets.select("tokens")))
    postings = cut(sets.mapInArrow(_prefixes(shared, num, den), "token long, key long, size int, pos int, bits long, indexed boolean"), "postings")
    found = cut(candidates(postings, num, den, block), "pairs")
    wanted = found.select(F.explode(F.array("x", "y")).alias("tm_key")).distinct()
    segments = cut(sets.join(wanted, "tm_key", "left_semi").mapInArrow(_segments(shared), "key long, size int, fragment int, tokens array<long>"), "segments")
    return overlaps(found, segments).where(f"shared * {num + den} >= {num} * (size_x + size_y)"), rows


def links(df: DataFrame, id_col: str, text: str = "text", num: int = 7, den: int = 10, tokens=word_tokens) -> DataFrame:
    """(id, class_id, n_links) of every id and text of its: ``class_id`` is the same for equal texts, ``n_links`` counts the other texts at least ``num / den`` alike."""
    pairs, rows = similar_records(df.select(id_col, text), tokens, text, num, den)
    each = pairs.select(F.explode(F.array("x", "y")).alias("tm_key")).groupBy("tm_key").agg(F.count("*").alias("n_links"))
    members = rows.select(F.col(id_col).alias("id"), "tm_key").where("id IS NOT NULL").distinct()
    return members.join(each, "tm_key", "left").select("id", F.col("tm_key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def similar_ids(df: DataFrame, id_col: str, text: str = "text", num: int = 7, den: int = 10, tokens=word_tokens) -> DataFrame:
    """Pairs (a, b), a < b, of different ids whose texts are at least ``num / den`` alike, equal texts included: every pair of ids, so k copies give k (k - 1) / 2 rows."""
    pairs, rows = similar_records(df.select(id_col, text), tokens, text, num, den)
    members = rows.groupBy("tm_key", id_col).agg(F.lit(1).alias("tm_one")).select("tm_key", F.col(id_col).alias("tm_id"))
    left, right = members.select(F.col("tm_key").alias("x"), F.col("tm_id").alias("a")), members.select(F.col("tm_key").alias("y"), F.col("tm_id").alias("b"))
    shared = members.groupBy("tm_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("tm_key").alias("x"), F.col("tm_key").alias("y"))
    alike = cut(pairs.select("x", "y").union(shared), "alike")
    met = alike.join(left, "x").join(right, "y").where("a < b OR (x <> y AND a <> b)")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
