"""Duplicates of new batches in all history, by content-defined chunks (problem 7).

A text in comparable form is cut where a rolling hash of the bytes before a blank meets a condition, so an edit changes
the chunks around it and no others, wherever it stands. Chunks are kept in one order, rare first; a record's prefix is as
short as the coverage threshold allows, so two records that share ``coverage`` of the longer one's bytes meet in it. The
persistent table maps the chunks of all prefixes to records, hash-bucketed by chunk, with the bytes that stand before
each. A batch looks its own prefixes up, sums shared bytes per pair, keeps pairs whose total can still reach the
coverage, and compares only those texts exactly. Its chunks are then appended; history is never cut, sorted or shuffled
again: a batch small enough to be sent scans the narrow columns it looks up, a large one is sent to the buckets.

Texts can share most of their words and few of their chunks (words swapped, single words edited all over the text). So the
same table also maps the distinct words of each text's word prefix, which is as long as ``least`` asks for: two texts that
share ``least`` of their distinct words meet in it. Pairs come from either, and no pair at or above ``least`` is missed.

The order is fixed when a table is begun, from exact counts over the history; tokens first seen later count as rare. The
table lives in its folder alone: bucket count, thresholds and order are stored with it, and any session can open it. Every
row carries the number of the step that added it, and only steps with a commit marker are read, so a batch that failed
half-way leaves nothing behind and can be checked again.

Defined results: null ids or texts match nothing; texts without words match nothing; within one call, rows are ordered by
``seq``, and a row is only held against earlier ones; repeated rows differ by ``seq``. Texts are keyed by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, scratch
from . import order
from .charform import WORD_BREAK, skeleton

WINDOW = 8
#: Of 16 hash values, so many end a chunk at a blank.
ENDS = 6
COVERAGE = Fraction(2, 3)
LEAST = Fraction(7, 10)
BUCKETS = 16

_rng = np.random.default_rng(20240607)
GEAR = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def cut_chunks(texts: pa.StringArray, window: int = WINDOW, ends: int = ENDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, chunk hash, bytes) of every chunk of an array of non-null texts, words separated by single blanks."""
    if not len(texts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    g = GEAR[raw]
    # Windowed gear hash by doubling: after k steps each place has the sum of 2**k shifted bytes, of its own text alone.
    place = np.arange(n) - np.repeat(off[:-1], np.diff(off))
    h, span = g.copy(), 1
    while span < window:
        h[span:] = h[span:] + np.where(place[span:] >= span, h[:-span] << np.uint64(span), np.uint64(0))
        span *= 2
    h ^= h >> np.uint64(29)
    blank = raw == 32
    spots = np.flatnonzero(blank)
    spots = spots[spots > 0]
    spots = spots[((h[spots - 1] * BASE) >> np.uint64(60)) < ends]
    stops = np.unique(np.concatenate([spots, off[1:]]))
    stops = stops[stops > 0]
    row = np.searchsorted(off, stops, side="left") - 1
    starts = np.maximum(np.concatenate([[0], stops[:-1]]), off[row])
    starts = starts + ((starts < n) & blank[np.minimum(starts, n - 1)] & (starts < stops))
    size = stops - starts
    ok = size > 0
    row, starts, stops, size = row[ok], starts[ok], stops[ok], size[ok]
    if not len(size):
        return row, np.empty(0, np.int64), size
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    inner = np.arange(size.sum()) - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()), BASE, np.uint64))
    value = np.add.reduceat(g[np.repeat(starts, size) + inner] * power[inner], first)
    value ^= value >> np.uint64(31)
    return row, (value * GEAR[7]).view(np.int64), size


def comparable(text):
    """Words in order, single blanks between them, case and character form put aside."""
    return F.array_join(F.filter(F.split(F.lower(skeleton(text)), WORD_BREAK), lambda w: w != ""), " ")


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([cut_chunks(batch.column(0))[1], _words(batch.column(0))[1]])


def _words(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word; hashes are inverted, so that a word and a chunk of one word differ."""
    row, word, _ = cut_chunks(texts, ends=16)
    return row, ~word


def _prefix(row: np.ndarray, token: np.ndarray, size: np.ndarray, rank: np.ndarray, n: int, share: Fraction) -> tuple[np.ndarray, ...]:
    """(row, token, size, size of those before it in the order) of the distinct tokens in each row's prefix, and the size of each of the ``n`` rows."""
    by = np.lexsort((token, rank, row))
    row, token, size = row[by], token[by], size[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    row, token, size = row[new], token[new], size[new]
    total = np.bincount(row, size, n).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(total)[:-1]]) if n else np.empty(0, np.int64)
    before = np.cumsum(size) - size - start[row]
    keep = share.denominator * (total[row] - before) >= share.numerator * total[row]
    return row[keep], token[keep], size[keep], before[keep], total


def _prefixes(shared, coverage: Fraction, least: Fraction):
    """(key, text) -> the chunks of the record's prefix, with the record's bytes and those before the chunk in the order; then the words of its word prefix, each of size 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: order.Order = shared.value
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            row, chunk, size = cut_chunks(batch.column(1))
            word_row, word = _words(batch.column(1))
            bits = np.zeros(len(key), np.uint64)
            np.bitwise_or.at(bits, word_row, np.uint64(1) << (word.view(np.uint64) >> np.uint64(58)))
            by_chunk = _prefix(row, chunk, size, known.rank(chunk), len(key), coverage)
            by_word = _prefix(word_row, word, np.ones(len(word), np.int64), known.rank(word), len(key), least)
            row, token, size, before = (np.concatenate(x) for x in zip(by_chunk[:4], by_word[:4]))
            is_word = np.arange(len(row)) >= len(by_chunk[0])
            total = np.where(is_word, by_word[4][row], by_chunk[4][row])
            columns = {"chunk": token, "key": key[row], "total": total.astype(np.int32), "before": before.astype(np.int32), "size": size.astype(np.int32), "bits": bits.view(np.int64)[row], "words": by_word[4][row].astype(np.int32), "word": is_word}
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

    return run


POSTING = "chunk long, key long, total int, before int, size int, bits long, words int, word boolean"


def _rows(df: DataFrame, id_col: str, tag_col: str, text: str, seq: str) -> DataFrame:
    rows = df.where(F.col(id_col).isNotNull() & F.col(text).isNotNull())
    return rows.select(F.col(seq).cast("long").alias("seq"), F.col(id_col).alias("id"), F.col(tag_col).alias("tag"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each key of a batch once, so that a hot text doesn't travel by the row."""
    for batch in batches:
        yield batch.take(pa.array(np.sort(np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)[1])))


def _texts(rows: DataFrame) -> DataFrame:
    """(key, text in comparable form) of every distinct text."""
    one = rows.select("key", "text").mapInArrow(_once, "key long, text string").groupBy("key").agg(F.first("text").alias("text"))
    return one.select("key", comparable(F.col("text")).alias("text")).where("text <> ''")


def _first_two(seen: DataFrame) -> DataFrame:
    """Per key, of (key, id, seq): the earliest entry and the earliest one of another id. Both are merged before the shuffle."""
    one = seen.groupBy("key", "id").agg(F.min("seq").alias("seq"))
    first = one.groupBy("key").agg(F.min(F.struct("seq", "id")).alias("first"))
    other = one.join(first, "key").where("id <> first.id").groupBy("key").agg(F.min(F.struct("seq", "id")).alias("second"))
    return first.join(other, "key", "left")


BUCKETED = {"texts": ("key", "key long, text string, added int"), "postings": ("chunk", POSTING + ", added int")}


class ChunkTable:
    """The persistent chunk-to-record table of one collection, in a folder that all executors share.

    ``postings`` and ``texts`` (each distinct text once) are bucketed tables: a batch's chunks and keys are sent to the
    buckets, and the tables themselves are never shuffled. ``records`` has the rows by (id, tag, seq) and their text's key.
    Word prefixes are cut for ``least``, the lowest share of words that can be asked for. Give ``begin`` a path of your own
    for a table that is to outlive the session, and ``open`` it there.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, coverage: Fraction, least: Fraction):
        self.spark, self.path, self.buckets, self.coverage, self.least = spark, path.rstrip("/"), buckets, coverage, least
        self.name = f"chunks_{xxhash.xxh64_hexdigest(self.path)}"
        self._shared = None
        # Every step is written out, so its shuffle files can go when it ends instead of when the driver collects its garbage.
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        for name, (by, columns) in BUCKETED.items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name}_{name} ({columns}) USING parquet OPTIONS (compression 'zstd') CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.path}/{name}'")

    @classmethod
    def begin(cls, history: DataFrame, id_col: str, tag_col: str, text: str, seq: str, path: str | None = None, coverage: Fraction = COVERAGE, least: Fraction = LEAST, buckets: int | None = None) -> ChunkTable:
        """A new table holding ``history``. With fewer buckets than shuffle partitions Spark would shuffle it for a large batch."""
        spark = history.sparkSession
        self = cls(spark, path or scratch(spark, "chunks"), buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions"))), coverage, least)
        rows = _rows(history, id_col, tag_col, text, seq)
        step = self._attempt()
        self._write(rows.drop("text"), "records", step)
        self._bucketed(_texts(rows), "texts", step)
        found = order.order_of(self.spark.table(f"{self.name}_texts").select("text"), values=_values)
        spark.createDataFrame(list(zip(found.hashes.tolist(), found.ranks.tolist())), "token long, rank long").coalesce(1).write.parquet(f"{self.path}/head")
        spark.createDataFrame([(found.cells.tobytes(),)], "cells binary").write.parquet(f"{self.path}/cells")
        self._bucketed(self._postings(self.spark.table(f"{self.name}_texts")), "postings", step)
        meta = (self.buckets, coverage.numerator, coverage.denominator, least.numerator, least.denominator)
        spark.createDataFrame([meta], "buckets int, c int, of int, l int, al int").coalesce(1).write.parquet(f"{self.path}/meta")
        self._commit(step)
        return self

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> ChunkTable:
        """The table in the folder ``path``, whatever session began it."""
        m = spark.read.parquet(f"{path.rstrip('/')}/meta").first()
        return cls(spark, path, m["buckets"], Fraction(m["c"], m["of"]), Fraction(m["l"], m["al"]))

    def _fs(self, *names: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, "log", *names]))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _logged(self) -> tuple[set[int], set[int]]:
        """(steps begun, steps committed)."""
        fs, where = self._fs()
        names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
        pick = lambda kind: {int(n[len(kind) :]) for n in names if n.startswith(kind)}
        return pick("begun-"), pick("done-")

    def _attempt(self) -> int:
        step = max(self._logged()[0], default=0) + 1
        fs, where = self._fs(f"begun-{step}")
        fs.create(where, False).close()
        return step

    def _commit(self, step: int) -> None:
        fs, where = self._fs(f"done-{step}")
        fs.create(where, True).close()

    def _bucketed(self, df: DataFrame, name: str, step: int) -> None:
        """Append rows to a bucketed table, one task a bucket."""
        by, columns = BUCKETED[name]
        df.withColumn("added", F.lit(step)).select(*[c.split(" ")[0] for c in columns.split(", ")]).repartition(self.buckets, by).write.mode("append").format("parquet").bucketBy(self.buckets, by).option("compression", "zstd").saveAsTable(f"{self.name}_{name}")

    def _read(self, name: str) -> DataFrame:
        begun, done = self._logged()
        if name in BUCKETED:
            found = self.spark.table(f"{self.name}_{name}")
        else:
            found = self.spark.read.parquet(f"{self.path}/{name}")
        lost = sorted(begun - done)
        return (found.where(~F.col("added").isin(lost)) if lost else found).drop("added")

    def _write(self, df: DataFrame, name: str, step: int) -> None:
        df.withColumn("added", F.lit(step)).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")

    def _order(self):
        if self._shared is None:
            head = self.spark.read.parquet(f"{self.path}/head").toPandas().sort_values("token")
            cells = np.frombuffer(self.spark.read.parquet(f"{self.path}/cells").first()[0], np.int64)
            self._shared = self.spark.sparkContext.broadcast(order.Order(head["token"].to_numpy(np.int64), head["rank"].to_numpy(np.int64), cells))
        return self._shared

    def _postings(self, texts: DataFrame) -> DataFrame:
        return texts.select("key", "text").mapInArrow(_prefixes(self._order(), self.coverage, self.least), POSTING)

    def check(self, batch: DataFrame, id_col: str, tag_col: str, text: str, seq: str, num: int = 7, den: int = 10) -> DataFrame:
        """(seq, dup_kind) of the batch's repeats, after which the batch belongs to the history. Several batches may be given as one: rows are ordered by ``seq``."""
        if Fraction(num, den) < self.least:
            raise ValueError(f"the table was begun for {self.least} of the words and more")
        rows = cut(_rows(batch, id_col, tag_col, text, seq), "batch")
        texts = cut(_texts(rows), "batch_texts")
        new = rows.drop("text")
        known = self._read("records").unionByName(new)
        fresh = cut(self._postings(texts), "fresh")
        up, lo = self.coverage.numerator, self.coverage.denominator
        p = fresh.select("chunk", F.col("key").alias("x"), F.col("total").alias("xt"), F.col("before").alias("xb"), F.col("bits").alias("xw"), F.col("words").alias("xn"), "word")
        # Words of which only one text has any have bits that differ; most chance meetings end here, in the join.
        apart = f"(xn + yn - bit_count(xw ^ yw)) * {num + den} >= {2 * num} * (xn + yn)"

        def enough(shared: str) -> str:
            return f"CASE WHEN word THEN ({shared}) * {num + den} >= {num} * (xt + yt) ELSE ({shared}) * {lo} >= {up} * greatest(xt, yt) END"

        def meet(postings: DataFrame) -> DataFrame:
            i = postings.select("chunk", F.col("key").alias("y"), F.col("total").alias("yt"), F.col("before").alias("yb"), F.col("bits").alias("yw"), F.col("words").alias("yn"), "size")
            met = p.join(i, "chunk").where(f"x <> y AND {enough('least(xt - xb, yt - yb)')} AND {apart}")
            shared = met.groupBy("x", "y", "word").agg(F.sum("size").alias("shared"), F.max("xb").alias("xb"), F.max("yb").alias("yb"), F.first("xt").alias("xt"), F.first("yt").alias("yt"))
            # All from the last shared chunk on may still be shared, and all words after the last shared one.
            return shared.where(enough("shared + least(xt - xb, yt - yb) - int(word)")).select("x", "y")

        near = cut(meet(self._read("postings")).unionByName(meet(fresh)), "near").distinct()
        wanted = near.select(F.explode(F.array("x", "y")).alias("key")).distinct()
        known_texts = self._read("texts").join(wanted, "key", "left_semi")
        found = known_texts.unionByName(texts.join(wanted, "key", "left_semi").join(known_texts.select("key"), "key", "left_anti"))
        sets = cut(found.select("key", F.transform(F.array_distinct(F.split("text", " ")), lambda w: F.xxhash64(w)).alias("w")), "sets")
        pairs = near.join(sets.select(F.col("key").alias("x"), F.col("w").alias("wx")), "x").join(sets.select(F.col("key").alias("y"), F.col("w").alias("wy")), "y")
        pairs = pairs.withColumn("both", F.size(F.array_intersect("wx", "wy"))).where(f"both * {num + den} >= {num} * (size(wx) + size(wy))").select("x", "y")
        own = texts.select(F.col("key").alias("x"), F.col("key").alias("y"))
        alike = cut(pairs.unionByName(own), "alike")
        # Of all records alike to x, only the earliest and the earliest of another id can decide. The records are read once, for their keys and for their ids.
        tagged = new.where("tag IS NOT NULL")
        mine, ids = alike.select(F.col("y").alias("key"), F.lit(True).alias("by_key")).distinct(), tagged.select("id", F.lit(True).alias("by_id")).distinct()
        touched = cut(known.join(mine, "key", "left").join(ids, "id", "left").where("by_key OR by_id"), "touched")
        seen = _first_two(touched.where("by_key").select("key", "id", "seq"))
        entries = alike.join(seen.withColumnRenamed("key", "y"), "y").select(F.col("x").alias("key"), F.explode(F.array("first", "second")).alias("e")).where("e IS NOT NULL").select("key", "e.id", "e.seq")
        decided = _first_two(entries)
        by_text = new.join(decided, "key", "left").select("seq", F.expr("CASE WHEN first.id <> id THEN first.seq < seq ELSE coalesce(second.seq < seq, false) END").alias("text_dup"))
        since = touched.where("by_id").groupBy("id", "tag").agg(F.min("seq").alias("since"))
        by_id = tagged.join(since, ["id", "tag"]).select("seq", (F.col("since") < F.col("seq")).alias("id_dup"))
        out = by_text.join(by_id, "seq", "left").select("seq", F.expr("CASE WHEN id_dup THEN 'id' WHEN text_dup THEN 'text' END").alias("dup_kind")).where("dup_kind IS NOT NULL")
        out = cut(out, "verdicts")
        unseen = cut(texts.join(self._read("texts").select("key"), "key", "left_anti"), "unseen")
        step = self._attempt()
        self._write(new, "records", step)
        self._bucketed(unseen, "texts", step)
        self._bucketed(fresh.join(unseen.select("key"), "key", "left_semi"), "postings", step)
        self._commit(step)
        return out
