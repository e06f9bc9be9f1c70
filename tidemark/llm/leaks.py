"""Passages of test items inside a corpus (problem 9).

Items and documents are read as words: runs of letters and digits, with case and character form put aside. The hashed
n-word windows of all items are sent to every task; documents are scanned window by window, and each hit is compared word
by word with the item's window before it counts. Windows are only hashed where all their words occur in some item.

The set sent is checked: beyond ``MOST_WINDOWS`` item words, the 8-byte hashes of all document windows are joined with those
of the items instead, and only documents with a hash in common send their windows to be compared word by word. Both ways
give the same rows. Words stand for themselves by 64-bit hashes throughout.

Defined results: null and short texts (under n words) have no case; repeated documents or items each give their rows; a
document with several passages of an item is one row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_name
from . import order
from .charform import FROM, TO, skeleton

WORDS = 12
MOST_WINDOWS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed_words(text: Column) -> Column:
    found = F.filter(F.split(F.lower(skeleton(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _windows(words: np.ndarray, row: np.ndarray, ok: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the windows of ``n`` words of one row in which every word is ``ok``."""
    if len(words) < n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.concatenate([[0], np.cumsum(ok)])
    starts = np.flatnonzero((total[n:] - total[:-n] == n) & (row[n - 1 :] == row[: len(row) - n + 1]))
    value = np.zeros(len(starts), np.uint64)
    for k in range(n):
        value = (value ^ words[starts + k].view(np.uint64)) * _MIX
        value ^= value >> np.uint64(29)
    return starts, value


class _Items:
    """Item words and windows, sorted by window hash."""

    def __init__(self, items: pd.DataFrame, n: int):
        words = [np.asarray(w, np.int64) for w in items["words"]]
        sizes = np.array([len(w) for w in words], np.int64)
        self.words = np.concatenate([*words, np.empty(0, np.int64)])
        row = np.repeat(np.arange(len(words)), sizes)
        self.starts, hashes = _windows(self.words, row, np.ones(len(row), bool), n)
        by = np.argsort(hashes, kind="stable")
        self.starts, self.hashes, self.vocabulary = self.starts[by], hashes[by], np.unique(self.words)
        self.ids = items["item_id"].to_numpy()[row[self.starts]] if len(by) else np.empty(0, np.int64)


def _known(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(len(words), bool)
    return vocabulary[np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)] == words


def _scan(items: _Items, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            words, row, _ = order.flat(batch.column(1))
            starts, hashes = _windows(words, row, _known(words, items.vocabulary), n)
            lo, hi = np.searchsorted(items.hashes, hashes, "left"), np.searchsorted(items.hashes, hashes, "right")
            at = np.repeat(np.arange(len(starts)), hi - lo)
            which = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.repeat(lo, hi - lo) if len(at) else np.empty(0, np.int64)
            same = np.ones(len(at), bool)
            for k in range(n):
                same &= words[starts[at] + k] == items.words[items.starts[which] + k]
            found = pd.DataFrame({"doc_id": doc[row[starts[at][same]]], "item_id": items.ids[which[same]]}).drop_duplicates()
            yield pa.RecordBatch.from_pandas(found.astype("int64"), preserve_index=False)

    return run


def _emit(n: int, whole: bool):
    """(id, hash) of every window, or (id, window) with its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, row, _ = order.flat(batch.column(1))
            starts, hashes = _windows(words, row, np.ones(len(words), bool), n)
            what = pa.array(hashes.view(np.int64))
            if whole:
                what = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(starts) + 1) * n, n, dtype=np.int32)), pa.array(words[(starts[:, None] + np.arange(n)).ravel()]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[starts])), what], names=["id", "window"])

    return run


def leaked(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", n: int = WORDS, most: int = MOST_WINDOWS) -> DataFrame:
    """(doc_id, item_id): documents that hold at least ``n`` consecutive words of an item."""
    docs = documents.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), hashed_words(F.col(text)).alias("words"))
    tests = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), hashed_words(F.col(text)).alias("words"))
    size = tests.agg(F.sum(F.size("words"))).first()[0] or 0
    if size <= most:
        return docs.mapInArrow(_scan(_Items(tests.toPandas(), n), n), "doc_id long, item_id long").distinct()
    hashes = tests.mapInArrow(_emit(n, False), "id long, window long").select("window").distinct()
    near = docs.mapInArrow(_emit(n, False), "id long, window long").join(hashes, "window", "left_semi").select(F.col("id").alias("doc_id")).distinct()
    windows = tests.mapInArrow(_emit(n, True), "id long, window array<long>").select(F.col("id").alias("item_id"), "window").distinct()
    found = docs.join(near, "doc_id", "left_semi").mapInArrow(_emit(n, True), "id long, window array<long>")
    return found.select(F.col("id").alias("doc_id"), "window").join(windows, "window").select("doc_id", "item_id").distinct()


_MAP = {ord(c): (TO[i] if i < len(TO) else None) for i, c in enumerate(FROM)}


def _spans(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) in the text as it stands."""
    out, word, start = [], "", 0
    for i, c in enumerate(text + " "):
        form = unicodedata.normalize("NFKD", c).translate(_MAP)
        if not form:
            continue
        if any(x.isalnum() or (word and unicodedata.combining(x)) for x in form):
            start = start if word else i
            word += form
            end = i + 1
        elif word:
            out.append((unicodedata.normalize("NFC", word).lower(), start, end))
            word = ""
    return out


def without_passages(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", n: int = WORDS, most: int = MOST_WINDOWS) -> DataFrame:
    """``documents`` with every passage of ``n`` or more item words cut out of ``text``. Only documents with a leak are rewritten, each with the items found in it at hand, so no task needs them all."""
    key, held = fresh_name(documents, "tm_doc"), fresh_name(documents, "tm_items")
    of_item = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col("text").alias("item"))
    hit = leaked(documents, items, doc_id, item_id, text, n, most).join(of_item, "item_id").groupBy(F.col("doc_id").alias(key)).agg(F.collect_set("item").alias(held))

    @F.pandas_udf("string")
    def strip(texts: pd.Series, found: pd.Series) -> pd.Series:
        grams: dict[str, set[tuple[str, ...]]] = {}

        def of(item: str) -> set[tuple[str, ...]]:
            if item not in grams:
                w = [x[0] for x in _spans(item)]
                grams[item] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
            return grams[item]

        def one(t: str, mine: list[str]) -> str:
            known = set().union(*(of(x) for x in mine))
            spans = _spans(t)
            gone = [False] * len(spans)
            for i in range(len(spans) - n + 1):
                if tuple(x[0] for x in spans[i : i + n]) in known:
                    gone[i : i + n] = [True] * n
            out, at, i = [], 0, 0
            while i < len(spans):
                if gone[i]:
                    j = i
                    while j + 1 < len(spans) and gone[j + 1]:
                        j += 1
                    out.append(t[at : spans[i][1]])
                    at, i = spans[j][2], j
                i += 1
            return "".join([*out, t[at:]])

        return pd.Series([None if t is None else one(t, mine) for t, mine in zip(texts, found)])

    joined = documents.withColumn(key, F.col(doc_id).cast("long")).join(hit, key, "left")
    return joined.withColumn(text, F.when(F.col(held).isNotNull(), strip(F.when(F.col(held).isNotNull(), F.col(text)), F.coalesce(held, F.array().cast("array<string>")))).otherwise(F.col(text))).drop(key, held)
