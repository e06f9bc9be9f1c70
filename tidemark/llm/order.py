"""A global order of tokens, rare first, and the prefixes that follow from it.

Any total order gives exact prefix filters; a good one puts rare tokens first. Counts are exact and over all records: one
distributed aggregation, merged before its shuffle. Two tables come out of it and are broadcast. The head holds the tokens
in at least ``share`` of all records, with their ranks: as a record counts a token once, there are at most (tokens a
record) / ``share`` of them, however large the collection and however it is partitioned. All other tokens are told apart
by ``CELLS`` hashed counters: a counter is the number of occurrences of all tail tokens in its cell, so a tail token that
is frequent after all comes late. Ties go by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1 / 20_000
CELLS = 1 << 16


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)


class Order:
    """``rank`` of tokens: ascending, rare first; tail tokens before the head."""

    def __init__(self, hashes: np.ndarray, ranks: np.ndarray, cells: np.ndarray):
        self.hashes, self.ranks, self.cells = hashes, ranks, cells

    def rank(self, tokens: np.ndarray) -> np.ndarray:
        tail = -1 - int(self.cells.max(initial=0)) + self.cells[_cell(tokens)]
        if not len(self.hashes):
            return tail
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return np.where(self.hashes[at] == tokens, self.ranks[at], tail)


def _counted(values):
    """Tokens of each batch with their counts: what a batch repeats is counted before it leaves the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, counts = np.unique(values(batch), return_counts=True)
            cells = _cell(tokens.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(counts, pa.int64()), pa.array(cells, pa.int64())], names=["token", "n", "cell"])

    return run


def listed(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False)


def order_of(records: DataFrame, share: float = SHARE, values=listed) -> Order:
    """The order of the tokens of the first column: array<long> of distinct tokens, or whatever ``values`` reads from a batch."""
    least = max(2, records.count() * share)
    counts = records.mapInArrow(_counted(values), "token long, n long, cell long").groupBy("token", "cell").agg(F.sum("n").alias("n"))
    # One row per head token and one per cell: both bounded, in one pass over the counts. As text, a 64-bit token is safe beside nulls.
    head = F.col("n") >= least
    kept = counts.groupBy("cell", F.when(head, F.col("token").cast("string")).alias("token")).agg(F.sum("n").alias("n")).toPandas()
    in_head = kept.token.notna().to_numpy()
    cells = np.zeros(CELLS, np.int64)
    cells[kept.cell[~in_head].to_numpy(np.int64)] = kept.n[~in_head].to_numpy(np.int64)
    hashes, n = np.array([int(x) for x in kept.token[in_head]], np.int64), kept.n[in_head].to_numpy(np.int64)
    by = np.lexsort((hashes, n))
    ranks = np.empty(len(by), np.int64)
    ranks[by] = np.arange(1, len(by) + 1)
    up = np.argsort(hashes)
    return Order(hashes[up], ranks[up], cells)


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, row of each value, length of each row) of an array<long> column without nulls."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), sizes


def positions(row: np.ndarray, rank: np.ndarray, token: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, position): ``order`` sorts values by row and global order, ``position`` is each one's place in its row."""
    order = np.lexsort((token, rank, row))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return order, np.arange(len(row)) - np.repeat(starts, sizes)
