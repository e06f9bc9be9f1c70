"""Texts of varying length in containers of fixed capacity (problem 8).

Sizes are tokens of a public tokenizer. An item over the capacity is cut into full containers and a rest; nothing else is
split. Dynamic programming over the exact global histogram of sizes chooses length buckets with the least padding, and a
container holds slots as long as their bucket's upper boundary. Token-budget batches form inside each bucket; what such a
batch leaves over is filled with slots of the largest buckets that fit, so a container is a pattern of slots. Patterns are
laid out on bucket counts alone (at most ``capacity`` numbers, whatever the corpus), and items take their places by rank
within their bucket. Ranks are counted in hashed parts, so no task gets a whole bucket.

Defined results: null and empty texts take a slot of one token; ties in rank go by id; repeated ids are numbered apart
only if ``id`` is unique, as it must be; no tables or no capacities give an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_BUCKETS = 128
PART_ROWS = 500_000


def token_counts(df: DataFrame, id_col: str, text: str, path: str = TOKENIZER, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens) by the byte-level BPE ranks in the file at ``path``, which every executor reads, and the regular expression that cuts texts first (by default the one published with the file)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        cuts = pattern
        if cuts is None:
            import public_tokenizers

            cuts = public_tokenizers.PATTERN

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=cuts, mergeable_ranks=ranks, special_tokens={})
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "n_tokens": [len(encoding.encode_ordinary(t)) if t else 0 for t in frame["text"]]})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, n_tokens long")


def choose_buckets(sizes: np.ndarray, counts: np.ndarray, most: int = MOST_BUCKETS) -> np.ndarray:
    """Upper boundaries of at most ``most`` buckets with the least total padding, by dynamic programming over the histogram."""
    m = len(sizes)
    if m <= most:
        return sizes.copy()
    n, s = np.concatenate([[0], np.cumsum(counts)]).astype(float), np.concatenate([[0], np.cumsum(counts * sizes)]).astype(float)
    best, back = np.full(m + 1, np.inf), []
    best[0] = 0
    blocks = [np.arange(j, min(j + 256, m + 1)) for j in range(1, m + 1, 256)]
    for _ in range(most):
        step, came = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        for j in blocks:
            # Items i..j-1 in one bucket that ends at sizes[j-1].
            i = np.arange(j[-1])
            total = best[i, None] + sizes[j - 1] * (n[j] - n[i, None]) - (s[j] - s[i, None])
            total[i[:, None] >= j] = np.inf
            came[j] = total.argmin(0)
            step[j] = total.min(0)
        best = step
        back.append(came)
    ends, at = [], m
    for k in reversed(back):
        if at == 0:
            break
        ends.append(sizes[at - 1])
        at = k[at]
    return np.array(ends[::-1])


def lay_out(ends: np.ndarray, counts: np.ndarray, capacity: int, fill: bool = True) -> list[tuple[int, int, int, int, int]]:
    """(bucket, first rank, last rank + 1, slots of it in a container, first container) of every pattern, by bucket."""
    left, used, out, container = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64), [], 0
    while left.any():
        room, pattern, free = capacity, {}, left.copy()
        for k in range(len(ends) - 1, -1, -1):
            take = int(min(room // ends[k], free[k]))
            if take:
                pattern[k] = take
                room -= take * int(ends[k])
                if not fill:
                    break
        times = min(int(left[k]) // t for k, t in pattern.items())
        for k, t in pattern.items():
            out.append((k, int(used[k]), int(used[k]) + t * times, t, container))
            used[k] += t * times
            left[k] -= t * times
        container += times
    return out


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], id_col: str = "id", size: str = "n_tokens", most: int = MOST_BUCKETS, fill: bool = True) -> DataFrame:
    """(pack_id, id, piece, n_tokens, container) of every piece of every item, for each (pack_id, capacity). Without ``fill`` a container holds slots of one bucket only."""
    spark = sizes.sparkSession
    kind = sizes.schema[id_col].dataType.simpleString()
    if not capacities:
        return spark.createDataFrame([], f"pack_id int, id {kind}, piece int, n_tokens long, container long")
    packs = F.array(*(F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("long").alias("capacity")) for p, c in capacities))
    items = sizes.select(F.col(id_col).alias("id"), F.col(size).cast("long").alias("n"), F.explode(packs).alias("p")).select("p.pack_id", "p.capacity", "id", "n")
    # The rest of an item over the capacity, or all of it; 0 where the item fills its containers exactly.
    items = items.withColumn("full", F.expr("n div capacity")).withColumn("rest", F.expr("CASE WHEN n = 0 THEN 1 ELSE n % capacity END"))
    histogram = items.groupBy("pack_id", "capacity", "rest").agg(F.count("*").alias("c"), F.sum("full").alias("f")).toPandas()
    buckets, slots, bases, parts = [], [], [], {}
    for p, capacity in capacities:
        h = histogram[(histogram.pack_id == p) & (histogram.rest > 0)].sort_values("rest")
        parts[p] = max(8, int(h.c.sum()) // PART_ROWS)
        if len(h):
            sz, c = h.rest.to_numpy(np.int64), h.c.to_numpy(np.int64)
            ends = choose_buckets(sz, c, most)
            of = np.searchsorted(ends, sz)
            buckets += [(p, int(a), int(b)) for a, b in zip(sz, of)]
            plan = lay_out(ends, np.bincount(of, c, len(ends)).astype(np.int64), capacity, fill)
            slots += [(p, *row) for row in plan]
            bases.append((p, max(x[4] + (x[2] - x[1]) // x[3] for x in plan)))
        else:
            bases.append((p, 0))
    bucket = F.broadcast(spark.createDataFrame(buckets, "pack_id int, rest long, bucket int"))
    slot = F.broadcast(spark.createDataFrame(slots, "pack_id int, bucket int, since long, until long, uses long, base long"))
    base = F.broadcast(spark.createDataFrame([(p, b, parts[p]) for p, b in bases], "pack_id int, first_full long, parts long"))
    rests = items.where("rest > 0").join(bucket, ["pack_id", "rest"]).join(base, "pack_id").withColumn("part", F.expr("pmod(xxhash64(id), parts)"))
    ranked = _ranked(rests, ["pack_id", "bucket"])
    placed = ranked.join(slot, ["pack_id", "bucket"]).where("rank >= since AND rank < until")
    ends = placed.select("pack_id", "id", F.col("full").cast("int").alias("piece"), F.expr("CASE WHEN n = 0 THEN 0 ELSE rest END").alias("n_tokens"), F.expr("base + (rank - since) div uses").alias("container"))
    wholes = items.where("full > 0").join(base, "pack_id").withColumn("part", F.expr("pmod(xxhash64(id), parts)"))
    wholes = _ranked(wholes, ["pack_id"], "full").select("pack_id", "id", F.posexplode(F.expr("sequence(0L, full - 1)")).alias("piece", "k"), F.col("capacity").alias("n_tokens"), (F.col("first_full") + F.col("rank")).alias("at"))
    wholes = wholes.select("pack_id", "id", "piece", "n_tokens", (F.col("at") + F.col("piece")).alias("container"))
    return ends.unionByName(wholes)


def _ranked(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """``df`` with the exact rank (or weight before it) of each row in its group, by part and id; offsets of parts come from their counts."""
    w = F.col(weight) if weight else F.lit(1)
    counts = df.groupBy(*keys, "part").agg(F.sum(w).alias("tm_n"))
    offsets = counts.withColumn("tm_before", F.sum("tm_n").over(Window.partitionBy(*keys).orderBy("part")) - F.col("tm_n")).drop("tm_n")
    inside = F.sum(w).over(Window.partitionBy(*keys, "part").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)) - w
    return df.withColumn("tm_inside", inside).join(offsets, [*keys, "part"]).withColumn("rank", F.col("tm_inside") + F.col("tm_before")).drop("tm_inside", "tm_before")


def pack_texts(df: DataFrame, id_col: str, text: str, capacities: list[tuple[int, int]], path: str = TOKENIZER) -> DataFrame:
    return pack(cut(token_counts(df, id_col, text, path), "tokens"), capacities)
