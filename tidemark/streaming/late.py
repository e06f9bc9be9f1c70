"""The late-event aggregates over a stream: each micro-batch is one increment of the keyed state."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.lateness import LateAggregates, _fs


def _base(state: LateAggregates, checkpoint: str) -> int:
    """The version the stream of this checkpoint began from, kept beside the state so that a restart counts on from the same one."""
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    fs, where = _fs(state.spark, f"{state.path}/streams/{name}")
    if fs.exists(where):
        return int("".join(r[0] for r in state.spark.read.text(f"{state.path}/streams/{name}").collect()))
    out = fs.create(where, True)
    out.write(str(state.version).encode())
    out.close()
    return state.version


def stream_late_aggregates(stream: DataFrame, state: LateAggregates, columns: tuple[str, ...], checkpoint: str, upsert: Callable[[DataFrame, int], None] | None = None, divert: Callable[[DataFrame, int], None] | None = None) -> tuple[StreamingQuery, Callable[[], LateAggregates]]:
    """Run ``stream`` to its present end. ``upsert`` gets the periods a micro-batch changed, ``divert`` its rows beyond the cut-off.

    Micro-batch n of a checkpoint is version base + n + 1 of the state in its folder, whatever process runs it: a restart
    goes on from the last version, and a batch that is run again after a failure is not applied twice. Returns the query and
    a function that gives the state as it is now.
    """
    base = _base(state, checkpoint)

    def increment(batch: DataFrame, number: int) -> None:
        after = state.at(base + number).apply(batch, *columns, version=base + number + 1)
        if upsert:
            upsert(after.upserts(), number)
        if divert:
            divert(after.diverted(), number)

    query = stream.writeStream.foreachBatch(increment).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query, lambda: LateAggregates.latest(state.spark, state.path, period=state.rule[0], grace=state.rule[1], cutoff=state.rule[2], retain=state.retain)
