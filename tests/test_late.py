from datetime import datetime, timedelta

import pytest

from tidemark.operators.lateness import LateAggregates
from tidemark.streaming.late import stream_late_aggregates

T0 = datetime(2026, 1, 5, 10, 20)
END = datetime(2026, 1, 5, 11)
COLUMNS = ("i", "k", "event", "arrival", "n")
SCHEMA = "i string, k string, event timestamp, arrival timestamp, n int, id string, key string, verdict string"


def row(i, arrival, n=1, k="a", event=T0):
    return (i, k, event, arrival, n, "clash", "clash", "clash")


ROWS = [
    row("1", END), row("2", END + timedelta(minutes=10)), row("3", END + timedelta(minutes=10, microseconds=1)), row("4", END + timedelta(hours=48)), row("5", END + timedelta(hours=48, microseconds=1), 50),
    row("1", END + timedelta(hours=60)), row("3", END + timedelta(hours=99), 7), row("6", T0 - timedelta(hours=1), None), row("7", None), row("8", END, event=None), row(None, END), row("9", END, k=None),
]


def state_of(s):
    return {(r["id"], r["key"]): r["verdict"] for r in s.read("arrivals").collect()}, sorted(tuple(r)[:6] for r in s.read("periods").drop("revision", "updated_at").collect())


def test_verdicts_and_boundaries(spark):
    s = LateAggregates(spark).apply(spark.createDataFrame(ROWS, SCHEMA), *COLUMNS)
    verdicts, periods = state_of(s)
    assert verdicts == {("1", "a"): "on_time", ("2", "a"): "on_time", ("3", "a"): "corrected", ("4", "a"): "corrected", ("5", "a"): "too_late", ("6", "a"): "on_time"}
    assert periods == [("a", datetime(2026, 1, 5, 10), 3, 5, 4, 1)]
    assert [r["id"] for r in s.diverted().collect()] == ["5"]


@pytest.mark.parametrize("cutpoints", [[4], [1, 6], [11]])
def test_increments_in_any_order_give_the_same_state(spark, cutpoints):
    whole = state_of(LateAggregates(spark).apply(spark.createDataFrame(ROWS, SCHEMA), *COLUMNS))
    for rows in (ROWS, ROWS[::-1]):
        s, at = LateAggregates(spark), [0, *cutpoints, len(rows)]
        for a, b in zip(at, at[1:]):
            s = s.apply(spark.createDataFrame(rows[a:b], SCHEMA), *COLUMNS)
        assert state_of(s) == whole


def test_upserts_name_only_changed_periods(spark):
    s = LateAggregates(spark).apply(spark.createDataFrame([row("1", END), row("2", END, k="b")], SCHEMA), *COLUMNS)
    s = s.apply(spark.createDataFrame([row("3", END + timedelta(hours=2))], SCHEMA), *COLUMNS)
    (u,) = s.upserts().collect()
    assert (u["key"], u["first_count"], u["final_count"]) == ("a", 1, 2)
    assert s.read("periods").count() == 2


def test_empty(spark):
    s = LateAggregates(spark).apply(spark.createDataFrame([], SCHEMA), *COLUMNS)
    assert s.read("arrivals").count() == s.read("periods").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for i in range(3):
        spark.createDataFrame(ROWS[4 * i : 4 * i + 4], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    seen = []
    query, now = stream_late_aggregates(stream, LateAggregates(spark, f"{tmp_path}/state"), COLUMNS, f"{tmp_path}/cp", upsert=lambda d, n: seen.append(d.count()))
    query.awaitTermination(60)
    query.stop()
    assert now().version == len(seen) > 1
    assert state_of(now()) == state_of(LateAggregates(spark).apply(df, *COLUMNS))


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    """The second process has neither the first one's objects nor its counters: only folder and checkpoint."""
    schema = spark.createDataFrame(ROWS, SCHEMA).schema

    def run(rows, k):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        diverted = []
        query, now = stream_late_aggregates(stream, LateAggregates.latest(spark, f"{tmp_path}/state"), COLUMNS, f"{tmp_path}/cp", divert=lambda d, n: diverted.extend(r["id"] for r in d.collect()))
        query.awaitTermination(60)
        query.stop()
        return now(), diverted

    first, gone = run(ROWS[:5], 0)
    assert first.version == 1 and gone == ["5"]
    second, gone = run(ROWS[5:], 1)
    assert second.version == 2 and gone == []
    assert state_of(second) == state_of(LateAggregates(spark).apply(spark.createDataFrame(ROWS, SCHEMA), *COLUMNS))


def test_a_version_is_applied_once(spark, tmp_path):
    s = LateAggregates(spark, f"{tmp_path}/s").apply(spark.createDataFrame(ROWS[:3], SCHEMA), *COLUMNS)
    again = LateAggregates(spark, f"{tmp_path}/s").apply(spark.createDataFrame(ROWS, SCHEMA), *COLUMNS, version=1)
    assert state_of(again) == state_of(s)
    # A failed increment leaves files without a manifest: the next try writes them again.
    spark.range(1).write.parquet(f"{tmp_path}/s/arrivals/version=2/day=2000-01-01")
    t = s.apply(spark.createDataFrame(ROWS[3:], SCHEMA), *COLUMNS)
    assert state_of(t) == state_of(LateAggregates(spark).apply(spark.createDataFrame(ROWS, SCHEMA), *COLUMNS))


def test_only_touched_days_are_rewritten_and_old_ones_leave(spark, tmp_path):
    day = timedelta(days=1)
    old, new = row("1", END), row("2", END + 9 * day, event=T0 + 9 * day)
    s = LateAggregates(spark, f"{tmp_path}/s", retain=5 * day).apply(spark.createDataFrame([old], SCHEMA), *COLUMNS)
    t = s.apply(spark.createDataFrame([row("3", END + day, event=T0 + day)], SCHEMA), *COLUMNS)
    assert t.manifest["arrivals"] == {"2026-01-05": 1, "2026-01-06": 2} == t.manifest["periods"]
    u = t.apply(spark.createDataFrame([new], SCHEMA), *COLUMNS)
    assert list(u.manifest["arrivals"]) == ["2026-01-14"] and len(u.manifest["periods"]) == 3
    v = u.apply(spark.createDataFrame([row("9", END)], SCHEMA), *COLUMNS)
    assert [r["id"] for r in v.diverted().collect()] == ["9"] and v.read("periods").count() == 3
