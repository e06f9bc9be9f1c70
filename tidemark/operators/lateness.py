"""Aggregates by event time that late arrivals correct, up to a cut-off (problem 4).

An event under a key counts once, at its first arrival. It belongs to the period of its event time. Arrivals up to
``grace`` after the period's end count in the period's first result; later ones, up to ``cutoff`` after the end, correct
it; those beyond are left out and diverted. State is keyed by (id, key) and by (key, period). An increment may be a
micro-batch of a stream or a whole table: increments merge to the same state in any order. An event seen again with an
earlier arrival is taken out and put in again.

State lives in a shared folder, laid out by day. An increment rewrites the days it touches and no others, and its version
exists once its manifest is written; an increment that failed leaves the version before it as it was, and one that is run
again under its number is not applied twice. The watermark, the latest arrival so far, is part of the state: with ``retain``
the days before watermark - retain leave the arrivals (their results stay), and rows that come for them are diverted.
Without it no key is ever forgotten, so that an event read again after weeks is not taken for a late one.

Defined results: rows without an id, a key or one of the times are ignored; ties in arrival go to the earlier event time;
repeated rows count once; null measures count as 0. An arrival before its event (clock skew) is on time.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

PERIOD, GRACE, CUTOFF = "1 hour", "10 minutes", "48 hours"


def first_arrivals(df: DataFrame, id_col: str, key_col: str, event: str, arrival: str, measure: str | None = None) -> DataFrame:
    """(id, key, event_at, arrived_at, amount), one row per (id, key)."""
    ok = df.where(F.col(id_col).isNotNull() & F.col(key_col).isNotNull() & F.col(event).isNotNull() & F.col(arrival).isNotNull())
    amount = F.coalesce(F.col(measure).cast("long"), F.lit(0).cast("long")) if measure else F.lit(0).cast("long")
    first = F.min(F.struct(F.col(arrival).alias("arrived_at"), F.col(event).alias("event_at"), amount.alias("amount"))).alias("f")
    return ok.groupBy(F.col(id_col).alias("id"), F.col(key_col).alias("key")).agg(first).select("id", "key", "f.event_at", "f.arrived_at", "f.amount")


def verdicts(arrivals: DataFrame, period: str = PERIOD, grace: str = GRACE, cutoff: str = CUTOFF) -> DataFrame:
    """``arrivals`` with period_start and verdict: on_time, corrected or too_late."""
    end = F.window("event_at", period)
    timed = arrivals.withColumn("tm_w", end).withColumn("period_start", F.col("tm_w.start"))
    verdict = F.expr(f"CASE WHEN arrived_at <= tm_w.end + INTERVAL {grace} THEN 'on_time' WHEN arrived_at <= tm_w.end + INTERVAL {cutoff} THEN 'corrected' ELSE 'too_late' END")
    return timed.withColumn("verdict", verdict).drop("tm_w")


def _deltas(judged: DataFrame) -> DataFrame:
    """(key, period_start) -> signed changes, for rows with ``sign``."""
    on, fix = F.col("verdict") == "on_time", F.col("verdict") == "corrected"
    counted = F.when(on | fix, F.col("sign")).otherwise(0)
    return judged.groupBy("key", "period_start").agg(
        F.sum(F.when(on, F.col("sign")).otherwise(0)).alias("first_count"),
        F.sum(counted).alias("final_count"),
        F.sum(counted * F.col("amount")).alias("final_amount"),
        F.sum(F.when(F.col("verdict") == "too_late", F.col("sign")).otherwise(0)).alias("dropped"),
        F.max(F.when(on | fix, F.col("arrived_at"))).alias("updated_at"),
    )


SUMS = ("first_count", "final_count", "final_amount", "dropped")
PERIODS = "key {k}, period_start timestamp, first_count long, final_count long, final_amount long, dropped long, updated_at timestamp, revision int"
ARRIVALS = "id {i}, key {k}, event_at timestamp, arrived_at timestamp, amount long, period_start timestamp, verdict string"


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


class LateAggregates:
    """The state after some increments: ``arrivals`` by (id, key) and ``periods`` by (key, period_start)."""

    def __init__(self, spark: SparkSession, path: str | None = None, version: int = 0, period: str = PERIOD, grace: str = GRACE, cutoff: str = CUTOFF, retain: timedelta | None = None):
        self.spark, self.path, self.version, self.rule, self.retain = spark, (path or scratch(spark, "late")).rstrip("/"), version, (period, grace, cutoff), retain
        self.manifest: dict = self._load() if version else {"arrivals": {}, "periods": {}, "watermark": None, "id": "string", "key": "string"}

    @classmethod
    def latest(cls, spark: SparkSession, path: str, **rule) -> LateAggregates:
        """The last version in the folder ``path``, or an empty state."""
        fs, where = _fs(spark, f"{path.rstrip('/')}/manifests")
        done = [int(x.getPath().getName()) for x in fs.listStatus(where) if x.getPath().getName().isdigit()] if fs.exists(where) else []
        return cls(spark, path, max(done, default=0), **rule)

    def at(self, version: int) -> LateAggregates:
        return LateAggregates(self.spark, self.path, version, *self.rule, retain=self.retain)

    def committed(self, version: int) -> bool:
        fs, where = _fs(self.spark, f"{self.path}/manifests/{version}")
        return fs.exists(where)

    def _load(self) -> dict:
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.path}/manifests/{self.version}").collect()))

    def _schema(self, name: str) -> str:
        return (ARRIVALS if name == "arrivals" else PERIODS).format(i=self.manifest["id"], k=self.manifest["key"])

    def read(self, name: str, days: list[str] | None = None) -> DataFrame:
        """``arrivals`` or ``periods``, of all days or some."""
        places = self.manifest[name]
        paths = [f"{self.path}/{name}/version={v}/day={d}" for d, v in places.items() if days is None or d in days]
        if not paths:
            return self.spark.createDataFrame([], self._schema(name))
        return self.spark.read.schema(self._schema(name)).parquet(*paths)

    def apply(self, df: DataFrame, id_col: str, key_col: str, event: str, arrival: str, measure: str | None = None, version: int | None = None) -> LateAggregates:
        """The state with ``df`` merged in, as ``version`` (by default the next one). ``upserts`` of the new state has the periods that changed, ``diverted`` the rows of this increment beyond the cut-off."""
        version = version or self.version + 1
        if self.committed(version):
            return self.at(version)
        first = first_arrivals(df, id_col, key_col, event, arrival, measure)
        kinds = {"id": first.schema["id"].dataType.simpleString(), "key": first.schema["key"].dataType.simpleString()}
        self.manifest |= kinds if not self.version else {}
        stage = f"{self.path}/steps/{version}"
        judged = verdicts(first, *self.rule)
        if self.version:
            # An increment's row matters where its (id, key) is new or arrived earlier than the one that counted so far.
            was = self.read("arrivals").select("id", "key", F.col("arrived_at").alias("was_at"), F.col("event_at").alias("was_event"))
            judged = judged.join(was, ["id", "key"], "left").where("was_at IS NULL OR arrived_at < was_at OR (arrived_at = was_at AND event_at < was_event)")
        else:
            judged = judged.withColumn("was_event", F.lit(None).cast("timestamp"))
        judged.withColumn("day", _day("event_at")).write.mode("overwrite").parquet(f"{stage}/new")
        new = self.spark.read.parquet(f"{stage}/new")
        seen = new.agg(F.max("arrived_at").cast("double").alias("w")).first()["w"]
        watermark = max((x for x in (self.manifest["watermark"], seen) if x is not None), default=None)
        oldest = _oldest(watermark, self.retain)
        beyond = new.where(f"day < '{oldest}'")
        new = new.where(f"day >= '{oldest}'")
        new.where("verdict = 'too_late'").unionByName(beyond.withColumn("verdict", F.lit("too_late"))).drop("day", "was_event").write.mode("overwrite").parquet(f"{stage}/diverted")
        moved = new.select("day").union(new.where("was_event IS NOT NULL").select(_day("was_event"))).distinct()
        days = sorted(r[0] for r in moved.collect())
        columns = [c.split(" ")[0] for c in ARRIVALS.split(", ")]
        old = self.read("arrivals", days)
        kept = old.join(new.select("id", "key"), ["id", "key"], "left_anti")
        whole = kept.select(columns).unionByName(new.select(columns)).withColumn("day", _day("event_at"))
        whole.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/arrivals/version={version}")
        signed = new.select(*columns, F.lit(1).cast("long").alias("sign"))
        if self.version:
            signed = signed.unionByName(old.join(new.select("id", "key"), ["id", "key"], "left_semi").select(*columns, F.lit(-1).cast("long").alias("sign")))
        deltas = _deltas(signed).withColumn("day", _day("period_start"))
        deltas.write.mode("overwrite").parquet(f"{stage}/deltas")
        deltas = self.spark.read.schema(f"{PERIODS.format(k=kinds['key']).replace(', revision int', '')}, day string").parquet(f"{stage}/deltas")
        changed = sorted(r[0] for r in deltas.select("day").distinct().collect())
        every = self.read("periods", changed).unionByName(deltas.drop("day").withColumn("revision", F.lit(version)))
        merged = every.groupBy("key", "period_start").agg(*(F.sum(c).alias(c) for c in SUMS), F.max("updated_at").alias("updated_at"), F.max("revision").alias("revision"))
        merged.withColumn("day", _day("period_start")).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/periods/version={version}")
        arrivals = {d: v for d, v in self.manifest["arrivals"].items() if d >= oldest} | _written(self.spark, f"{self.path}/arrivals/version={version}", version)
        arrivals = {d: v for d, v in arrivals.items() if d not in days or v == version}
        periods = self.manifest["periods"] | _written(self.spark, f"{self.path}/periods/version={version}", version)
        manifest = {"arrivals": arrivals, "periods": periods, "watermark": watermark, **kinds}
        fs, where = _fs(self.spark, f"{self.path}/manifests/{version}")
        half = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/.half-{version}")
        out = fs.create(half, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        fs.rename(half, where)
        return self.at(version)

    def upserts(self) -> DataFrame:
        return self.read("periods").where(F.col("revision") == self.version)

    def diverted(self) -> DataFrame:
        """Rows of the last increment that came too late; those of all time are in ``arrivals``."""
        return self.spark.read.schema(self._schema("arrivals")).parquet(f"{self.path}/steps/{self.version}/diverted")


def _oldest(watermark: float | None, retain: timedelta | None) -> str:
    """The first day that is kept."""
    if watermark is None or retain is None:
        return ""
    return (datetime.fromtimestamp(watermark, timezone.utc) - retain).strftime("%Y-%m-%d")


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _written(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    """The days a partitioned write has left in ``path``."""
    fs, where = _fs(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return {n.removeprefix("day="): version for n in names if n.startswith("day=")}
