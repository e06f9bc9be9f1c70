"""Pairs of items that occur together, kept up to date by signed deltas (problem 2).

A basket is an id with a set of tags. The persistent table holds baskets, pair counts, marginals and scores. When baskets
change, their old pairs and tags count -1 and their new ones +1; the deltas are summed per pair, so what didn't change
cancels, and merged into counts that are hash-bucketed by pair. Association scores are recomputed for pairs whose own
count or a marginal changed, and for no others: a score leaves out the number of baskets, which readers apply.

Baskets, counts and scores lie in buckets, as many as the first load asks for (``ROWS`` pairs each). A delta rewrites the
buckets that something changed in; a manifest, written last, says which version holds each bucket, so a step that failed
leaves the table as it was and ``PairTable.latest`` goes on from the folder in any session.

Defined results: null ids and null, empty or blank tags are dropped; repeated tags count once a basket; a basket without
tags counts as a basket; ``None`` for a basket's tags removes it. Pairs are ordered by code point, without pairs of a tag
with itself. Baskets of any size are counted whole: small ones expand in place, large ones by a join on parts of theirs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .charform import NON_ASCII, WIDTH_FROM, WIDTH_TO, nfc

#: Baskets or pairs of a bucket that the number of buckets is chosen for, the least and the most buckets there are, and the parts a bucket is written in beyond that.
ROWS, LEAST_BUCKETS, MOST_BUCKETS, MOST_PARTS = 100_000, 16, 4096, 1024
TABLES = {"baskets": "id string, tags array<string>", "counts": "tag_a string, tag_b string, n long", "scores": "tag_a string, tag_b string, n long, n_a long, n_b long, association double"}
#: Baskets of at most so many tags expand in place; larger ones take the join.
IN_PLACE = 64


def tag_form(tag: Column) -> Column:
    """Lower case, composed, normal width, without leading ``#`` and outer blanks."""
    wide = F.when(tag.rlike(NON_ASCII), nfc(F.translate(tag, WIDTH_FROM, WIDTH_TO))).otherwise(tag)
    return F.regexp_replace(F.lower(wide), r"^[\s#]+|\s+$", "")


def baskets(df: DataFrame, id_col: str, *tags: Column) -> DataFrame:
    """(id, tags): the distinct tags, ascending, of all rows of an id. ``tags`` are arrays."""
    every = F.concat(*(F.coalesce(t, F.array().cast("array<string>")) for t in tags))
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode_outer(F.array_distinct(F.transform(every, tag_form))).alias("tag"))
    one = rows.withColumn("tag", F.expr("CASE WHEN tag <> '' THEN tag END")).groupBy("id", "tag").agg(F.lit(1).alias("tm_n"))
    return one.groupBy("id").agg(F.array_sort(F.collect_list("tag")).alias("tags"))


def _pairs(b: DataFrame) -> DataFrame:
    """(tag_a, tag_b, sign) for (tags, sign)."""
    small = b.where(F.size("tags").between(2, IN_PLACE))
    heads = F.flatten(F.transform("tags", lambda t, i: F.transform(F.filter(F.col("tags"), lambda u: u > t), lambda u: F.struct(t.alias("tag_a"), u.alias("tag_b")))))
    near = small.select(F.explode(heads).alias("p"), "sign").select("p.tag_a", "p.tag_b", "sign")
    # A large basket is split: each part of its tags meets all of them under a key of its own.
    large = b.where(F.size("tags") > IN_PLACE).withColumn("parts", F.expr(f"int(ceil(size(tags) / {IN_PLACE}))"))
    left = large.select("id", "sign", "parts", F.explode("tags").alias("l")).withColumn("part", F.expr("pmod(xxhash64(l), parts)").cast("int"))
    right = large.select("id", "sign", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "tags").select("id", "sign", "part", F.explode("tags").alias("r"))
    far = left.join(right, ["id", "sign", "part"]).where("l < r").select(F.col("l").alias("tag_a"), F.col("r").alias("tag_b"), "sign")
    return near.groupBy("tag_a", "tag_b").agg(F.sum("sign").alias("n")).unionByName(far.groupBy("tag_a", "tag_b").agg(F.sum("sign").alias("n")))


class PairTable:
    """Pair counts, marginals and scores of a growing set of baskets, in numbered versions under one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, version: int = 0):
        self.spark, self.path, self.version = spark, (path or scratch(spark, "pairs")).rstrip("/"), version
        self.manifest = json.loads("".join(r[0] for r in spark.read.text(f"{self.path}/manifests/{version}").collect())) if version else {"buckets": 0, "parts": 1, "id": "string", **{t: {} for t in TABLES}}

    @classmethod
    def latest(cls, spark: SparkSession, path: str) -> PairTable:
        fs, where = _fs(spark, f"{path.rstrip('/')}/manifests")
        done = [int(x.getPath().getName()) for x in fs.listStatus(where) if x.getPath().getName().isdigit()] if fs.exists(where) else []
        return cls(spark, path, max(done, default=0))

    def _schema(self, name: str) -> str:
        return TABLES[name].replace("id string", f"id {self.manifest['id']}")

    def read(self, name: str, buckets: list[str] | None = None) -> DataFrame:
        """``baskets``, ``counts`` or ``scores``, of all buckets or some; ``marginals`` or ``total``."""
        if name not in TABLES:
            return self.spark.read.parquet(f"{self.path}/{name}/version={self.version}")
        paths = [f"{self.path}/{name}/version={v}/bucket={b}" for b, v in self.manifest[name].items() if buckets is None or b in buckets]
        return self.spark.read.schema(self._schema(name)).parquet(*paths) if paths else self.spark.createDataFrame([], self._schema(name))

    def _bucket(self, *columns: str, of: int) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(of)).cast("int").alias("bucket")

    def _put(self, df: DataFrame, name: str, version: int, of: int, *key: str) -> dict[str, int]:
        """Write the buckets that ``df`` holds whole; a bucket goes to as many tasks as the manifest's parts say."""
        at = f"{self.path}/{name}/version={version}"
        columns = [c.split(" ")[0] for c in TABLES[name].split(", ")]
        part = F.pmod(F.xxhash64(F.lit(1), *key), F.lit(self.manifest["parts"]))
        df.select(*columns, self._bucket(*key, of=of)).repartition("bucket", part).write.mode("overwrite").partitionBy("bucket").parquet(at)
        fs, where = _fs(self.spark, at)
        names = [x.getPath().getName() for x in fs.listStatus(where)]
        return {n.removeprefix("bucket="): version for n in names if n.startswith("bucket=")}

    def apply(self, changed: DataFrame) -> PairTable:
        """The table after ``changed`` (id, tags), which replaces the baskets it names."""
        version, step = self.version + 1, f"{self.path}/steps/{self.version + 1}"
        kept = {t: dict(self.manifest[t]) for t in TABLES}
        kind = changed.schema["id"].dataType.simpleString() if not self.version else self.manifest["id"]
        self.manifest["id"] = kind
        changed.select("id", "tags").write.mode("overwrite").parquet(f"{step}/changed")
        changed = self.spark.read.parquet(f"{step}/changed")
        signed = changed.where("tags IS NOT NULL").select("id", "tags", F.lit(1).cast("long").alias("sign"))
        if self.version:
            old = self.read("baskets").join(changed.select("id"), "id", "left_semi")
            signed = signed.unionByName(old.select("id", "tags", F.lit(-1).cast("long").alias("sign")))
        _pairs(signed).groupBy("tag_a", "tag_b").agg(F.sum("n").alias("n")).where("n <> 0").write.mode("overwrite").parquet(f"{step}/pairs")
        signed.select(F.explode("tags").alias("tag"), "sign").groupBy("tag").agg(F.sum("sign").alias("n")).where("n <> 0").write.mode("overwrite").parquet(f"{step}/tags")
        pairs, tags = self.spark.read.parquet(f"{step}/pairs"), self.spark.read.parquet(f"{step}/tags")
        if not self.version:
            rows = max(pairs.count(), changed.count())
            of = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows // ROWS)))
            self.manifest |= {"buckets": of, "parts": min(MOST_PARTS, max(1, rows // (ROWS * of)))}
        of = self.manifest["buckets"]
        total, marginals = signed.agg(F.coalesce(F.sum("sign"), F.lit(0).cast("long")).alias("n")), tags
        if self.version:
            total = total.union(self.read("total")).agg(F.sum("n").alias("n"))
            marginals = self.read("marginals").unionByName(tags).groupBy("tag").agg(F.sum("n").alias("n")).where("n > 0")
        total.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/total/version={version}")
        marginals.write.mode("overwrite").parquet(f"{self.path}/marginals/version={version}")
        marginals = self.spark.read.parquet(f"{self.path}/marginals/version={version}")

        def touched(df: DataFrame, *key: str) -> list[str]:
            return sorted(str(r[0]) for r in df.select(self._bucket(*key, of=of)).distinct().collect())

        # Baskets and counts: the buckets that hold a changed one.
        where = touched(changed, "id")
        baskets = self.read("baskets", where).join(changed.select("id"), "id", "left_anti").unionByName(changed.where("tags IS NOT NULL"))
        kept["baskets"] = {b: v for b, v in kept["baskets"].items() if b not in where} | self._put(baskets, "baskets", version, of, "id")
        where = touched(pairs, "tag_a", "tag_b")
        counts = self.read("counts", where).unionByName(pairs).groupBy("tag_a", "tag_b").agg(F.sum("n").alias("n")).where("n > 0")
        kept["counts"] = {b: v for b, v in kept["counts"].items() if b not in where} | self._put(counts, "counts", version, of, "tag_a", "tag_b")
        after = PairTable.__new__(PairTable)
        after.spark, after.path, after.version, after.manifest = self.spark, self.path, version, {"buckets": of, "parts": self.manifest["parts"], "id": kind, **kept}
        # Scores: also the buckets of pairs with a changed marginal.
        stale = pairs.select("tag_a", "tag_b")
        if self.version:
            held = after.read("counts").select("tag_a", "tag_b")
            for side in ("tag_a", "tag_b"):
                stale = stale.unionByName(held.join(tags.select(F.col("tag").alias(side)), side, "left_semi").select("tag_a", "tag_b"))
            stale = stale.distinct()
        where = touched(stale, "tag_a", "tag_b")
        still = self.read("scores", where).join(stale, ["tag_a", "tag_b"], "left_anti")
        again = after.read("counts", where).join(stale, ["tag_a", "tag_b"], "left_semi") if self.version else after.read("counts", where)
        again = again.join(marginals.select(F.col("tag").alias("tag_a"), F.col("n").alias("n_a")), "tag_a").join(marginals.select(F.col("tag").alias("tag_b"), F.col("n").alias("n_b")), "tag_b")
        again = again.withColumn("association", F.col("n") / (F.col("n_a").cast("double") * F.col("n_b")))
        columns = [c.split(" ")[0] for c in TABLES["scores"].split(", ")]
        scores = still.select(columns).unionByName(again.select(columns))
        kept["scores"] = {b: v for b, v in kept["scores"].items() if b not in where} | self._put(scores, "scores", version, of, "tag_a", "tag_b")
        fs, where = _fs(self.spark, f"{self.path}/manifests/{version}")
        half = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/.half-{version}")
        out = fs.create(half, True)
        out.write(json.dumps(after.manifest | kept).encode())
        out.close()
        fs.rename(half, where)
        return PairTable(self.spark, self.path, version)

    def scores(self) -> DataFrame:
        """(tag_a, tag_b, n, n_a, n_b, n_baskets, lift). The lift is the stored association times the number of baskets, divided last so that it is right to the last digit."""
        total = self.read("total").first()["n"] or 0
        return self.read("scores").select("tag_a", "tag_b", "n", "n_a", "n_b", F.lit(total).cast("long").alias("n_baskets"), (F.col("n") * F.lit(float(total)) / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"))

    def associated(self, least: int = 5, one_in: int = 500, lift: int = 3) -> DataFrame:
        """Pairs in at least ``least`` baskets, one in ``one_in`` baskets, and ``lift`` times as often as chance; in whole numbers."""
        return self.scores().where(f"n >= {least} AND n * {one_in} >= n_baskets AND cast(n AS decimal(19)) * n_baskets >= cast({lift} AS decimal(19)) * n_a * n_b")


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where
