"""Raw JSON-lines records: scan, typed reading, cleaning, validation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

COUNTS = ("likes", "retweets", "replies")
RECORD = "tweet_id string, username string, created_at timestamp, collected_at timestamp, text string, text_normalized string, likes int, retweets int, replies int, mentions array<string>, hashtags array<string>, source_hashtag string, lang_hint string"


def scan_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(raw_line, ordinal) of every line of a folder's *.jsonl files, in file order. ``ordinal`` sorts by file, block and line."""
    raw = spark.read.option("pathGlobFilter", "*.jsonl").text(path).withColumnRenamed("value", "raw_line")
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return raw.select("raw_line", at.alias("ordinal"))


def _kind(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def parse(df: DataFrame, line: str = "raw_line") -> DataFrame:
    """``df`` with the record's fields as they stand, their JSON types, and ``parse_error``. Blank lines are dropped.

    Counts, texts and times keep JSON's types apart: a number is no text, while a text of digits is a count.
    """
    rows = df.where(F.col(line).isNotNull() & (T.collapse(F.col(line)) != "")).withColumn("tm_v", F.try_parse_json(line))
    kind = F.schema_of_variant("tm_v")
    error = F.when(F.col("tm_v").isNull(), "malformed_json: the line is no JSON").when(~kind.startswith("OBJECT"), "malformed_json: the line is no object")
    rows = rows.withColumn("parse_error", error).withColumn("tm_v", F.when(F.col("parse_error").isNull(), F.col("tm_v")))
    fields = {}
    for name in ("tweet_id", "username", "created_at", "collected_at", "text", "source_hashtag", *COUNTS, "mentions", "hashtags"):
        fields[f"k_{name}"] = _kind(F.col("tm_v"), name)
        fields[f"j_{name}"] = F.try_variant_get("tm_v", f"$.{name}", "string")
    for name in ("mentions", "hashtags"):
        fields[f"a_{name}"] = F.try_variant_get("tm_v", f"$.{name}", "array<string>")
        kinds = F.transform(F.try_variant_get("tm_v", f"$.{name}", "array<variant>"), lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID")))
        fields[f"bad_{name}"] = F.array_position(F.transform(kinds, lambda k: k != "STRING"), F.lit(True)) - 1
    return rows.withColumns(fields).drop("tm_v")


def _count(name: str) -> Column:
    """A count by lax rules: whole numbers, whole decimals, true and false, and texts of whole numbers."""
    k, j = F.col(f"k_{name}"), F.col(f"j_{name}")
    number = F.when(k == "BOOLEAN", F.when(j == "true", 1).otherwise(0).cast("decimal(38,6)")).when(k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL"), j.try_cast("decimal(38,6)")).when((k == "STRING") & F.trim(j).rlike(r"^[+-]?\d+(\.0+)?$"), F.trim(j).try_cast("decimal(38,6)"))
    return F.when(number == F.floor(number), number)


def _time(name: str) -> Column:
    k, j = F.col(f"k_{name}"), F.col(f"j_{name}")
    seconds = j.try_cast("double")
    epoch = F.timestamp_micros(F.when(F.abs(seconds) > 2e10, seconds * 1e3).otherwise(seconds * 1e6).cast("long"))
    return F.when(k == "STRING", T.iso_timestamp(j)).when(k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL"), epoch)


def clean(parsed: DataFrame) -> DataFrame:
    """The cleaned, typed record of every parsed line; what doesn't fit its type is null and ``invalid`` has the first field at fault."""
    text = F.when(F.col("k_text") == "STRING", T.clean_text(F.col("j_text")))
    values = {n: F.when(F.col(f"k_{n}") == "STRING", F.col(f"j_{n}")) for n in ("tweet_id", "username", "source_hashtag")}
    values |= {n: _time(n) for n in ("created_at", "collected_at")} | {"text": text} | {n: _count(n) for n in COUNTS}
    rows = parsed.withColumns(values)
    arrays = {n: F.when(F.col(f"k_{n}").startswith("ARRAY") & (F.col(f"bad_{n}") < 0), F.col(f"a_{n}")) for n in ("mentions", "hashtags")}
    rows = rows.withColumns(arrays).withColumns({"text_normalized": T.normalize_for_features(F.col("text")), "lang_hint": T.lang_hint(F.col("text"))})
    checks = []
    for name in ("tweet_id", "username", "created_at", "collected_at", "text", *COUNTS, "mentions", "hashtags", "source_hashtag"):
        c = F.col(name)
        bad = c.isNull()
        if name in ("tweet_id", "username", "text", "source_hashtag"):
            bad = bad | (c == "")
        elif name in COUNTS:
            bad = bad | (c < 0) | (c > 2147483647)
        label = F.lit(name)
        if name in ("mentions", "hashtags"):
            label = F.when(F.col(f"bad_{name}") >= 0, F.concat(F.lit(f"{name}."), F.col(f"bad_{name}").cast("string"))).otherwise(label)
        checks.append((label, F.coalesce(bad, F.lit(True))))
    reason = F.col("parse_error")
    fault = F.lit(None).cast("string")
    for name, bad in reversed(checks):
        fault = F.when(bad, F.concat(name, F.lit(": missing, empty or of a wrong type or range"))).otherwise(fault)
    rows = rows.withColumn("reject_reason", F.coalesce(reason, fault))
    return rows.withColumns({n: F.when(F.col(n).between(0, 2147483647), F.col(n).cast("int")) for n in COUNTS})


def within_lookback(created_at: Column, now: datetime | None, hours: float | None) -> Column:
    """True inside the last ``hours`` before ``now``; without hours, always. A null time is outside."""
    if hours is None:
        return F.lit(True)
    cutoff = F.lit(now) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
    return F.coalesce(created_at >= cutoff, F.lit(False))


def classify(cleaned: DataFrame, now: datetime | None = None, hours: float | None = None) -> DataFrame:
    """``cleaned`` with ``outcome``: rejected (no JSON), out_of_window, rejected (invalid), or valid; in that order of precedence."""
    inside = within_lookback(F.col("created_at"), now, hours)
    outcome = F.when(F.col("parse_error").isNotNull(), "rejected").when(~inside, "out_of_window").when(F.col("reject_reason").isNotNull(), "rejected").otherwise("valid")
    return cleaned.withColumn("outcome", outcome).withColumn("reject_bucket", F.when(F.col("outcome") == "rejected", T.reject_bucket(F.col("reject_reason"))))
