"""Text expressions. Regular expressions follow Python's classes where Java's differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
WORD = r"\p{L}\p{N}_"
DEVANAGARI = "ऀ-ॿ"


def nfc(c: Column) -> Column:
    """Composed form by ICU, which is on Spark's own class path; ASCII is composed already."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))).otherwise(c)


def collapse(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"(?U){SPACE}+", " "), "^ | $", "")


def clean_text(c: Column) -> Column:
    """Composed, without URLs, white space collapsed."""
    return collapse(F.regexp_replace(nfc(c), r"(?U)(?:https?://|www\.)[^\s\x1c-\x1f]+", ""))


def normalize_for_features(c: Column) -> Column:
    return F.lower(c)


def lang_hint(c: Column) -> Column:
    """'mixed', 'hi' or 'en' by the scripts in the text: Devanagari and ASCII letters."""
    hindi, latin = c.rlike(rf"[ऀ-ॿ]"), c.rlike("[A-Za-z]")
    return F.when(hindi & latin, "mixed").when(hindi, "hi").otherwise("en")


def strip_markup(c: Column) -> Column:
    return collapse(F.regexp_replace(c, "<[^>]+>", " "))


def hashtags(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(rf"#([{WORD}]+)"), F.lit(1)), lambda t: F.lower(t))))


def mentions(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(rf"@([{WORD}]+)"), F.lit(1))))


def status_link(c: Column) -> Column:
    """struct(username, tweet_id) of a status link, null where there is none."""
    pattern = r"/([A-Za-z0-9_]{1,15})/status/(\d+)"
    return F.when(c.rlike(pattern), F.struct(F.regexp_extract(c, pattern, 1).alias("username"), F.regexp_extract(c, pattern, 2).alias("tweet_id")))


def parse_count(c: Column) -> Column:
    """'1.2K' -> 1200, '3,401' -> 3401, '12.7' -> 12, '' -> 0; other texts give their digits."""
    text = F.upper(F.regexp_replace(F.trim(c), ",", ""))
    number = F.regexp_extract(text, r"^([0-9]*\.?[0-9]+)[KMB]?$", 1)
    scale = F.when(text.endswith("K"), 1_000).when(text.endswith("M"), 1_000_000).when(text.endswith("B"), 1_000_000_000).otherwise(1)
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(number != "", (number.cast("double") * scale).cast("long")).when(digits != "", digits.try_cast("long")).otherwise(F.lit(0).cast("long"))


def card_timestamp(c: Column) -> Column:
    """'Aug 4, 2026 · 12:59 PM UTC'."""
    return F.try_to_timestamp(collapse(F.regexp_replace(F.regexp_replace(c, "·", " "), r"UTC\s*$", "")), F.lit("MMM d, yyyy h:mm a"))


def rss_timestamp(c: Column) -> Column:
    """RFC 2822 dates; the weekday is not looked at."""
    plain = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    named = F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss zzz"))
    return F.coalesce(F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss xx")), named)


def iso_timestamp(c: Column) -> Column:
    """ISO 8601 with seconds optional; without an offset it is UTC. Anything else is null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"), c.try_cast("timestamp"))


def content_hash(*values: Column) -> Column:
    """SHA-256 of the values, separated by U+001F; nulls count as empty."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(v.cast("string"), F.lit("")) for v in values)), 256)


def reject_bucket(reason: Column) -> Column:
    """A file-name-safe name of a rejection's kind: what stands before the colon."""
    name = F.regexp_replace(F.split_part(reason, F.lit(":"), F.lit(1)), "[^A-Za-z0-9_]+", "_")
    return F.when((name == "") | name.isNull(), "unknown").otherwise(name)
