"""Texts that look the same: one canonical text per class (problem 1).

Texts are mapped by ``charform.lookalikes`` and grouped, in SQL, under Spark's accent- and case-sensitive ``UNICODE``
collation, which equates canonically equivalent sequences and ignores invisible characters. The canonical member of a
class is its member with the fewest characters outside ASCII, separate accents counting twice, then the smallest by code point; it is joined back.

Collation sorts are dear, so rows are first blocked by a hash of their mapped letters and digits, which texts of one
class share; only blocks with two different texts go on. Copies of a text are one form, so a hot text costs one row.

Defined results: a null text has no class and a null canonical text; an empty text is a class of its own; repeated rows
stay in ``canonical_forms``; ties go by code point. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_name
from .charform import NON_ASCII, lookalikes


def _mapped(c: Column) -> Column:
    return F.when(c.rlike(NON_ASCII), lookalikes(c)).otherwise(c)


def _block(mapped: Column) -> Column:
    return F.xxhash64(F.regexp_replace(mapped, r"[^\p{L}\p{N}]+", ""))


def look_classes(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(forms, rows): the distinct texts of every class that has more than one, and the rows that hold them.

    forms: class_id, form_id, form, canonical_text. rows: the columns ``keep`` and form_id.
    """
    spark = df.sparkSession
    rows = df.where(F.col(text).isNotNull()).select(*(F.col(c) for c in keep or []), F.col(text).alias("tm_form")).withColumn("tm_mapped", _mapped(F.col("tm_form")))
    rows = rows.select(*(keep or []), "tm_form", F.xxhash64("tm_form").alias("form_id"), _block(F.col("tm_mapped")).alias("tm_block"))
    blocks = rows.groupBy("tm_block").agg(F.min("form_id").alias("lo"), F.max("form_id").alias("hi")).where("lo <> hi").select("tm_block")
    rows = rows.join(blocks, "tm_block", "left_semi")
    forms = rows.groupBy("form_id").agg(F.first("tm_form").alias("form"))
    forms = forms.withColumn("mapped", _mapped(F.col("form"))).withColumn("cost", F.length(F.regexp_replace("form", r"[\x00-\x7F]+", "")) + F.length(F.regexp_replace("form", r"[^\u0300-\u036F]+", "")))
    forms = spark.sql(
        """WITH classes AS (
             SELECT mapped COLLATE UNICODE AS look, min(struct(cost, form, form_id)) AS best
             FROM {forms} GROUP BY mapped COLLATE UNICODE HAVING min(form_id) <> max(form_id))
           SELECT c.best.form_id AS class_id, f.form_id, f.form, c.best.form AS canonical_text
           FROM {forms} f JOIN classes c ON f.mapped COLLATE UNICODE = c.look""",
        forms=forms,
    )
    return forms, rows.select(*(keep or []), "form_id")


def canonical_forms(df: DataFrame, text: str = "text", out: str = "canonical_text") -> DataFrame:
    """``df`` with the canonical text of each row's class in ``out``."""
    forms, _ = look_classes(df, text)
    key, best = fresh_name(df, "tm_id"), fresh_name(df, "tm_canonical")
    better = forms.where("form_id <> class_id").select(F.col("form_id").alias(key), F.col("canonical_text").alias(best))
    joined = df.withColumn(key, F.xxhash64(text)).join(better, key, "left")
    return joined.withColumn(out, F.coalesce(best, text)).drop(key, best)


def lookalike_pairs(df: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """Pairs (a, b), a < b, of different ids whose texts look the same but differ in code points.

    Forms are paired before rows, so only rows of different forms meet: the work is that of writing the result.
    """
    forms, rows = look_classes(df, text, [id_col])
    rows = rows.distinct()
    forms = forms.select("class_id", "form_id")
    pairs = forms.alias("f").join(forms.alias("g"), (F.col("f.class_id") == F.col("g.class_id")) & (F.col("f.form_id") < F.col("g.form_id"))).select(F.col("f.form_id").alias("tm_f"), F.col("g.form_id").alias("tm_g"))
    one = rows.select(F.col(id_col).alias("tm_a"), F.col("form_id").alias("tm_f"))
    two = rows.select(F.col(id_col).alias("tm_b"), F.col("form_id").alias("tm_g"))
    met = pairs.join(one, "tm_f").join(two, "tm_g").where("tm_a <> tm_b")
    return met.select(F.least("tm_a", "tm_b").alias("a"), F.greatest("tm_a", "tm_b").alias("b")).distinct()
