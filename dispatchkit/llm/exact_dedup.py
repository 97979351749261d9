"""Exact dedup with skew-safe combining (operator 7).

Rows are first merged inside each map task (the partial aggregate of a ``groupBy`` on digest,
whole text and salt), then per (digest, text, salt), and the salt winners are merged per
(digest, text). The text itself is part of every grouping key, so two texts are merged only
when they are identical, never because a digest says so; a digest that two different texts
share stops the job. A text that a third of all rows hold reaches a reducer as at most one row
per map task and salt. The answer returns to the rows over (digest, salt), so the rows of one
text are spread over ``salts`` keys on the way back as well.

Defined results: NULL text counts as empty; a NULL id is never the smallest unless the whole
group has none; rows that repeat both id and text count in ``group_size`` and exactly one of
them is kept; no rows in, no rows out; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANKS, whole_rows

SALTS = 64


def normalised(text: Column) -> Column:
    """Text with every run of blanks replaced by one space (NULL: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    norm = normalised(F.col(text_col))
    salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm"), salt.alias("salt")).withColumn(
        "digest", F.unhex(F.sha2("norm", 256)))
    per_salt = rows.groupBy("digest", "norm", "salt").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    per_text = (per_salt.repartition("digest").groupBy("digest", "norm")
                .agg(F.min("least").alias("least"), F.sum("n").alias("n")))
    winners = per_text.groupBy("digest").agg(F.min("least").alias("keep_id"), F.sum("n").alias("group_size"),
                                             F.count(F.lit(1)).alias("n_texts"))
    narrow = rows.select("id", "digest", "salt")
    answers = narrow.select("digest", "salt").distinct().join(winners, "digest")
    first = F.row_number().over(Window.partitionBy("digest", "salt", "id").orderBy("id")) == 1
    one_text = F.when(F.col("n_texts") > 1, F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")) \
        .otherwise(F.col("group_size"))
    return narrow.join(answers, ["digest", "salt"]).select(
        F.col("id").alias(id_col), "keep_id", one_text.alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per distinct text."""
    def keyed(row_id):          # no NULL among the keys: join and window then share one exchange of the rows
        return {"at": F.coalesce(row_id.cast("string"), F.lit("")), "known": row_id.isNotNull()}

    keep = exact_dedup(docs, id_col, text_col, salts).filter("kept").select(
        F.unhex("text_sha256").alias("sha"), *[c.alias(k) for k, c in keyed(F.col(id_col)).items()])
    rows = whole_rows(docs, sha=F.unhex(F.sha2(normalised(F.col(text_col)), 256)), **keyed(F.col(id_col)))
    kept = rows.join(keep, ["sha", "at", "known"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("sha", "at", "known").orderBy("known"))
    return kept.withColumn("nth", nth).filter("nth = 1").select("_row.*")
