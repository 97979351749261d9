"""Mixing sources to target weights with a low-discrepancy schedule (operator 2).

Targets. Sources in code point order (NULL last) get the weights in turn; ``factor`` times all
words is shared by weight, a source takes at most ``cap`` times its own words, and the excess is
shared again among the others. The fixed point of that sharing is ``min(cap * size, level *
weight)`` for one water level, found with running sums over the sources ordered by
``size / weight``.

Schedule. Each source is shuffled (order of a keyed digest), laid end to end and cut into blocks
of ``block_words`` words. Its target needs a whole number of slots (its last one cut short).
Slot positions are van der Corput points: the sources' slot counts, laid end to end, form the
cumulative weights over [0, N); point number i of the base-2 sequence of 2**m >= N points is the
bit reversal of i, points past N are void. Every source thus gets exactly its slots, evenly
spread over the whole mix. Slots are ranked per source in mix order, rank k takes block
``k mod blocks`` (epoch ``k div blocks``), and the blocks' documents are joined.

Ranks and running sums are two-level (buckets of slots or of digests, then a running sum over
one row per bucket), so a source that holds a third of all rows is split over many tasks. The
joins are equi-joins on (source, block), with at most ``block_words`` rows a key.

Defined results: NULL text has 0 words; a document without words has no piece; NULL is a source
of its own; an empty table gives an empty mix; repeated rows are documents of their own; further
columns are ignored. The digest is keyed by seed and id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, whole_rows, word_count

WEIGHTS = (5, 2, 1)
FACTOR = 1.5
CAP = 2
BLOCK_WORDS = 1024
ROWS_PER_BUCKET = 2048
SLOTS_PER_BUCKET = 4096


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = 0) -> DataFrame:
    """Narrow stored table: id, source, size in words and the 32-bit shuffle key."""
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))),
                             1, 8), 16, 10).cast("long")
    return materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   word_count(F.col(text_col)).alias("size"), key.alias("h")), "mix-sized")


def targets(rows: DataFrame, weights=WEIGHTS, factor: float = FACTOR, cap: int = CAP,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: size, target, blocks, slots and the first point of its interval."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_source) - 1,
                                                                         F.lit(len(weights))) + 1).cast("int"))
    per = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("weight", weight).withColumn("ratio", F.col("source_size") * cap / F.col("weight"))
           .withColumn("total", F.sum("source_size").over(everything) * F.lit(factor))
           .withColumn("spent", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)))
           .withColumn("left_weight", F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("level", F.max((F.col("total") - F.col("spent")) / F.col("left_weight")).over(everything))
           .withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), F.col("level") * F.col("weight"))))
    words = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0)
    rest = F.col("quota") - F.col("whole") * F.col("source_size")
    per = (per.withColumn("quota", words).withColumn("whole", whole)
           .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
           .withColumn("slots", F.col("whole") * F.col("blocks") + F.ceil(rest / block_words)))
    first = F.coalesce(F.sum("slots").over(by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.select("source", source_key().alias("skey"), "source_size", "target", "quota", "blocks",
                      "slots", first.alias("first_point"), F.sum("slots").over(everything).alias("n_slots"))


def source_key() -> Column:
    """A source as a join key that is never NULL."""
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))


def placed(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Each document's first word position in its source's shuffled stream.

    Buckets are ranges of the shuffle key, so many that one holds about ``ROWS_PER_BUCKET`` rows
    even if all rows are of one source; the windows run per (source, bucket)."""
    bits = max(0, min(32, (max(rows.count(), 1) // ROWS_PER_BUCKET).bit_length()))
    d = rows.select("*", source_key().alias("skey"), F.shiftright("h", 32 - bits).alias("bucket"))
    inside = Window.partitionBy("skey", "bucket").orderBy("h", "doc_id", "size")
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("skey", "bucket").agg(F.sum("size").alias("n")).select(
        "skey", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return (d.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .join(sums, ["skey", "bucket"])
            .join(per_source.select("skey", "source_size", "target", "quota", "blocks"), "skey")
            .select("doc_id", "source", "skey", "size", "source_size", "target", "quota", "blocks",
                    (F.col("base") + F.col("upto") - F.col("size")).alias("start")))


def slot_schedule(per_source: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(source, block) -> slot number in the mix, epoch and the words the slot takes."""
    bits = F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.col("n_slots"), F.lit(1)).cast("double")))).cast("int")
    runs = per_source.filter("slots > 0").withColumn("m", bits).withColumn("run", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(slots - 1) div {SLOTS_PER_BUCKET}")))).repartition("skey", "run")
    point = runs.withColumn("j", F.explode(F.sequence(F.col("run") * SLOTS_PER_BUCKET, F.least(
        F.col("slots"), (F.col("run") + 1) * SLOTS_PER_BUCKET) - 1))).withColumn("point", F.col("first_point") + F.col("j"))
    slot = F.conv(F.reverse(F.expr("lpad(bin(point), m, '0')")), 2, 10).cast("long")
    s = point.withColumn("slot", slot).withColumn("bucket", F.expr(f"slot div {SLOTS_PER_BUCKET}"))
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = s.groupBy("skey", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "skey", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("skey", "bucket").orderBy("slot")) - 1
    s = (s.withColumn("in_bucket", rank).join(sums, ["skey", "bucket"]).withColumn("rank", F.col("base") + F.col("in_bucket"))
         .withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks")))
    from_word = F.col("block") * block_words
    upto = F.least(from_word + block_words, F.col("source_size"), F.col("quota") - F.col("epoch") * F.col("source_size"))
    return s.select("skey", "block", "slot", "epoch", from_word.alias("block_from"), upto.alias("block_upto"))


def mix_pieces(where: DataFrame, schedule: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: one row per document piece of each slot; ``word_from`` counts in the document."""
    cut = where.filter("size > 0").withColumn("block", F.explode(F.sequence(
        F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
    lo, hi = F.greatest("start", "block_from"), F.least(F.col("start") + F.col("size"), F.col("block_upto"))
    return (cut.join(schedule, ["skey", "block"]).withColumn("n_words", hi - lo).filter("n_words > 0")
            .select("slot", "doc_id", "source", "skey", "start", "size", "epoch", "block",
                    (lo - F.col("start")).alias("word_from"), "n_words"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, factor: float = FACTOR, cap: int = CAP, block_words: int = BLOCK_WORDS,
                seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(placed documents with their source's target, pieces of the mix in slot order)."""
    rows = sized(docs, id_col, text_col, source_col, seed)
    per_source = targets(rows, weights, factor, cap, block_words)
    where = placed(rows, per_source)
    return where, mix_pieces(where, slot_schedule(per_source, block_words), block_words)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per document: id, size, its source's size and target, and the words the mix takes."""
    where, mix = mix_sources(docs, **options)
    taken = mix.groupBy("skey", "start").agg(F.sum("n_words").alias("taken"),
                                             F.sum(F.when(F.col("word_from") == 0, 1).otherwise(0)).alias("copies"))
    has = where.filter("size > 0").join(taken, ["skey", "start"], "left")
    none = where.filter("size = 0").withColumn("taken", F.lit(None).cast("long")).withColumn("copies", F.lit(None).cast("long"))
    return has.unionByName(none.select(has.columns)).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("copies", F.lit(0)).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` as the mix uses them, whole: a row appears once for every epoch in which the
    mix takes its first word (a document that the end of the mix cuts is kept whole). A row
    whose id repeats is used as often as the row of that id the mix uses most."""
    copies = (taken_words(docs, id_col=id_col, **options).filter("copies > 0").groupBy(F.col("doc_id").alias("mix_id"))
              .agg(F.max("copies").alias("copies")))
    return (whole_rows(docs, id=F.col(id_col)).join(copies, F.col("id").eqNullSafe(F.col("mix_id")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*"))
