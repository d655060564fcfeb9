"""Mixing sources to target weights.

The words of each source, document after document in a hashed order, are
packed into blocks of a fixed length.  The mix is a sequence of slots, one
block each, cut into output shards.  The slots of all sources are dealt to
the output shards by one pseudorandom permutation, so the source counts of a
shard are multinomial draws, conditioned on the corpus totals: no source
drifts from its target.  Slot i of a source takes block perm(i mod blocks) in
pass i div blocks, with another permutation for each pass; joining blocks by
index gives the words.  Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trainyard.llm.common import (bucket_count, permuted, running_start,
                                  written)

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3.0
BLOCK_WORDS = 512
SHARD_SLOTS = 1024
# Slots a single row is expanded to at most, before rows are dealt again.
RUN = 4096
SLOTS_PER_TASK = 1_000_000


def text_words() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   cap: float = CAP) -> DataFrame:
    """Targets in words of (skey, source, source_size) rows.

    Sources by code point, null last, weigh ``weights`` in turn.  Shares of
    the total that are above ``cap`` times the source's size stop there, and
    the excess goes to the others by weight until none is above: in the order
    of cap/weight, the first sources are capped and the others share what is
    left.  One row per source is sorted in one task; documents are not."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     F.pmod(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(
                         F.col("source").asc_nulls_last())) - 1,
                         F.lit(len(weights))) + 1)
    s = (sizes.withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(float(cap))))
    by = Window.partitionBy(F.lit(0)).orderBy(
        F.col("cap") / F.col("weight"), "skey")
    upto = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    s = s.withColumn("level", (
        F.sum("source_size").over(whole).cast("double")
        - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        / F.sum("weight").over(after))
    s = s.withColumn("is_capped",
                     F.col("level") * F.col("weight") > F.col("cap"))
    # the level of the first source that is not capped holds for all others
    s = s.withColumn("level", F.first(
        F.when(~F.col("is_capped"), F.col("level")), ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return s.select(
        "skey", "source", "source_size", "weight",
        F.when(F.col("is_capped"), F.col("cap")).otherwise(
            F.col("level") * F.col("weight")).alias("target"))


def row_key() -> list[Column]:
    """Hash and size of a row: which row of the table it is, but for equal
    rows."""
    return [F.xxhash64("doc_id", "text", F.lit(5)).alias("h"),
            text_words().alias("size")]


def source_key() -> Column:
    """The source, without nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")),
                      F.lit("null")).alias("skey")


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS,
                cap: float = CAP, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, seed: int = 5
                ) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, text, source): returns (packed, mix).

    ``packed``, a row per row: doc_id, skey, off (the row's place in its
    source's words; null if it has none), size, h (a hash of the row),
    source_size, target.  ``mix``, a row per stretch of a document in a slot:
    shard, slot (place in the shard), skey, block, pass, off, w_from, w_to
    (words of the document, from 0).

    A source takes round(target) words: whole passes over all its blocks,
    then blocks in permuted order until the rest is met; the last block is
    cut.  No document is taken more than ``cap`` times.  Null text has no
    words; documents without words are never taken; null source is a source
    of its own; repeated rows are packed one after the other; an empty table
    gives empty results; other columns are ignored."""
    spark = docs.sparkSession
    rows = written(docs.select("doc_id", "source", source_key(), *row_key()),
                   "mix-rows")
    buckets = bucket_count(spark, rows.count())
    rows = rows.withColumn("b", F.pmod(F.xxhash64("h", F.lit(seed)),
                                       F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("skey").agg(
        F.first("source").alias("source"),
        F.sum("size").alias("source_size"))
    b = F.lit(block_words).cast("long")
    plan = source_targets(sizes, weights, cap)
    full = F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size")),
        F.floor(F.lit(float(cap))))).otherwise(0).cast("long")
    plan = plan.withColumn("full", full).withColumn(
        "blocks", F.ceil(F.col("source_size") / b).cast("long"))
    rest = F.least(
        F.col("source_size"), F.round(F.col("cap_words") - F.col("full")
                                      * F.col("source_size")).cast("long"))
    plan = (plan.withColumn("cap_words", F.least(
        F.col("target"), F.col("source_size") * F.lit(float(cap))))
        .withColumn("rest", F.greatest(F.lit(0).cast("long"), rest)))
    # the short last block may be among the blocks of the last pass: one more
    plan = plan.withColumn("short_at", F.when(F.col("blocks") > 0, permuted(
        F.col("blocks") - 1, F.greatest(F.col("blocks"), F.lit(1)),
        [F.col("skey"), F.col("full"), F.lit(seed)], inverse=True)))
    plan = plan.withColumn("draws", F.col("full") * F.col("blocks")
                           + F.when(F.col("rest") > 0, F.least(
                               F.col("blocks"), F.ceil(F.col("rest") / b) + 1))
                           .otherwise(0)).withColumn(
        "draws", F.col("draws").cast("long"))
    every = Window.partitionBy(F.lit(0))
    plan = plan.withColumn("base", F.coalesce(F.sum("draws").over(
        every.orderBy("skey").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).withColumn("slots", F.sum("draws").over(every))
    plan = written(plan, "mix-plan")

    # the plan is a few rows, the slots it grows to are not: their number
    # sets the tasks, and neither side of the join may be taken for small
    total = plan.agg(F.max("slots")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                total // SLOTS_PER_TASK)
    n = F.col("blocks")
    block = permuted(F.col("i") % n, n, [
        F.col("skey"), (F.col("i") / n).cast("long"), F.lit(seed)])
    last = F.col("source_size") - (n - 1) * b
    length = F.when(F.col("block") == n - 1, last).otherwise(b)
    j = F.col("i") - F.col("full") * n
    before = j * b - F.when(j > F.col("short_at"), b - last).otherwise(0)
    take = F.when(j < 0, length).otherwise(F.greatest(
        F.lit(0), F.least(length, F.col("rest") - before)))
    draws = (plan.where("draws > 0")
             .withColumn("i0", F.explode(F.sequence(
                 F.lit(0).cast("long"), F.col("draws") - 1,
                 F.lit(RUN).cast("long"))))
             .repartition(tasks, "skey", "i0")
             .withColumn("i", F.explode(F.sequence(
                 F.col("i0"), F.least(F.col("i0") + RUN, F.col("draws")) - 1)))
             .withColumn("block", block).withColumn("take", take.cast("long"))
             .withColumn("place", permuted(
                 F.col("base") + F.col("i"), F.col("slots"),
                 [F.lit("slots"), F.lit(seed)]))
             .where("take > 0")
             .select("skey", "block", "take",
                     F.floor(F.col("i") / n).cast("int").alias("pass"),
                     F.floor(F.col("place") / shard_slots).alias("shard"),
                     (F.col("place") % shard_slots).alias("slot")))

    at = running_start(rows, ["skey"], "b", ["h", "doc_id", "size"], "size",
                       "off")
    packed = written(at.join(
        plan.select("skey", "source_size", "target"), "skey").select(
        "doc_id", "skey", F.when(F.col("size") > 0, F.col("off")).alias("off"),
        "size", "h", "source_size", "target"), "mix-packed")
    pieces = (packed.where("off is not null").select("skey", "off", "size")
              .withColumn("block", F.explode(F.sequence(
                  F.floor(F.col("off") / b),
                  F.floor((F.col("off") + F.col("size") - 1) / b)))))
    lo = F.greatest(F.col("off"), F.col("block") * b)
    hi = F.least(F.col("off") + F.col("size"),
                 F.col("block") * b + F.col("take"))
    mix = (pieces.hint("merge").join(draws.hint("merge"), ["skey", "block"])
           .where(hi > lo)
           .select("shard", "slot", "skey", "block", "pass", "off",
                   (lo - F.col("off")).alias("w_from"),
                   (hi - F.col("off")).alias("w_to")))
    return packed, mix


def taken_words(packed: DataFrame, mix: DataFrame) -> DataFrame:
    """Words the mix takes of every row, repeats counted."""
    sums = mix.groupBy("skey", "off").agg(
        F.sum(F.col("w_to") - F.col("w_from")).alias("taken"))
    return packed.join(sums, ["skey", "off"], "left").select(
        "doc_id", "size", F.col("source_size").cast("long")
        .alias("source_size"), "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, packed: DataFrame, mix: DataFrame
                    ) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: for every document
    and pass over its source one row with the words taken in that pass.  A
    document taken whole keeps its text as it is; of others the taken words
    are joined by single spaces.  n_chars, if there, is that of the new text.
    Texts are shuffled once."""
    runs = mix.groupBy("skey", "off", "pass").agg(
        F.sort_array(F.collect_list(F.struct("w_from", "w_to"))).alias("runs"))
    # equal rows of a source are told apart by their order only
    same = Window.partitionBy("h", "size", "skey").orderBy("off")
    runs = (packed.where("off is not null")
            .withColumn("n", F.row_number().over(same))
            .join(runs, ["skey", "off"])
            .select(F.struct("h", "size", "skey", "n", "runs").alias("__m")))
    rows = docs.withColumn("__r", F.struct(*row_key(), source_key()))
    same = Window.partitionBy("__r.h", "__r.size", "__r.skey").orderBy(
        "source")
    rows = rows.withColumn("__n", F.row_number().over(same))
    # as two comparisons: the window's partitioning serves the join as well
    got = rows.join(runs, (F.col("__r.h") == F.col("__m.h"))
                    & (F.col("__r.size") == F.col("__m.size"))
                    & (F.col("__r.skey") == F.col("__m.skey"))
                    & (F.col("__n") <= F.col("__m.n"))
                    & (F.col("__n") >= F.col("__m.n")))
    taken = F.aggregate("__m.runs", F.lit(0).cast("long"),
                        lambda a, r: a + r["w_to"] - r["w_from"])
    whole = taken == F.col("__m.size")
    # a leading separator gives an empty first word
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    got = got.withColumn("__words", F.when(~whole, words))
    part = F.array_join(F.flatten(F.transform("__m.runs", lambda r: F.slice(
        F.col("__words"), (r["w_from"] + 1).cast("int"),
        (r["w_to"] - r["w_from"]).cast("int")))), " ")
    got = got.withColumn("__text", F.when(whole, F.col("text"))
                         .otherwise(part))
    new = {"text": F.col("__text"),
           "n_chars": F.char_length("__text").cast("long")}
    return got.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def op5_query(docs: DataFrame) -> DataFrame:
    return taken_words(*mix_sources(docs))
