"""Sharding by balanced label propagation.

Documents with the same link key are neighbours.  Every document starts in a
hashed shard; in each round the linked documents move towards the shard most
of their neighbours are in, as far as the shards' quotas allow; groups that
are still apart in the end are placed whole.  Documents without neighbours can be anywhere, so they fill up what the linked ones
leave; shard sizes then differ by one row at most.

All documents of a group are neighbours of each other, so their labels are
kept as counts per (group, shard): a round is two aggregations over those
counts, however large a group is.  Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from trainyard.llm.common import bucket_count, running_start, written

SALTS = 4096


def text_size() -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def text_crc() -> Column:
    return F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8"))


def accepted_shares(flow: list[list[int]], room: Sequence[int]
                    ) -> list[float]:
    """Share of the proposals each shard accepts: as many as it has room for
    with the rows that leave it in the same round.  ``flow[s][t]``: rows of
    shard s that are to be in t."""
    n = len(room)
    load = [sum(row) for row in flow]
    demand = [sum(flow[s][t] for s in range(n) if s != t) for t in range(n)]
    share = [1.0] * n
    for _ in range(200):
        out = [sum(flow[s][t] * share[t] for t in range(n) if t != s)
               for s in range(n)]
        new = [min(share[t], max(0.0, room[t] - load[t] + out[t]) / demand[t])
               if demand[t] else 0.0 for t in range(n)]
        if max((a - b for a, b in zip(share, new)), default=0.0) < 1e-6:
            return new
        share = new
    return share


def propagate(labels: DataFrame, room: Sequence[int], rounds: int = 8,
              seed: int = 8) -> DataFrame:
    """Label propagation under quotas.

    ``labels`` has (g, s, n): n documents of group g are in shard s, which
    may hold ``room[s]`` of them.  Each round every (g, s) proposes to join
    the shard in which most of g is (ties: a hash of g and shard); a shard
    accepts as large a share of the proposals as it has room for, rows that
    leave it counted as room, and of a proposal of n documents that share
    moves (rounded by a hash).  Ends when next to nobody can move, after
    ``rounds`` rounds at the latest; groups that are then still apart are
    for the caller to place whole."""
    n_shards = len(room)
    for k in range(rounds):
        rank = F.struct("n", F.xxhash64("g", "s", F.lit(seed)), "s")
        best = labels.groupBy("g").agg(F.max(rank).alias("b")).select(
            "g", F.col("b.s").alias("t"))
        wish = labels.join(best, "g")
        flow = [[0] * n_shards for _ in range(n_shards)]
        for r in (wish.groupBy("s", "t").agg(F.sum("n").alias("n"))
                  .collect()):  # n_shards squared rows at most
            flow[r.s][r.t] = r.n
        share = accepted_shares(flow, room)
        apart = sum(map(sum, flow)) - sum(flow[s][s] for s in range(n_shards))
        moving = sum(flow[s][t] * share[t] for s in range(n_shards)
                     for t in range(n_shards) if s != t)
        if moving < max(1.0, apart / 100):
            break
        accepted = F.element_at(F.array(*map(F.lit, share)), F.col("t") + 1)
        dice = F.pmod(F.xxhash64("g", "s", F.lit(seed + 1 + k)),
                      F.lit(1 << 20)) / F.lit(float(1 << 20))
        moved = F.when((F.col("s") == F.col("t")) | (accepted == 0), F.lit(0)) \
            .otherwise(F.least(F.floor(F.col("n") * accepted + dice),
                               F.col("n"))).cast("long")
        pairs = F.array(F.struct("s", (F.col("n") - moved).alias("n")),
                        F.struct(F.col("t").alias("s"), moved.alias("n")))
        labels = written(
            wish.select("g", F.inline(pairs)).where("n > 0")
            .groupBy("g", "s").agg(F.sum("n").alias("n")), "shard-labels")
    return labels


class Shelf:
    """Open places of the shards, for a few groups that are put one by one:
    whole into the shard they fill best, in pieces only if none has room."""

    def __init__(self, free: Sequence[int], slot: Sequence[int]):
        self.free, self.slot = list(free), list(slot)
        self.places: list[tuple] = []   # (g, shard, lf, lt, slot0)

    def put(self, g: object, n: int) -> None:
        shards, at = range(len(self.free)), 0
        while at < n:
            fits = [s for s in shards if self.free[s] >= n - at]
            s = min(fits, key=lambda s: self.free[s]) if fits else \
                max(shards, key=lambda s: self.free[s])
            took = min(n - at, self.free[s])
            self.places.append((g, s, at, at + took, self.slot[s]))
            self.free[s] -= took
            self.slot[s] += took
            at += took


def shard_documents(docs: DataFrame, n_shards: int = 8,
                    link: Column | None = None,
                    keep: Sequence[str] = ("doc_id",), rounds: int = 8,
                    seed: int = 8) -> DataFrame:
    """Assign every row of ``docs`` (doc_id, text, ...) to a shard.

    ``link`` is the key that linked documents share (default: the text's
    SHA-256, so equal texts are linked).  Returns the columns ``keep`` plus
    size, text_crc32, shard (int, from 0) and slot (long, gapless from 0 in
    each shard).  Row counts of shards differ by one at most.  A group that
    fits goes into one shard; one larger than a shard fills shards one after
    the other.  Null text counts as no bytes and equals the empty text; null
    and repeated doc_ids are rows like any other; an empty table gives an
    empty result; other columns are ignored unless named in ``keep``.

    Groups that fit are split only if whole ones leave no shard with room for
    them: less than ``n_shards`` of them, whatever share of the rows is
    linked."""
    spark = docs.sparkSession
    # columns named like the new ones are replaced
    keep = [c for c in keep if c.lower() not in (
        "size", "text_crc32", "shard", "slot")]
    if link is None:
        link = F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)
    salt = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(SALTS)).cast("int")
    # named apart from the caller's columns
    rows = docs.select(*[F.col(c) for c in keep],
                       F.struct(text_size().alias("size"),
                                text_crc().alias("crc"), link.alias("g"),
                                salt.alias("salt")).alias("__s"))
    counts = written(docs.select(link.alias("g"), salt.alias("salt"))
                     .groupBy("g", "salt").agg(F.count("*").alias("n")),
                     "shard-counts")
    n_rows = counts.agg(F.sum("n")).first()[0] or 0
    buckets = bucket_count(spark, n_rows)
    by_hash = F.pmod(F.xxhash64("g", F.lit(seed)), F.lit(buckets)).alias("b")

    grouped = counts.groupBy("g").agg(F.sum("n").alias("n_g"))
    quota = [n_rows // n_shards + (s < n_rows % n_shards)
             for s in range(n_shards)]
    # groups larger than any shard: less than n_shards
    shelf = Shelf(quota, [0] * n_shards)
    large = grouped.where(F.col("n_g") > F.lit(max(quota)))
    for r in sorted(large.collect(), key=lambda r: (-r.n_g, str(r.g))):
        shelf.put(r.g, r.n_g)
    linked = grouped.where((F.col("n_g") > 1)
                           & (F.col("n_g") <= F.lit(max(quota))))
    labels = propagate(
        written(counts.join(linked, "g")
                .groupBy("g", F.pmod("salt", F.lit(n_shards)).cast("int")
                         .alias("s")).agg(F.sum("n").alias("n")),
                "shard-labels"), shelf.free, rounds, seed)

    def pick(values: Sequence[int], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]),
                            at + 1)

    # groups that are together take places [p, p + n) of their shard; those
    # that reach over its end, and those still apart, go on whole
    groups = labels.groupBy("g").agg(
        F.count("*").alias("k"), F.min("s").alias("s"),
        F.sum("n").alias("n")).select("g", "k", "s", "n", by_hash)
    groups = written(groups, "shard-chunks")
    placed = running_start(groups.where("k = 1"), ["s"], "b", ["g"], "n", "p")
    placed = written(placed.withColumn(
        "kept", F.col("p") + F.col("n") <= pick(shelf.free, F.col("s"))),
        "shard-placed")
    kept = [0] * n_shards
    for r in placed.where("kept").groupBy("s").agg(
            F.sum("n").alias("k")).collect():
        kept[r.s] = r.k
    together = placed.where("kept").select(
        "g", F.col("s").alias("shard"), F.lit(0).cast("long").alias("lf"),
        F.col("n").alias("lt"),
        (pick(shelf.slot, F.col("s")) + F.col("p")).alias("slot0"))

    def fill(rest: DataFrame, free: list[int], name: str) -> DataFrame:
        """Places of ``rest`` (g, n, b), in one order, in the shards' open
        places in turn: (g, n, p, shard, d0, d1), a row per shard reached."""
        line = running_start(written(rest.withColumn("all", F.lit(0)), name),
                             ["all"], "b", ["g"], "n", "p")
        spans, at = [], 0
        for s, f in enumerate(free):
            spans.append(F.struct(F.lit(s).alias("shard"),
                                  F.lit(at).cast("long").alias("d0"),
                                  F.lit(at + f).cast("long").alias("d1")))
            at += f
        return (line.select("g", "n", "p", F.inline(F.array(*spans)))
                .where((F.col("p") < F.col("d1"))
                       & (F.col("p") + F.col("n") > F.col("d0"))))

    shelf.free = [f - k for f, k in zip(shelf.free, kept)]
    shelf.slot = [a + k for a, k in zip(shelf.slot, kept)]
    found = written(fill(
        groups.where("k > 1").select("g", "n", "b").unionByName(
            placed.where("not kept").select("g", "n", "b")),
        shelf.free, "shard-rest"), "shard-filled")
    inside = (F.col("p") >= F.col("d0")) \
        & (F.col("p") + F.col("n") <= F.col("d1"))
    first, used = [0] * n_shards, [0] * n_shards
    for r in found.where(inside).groupBy("shard").agg(
            F.min(F.col("p") - F.col("d0")).alias("p"),
            F.sum("n").alias("n")).collect():
        first[r.shard], used[r.shard] = r.p, r.n
    later = found.where(inside).select(
        "g", "shard", F.lit(0).cast("long").alias("lf"),
        F.col("n").alias("lt"),
        (pick(shelf.slot, F.col("shard")) + F.col("p") - F.col("d0")
         - pick(first, F.col("shard"))).alias("slot0"))
    # groups over an end: less than n_shards
    shelf.free = [f - k for f, k in zip(shelf.free, used)]
    shelf.slot = [a + k for a, k in zip(shelf.slot, used)]
    over = found.where(~inside).select("g", "n").distinct()
    for r in sorted(over.collect(), key=lambda r: (-r.n, str(r.g))):
        shelf.put(r.g, r.n)

    # documents without neighbours fill what is left
    alone = fill(grouped.where("n_g = 1").select(
        "g", F.lit(1).cast("long").alias("n"), by_hash),
        shelf.free, "shard-alone").select(
        "g", "shard", F.lit(0).cast("long").alias("lf"),
        F.col("n").alias("lt"), (pick(shelf.slot, F.col("shard"))
                                 + F.col("p") - F.col("d0")).alias("slot0"))
    few = spark.createDataFrame(shelf.places, StructType([
        counts.schema["g"], StructField("shard", IntegerType()),
        *[StructField(c, LongType()) for c in ("lf", "lt", "slot0")]]))
    places = (together.unionByName(later).unionByName(alone)
              .unionByName(few))

    # ranks of documents in their group: per salt, so that a large group is
    # ranked by many tasks
    by_salt = Window.partitionBy("g").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select("g", "salt", "n", F.coalesce(
        F.sum("n").over(by_salt), F.lit(0)).alias("base"))
    places = (bases.join(places, "g")
              .where("lf < base + n and lt > base")
              .select(F.col("g").alias("__g"), F.col("salt").alias("__salt"),
                      "base", "lf", "lt", "slot0",
                      F.col("shard").alias("__shard")))
    places = written(places, "shard-places")
    places = places.select("__g", "__salt", F.struct(
        "base", "lf", "lt", "slot0", "__shard").alias("__p"))
    rank = Window.partitionBy("__g", "__salt").orderBy("__h", *[
        F.col(c) for c in keep if c == "doc_id"])
    ranked = rows.select(
        *keep, "__s", F.col("__s.g").alias("__g"),
        F.col("__s.salt").alias("__salt"),
        F.xxhash64(*[F.col(c) for c in keep]).alias("__h")
    ).withColumn("__rn", F.row_number().over(rank) - 1)
    at = F.col("__p.base") + F.col("__rn")
    return (ranked.join(places, ["__g", "__salt"])
            .where((at >= F.col("__p.lf")) & (at < F.col("__p.lt")))
            .select(*keep, F.col("__s.size").alias("size"),
                    F.col("__s.crc").alias("text_crc32"),
                    F.col("__p.__shard").alias("shard"),
                    (F.col("__p.slot0") + at - F.col("__p.lf"))
                    .cast("long").alias("slot")))


def cut_edges(sharded: DataFrame, link: str = "text_crc32") -> DataFrame:
    """Links inside and across shards by row of ``sharded``: for each shard
    the pairs of linked documents it holds, and over all shards the pairs
    that are cut (report for tuning; counts only, no pair is built)."""
    per = sharded.groupBy(link, "shard").agg(F.count("*").alias("n"))
    whole = per.groupBy(link).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("inside"))
    return whole.agg(
        F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("links"),
        F.sum(F.col("n") * (F.col("n") - 1) / 2 - F.col("inside"))
        .cast("long").alias("cut"))


def op8_query(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs`` under the law ``rows``."""
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"))
