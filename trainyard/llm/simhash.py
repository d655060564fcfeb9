"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is made of the XXH64 of a text's word shingles; texts
are linked where fingerprints differ in a few bits.  Candidates come from a
covering code: 46 of the 64 bits are read as two words of the perfect binary
Golay code [23, 12, 7], whose 2**24 pairs of code words are the anchors.  Every
fingerprint has one home anchor within the covering radius (3 bits per word).
Each is replicated to all anchors within the radius plus the threshold, so a
fingerprint that differs in at most ``max_bits`` bits from another meets it at
the other's home.  Full fingerprints are compared per anchor, in one equi-join
over distinct fingerprints: copies are one row, and large anchors are split as
any skewed join.  Components of the links come from star contraction rounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trainyard.llm.common import LOWER, spread_join, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
FINGERPRINTS_PER_TASK = 100_000
RADIUS = 3          # of the Golay code: every 23-bit word is that near
GOLAY = 0b110001110101  # fixed value: generator polynomial of degree 11


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text: a bit is 1 if it is set in over half of the
    shingles' hashes; 0 for a text without words or null."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, 65536):
        h = np.array([digest(line[a:b], SEED) for a, b in
                      zip(starts[i:i + 65536], ends[i:i + 65536])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE,
                 keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and fp (long: the fingerprint's bits) of every
    row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle)
                              for t in batch.column("text")),
                             np.uint64, len(batch)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(fp)],
                [*keep, "fp"])

    rows = docs.select(*keep, F.col("text").cast("string"))
    return rows.mapInArrow(run, rows.drop("text").schema.add("fp", "long"))


@lru_cache(maxsize=4)
def _golay(extra: int):
    """Tables over the 2**11 syndromes of the [23, 12] code: the syndrome of
    each bit, the coset leader, and all code words within RADIUS + extra of
    the leader as (error, distance) lists."""
    def times(m: int) -> int:
        out = 0
        for i in range(12):
            if m >> i & 1:
                out ^= GOLAY << i
        return out

    code = np.array([times(m) for m in range(1 << 12)], np.int64)
    # remainder of x**i by the generator polynomial
    column = []
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        column.append(r)
    leader = np.zeros(1 << 11, np.int64)
    for a in range(23):
        leader[column[a]] = 1 << a
        for b in range(a):
            leader[column[a] ^ column[b]] = 1 << a | 1 << b
            for c in range(b):
                leader[column[a] ^ column[b] ^ column[c]] = \
                    1 << a | 1 << b | 1 << c
    offsets, errors, far = [0], [], []
    for e in leader:
        d = np.bitwise_count(code ^ e).astype(np.int64)
        near = np.flatnonzero(d <= RADIUS + extra)
        near = near[np.argsort(d[near], kind="stable")]
        errors.append(code[near] ^ e)
        far.append(np.maximum(0, d[near] - RADIUS))
        offsets.append(offsets[-1] + len(near))
    return (np.array(column, np.int64), leader, np.array(offsets),
            np.concatenate(errors), np.concatenate(far).astype(np.int64))


def _syndrome(y: np.ndarray, column: np.ndarray) -> np.ndarray:
    s = np.zeros(len(y), np.int64)
    for i, c in enumerate(column):
        s ^= np.where(y >> i & 1, c, 0)
    return s


def anchors(fp: np.ndarray, max_bits: int, home: bool
            ) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of fingerprints as (index into fp, anchor).  ``home``: the one
    within the covering radius; else all within radius plus ``max_bits``."""
    column, leader, offsets, errors, extra = _golay(max_bits)
    mask = (1 << 23) - 1
    y1, y2 = fp & mask, fp >> 23 & mask
    s1, s2 = _syndrome(y1, column), _syndrome(y2, column)
    if home:
        return (np.arange(len(fp)),
                (y1 ^ leader[s1]) | (y2 ^ leader[s2]) << 23)
    n1 = offsets[s1 + 1] - offsets[s1]
    i = np.repeat(np.arange(len(fp)), n1)
    k = np.arange(len(i)) - np.repeat(np.cumsum(n1) - n1, n1) \
        + offsets[s1][i]
    c1, e1 = y1[i] ^ errors[k], extra[k]
    n2 = (offsets[s2 + 1] - offsets[s2])[i]
    j = np.repeat(np.arange(len(i)), n2)
    k = np.arange(len(j)) - np.repeat(np.cumsum(n2) - n2, n2) \
        + offsets[s2][i][j]
    ok = e1[j] + extra[k] <= max_bits
    j, k = j[ok], k[ok]
    return i[j], c1[j] | (y2[i[j]] ^ errors[k]) << 23


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints (column fp) that differ
    in ``max_bits`` bits at most, each once."""
    # each fingerprint becomes some sixty rows: deal them out first
    n = distinct.count()
    width = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.select("fp").repartition(
        max(width, n // FINGERPRINTS_PER_TASK), "fp")

    def dealt(home: bool):
        def run(batches: Iterator[pa.RecordBatch]
                ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fp = batch.column("fp").to_numpy(zero_copy_only=False)
                for i in range(0, len(fp), 500):
                    part = fp[i:i + 500]
                    at, anchor = anchors(part, max_bits, home)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(part[at])],
                        ["anchor", "u" if home else "v"])
        return (distinct.select("fp") if home else spread).mapInArrow(
            run, f"anchor long, {'u' if home else 'v'} long")

    return (dealt(True).join(dealt(False), "anchor")
            .where("u < v and bit_count(u ^ v) <= " + str(int(max_bits)))
            .select("u", "v"))


def forest(edges: DataFrame) -> DataFrame:
    """Per task, a spanning forest of its edges: same components, at most one
    edge for each node of the task.  Keeps links of dense groups few."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := root.setdefault(x, x)) != x:
                root[x] = x = root[p]
            return x

        for batch in batches:
            kept_u, kept_v = [], []
            for u, v in zip(batch.column("u").to_pylist(),
                            batch.column("v").to_pylist()):
                a, b = find(u), find(v)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    kept_u.append(u)
                    kept_v.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept_u, pa.int64()), pa.array(kept_v, pa.int64())],
                ["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node it
    reaches.  Star contraction: in turn, each node hands its larger
    neighbours (large star) and its smaller ones (small star) to the smallest
    node it knows, until only stars are left.  Each round is written."""
    edges = written(forest(edges).where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "star-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"),
                                              F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(
            F.min("v").alias("m"), F.count("*").alias("_n")).select(
            F.col("u"), F.least("u", "m").alias("m"), "_n"), "star-low")
        # no more rows than edges, so equal ones can wait for the end; the
        # centre of a star may hold most of them
        large = spread_join(both, low.select("u", "m"), ["u"],
                            low.select("u", "_n")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("m", F.explode(
            F.array("u", "v")).alias("u")).where("u <> m").select(
            "u", F.col("m").alias("v")).distinct()
        edges = written(small, "star-edges")
        # only stars are left when no centre is a leaf and a leaf has one centre
        ends = edges.select(F.inline(F.array(
            F.struct(F.col("u").alias("node"), F.lit(1).alias("leaf")),
            F.struct(F.col("v").alias("node"), F.lit(0).alias("leaf")))))
        still_open = ends.groupBy("node").agg(
            F.sum("leaf").alias("centres"),
            F.min("leaf").alias("least")).where(
            "centres > 1 or centres = 1 and least = 0").agg(F.count("*"))
        if still_open.first()[0] == 0:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(edges.select(F.col("v").alias("node"),
                                  F.col("v").alias("root")).distinct())


def _groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) of the distinct fingerprints of ``rows``."""
    distinct = written(rows.select("fp").distinct(), "simhash-distinct")
    parts = components(written(links(distinct, max_bits), "simhash-links"))
    return distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fp (long) and
    component_id, the smallest doc_id of all documents reached by links.

    Null and wordless texts have fingerprint zero and link like any other.
    Rows with a null doc_id take part; a component without any id has a null
    component_id.  Repeated rows give repeated rows; an empty table gives an
    empty result; other columns are ignored."""
    rows = written(fingerprints(docs, shingle), "simhash-fp")
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = written(_groups(rows, max_bits).join(first, "fp"),
                    "simhash-named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    found = written(named.join(smallest, "root").select(
        "fp", "component_id"), "simhash-found")
    return spread_join(rows, found, ["fp"]).select("doc_id", "fp",
                                                   "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the
    row with the smallest doc_id (null ids last; ties: by a hash of the
    text) stays, all columns kept."""
    h, id_, th, n = (_free(name, docs) for name in ("h", "id", "th", "n"))
    key = docs.withColumn(h, F.xxhash64("text"))
    rows = written(fingerprints(key, shingle, ("doc_id", h)), "simhash-fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                     F.col(h).alias("th"))
    # per fingerprint first: copies are many
    first = rows.groupBy("fp").agg(F.min(order).alias("f"))
    stay = _groups(rows, max_bits).join(first, "fp").groupBy("root").agg(
        F.min("f").alias("f")).select(F.col("f.doc_id").alias(id_),
                                      F.col("f.th").alias(th))
    stay = written(stay, "simhash-stay")
    kept = key.join(stay, F.col("doc_id").eqNullSafe(F.col(id_))
                    & (F.col(h) == F.col(th)))
    once = Window.partitionBy(id_, th).orderBy(th)
    return (kept.withColumn(n, F.row_number().over(once))
            .where(F.col(n) == 1).select(*docs.columns))


def _free(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while (name := "_" + name) in taken:
        pass
    return name


def op10_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
