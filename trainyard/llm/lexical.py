"""Ranked lexical search by dense blocked matrix products.

Benchmark items are queries, documents are ranked for each.  Items are taken
in tiles; a tile has the vocabulary of its items only.  A document's impacts
(a whole number for each term it holds) fill a dense tile of vocabulary times
documents, the items' term weights another of items times vocabulary, and one
BLAS product in float64 gives the scores of a block.  All numbers are whole and
a tile's vocabulary is so small that no partial sum reaches 2**53, so the
products are exact in any order of addition; an item with more terms is summed
over several tiles in 64-bit integers.

Each task keeps the best ``k`` of an item with the ties at the border settled
by doc_id, so the rows that leave a task depend on items and tasks alone.
Documents are tokenised once a block of items, into a written table of term
numbers and counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainyard.llm.common import running_start, written
from trainyard.llm.decontamination import words_of

TOP = 50
TILE_ITEMS = 64
TILE_TERMS = 1024
TILE_DOCS = 2048
BLOCK_TERMS = 500_000   # (item, term) pairs that are broadcast at once
CHUNK_WORDS = 400_000
WEIGHT = 1000           # fixed values of the score: scale of the weights,
SCALE = 1_000_000_000   # of the impacts, the counts' factor,
COUNT = 1000            # the length norm's factor
NORM = 20               # and the share of the length in the norm, in percent
SHARE = 50
EXACT = 1 << 53


@dataclass
class ItemBlock:
    """Items of one block: numbers, and their terms as vocabulary numbers."""
    vocabulary: dict[bytes, int]
    items: list[int]
    terms: list[np.ndarray]


def item_table(bench: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One written row per row of ``bench`` (item_id, text) with a term:
    item (a number of the row), item_id, terms (distinct), block (items of
    about ``block_terms`` terms together, one larger item alone)."""
    kind = bench.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted(set(words_of(t)))
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("item_id"),
                 pa.array(terms, pa.list_(pa.binary()))],
                ["item_id", "terms"])

    rows = bench.select("item_id", F.col("text").cast("string")).mapInArrow(
        run, f"item_id {kind}, terms array<binary>")
    items = written(rows.where("size(terms) > 0").select(
        F.monotonically_increasing_id().alias("item"), "item_id", "terms",
        F.size("terms").cast("long").alias("n")), "search-items")
    # the high bits of the number are the task that gave it
    at = running_start(items.select("item", "n", F.shiftright("item", 33)
                                    .alias("task")), [], "task", ["item"],
                       "n", "start")
    return written(items.join(at.select(
        "item", F.floor(F.col("start") / block_terms).alias("block")),
        "item"), "search-items")


def _blocks(items: DataFrame) -> Iterator[ItemBlock]:
    numbers = [r.block for r in items.select("block").distinct().collect()]
    for k in sorted(numbers):
        rows = items.where(F.col("block") == k).select("item", "terms") \
            .orderBy("item").collect()
        vocabulary: dict[bytes, int] = {}
        terms = [np.array([vocabulary.setdefault(bytes(t), len(vocabulary))
                           for t in r.terms], np.int64) for r in rows]
        yield ItemBlock(vocabulary, [r.item for r in rows], terms)


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms, with repeats), terms (numbers in ``vocabulary``) and
    tfs of every row of ``docs`` that has a term at all."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def chunk(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        get, size = sent.value.get, max(1, len(sent.value))
        n = np.array([len(w) for w in words], np.int64)
        term = np.fromiter(map(get, chain.from_iterable(words), repeat(-1)),
                           np.int64, int(n.sum()))
        at = np.repeat(np.arange(len(n)), n)
        hit = term >= 0
        key, tf = np.unique(at[hit] * size + term[hit], return_counts=True)
        edge = pa.array(np.searchsorted(
            key, np.arange(len(n) + 1) * size).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n),
             pa.ListArray.from_arrays(edge, pa.array((key % size)
                                                     .astype(np.int32))),
             pa.ListArray.from_arrays(edge, pa.array(tf.astype(np.int32)))],
            ["doc_id", "n", "terms", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words, total = [], [], 0
            for doc, text in zip(b.column("doc_id").to_pylist(),
                                 b.column("text")):
                w = words_of(text.as_py())
                if w:
                    ids.append(doc)
                    words.append(w)
                    total += len(w)
                if total >= CHUNK_WORDS:
                    yield chunk(ids, words)
                    ids, words, total = [], [], 0
            if ids:
                yield chunk(ids, words)

    return docs.select(F.col("doc_id").cast("long"),
                       F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")


def document_counts(posted: DataFrame, size: int) -> np.ndarray:
    """How many rows of :func:`postings` hold each of ``size`` terms: summed
    per task, then over the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_flat(b, "terms")[0], minlength=size)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(term), pa.array(total[term])], ["term", "df"])

    out = np.zeros(size, np.int64)
    rows = posted.select("terms").mapInArrow(run, "term long, df long") \
        .groupBy("term").agg(F.sum("df").alias("df"))
    for r in rows.collect():  # one row a term of the block
        out[r.term] = r.df
    return out


def _flat(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column, and where each row's begin."""
    c = b.column(name)
    edge = c.offsets.to_numpy().astype(np.int64)
    values = c.values.to_numpy(zero_copy_only=False)
    return values[edge[0]:edge[-1]].astype(np.int64), edge - edge[0]


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int
            ) -> np.ndarray:
    """Whole-number impact of a term that occurs tf times in a document of n
    terms, of ``docs`` documents with ``length`` terms in all."""
    if not len(n):
        return np.zeros(0, np.int64)
    if SHARE * int(n.max()) * docs < 1 << 62:
        share = (SHARE * docs * n) // length
    else:
        share = np.array([SHARE * docs * int(x) // length for x in n],
                         np.int64)
    norm = 100 - SHARE + share
    return (SCALE * tf) // (COUNT * tf + NORM * norm)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT * math.log((2 * docs + 2)
                                                  / (2 * int(x) + 1)))
                     for x in df], np.int64)


@dataclass
class Tile:
    """Some items with (part of) their vocabulary; ``last`` ends the sum."""
    items: np.ndarray       # places in the block's list of items
    column: np.ndarray      # vocabulary number -> column of the tile, or -1
    width: int
    weight: np.ndarray      # items x columns, float64
    last: bool


def tiles(block: ItemBlock, weight: np.ndarray, tile_items: int = TILE_ITEMS,
          tile_terms: int = TILE_TERMS) -> list[Tile]:
    """Tiles of up to ``tile_items`` items and ``tile_terms`` distinct terms.
    An impact is at most SCALE / COUNT, so a tile's sums stay below 2**53
    while its weights sum to less than 2**53 / that."""
    most = max(1, int(weight.max(initial=1)))
    width = min(tile_terms, (EXACT - 1) // (most * (SCALE // COUNT)))
    out: list[Tile] = []

    def tile(items: list[int], terms: list[np.ndarray], last: bool) -> None:
        used = np.unique(np.concatenate(terms))
        column = np.full(len(weight), -1, np.int64)
        column[used] = np.arange(len(used))
        w = np.zeros((len(items), len(used)))
        for i, t in enumerate(terms):
            w[i, column[t]] = weight[t]
        out.append(Tile(np.array(items), column, len(used), w, last))

    items, terms, used = [], [], set()
    for i, t in enumerate(block.terms):
        if len(t) > width:      # an item of its own, over several tiles
            for a in range(0, len(t), width):
                tile([i], [t[a:a + width]], a + width >= len(t))
            continue
        more = used | set(t.tolist())
        if items and (len(items) >= tile_items or len(more) > width):
            tile(items, terms, True)
            items, terms, more = [], [], set(t.tolist())
        items.append(i)
        terms.append(t)
        used = more
    if items:
        tile(items, terms, True)
    return out


class Best:
    """The ``k`` best (score, doc) of one item so far.  Rows that tie with
    the k-th stay candidates until all rows with a smaller doc are seen."""

    def __init__(self, k: int):
        self.k, self.least, self.held = k, 1, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, score: np.ndarray, doc: np.ndarray, none: np.ndarray
            ) -> None:
        at = np.flatnonzero(score >= self.least)
        if len(at):
            self.parts.append((score[at], doc[at], none[at]))
            self.held += len(at)
            if self.held > 4 * self.k:
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64), np.zeros(0, np.int64),
                    np.zeros(0, bool))
        score, doc, none = map(np.concatenate, zip(*self.parts))
        at = np.lexsort((doc, none, -score))[:self.k]
        self.parts, self.held = [(score[at], doc[at], none[at])], len(at)
        if len(at) == self.k:
            self.least = int(score[at[-1]])
        return self.parts[0]


def best_of_tasks(posted: DataFrame, block: ItemBlock, weight: np.ndarray,
                  n_docs: int, length: int, k: int) -> DataFrame:
    """item, doc_id, score: of each task the best ``k`` rows of every item,
    ties by ascending doc_id."""
    sent = posted.sparkSession.sparkContext.broadcast(
        (block.items, tiles(block, weight)))

    def scored(b: pa.RecordBatch, best: list[Best], work: np.ndarray) -> None:
        term, edge = _flat(b, "terms")
        doc = np.repeat(np.arange(len(b)), np.diff(edge))
        n = b.column("n").to_numpy()
        impact = impacts(_flat(b, "tfs")[0], n[doc], n_docs, length)
        ids = b.column("doc_id").fill_null(0).to_numpy()
        none = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        total = None
        for t in sent.value[1]:
            c = t.column[term]
            hit = c >= 0
            x = work[:t.width, :len(b)]
            x[:] = 0
            x[c[hit], doc[hit]] = impact[hit]
            s = (t.weight @ x).astype(np.int64)
            total = s if total is None else total + s
            if t.last:
                for row, i in zip(total, t.items.tolist()):
                    best[i].add(row, ids, none)
                total = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, plan = sent.value
        best = [Best(k) for _ in numbers]
        work = np.zeros((max((t.width for t in plan), default=0), TILE_DOCS))
        for batch in batches:
            for i in range(0, len(batch), TILE_DOCS):
                scored(batch.slice(i, TILE_DOCS), best, work)
        for item, b in zip(numbers, best):
            score, doc, none = b.cut()
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), item, np.int64)),
                     pa.array(doc, mask=none), pa.array(score)],
                    ["item", "doc_id", "score"])

    return posted.mapInArrow(run, "item long, doc_id long, score long")


def ranked(docs: DataFrame, bench: DataFrame, k: int = TOP,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """For each row of ``bench`` (item_id, text) its ``k`` documents (doc_id,
    text) of the highest score above 0 (all, if fewer): item_id, rank (from
    1), doc_id, score; ties by ascending doc_id, null ids last.

    Null and wordless texts have no terms: such items have no rows, such
    documents are not counted.  Repeated documents are documents, repeated
    items are ranked again; an empty table on either side gives no rows;
    other columns are ignored.  A long text counts whole.  On the driver: one
    block of items, and one count for each of its terms."""
    spark = docs.sparkSession
    items = item_table(bench, block_terms)
    found = None
    for block in _blocks(items):
        posted = written(postings(docs, block.vocabulary), "search-postings")
        n_docs, length = posted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        weight = weights(document_counts(posted, len(block.vocabulary)),
                         n_docs)
        one = best_of_tasks(posted, block, weight, n_docs, length, k)
        found = one if found is None else found.unionByName(one)
    if found is None:
        kind = bench.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"item_id {kind}, rank int, doc_id long, score long")
    found = written(found, "search-best")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # some k rows of every task: in two steps, none of which gets them all
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id"),
                                            F.lit(width)))
    parts = parts.withColumn("rank", F.row_number().over(
        Window.partitionBy("item", "part").orderBy(*order))) \
        .where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return (parts.withColumn("rank", rank).where(F.col("rank") <= k)
            .join(items.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score"))


def op13_query(docs: DataFrame, bench: DataFrame) -> DataFrame:
    return ranked(docs, bench)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, r, words, len(words)::BIGINT AS n FROM w
      WHERE len(words) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term,
              count(*)::BIGINT AS tf
       FROM (SELECT r, doc_id, n, unnest(words) AS term FROM d)
       GROUP BY r, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark),
scores AS (
  SELECT q.item_id, tf.r, any_value(tf.doc_id) AS doc_id, sum(
    floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * df.df + 1)))::BIGINT
    * ((1000000000 * tf.tf)
       // (1000 * tf.tf + 20 * (50 + (50 * tf.n * s.docs) // s.total)))
    )::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) CROSS JOIN s
  GROUP BY q.item_id, tf.r),
ranks AS (SELECT *, row_number() OVER (
            PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50
"""
