"""Benchmark decontamination with suffix arrays of the training text.

The training texts are cut into shards of whole documents.  Each shard gets a
suffix array over its words; every suffix of every benchmark item is searched
in it by binary search.  The neighbours of the insertion point give the
longest verbatim match and where it is; the interval of a window's prefix
gives every place it occurs.

Words that no item has cannot be in a match: they are 0, sort before all
others and end a match, and suffixes that start with one are left out of the
array.  Suffixes are ordered as deep as the longest item reaches.
The benchmark is broadcast in blocks of ``BLOCK_CHARS`` at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainyard.llm.common import written

WINDOW = 10
SHARD_WORDS = 2_000_000
BLOCK_CHARS = 4_000_000
# Lower case, and every byte that is in no word made a space: words are
# digits, letters and all characters outside ASCII.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122
    or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


@dataclass
class TestBlock:
    """Benchmark items as word numbers, with their suffixes and windows."""
    vocabulary: dict[bytes, int]
    text: np.ndarray        # word numbers, one 0 behind each item
    suffix: np.ndarray      # start of every distinct suffix in text
    suffix_len: np.ndarray
    suffix_item: list       # item_id and word position of the suffix
    suffix_pos: np.ndarray
    window: np.ndarray      # start of every distinct window in text
    window_len: np.ndarray
    items_from: np.ndarray  # CSR: items of each window, as numbers
    items: np.ndarray
    item_ids: list
    opens: np.ndarray       # suffixes that begin with a window,
    open_len: np.ndarray    # and the words of that window


def test_block(rows: list[tuple], window: int = WINDOW) -> TestBlock:
    """``rows``: (item_id, text).  Items without an id still mark words."""
    vocabulary: dict[bytes, int] = {}
    text, suffixes, windows, ids = [], {}, {}, {}
    for row, (item, body) in enumerate(rows):
        w = [vocabulary.setdefault(x, len(vocabulary) + 1)
             for x in words_of(body)]
        at = len(text)
        text += [*w, 0]
        number = None if item is None else ids.setdefault(item, len(ids))
        for i in range(len(w)):
            # long suffixes are not compared, each is one
            suffixes.setdefault(
                tuple(w[i:]) if len(w) - i <= 64 else (-1 - row, i),
                (at + i, len(w) - i, item, i,
                 min(window, len(w)) if i == 0 or len(w) - i >= window
                 else 0))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            start, owners = windows.setdefault(
                tuple(w[i:i + window]), (at + i, set()))
            if number is not None:
                owners.add(number)
    s, k = list(suffixes.values()), list(windows)
    # a short item that ends another one's text is a window all the same
    opens = np.array([x[4] or (x[1] if key in windows else 0)
                      for key, x in suffixes.items()], np.int64)
    owners = [sorted(windows[x][1]) for x in k]
    flat = [x for o in owners for x in o]
    return TestBlock(
        vocabulary, np.array(text + [0], np.int32),
        np.array([x[0] for x in s], np.int64),
        np.array([x[1] for x in s], np.int64), [x[2] for x in s],
        np.array([x[3] for x in s], np.int64),
        np.array([windows[x][0] for x in k], np.int64),
        np.array([len(x) for x in k], np.int64),
        np.cumsum([0] + [len(o) for o in owners]),
        np.array(flat, np.int64), list(ids), np.flatnonzero(opens),
        opens[opens > 0])


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``ids`` that begin with a number above 0, in
    the order of their first ``depth`` numbers (a 0 ends a suffix), by prefix
    doubling: each round sorts only what the last one left tied."""
    sa = np.flatnonzero(ids)
    if not len(sa):
        return sa
    sa = sa[np.argsort(ids[sa])]
    n = len(ids)
    rank = np.zeros(n + 1, np.int64)
    first = ids[sa]
    new = np.concatenate(([True], first[1:] != first[:-1]))
    start = np.maximum.accumulate(np.where(new, np.arange(len(sa)), 0))
    rank[sa] = start + 1
    tied = ~(new & np.concatenate((new[1:], [True])))
    active, start = np.flatnonzero(tied), start[tied]
    h = 1
    while len(active) and h < depth:
        pos = sa[active]
        behind = rank[np.minimum(pos + h, n)]
        key = start * (n + 2) + behind
        order = np.argsort(key)
        pos, key, behind = pos[order], key[order], behind[order]
        sa[active] = pos
        new = np.concatenate(([True], key[1:] != key[:-1]))
        start = active[np.maximum.accumulate(
            np.where(new, np.arange(len(active)), 0))]
        rank[pos] = start + 1
        tied = ~(new & np.concatenate((new[1:], [True]))) & (behind > 0)
        active, start = active[tied], start[tied]
        h *= 2
    return sa


def _common(ids: np.ndarray, pos: np.ndarray, text: np.ndarray,
            query: np.ndarray, length: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """For each pair: words that the suffix at pos and the query share, up to
    the query's length; and whether the suffix sorts before the query."""
    lcp = np.zeros(len(pos), np.int64)
    before = np.zeros(len(pos), bool)
    live, d, end = np.arange(len(pos)), 0, len(ids) - 1
    while len(live):
        live = live[length[live] > d]
        a = ids[np.minimum(pos[live] + d, end)]
        b = text[query[live] + d]
        before[live] = a < b
        live = live[a == b]
        d += 1
        lcp[live] = d
    return lcp, before & (lcp < length)


def search(ids: np.ndarray, sa: np.ndarray, text: np.ndarray,
           query: np.ndarray, length: np.ndarray, after: bool = False
           ) -> np.ndarray:
    """Binary search: the first place in ``sa`` whose suffix is not before
    the query (``after``: nor starts with it).  ``ids`` must end with a 0."""
    lo = np.zeros(len(query), np.int64)
    hi = np.full(len(query), len(sa), np.int64)
    while (live := np.flatnonzero(lo < hi)).size:
        mid = (lo[live] + hi[live]) // 2
        lcp, before = _common(ids, sa[mid], text, query[live], length[live])
        if after:
            before |= lcp == length[live]
        lo[live] = np.where(before, mid + 1, lo[live])
        hi[live] = np.where(before, hi[live], mid)
    return lo


class Shard:
    """Whole documents as one suffix array against one benchmark block."""

    def __init__(self, texts, block: TestBlock):
        known = block.vocabulary.get
        parts, lengths = [], []
        for t in texts:
            w = words_of(t)
            parts.append(np.fromiter(map(known, w, repeat(0)), np.int32,
                                     len(w)))
            parts.append(np.zeros(1, np.int32))
            lengths.append(len(w))
        self.block = block
        self.ids = np.concatenate([*parts, np.zeros(1, np.int32)])
        self.n_words = np.array(lengths, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.n_words + 1)[:-1])) \
            if lengths else np.zeros(0, np.int64)
        depth = int(block.suffix_len.max(initial=1))
        self.sa = suffix_array(self.ids, depth)

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hit, doc, window): for each word whether it is hit, and the
        distinct pairs of document and window that occurs in it."""
        b = self.block
        lo = search(self.ids, self.sa, b.text, b.window, b.window_len)
        hi = search(self.ids, self.sa, b.text, b.window, b.window_len, True)
        n = hi - lo
        k = np.repeat(np.arange(len(n)), n)
        pos = self.sa[np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                      + np.repeat(lo, n)]
        edge = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edge, pos, 1)
        np.add.at(edge, pos + b.window_len[k], -1)
        doc = np.searchsorted(self.starts, pos, "right") - 1
        pair = np.unique(doc * max(1, len(n)) + k)
        return (np.cumsum(edge[:-1]) > 0, pair // max(1, len(n)),
                pair % max(1, len(n)))

    def longest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, doc, word) of the longest match of every test suffix."""
        b = self.block
        at = search(self.ids, self.sa, b.text, b.suffix, b.suffix_len)
        best = np.zeros(len(at), np.int64)
        place = np.zeros(len(at), np.int64)
        for side in (at - 1, at):
            ok = np.flatnonzero((side >= 0) & (side < len(self.sa)))
            pos = self.sa[side[ok]]
            lcp, _ = _common(self.ids, pos, b.text, b.suffix[ok],
                             b.suffix_len[ok])
            more = lcp > best[ok]
            best[ok[more]], place[ok[more]] = lcp[more], pos[more]
        doc = np.maximum(0, np.searchsorted(self.starts, place, "right") - 1)
        return best, doc, place - (self.starts[doc] if len(self.starts)
                                   else 0)

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, suffix, length): where a test suffix that begins with a
        window has that window in the documents, and how many words of the
        suffix follow there."""
        b = self.block
        query = b.suffix[b.opens]
        lo = search(self.ids, self.sa, b.text, query, b.open_len)
        n = search(self.ids, self.sa, b.text, query, b.open_len, True) - lo
        k = np.repeat(np.arange(len(n)), n)
        place = self.sa[np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                        + np.repeat(lo, n)]
        suffix = b.opens[k]
        length, _ = _common(self.ids, place, b.text, b.suffix[suffix],
                            b.suffix_len[suffix])
        return place, suffix, length

    def longest_by_document(self) -> tuple[np.ndarray, ...]:
        """(length, word, suffix) of each document's longest match that holds
        a window; 0, -1, -1 where there is none.  Ties: the first word, then
        the first suffix."""
        place, suffix, length = self.matches()
        doc = np.searchsorted(self.starts, place, "right") - 1
        order = np.lexsort((suffix, place, -length, doc))
        first = order[np.concatenate(([True], np.diff(doc[order]) > 0))] \
            if len(order) else order
        out = [np.zeros(len(self.starts), np.int64)] + [
            np.full(len(self.starts), -1, np.int64) for _ in range(2)]
        at = doc[first]
        out[0][at] = length[first]
        out[1][at] = place[first] - self.starts[at]
        out[2][at] = suffix[first]
        return tuple(out)

    def hit_counts(self, hit: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(hit)))
        return total[self.starts + self.n_words] - total[self.starts]


def blocks_of(bench: DataFrame, window: int = WINDOW,
              block_chars: int = BLOCK_CHARS) -> Iterator[TestBlock]:
    """The benchmark (item_id, text) in blocks of bounded size; null and
    wordless texts have no windows, repeated rows count once."""
    bench = bench.select("item_id", F.col("text").cast("string")) \
        .where("text is not null").distinct()
    chars = bench.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = 1 + chars // block_chars
    for k in range(n):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
                           == k).collect()
        yield test_block([(r.item_id, r.text) for r in sorted(
            rows, key=lambda r: (str(r.item_id), r.text))], window)


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int
            ) -> Iterator[pa.Table]:
    """Batches gathered until their texts have about that many words."""
    kept, size = [], 0
    for batch in batches:
        for i in range(0, len(batch), 256):
            part = batch.slice(i, 256)
            kept.append(part)
            size += (pc.sum(pc.binary_length(part.column("text"))).as_py()
                     or 0) // 6
            if size >= shard_words:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


def _over_shards(docs: DataFrame, block: TestBlock, schema: str,
                 emit: Callable, shard_words: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, shard_words):
            shard = Shard(part.column("text").to_pylist(), sent.value)
            yield from emit(part, shard).to_batches()

    return docs.mapInArrow(run, schema)


def _hit_rows(part: pa.Table, shard: Shard) -> pa.Table:
    b = shard.block
    hit, doc, window = shard.hits()
    counts = shard.hit_counts(hit)
    owned = np.diff(b.items_from)[window]
    d = np.repeat(doc, owned)
    item = b.items[np.arange(len(d)) - np.repeat(np.cumsum(owned) - owned,
                                                 owned)
                   + np.repeat(b.items_from[window], owned)]
    pair = np.unique(d * max(1, len(b.item_ids)) + item)
    d, item = pair // max(1, len(b.item_ids)), pair % max(1, len(b.item_ids))
    bounds = np.searchsorted(d, np.arange(len(part) + 1))
    names = [str(x) for x in b.item_ids]
    items = [[names[x] for x in item[bounds[i]:bounds[i + 1]]]
             for i in range(len(part))]
    places = [np.flatnonzero(hit[s:s + n]).tolist() if c else []
              for s, n, c in zip(shard.starts, shard.n_words, counts)]
    length, word, suffix = shard.longest_by_document()
    longest = pa.StructArray.from_arrays(
        [pa.array(length), pa.array(word), pa.array(
            [None if k < 0 or b.suffix_item[k] is None
             else str(b.suffix_item[k]) for k in suffix.tolist()],
            pa.string()),
         pa.array(np.where(suffix < 0, -1, b.suffix_pos[suffix])
                  if len(b.suffix_pos) else suffix)],
        ["length", "word", "item", "item_word"])
    return pa.table({
        "doc_id": part.column("doc_id"), "key": part.column("key"),
        "n_words": pa.array(shard.n_words), "hits": pa.array(
            places, pa.list_(pa.int32())),
        "items": pa.array(items, pa.list_(pa.string())),
        "longest": longest})


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW,
                  shard_words: int = SHARD_WORDS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, hits
    (word positions inside any occurrence of a window, ascending), items
    (ids, as strings, of the items with occurring windows, sorted) and longest
    (length, word, item, item_word: the longest verbatim match that holds a
    window, where it begins in the text, the item and where in it; null
    where no window occurs).

    An item of fewer words than ``window`` is one window; null and wordless
    texts have no words and no windows; items with a null id mark words but
    are not listed.  Repeated rows give repeated rows; empty tables on either
    side give no hits; other columns are ignored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, key string, n_words long, hits array<int>, "
              "items array<string>, longest struct<length: long, word: long, "
              "item: string, item_word: long>")
    blocks = list(blocks_of(bench, window, block_chars))
    keyed = docs.select("doc_id", F.col("text").cast("string"))
    if len(blocks) == 1:
        rows = _over_shards(keyed.withColumn("key", F.lit("")), blocks[0],
                            schema, _hit_rows, shard_words)
    else:
        # rows of several passes meet by id and text
        keyed = keyed.withColumn("key", F.sha2(F.encode(
            F.coalesce("text", F.lit("")), "utf-8"), 256))
        first = keyed.select("doc_id", "key")
        once = keyed.dropDuplicates(["doc_id", "key"])
        found = None
        for b in blocks:
            one = written(_over_shards(once, b, schema, _hit_rows,
                                       shard_words), "bench-hits")
            found = one if found is None else found.unionByName(one)
        found = found.groupBy("doc_id", "key").agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items")))
            .alias("items"),
            F.max_by("longest", F.struct(
                F.col("longest.length"), -F.col("longest.word"),
                F.col("longest.item"))).alias("longest"))
        found = found.withColumnRenamed("doc_id", "_d") \
            .withColumnRenamed("key", "_k")
        rows = first.join(found, F.col("doc_id").eqNullSafe(F.col("_d"))
                          & (F.col("key") == F.col("_k")))
    return rows.select("doc_id", "n_words",
                       F.sort_array("hits").alias("hits"),
                       F.sort_array("items").alias("items"),
                       F.when(F.col("longest.length") > 0, F.col("longest"))
                       .alias("longest"))


def longest_matches(docs: DataFrame, bench: DataFrame,
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """For every distinct benchmark suffix with a match: item_id, item_word
    (its start), length (words of its longest verbatim match in ``docs``) and
    one place of it: doc_id, doc_word (ties: the smallest doc_id)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = bench.schema["item_id"].dataType.simpleString()

    def emit(part: pa.Table, shard: Shard) -> pa.Table:
        b = shard.block
        length, doc, word = shard.longest()
        ok = np.flatnonzero(length > 0)
        return pa.table({
            "item_id": pa.array([b.suffix_item[i] for i in ok],
                                pa.int64() if item == "bigint" else None),
            "item_word": pa.array(b.suffix_pos[ok]),
            "length": pa.array(length[ok]),
            "doc_id": part.column("doc_id").take(pa.array(doc[ok])),
            "doc_word": pa.array(word[ok])})

    out = None
    for b in blocks_of(bench):
        one = _over_shards(
            docs.select("doc_id", F.col("text").cast("string")), b,
            f"item_id {item}, item_word long, length long, doc_id {kind}, "
            "doc_word long", emit, shard_words)
        out = one if out is None else out.unionByName(one)
    best = out.groupBy("item_id", "item_word").agg(F.min(F.struct(
        (-F.col("length")).alias("minus"), "doc_id", "doc_word")).alias("b"))
    return best.select("item_id", "item_word",
                       (-F.col("b.minus")).alias("length"), "b.doc_id",
                       "b.doc_word")


def remove_contaminated(docs: DataFrame, bench: DataFrame,
                        window: int = WINDOW,
                        shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` without a verbatim match that holds a window, all
    columns kept: one pass over the rows per benchmark block, no shuffle."""
    def emit(part: pa.Table, shard: Shard) -> pa.Table:
        return part.filter(pa.array(shard.longest_by_document()[0] == 0))

    for b in blocks_of(bench, window):
        docs = _over_shards(docs, b, docs.schema, emit, shard_words)
    return docs


def op2_query(docs: DataFrame, bench: DataFrame) -> DataFrame:
    joined = F.array_join("items", ",")
    return contamination(docs, bench).select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(joined, "utf-8"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.coalesce("longest.length", F.lit(0)).cast("long").alias("longest"),
        F.col("longest.word").alias("longest_word"),
        F.col("longest.item").alias("longest_item"),
        F.col("longest.item_word").alias("longest_item_word"))
