"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, encoded, and written one row
each: ids as an integer array (ORC run-length encodes integers), stripes of a
bounded size, a row index every ``INDEX_ROWS`` rows and a Bloom filter on the
document id, so that a lookup reads the stripes and row groups that can hold
the id and nothing else.  Files split by stripes when they are read.

A row holds the number of ids before it in its file; a manifest, one row per
file, holds the ids before the file.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from trainyard.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
END = 0                 # id behind each document
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
SLICE = 1_000_000       # characters encoded at once
TOGETHER = 64           # pieces encoded as one text
LONGEST = 4_000_000     # characters of a text that is cut into pieces

# A text is cut in front of each single blank or line end between two
# characters that are no white space.  The tokenizer never joins ids across
# such a place, so the pieces can be encoded apart; texts with other white
# space, and those with the name of an added token, are encoded whole.
_OTHER_SPACE = re.compile(
    "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Nor does it join a letter and the marks behind it.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_MARK[list(b".,;:!?")] = True
_SPACE = np.zeros(256, np.uint8)    # 1: blank and line end, 2: others
_SPACE[[32, 10]] = 1
_SPACE[[9, 11, 12, 13, 28, 29, 30, 31]] = 2


# Byte-level vocabularies write each byte as a character: printable ones of
# Latin-1 as they are, the others, in order, as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHAR_BYTE = {chr(b): b for b in _PRINTED} | {
    chr(256 + i): b for i, b in enumerate(
        b for b in range(256) if b not in _PRINTED)}


class Rolling:
    """64-bit hashes of stretches of bytes, all at once: a sum of a random
    number for each byte times a power of an odd number, shifted back to the
    stretch's start."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 1
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray
                 ) -> np.ndarray:
        if len(self.up) <= len(raw):
            n = max(len(raw) + 1, 2 * len(self.up))
            factors = np.ones((2, n), np.uint64)
            factors[0, 1:] = self.base
            factors[1, 1:] = pow(self.base, -1, 1 << 64)
            self.up, self.down = np.cumprod(factors, axis=1, dtype=np.uint64)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.of[raw] * self.up[:len(raw)], out=total[1:])
        h = (total[end] - total[begin]) * self.down[begin]
        return h ^ (h >> np.uint64(29))


class Store:
    """Ids of pieces, one after the other, found by two hashes; entry 0 is the
    end id."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.entry = np.full(1 << bits, -1, np.int32)
        self.key = np.zeros((1 << bits, 2), np.uint64)
        self.flat, self.edge = array("i", [END]), array("q", [0, 1])

    def __len__(self) -> int:
        return len(self.edge) - 1

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(
            np.int64)

    def find(self, h: np.ndarray, check: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each piece (-1: none), and which meet another one's."""
        at, out = self._slots(h), np.full(len(h), -1, np.int64)
        clash = np.zeros(len(h), bool)
        left = np.arange(len(h))
        while len(left):
            slot = at[left]
            here, key = self.entry[slot], self.key[slot]
            same = (here >= 0) & (key[:, 0] == h[left])
            out[left[same]] = here[same]
            clash[left[same]] = key[same, 1] != check[left[same]]
            left = left[(here >= 0) & ~same]
            at[left] = (at[left] + 1) & (len(self.entry) - 1)
        return out, clash

    def add(self, h: np.ndarray, check: np.ndarray, ids: np.ndarray,
            ends: np.ndarray) -> None:
        """Distinct pieces that are not there; ``ends``: where each one's ids
        end in ``ids``."""
        number = np.arange(len(self), len(self) + len(h))
        at, left = self._slots(h), np.arange(len(h))
        while len(left):
            free = left[self.entry[at[left]] < 0]
            self.entry[at[free]] = number[free]     # of several, one stays
            won = free[self.entry[at[free]] == number[free]]
            self.key[at[won], 0], self.key[at[won], 1] = h[won], check[won]
            left = left[self.entry[at[left]] != number[left]]
            at[left] = (at[left] + 1) & (len(self.entry) - 1)
        self.edge.frombytes((ends + len(self.flat)).astype("q").tobytes())
        self.flat.frombytes(ids.astype("i").tobytes())

    def take(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries, and where each one's end."""
        # arrays cannot grow while a view of them is left
        flat = np.frombuffer(self.flat, np.int32)
        edge = np.frombuffer(self.edge, np.int64)
        begin = edge[entries]
        n = edge[entries + 1] - begin
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
        at = np.arange(total, dtype=kind)
        at += np.repeat((begin - ends + n).astype(kind), n)
        return flat[at], ends


class Encoder:
    """Ids of whole texts, as the tokenizer gives them by default.  Those of
    pieces are kept in two generations of a bounded size: a full one becomes
    the old one, and a piece of the old one that is seen again moves on."""

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in
                      self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token) if all(
                c in _CHAR_BYTE for c in token) else 0
        self.limit = limit
        self.hashes = Rolling(1), Rolling(2)
        self.new, self.old = self._store(), self._store()

    def _store(self) -> Store:
        # room for the pieces that a slice adds to a full one
        return Store(max(20, (2 * self.limit).bit_length()))

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and where each one's end.  Pieces are encoded many
        at once, as one text; the bytes of the ids tell them apart."""
        joined = ["".join(pieces[i:i + TOGETHER])
                  for i in range(0, len(pieces), TOGETHER)]
        out, ends, total = [], [], 0
        for k, ids in enumerate(self._encoded(joined)):
            some = pieces[k * TOGETHER:(k + 1) * TOGETHER]
            ids = np.array(ids, np.int64)
            cuts = np.cumsum(self.size[ids])
            edges = np.cumsum([len(p) for p in some] if joined[k].isascii()
                              else [len(p.encode()) for p in some])
            end = np.searchsorted(cuts, edges) + 1
            if not len(cuts) or cuts[-1] != edges[-1] or not (
                    cuts[end - 1] == edges).all():
                ids, end = self._apart(some)
            out.append(ids)
            ends.append(end + total)
            total += len(ids)
        return (np.concatenate([np.zeros(0, np.int64), *out]),
                np.concatenate([np.zeros(0, np.int64), *ends]))

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self._encoded(pieces)
        return (np.array([x for e in each for x in e], np.int64),
                np.cumsum([len(e) for e in each]).astype(np.int64))

    def _entries(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each stretch of ``raw``, and which cannot be told from
        another piece by their hash (not to be expected)."""
        h, check = (f(raw, begin, end) for f in self.hashes)
        at, clash = self.new.find(h, check)
        miss = np.flatnonzero(at < 0)
        if not len(miss):
            return at, clash
        _, first = np.unique(h[miss], return_index=True)
        some = miss[first]
        old, other = self.old.find(h[some], check[some])
        again = (old >= 0) & ~other
        if again.any():
            self.new.add(h[some[again]], check[some[again]],
                         *self.old.take(old[again]))
        some = some[~again]
        blanks = _SPACE[raw[begin[some]]] > 0
        # marks and a text's first piece have no blank in front
        for who, learn in ((some[blanks], self._learn),
                           (some[~blanks], self._apart)):
            if len(who):
                self.new.add(h[who], check[who], *learn(
                    [raw[a:b].tobytes().decode() for a, b in
                     zip(begin[who].tolist(), end[who].tolist())]))
        at[miss], clash[miss] = self.new.find(h[miss], check[miss])
        return at, clash

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other with the end id behind each,
        and the places where texts begin and end."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, self._store()
        cut = np.array([bool(t) and len(t) <= LONGEST and not any(
            x in t for x in self.added) and (t.isascii() or not
                                             _OTHER_SPACE.search(t))
                        for t in texts], bool)
        at = np.flatnonzero(cut)
        coded = [texts[i].encode() for i in at.tolist()]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        stop = np.cumsum([len(c) for c in coded]).astype(np.int64)
        start = np.concatenate(([0], stop[:-1])).astype(np.int64)
        space = _SPACE[raw]
        odd = space == 2
        odd[1:] |= (space[1:] > 0) & (space[:-1] > 0)
        if len(at):
            odd[start] |= space[start] > 0
            odd[stop - 1] |= space[stop - 1] > 0
            space[start] = 1
        space[1:] |= _MARK[raw[1:]] & _LETTER[raw[:-1]]
        begin = np.flatnonzero(space == 1)
        end = np.append(begin[1:], len(raw))
        owner = np.searchsorted(start, begin, "right") - 1
        plain = np.ones(len(at), bool)
        plain[np.searchsorted(start, np.flatnonzero(odd), "right") - 1] = False
        keep = plain[owner]
        begin, end, owner = begin[keep], end[keep], owner[keep]
        entry, clash = self._entries(raw, begin, end)
        if clash.any():
            plain[owner[clash]] = False
            keep = plain[owner]
            entry, owner = entry[keep], owner[keep]
        cut[at[~plain]] = False
        # the texts' own entries: pieces, then the end
        number = np.bincount(at[owner], minlength=len(texts))
        ids, ends = self.new.take(np.insert(entry, np.cumsum(number), 0))
        bounds = np.concatenate(([0], ends[np.cumsum(number + 1) - 1]))
        whole = [i for i in np.flatnonzero(~cut).tolist() if texts[i]]
        if whole:
            extra = dict(zip(whole, self._encoded([texts[i] for i in whole])))
            rows = [np.concatenate([np.array(extra[i], np.int32), x])
                    if i in extra else x
                    for i, x in enumerate(np.split(ids, bounds[1:-1]))]
            ids = np.concatenate(rows)
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
        return ids, bounds


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, used again by its later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, file (the task's partition), before (ids of earlier rows of
    the partition), ids.  Rows keep their order."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            at, size = 0, 0
            sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0) \
                .to_pylist()
            for i, n in enumerate(sizes):
                size += n
                if size <= SLICE and i + 1 < len(sizes):
                    continue
                part = batch.slice(at, i + 1 - at)
                at, size = i + 1, 0
                ids, edge = encoder(path).encode(
                    [t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array(np.full(len(part), file, np.int32)),
                     pa.array(before + edge[:-1]),
                     pa.ListArray.from_arrays(
                         pa.array(edge, pa.int32()),
                         pa.array(ids))],
                    ["doc_id", "file", "before", "ids"])
                before += int(edge[-1])

    return docs.mapInArrow(
        run, f"doc_id {kind}, file int, before long, ids array<int>")


def write_tokens(docs: DataFrame, path: str,
                 tokenizer: str | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order
    below ``path``: ``ids`` and ``manifest`` (file, n_rows, n_tokens, start,
    first_id, last_id).

    Null and empty texts are an end id alone; null doc_ids come first;
    repeated doc_ids follow each other in a fixed order; an empty table
    writes empty files; other columns are not written."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    order = ["doc_id", F.xxhash64("text")]
    # one row per record of the writer: long texts count towards the stripe
    (tokens(rows.repartitionByRange(*order).sortWithinPartitions(*order),
            tokenizer)
     .withColumn("n_tokens", F.size("ids").cast("long"))
     .write.mode("overwrite")
     .option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", INDEX_ROWS)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", 0.01)
     .option("compression", "zstd").orc(f"{path}/ids"))
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    files = spark.read.schema(
        f"doc_id {kind}, file int, n_tokens long").orc(f"{path}/ids")
    # one row per file
    by = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(
        Window.unboundedPreceding, -1)
    (files.groupBy("file").agg(
        F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
     .withColumn("start", F.coalesce(F.sum("n_tokens").over(by), F.lit(0)))
     .write.mode("overwrite").orc(f"{path}/manifest"))


def read_tokens(spark: SparkSession, path: str, kind: str = "bigint"
                ) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids.  A filter on
    doc_id reaches the row index and the Bloom filter."""
    rows = spark.read.schema(
        f"doc_id {kind}, file int, before long, ids array<int>").orc(
        f"{path}/ids")
    starts = spark.read.schema("file int, start long").orc(
        f"{path}/manifest").withColumnRenamed("start", "_file_start")
    return rows.join(starts, "file").select(
        "doc_id", (F.col("_file_start") + F.col("before")).alias("start"),
        "ids")


def digest(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) of rows of :func:`read_tokens`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            edge = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[x:y].tobytes())
                   for x, y in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"),
                 pa.array(np.diff(edge).astype(np.int64)),
                 pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op4_query(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = work_dir(spark, "token-files")
    write_tokens(docs, path)
    return digest(read_tokens(
        spark, path, docs.schema["doc_id"].dataType.simpleString()))
