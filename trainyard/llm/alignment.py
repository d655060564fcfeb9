"""Alignment of two tokenizers' ids over the same text.

One tokenizer is a byte-level vocabulary of the tokenizers library (A), the
other a sentencepiece model (B).  Both give spans: character offsets of A,
byte spans of B's proto.  They are the coarse cuts; where several ids
share a character or a span is empty (split multibyte characters, byte
fallback) the ids' decoded bytes place the cuts in between, and decoded bytes
are held against the text everywhere.

A text is taken apart in front of single blanks and line ends between two
characters that are no white space.  Neither tokenizer joins ids across such a
place (the model's pieces are looked through for it when it is loaded), so the
pieces are aligned apart and those seen again come from a bounded cache.

Two tokenizations of the same bytes overlap in one pair of ids for each stretch
between neighbouring cuts of either; so an alignment needs the ids alone, which
are written once and read twice: to count the pairs of the corpus, then to
weigh each text's links by those counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trainyard.llm.common import written
from trainyard.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
MODEL = "piece_bpe_32k.model"
CACHED = 160_000        # pieces of a generation; two are kept
CACHED_CHARS = 64       # longer pieces are not kept
SLICE = 500_000         # characters aligned at once
TOGETHER = 100          # pieces encoded as one text
HEAD = 1 << 20          # most frequent pairs, broadcast; others are joined
LINKS = 400_000         # links counted at once
_MARK = "\u2581"        # sentencepiece's blank
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_OTHER_SPACE = re.compile(
    "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f"
    "\u205f\u3000]")
# Nor do they join a letter with marks behind it (also looked for).
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKED = re.compile(f"(.*[{_LETTER}])([.,;:!?]+)", re.DOTALL)
# Byte-level vocabularies write each byte as a character: printable ones of
# Latin-1 as they are, the others, in order, as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTED} | {
    chr(256 + i): b for i, b in enumerate(
        b for b in range(256) if b not in _PRINTED)}


def cut(text: str) -> list[str]:
    """The pieces of blank + ``text``."""
    if not (text[0] in " \n" or text[-1] in " \n" or "  " in text
            or " \n" in text or "\n " in text or "\n\n" in text
            or _OTHER_SPACE.search(text)):
        return [p if p[0] == "\n" else " " + p
                for p in text.replace("\n", " \n").split(" ")]
    return _CUT.split(" " + text)


def byte_cuts(begin: np.ndarray, end: np.ndarray, size: np.ndarray
              ) -> np.ndarray:
    """Where each id ends, in bytes: at its span's end where the span is its
    own, else its decoded bytes (``size``) behind the last such place.  Spans
    that contradict the decoded bytes give way to them."""
    decoded = np.cumsum(size)
    behind = np.append(begin[1:], np.iinfo(np.int64).max)
    own = (end > begin) & (behind >= end) & (end == decoded)
    return np.where(own, end, decoded)


def char_bytes(text: bytes) -> np.ndarray:
    """The byte where each character of ``text`` begins, and its length."""
    raw = np.frombuffer(text, np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


class Aligner:
    """Both tokenizers, their ids' bytes, and aligned pieces."""

    def __init__(self, tokenizer: str, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(tokenizer)
        self.a.encode_special_tokens = True  # their names are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        entry = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(_BYTE_OF.get(c, 63) for c in entry.get(i, ""))
                        for i in range(max(entry) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.apart = not any(re.search(f"\n|[^{_MARK}]{_MARK}", p)
                             for p in pieces)
        self.marks_apart = self.apart and not any(
            re.search(f"[{_LETTER}][.,;:!?]", p) for p in pieces)
        self.marks: dict[str, tuple | None] = {}
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _tokens(self, text: str, own_blank: bool):
        """Both tokenizers' ids of ``text`` and their byte cuts; None where
        the ids' bytes are not the text's.  ``own_blank``: the text's first
        blank is the one that the model puts in front."""
        whole = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        proto = self.b.encode(text[1:] if own_blank else text,
                              return_type="proto")
        a = encoding.ids
        spans = [(p.id, p.begin, p.end) for p in proto.pieces]
        if not own_blank:       # the model's blank is not in the text
            spans = spans[1:]
        b = [p[0] for p in spans]
        if b"".join([self.a_bytes[i] for i in a]) != whole or \
                b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        at = np.array(encoding.offsets, np.int64).reshape(-1, 2)
        if not text.isascii():
            at = char_bytes(whole)[at]
        spans = np.array(spans, np.int64).reshape(-1, 3)
        begin, end = spans[:, 1] + own_blank, spans[:, 2] + own_blank
        if own_blank:
            begin[0] = 0
        return (a, byte_cuts(at[:, 0], at[:, 1], self.a_size[a]),
                b, byte_cuts(begin, end, self.b_size[b]))

    def _entries(self, a, ends_a, b, ends_b, edges) -> list[tuple]:
        """ids of A and of B as bytes, the groups as text, numbers of groups
        and of links, for the stretch up to each of the byte ``edges``."""
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a = np.searchsorted(cuts, ends_a)
        group_b = np.searchsorted(cuts, ends_b)
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        # a group's ids of A, then its ids of B
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)),
                           kind="stable")
        words = [f"{i}|" if e else f"{i}," for i, e in
                 zip(a.tolist(), last_a.tolist())]
        words += [f"{i};" if e else f"{i}," for i, e in
                  zip(b.tolist(), last_b.tolist())]
        words = [words[i] for i in order.tolist()]
        flat_a, flat_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        to_a = np.searchsorted(ends_a, edges, "right").tolist()
        to_b = np.searchsorted(ends_b, edges, "right").tolist()
        to_cut = np.searchsorted(cuts, edges, "right").tolist()
        out, i, j, k = [], 0, 0, 0
        for x, y, z in zip(to_a, to_b, to_cut):
            out.append((flat_a[4 * i:4 * x], flat_b[4 * j:4 * y],
                        "".join(words[i + j:x + y])[:-1], z - k,
                        x - i + y - j - z + k))
            i, j, k = x, y, z
        return out

    def _one(self, piece: str) -> tuple:
        """Entry of one piece; (.., -2**40) where the bytes differ."""
        got = self._tokens(piece, piece[0] == " ")
        if got is None:
            return b"", b"", "", 0, -1 << 40
        return self._entries(*got, np.array([len(piece.encode())]))[0]

    def _marks(self, marks: str) -> tuple | None:
        """Entry of marks behind a letter; None where they cannot be told
        from it."""
        if marks not in self.marks:
            got, edges = self._tokens(" a" + marks, True), np.array(
                [2, 2 + len(marks)])
            self.marks[marks] = self._entries(*got, edges)[1] if got \
                and 2 in got[1] and 2 in got[3] else None
        return self.marks[marks]

    def _learn(self, pieces: list[str]) -> dict[str, tuple]:
        """Entries of pieces.  Those with no white space behind their first
        character and at their end are encoded many at once, as one text."""
        out, plain = {}, []
        for p in pieces:
            if self.apart and len(p) > 1 and not p[1].isspace() \
                    and not p[-1].isspace() and _MARK not in p:
                plain.append(p)
            else:
                out[p] = self._one(p)
        for i in range(0, len(plain), TOGETHER):
            some = [" a", *plain[i:i + TOGETHER]]
            edges = np.cumsum([len(p.encode()) for p in some])
            got = self._tokens("".join(some), True)
            if got is None or not np.isin(edges, got[1]).all() \
                    or not np.isin(edges, got[3]).all():
                out |= {p: self._one(p) for p in some[1:]}
                continue
            out |= zip(some[1:], self._entries(*got, edges)[1:])
        return out

    def align(self, texts: list[str]) -> list[tuple | None]:
        """Entries of whole texts; None for one that is empty or whose bytes
        a tokenizer does not keep."""
        if len(self.new) > CACHED:
            self.old, self.new = self.new, {}
        cuts = [(cut(t) if self.apart else [" " + t]) if t else []
                for t in texts]
        new, old = self.new, self.old
        missing = {p: 0 for c in cuts for p in c if p not in new}
        # words with marks are put together from both, for this slice only
        marked = {}
        for p in list(missing) if self.marks_apart else ():
            m = _MARKED.fullmatch(p)
            if m and self._marks(m[2]):
                marked[p] = m.groups()
                del missing[p]
                if m[1] not in new:
                    missing[m[1]] = 0
        for p in missing.keys() & old.keys():
            new[p] = old[p]
            del missing[p]
        long = {}
        for p, e in self._learn(list(missing)).items():
            (new if len(p) <= CACHED_CHARS else long)[p] = e
        for p, (word, marks) in marked.items():
            a, b = new.get(word) or long[word], self._marks(marks)
            long[p] = (a[0] + b[0], a[1] + b[1], f"{a[2]};{b[2]}",
                       a[3] + b[3], a[4] + b[4])
        out = []
        for c in cuts:
            es = [new.get(p) or long[p] for p in c]
            links = sum([e[4] for e in es])
            if links <= 0:
                out.append(None)
                continue
            out.append((b"".join([e[0] for e in es]),
                        b"".join([e[1] for e in es]),
                        ";".join([e[2] for e in es]),
                        sum([e[3] for e in es]), links))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(tokenizer: str, model: str) -> Aligner:
    """One per Python worker, used again by its later tasks."""
    if (tokenizer, model) not in _ALIGNERS:
        _ALIGNERS[tokenizer, model] = Aligner(tokenizer, model)
    return _ALIGNERS[tokenizer, model]


def aligned(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """doc_id, a, b (ids as little-endian 32-bit integers), n_groups, n_links
    and groups (SHA-256 of ``a1,a2|b1;a3|b2,b3``) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    nothing = (b"", b"", None, 0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, size = batch.column("text"), 0, 0
            for i, t in enumerate(texts):
                size += len(t.as_py() or "")
                if size <= SLICE and i + 1 < len(texts):
                    continue
                part = batch.slice(at, i + 1 - at)
                at, size = i + 1, 0
                rows = [e or nothing for e in aligner(tokenizer, model).align(
                    [t or "" for t in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[3] for r in rows], pa.int64()),
                     pa.array([r[4] for r in rows], pa.int64()),
                     pa.array(["" if r[2] is None else hashlib.sha256(
                         r[2].encode()).hexdigest() for r in rows])],
                    ["doc_id", "a", "b", "n_groups", "n_links", "groups"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, a binary, b binary, n_groups long, "
        "n_links long, groups string")


class Links:
    """The links of rows of :func:`aligned`, from their ids' lengths."""

    def __init__(self, tokenizer: str, model: str):
        tok = aligner(tokenizer, model)
        tok.new, tok.old = {}, {}   # pieces are not needed here
        self.a, self.b = tok.a_size, tok.b_size

    def keys(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(first row, rows, keys) of slices of about ``LINKS`` links; a key
        is a << 32 | b, in the order of the text."""
        number = batch.column("n_links").to_numpy()
        first, size = 0, 0
        for i, n in enumerate(number.tolist()):
            size += n
            if size < LINKS and i + 1 < len(number):
                continue
            a, b = (np.frombuffer(b"".join(
                batch.column(c).slice(first, i + 1 - first).to_pylist()),
                "<u4").astype(np.int64) for c in ("a", "b"))
            ends_a, ends_b = np.cumsum(self.a[a]), np.cumsum(self.b[b])
            mark = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
            mark[ends_a] = 1
            mark[ends_b] |= 2
            mark = mark[mark > 0]
            of_a, of_b = mark & 1, mark >> 1
            i_a = np.cumsum(of_a, dtype=np.int64) - of_a
            i_b = np.cumsum(of_b, dtype=np.int64) - of_b
            yield first, i + 1 - first, a[i_a] << 32 | b[i_b]
            first, size = i + 1, 0


def pair_counts(rows: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """key (a << 32 | b) and n, the corpus-wide links between two ids: summed
    in each task as far as memory allows, then over the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, keys, counts = Links(tokenizer, model), [], []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            k, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(k), np.int64)
            np.add.at(n, at, np.concatenate(counts))
            return k, n

        def out(k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)],
                                              ["key", "n"])

        held = 0
        for batch in batches:
            for _, _, key in links.keys(batch):
                k, n = np.unique(key, return_counts=True)
                keys.append(k)
                counts.append(n)
                held += len(k)
                if held > 4 * HEAD:
                    k, n = summed()
                    if len(k) > 2 * HEAD:
                        yield out(k, n)
                        keys, counts, held = [], [], 0
                    else:
                        keys, counts, held = [k], [n], len(k)
        if keys:
            yield out(*summed())

    return rows.select("a", "b", "n_links").mapInArrow(
        run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Table:
    """Whole numbers by key, for many lookups at once: open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys))))) + 2)
        self.shift = np.uint64(64 - bits)
        self.key = np.full(1 << bits, -1, np.int64)
        self.value = np.zeros(1 << bits, np.int64)
        at, left = self._at(keys), np.arange(len(keys))
        while len(left):
            free = left[self.key[at[left]] < 0]
            self.key[at[free]] = keys[free]     # of several, one stays
            self.value[at[free]] = values[free]
            left = left[self.key[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.key) - 1)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``; 0 where there is none."""
        at = self._at(keys)
        found = self.key[at]
        out = np.where(found == keys, self.value[at], 0)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.key) - 1)
            found = self.key[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.value[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


def _head(counts: DataFrame, head: int) -> tuple[int, bool]:
    """Least count of the at most ``head`` most frequent pairs, and whether
    those are all pairs."""
    steps = {r.step: r["count"] for r in counts.groupBy(
        F.floor(F.log2("n") * 16).cast("int").alias("step")).count()
        .collect()}      # some hundred steps
    total, least = 0, None
    for step in sorted(steps, reverse=True):
        total += steps[step]
        if total > head:
            return int(np.ceil(2 ** ((step + 1) / 16) - 1e-9)), False
        least = step
    return 0 if least is None else 1, True


def weighed(rows: DataFrame, counts: DataFrame, tokenizer: str, model: str,
            head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of the written ``rows`` (with a column row, a number of each).  Counts of
    the ``head`` most frequent pairs go to every task, links of rarer ones are
    joined."""
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, "
              "n_links long, n_best long, count_sum long, groups_sha256 string")
    names = [c.split()[0] for c in schema.split(", ")]
    b_id = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))
    # as many rows as B has ids
    best = {r.b: r.n for r in counts.groupBy(b_id.alias("b")).agg(
        F.max("n").alias("n")).collect()}
    most = np.zeros(max(best, default=0) + 1, np.int64)
    most[list(best)] = list(best.values())
    least, whole = _head(counts, head)
    top = counts.where(F.col("n") >= least).select("key", "n").toArrow()
    sent = spark.sparkContext.broadcast(
        (Table(top["key"].to_numpy(), top["n"].to_numpy()), most))

    def sums(values: np.ndarray, edge: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return c[edge[1:]] - c[edge[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, (table, most) = Links(tokenizer, model), sent.value
        for batch in batches:
            n_best, total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            number = batch.column("n_links").to_numpy()
            for first, n, key in links.keys(batch):
                count = table.get(key)
                edge = np.concatenate(([0], np.cumsum(
                    number[first:first + n])))
                is_best = (count > 0) & (count == most[key & 0xFFFFFFFF])
                n_best.append(sums(is_best, edge))
                total.append(sums(count, edge))
            size = [pc.divide(pc.binary_length(batch.column(c)), 4).cast(
                pa.int64()) for c in ("a", "b")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *size,
                 batch.column("n_groups"), batch.column("n_links"),
                 pa.array(np.concatenate(n_best)),
                 pa.array(np.concatenate(total)), batch.column("groups")],
                names)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, (table, _) = Links(tokenizer, model), sent.value
        for batch in batches:
            number = batch.column("n_links").to_numpy()
            ids = batch.column("row").to_numpy()
            for first, n, key in links.keys(batch):
                at = np.flatnonzero(table.get(key) == 0)
                row = np.repeat(ids[first:first + n],
                                number[first:first + n])[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(key[at])], ["row", "key"])

    out = rows.mapInArrow(run, schema)
    if not whole:
        # these pairs are rare, so no key holds many of the links
        top_of_b = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("m"))
        rest = counts.where(F.col("n") < least).select(
            "key", "n", b_id.alias("b")).join(top_of_b, "b").select(
            "key", "n", (F.col("n") == F.col("m")).cast("long").alias("top"))
        more = rows.select("row", "a", "b", "n_links").mapInArrow(
            rare, "row long, key long").join(rest, "key").groupBy("row").agg(
            F.sum("top").alias("more_best"), F.sum("n").alias("more_sum"))
        zero = F.lit(0).cast("long")
        out = out.join(more, "row", "left").withColumn(
            "n_best", F.col("n_best") + F.coalesce("more_best", zero)) \
            .withColumn("count_sum", F.col("count_sum")
                        + F.coalesce("more_sum", zero))
    return out.select(*names[1:])


def align_tokens(docs: DataFrame, tokenizer: str | None = None,
                 model: str | None = None, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum and groups_sha256.

    Null and empty texts, and texts whose bytes one of the tokenizers changes,
    have zeros and an empty hash.  Null ids are kept, repeated rows give
    repeated rows (and count as often), an empty table gives an empty result;
    other columns are ignored.  Long texts count whole."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    model = model or public_tokenizers.path(MODEL)
    spark = docs.sparkSession
    path = work_dir(spark, "alignment")
    made = aligned(docs, tokenizer, model).withColumn(
        "row", F.monotonically_increasing_id())
    made.write.mode("overwrite").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    counts = written(pair_counts(rows, tokenizer, model), "alignment-pairs")
    return weighed(rows, counts, tokenizer, model, head)


def op11_query(docs: DataFrame) -> DataFrame:
    return align_tokens(docs)
