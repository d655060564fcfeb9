"""Language-model scores of whole texts.

Tokens are lower-cased words and one end per text.  Two scores are given: a
unigram base from the word counts of all training texts, and the probability
under the attention model of ``attention.py``, which tilts the base by
context.  Counts, vocabulary, the network's weights and the model's P(k) come
from every training text, whatever its length.  The network starts from random
weights; every window of every training text is fitted once, in two rounds (the
first, of a fixed share, gives the second its start).  In a round, parts
that a hash of the rows makes are fitted apart and their changes averaged, so
the weights do not depend on how the input is split.

The counts of the ``HEAD`` most frequent words are broadcast (a bounded
number of rows); rarer words of each text are joined to the table of counts.
"""

from __future__ import annotations

import math
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from trainyard.llm import attention
from trainyard.llm.common import written

TOKENIZER = "byte_bpe_50k.json"
HEAD = 100_000          # words whose counts are broadcast
FIRST = 8               # one in so many texts is in the first round
PART_TOKENS = 5_000_000     # training tokens of a part
LEAST_PARTS = 8
FAN = 256               # tasks whose changes of the weights are added at once
SLICE = 1_500_000       # characters of text scored at once
COUNTED = 4_000_000     # words counted at once
HASHED = 2_000_000      # words a partition that a join holds (240 MB)
FOLDS, HELD_OUT = 10, 0
SMOOTH = 0.1
END = b""               # stands for the end token among words
TOGETHER = 200          # words encoded in one text
BLANK = "\u0120"        # as byte-level vocabularies write it
OTHER_BLANK = re.compile(r"[^\S ]")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, one after another, and how many each
    text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = parts.flatten().cast(pa.binary())
    # blanks at the ends of a text leave empty words
    real = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(
        zero_copy_only=False))])
    edge = parts.offsets.to_numpy()
    return (words if before[-1] == len(words) else words.filter(real),
            np.diff(before[edge - edge[0]]))


def held_out() -> Column:
    """crc32 of the id as text, mod 10, is 0; rows without id train."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
                      % FOLDS == HELD_OUT, F.lit(False))


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Of more than ``SLICE`` characters, but for the last."""
    size, begin = 0, 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist(), 1):
        size += n or 0
        if size > SLICE or i == len(texts):
            yield texts.slice(begin, i - begin)
            size, begin = 0, i


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n): all words of all texts; the empty word counts the
    ends, one per text.  Each task adds up before it sends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Array] = []
        size = ends = 0

        def out() -> pa.RecordBatch:
            seen = pa.concat_arrays(kept).value_counts() if kept else \
                pa.array([], pa.struct({"values": pa.binary(),
                                        "counts": pa.int64()}))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([seen.field("values"),
                                   pa.array([END], pa.binary())]),
                 pa.concat_arrays([seen.field("counts"),
                                   pa.array([ends], pa.int64())])],
                ["word", "n"])

        for batch in batches:
            for some in slices(batch.column("text")):
                kept.append(words_of(some)[0])
                size += len(kept[-1])
                ends += len(some)
                if size > COUNTED:
                    yield out()
                    kept.clear()
                    size = ends = 0
        if ends:
            yield out()
        kept.clear()
        pa.default_memory_pool().release_unused()

    return (texts.select(F.col("text").cast("string"))
            .mapInArrow(run, "word binary, n long")
            # not added up again in the same task, where few words are equal
            .repartition("word").groupBy("word").agg(F.sum("n").alias("n")))


class Subwords:
    """Subword ids of words by a public tokenizer, in a bounded cache."""

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end = self.tokenizer.get_vocab_size() - 1
        self.limit = limit
        # byte-level tokenizers read words between blanks apart
        cut = self.tokenizer.pre_tokenizer
        self.joins = (
            isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex
            and self.tokenizer.normalizer is None
            and all(t.special for t in
                    self.tokenizer.get_added_tokens_decoder().values()))
        self.begins = np.zeros(self.end + 1, bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items()
                     if t.startswith(BLANK)]] = True

        self.known: dict[bytes, int] = {END: 0}     # in order of their number
        self.ids = attention.Words(np.array([self.end], np.int32),
                                   np.array([0, 1], np.int64))
        self.again = np.ones(1, bool)               # asked for more than once
        self.logs: tuple[str, np.ndarray] = "", np.zeros(0)

    def _places(self, words: list[bytes]) -> np.ndarray:
        """Places of distinct words among the known, until the next call."""
        if len(self.known) > self.limit:
            self._forget()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64,
                         len(words))
        miss = np.flatnonzero(at < 0)
        self.again[at[at >= 0]] = True
        if len(miss):
            new = [words[i] for i in miss.tolist()]
            ids, sizes = self._encoded(new)
            first = len(self.known)
            at[miss] = np.arange(first, first + len(new))
            self.known.update(zip(new, range(first, first + len(new))))
            self.ids = attention.Words(
                np.concatenate([self.ids.ids, ids]),
                np.concatenate([self.ids.edge,
                                np.cumsum(sizes) + len(self.ids.ids)]))
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return at

    def _forget(self) -> None:
        """All but the words asked for more than once, or half of the limit of
        those."""
        kept = np.flatnonzero(self.again)[:max(1, self.limit // 2)]
        words = list(self.known)
        self.known = {words[i]: j for j, i in enumerate(kept.tolist())}
        self.ids = self.ids.take(kept)
        self.again = np.zeros(len(kept), bool)
        self.again[0] = True
        name, logs = self.logs
        self.logs = name, logs[kept[kept < len(logs)]]

    def of(self, words: list[bytes]) -> attention.Words:
        """``words``: distinct, not kept; the empty word is the end token."""
        ids, sizes = self._encoded([w for w in words if w])
        if END in words:
            i = words.index(END)
            ids = np.insert(ids, sizes[:i].sum(), self.end)
            sizes = np.insert(sizes, i, 1)
        return attention.Words(ids.astype(np.int32),
                               np.concatenate([[0], np.cumsum(sizes)]))

    def numbered(self, texts: pa.Array) -> tuple[
            list[np.ndarray], attention.Words, pa.Array, np.ndarray]:
        """Texts as numbers of their distinct words, number 0 the end token,
        the others as they first occur; these words as ids and as they are,
        and their places among the known until the next call."""
        words, size = words_of(texts)
        code = words.dictionary_encode()
        edge = np.cumsum(size + 1)
        flat = np.zeros(len(words) + len(texts), np.int32)
        word = np.ones(len(flat), bool)
        word[edge - 1] = False
        flat[word] = code.indices.to_numpy() + 1
        words = pa.concat_arrays([pa.array([END], pa.binary()),
                                  code.dictionary])
        at = self._places(words.to_numpy(zero_copy_only=False).tolist())
        return (np.split(flat, edge[:-1]),
                self.ids.take(at), words, at)

    def bases(self, scorer: Scorer, at: np.ndarray) -> np.ndarray:
        """``scorer.head`` of words at these places, NaN for others."""
        name, logs = self.logs
        if name != scorer.name:
            logs = np.zeros(0)
        if len(logs) < len(self.known):
            logs = np.concatenate([logs, np.fromiter(
                map(scorer.head.get, islice(self.known, len(logs), None),
                    repeat(math.nan)), float, len(self.known) - len(logs))])
            self.logs = scorer.name, logs
        return logs[at]

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each behind a blank, and how many each has.  Words
        are encoded ``TOGETHER`` where that gives what each alone gives: where
        no other blank is in them."""
        texts: list[str] = []
        held: list[int] = []                        # words of each text
        for i in range(0, len(words), TOGETHER):
            some = words[i:i + TOGETHER]
            text = " " + b" ".join(some).decode()
            if self.joins and not OTHER_BLANK.search(text):
                texts.append(text)
                held.append(len(some))
            else:
                texts += [" " + w.decode() for w in some]
                held += [1] * len(some)
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(texts), 100):
            for n, text, e in zip(
                    held[i:], texts[i:i + 100],
                    self.tokenizer.encode_batch_fast(
                        texts[i:i + 100], add_special_tokens=False)):
                x = np.array(e.ids, np.int32)
                first = np.flatnonzero(self.begins[x]) if n > 1 else [0]
                if len(first) == n:
                    ids.append(x)
                    sizes.append(np.diff(first, append=len(x)))
                    continue
                for w in text[1:].split(" "):
                    x = np.array(self.tokenizer.encode(
                        " " + w, add_special_tokens=False).ids, np.int32)
                    ids.append(x)
                    sizes.append(np.array([len(x)]))
        return np.concatenate(ids), np.concatenate(sizes)


@dataclass
class Scorer:
    """All a task needs; ``head``: log10 of the base chance of the most
    frequent words."""
    name: str
    model: attention.Model
    head: dict[bytes, float]
    tokenizer: str


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """One per Python worker, used again by its later tasks."""
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


def fit(train: DataFrame, n_tokens: int, tokenizer: str) -> attention.Model:
    """Network weights from all windows of all training texts, in two rounds
    of disjoint texts.  In each, every part goes through its texts in the
    order of their hash, and the changes of the weights are averaged, each
    subword's by how often a part has seen it."""
    model = attention.Model(**attention.initial(
        Subwords(tokenizer).end + 1))
    h = F.xxhash64("doc_id", "text")
    rows = train.select("text", h.alias("h"))
    first = F.pmod(F.col("h"), F.lit(FIRST)) == 0
    for some, share in ((rows.where(first), 1 / FIRST),
                        (rows.where(~first), 1 - 1 / FIRST)):
        model = _round(some, model, tokenizer, max(
            LEAST_PARTS, int(n_tokens * share) // PART_TOKENS))
    return model


def _round(rows: DataFrame, model: attention.Model, tokenizer: str,
           parts: int) -> attention.Model:
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def fitted(part: int, local: attention.Local
               ) -> Iterator[pa.RecordBatch]:
        local.finish()
        for k, x in local.blocks() if local.windows else ():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([k], pa.int32()), pa.array([x.tobytes()],
                                                     pa.binary())],
                ["part", "at", "k", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local, texts, size = None, None, [], 0

        def go() -> None:
            if texts:
                t, words, *_ = subwords(tokenizer).numbered(
                    pa.concat_arrays(texts))
                local.add(t, words, 0)
                texts.clear()

        for batch in batches:
            text = batch.column("text")
            for i, (p, n) in enumerate(zip(
                    batch.column("part").to_pylist(),
                    pc.utf8_length(text).to_pylist())):
                if p != part:
                    if local:
                        go()
                        yield from fitted(part, local)
                    part, local, size = p, attention.Local(sent.value), 0
                texts.append(text.slice(i, 1))
                size += n or 0
                if size > SLICE:
                    go()
                    size = 0
        if local:
            go()
            yield from fitted(part, local)

    def add(table: pa.Table) -> pa.Table:
        # in the order of the parts, so that reruns round alike
        table = table.sort_by("at")
        k = table.column("k")[0].as_py()
        kind = np.float64 if k < 0 else np.float32
        x = sum(np.frombuffer(v.as_py(), kind) for v in table.column("x"))
        return pa.table({"part": table.column("part").slice(0, 1),
                         "at": table.column("at").slice(0, 1),
                         "k": table.column("k").slice(0, 1),
                         "x": pa.array([x.tobytes()], pa.binary())})

    kind = "part int, at int, k int, x binary"
    got = rows.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts))
                          .cast("int")).repartition(parts, "part") \
        .sortWithinPartitions("part", "h").select("part", "text") \
        .mapInArrow(run, kind)
    # no group adds up more than FAN blocks
    while parts > 1:
        parts = -(-parts // FAN)
        got = got.withColumn("part", F.floor(F.col("part") / FAN)
                             .cast("int")).groupBy("part", "k").applyInArrow(
                                 add, kind)
    total: dict[int, np.ndarray] = {}
    for r in sorted(got.collect(), key=lambda r: (r.k, r.at)):
        # the weights once
        x = np.frombuffer(r.x, np.float64 if r.k < 0 else np.float32)
        total[r.k] = total[r.k] + x if r.k in total else x
    return attention.averaged(model, total)


def part_shares(counts: DataFrame, model: attention.Model, tokenizer: str
                ) -> np.ndarray:
    """P(k) under the base: each distinct word once, by its smoothed count,
    so that the tilted chances of all known words sum to what the base gives
    them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(attention.PARTS)
        for batch in batches:
            words = batch.column("word").to_numpy(
                zero_copy_only=False).tolist()
            n = batch.column("n").to_numpy(zero_copy_only=False) + SMOOTH
            for i in range(0, len(words), 20_000):
                r = model.parts_of(subwords(tokenizer).of(words[i:i + 20_000]))
                total += n[i:i + 20_000] @ r.astype(float)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(total)],
            ["k", "n"])

    got = counts.mapInArrow(run, "k int, n double").groupBy("k").agg(
        F.sum("n").alias("n")).collect()  # one row per part
    share = np.zeros(attention.PARTS)
    for r in got:
        share[r.k] = r.n
    return np.maximum(share / max(share.sum(), 1e-300), 1e-9) \
        if share.sum() else np.full(attention.PARTS, 1 / attention.PARTS)


def _score(ids: pa.Array, texts: pa.Array, scorer: Scorer, first: int
           ) -> pa.RecordBatch:
    known = subwords(scorer.tokenizer)
    t, subs, words, at = known.numbered(texts)
    tilt = scorer.model.tilt(t, subs, 0) / math.log(10)
    value = known.bases(scorer, at)
    rare = np.isnan(value)
    value[rare] = 0.0
    size = np.array([len(x) for x in t], np.int64)
    flat, owner = np.concatenate(t), np.repeat(np.arange(len(t)), size)
    seldom = rare[flat]
    # rare words of each text, each once with its number
    pair, n = np.unique(owner[seldom] * len(words) + flat[seldom],
                        return_counts=True)
    edge = np.searchsorted(pair // len(words), np.arange(len(t) + 1))
    tail = pa.StructArray.from_arrays(
        [words.take(pa.array(pair % len(words))),
         pa.array(n.astype(np.int64))], ["word", "n"])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first, first + len(t))), ids,
         pa.array(size),
         pa.array(size - np.bincount(owner[seldom], minlength=len(t))),
         pa.array(np.bincount(owner, value[flat], len(t))), pa.array(tilt),
         pa.ListArray.from_arrays(pa.array(edge, pa.int32()), tail)],
        ["row", "doc_id", "n_tokens", "n_head", "base", "tilt", "tail"])


def frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent words, ``limit`` at most: all whose count is above a
    bound taken from a histogram of counts, so that nothing is sorted and no
    more than ``limit`` rows ever leave."""
    level = F.floor(F.log2("n") * 16).cast("int")
    bars = counts.groupBy(level.alias("l")).count().collect()  # < 1024 rows
    least, total = None, 0
    for r in sorted(bars, key=lambda r: -r["l"]):
        total += r["count"]
        if total > limit:
            break
        least = r["l"]
    return counts.where(F.lit(False) if least is None else level >= least)


def score_texts(docs: DataFrame, tokenizer: str | None = None,
                head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known (tokens that training texts have), train_tokens, base_score and
    score (both log10 of the probability of the whole text).

    Null and empty texts are an end token alone.  Repeated rows are scored
    each; rows with a null doc_id train and are scored; without training
    texts every word has the same chance; an empty table gives no rows; other
    columns are ignored.  Words may be of any length."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    docs = docs.select("doc_id", F.col("text").cast("string"))
    train = docs.where(~held_out())
    counts = written(word_counts(train), "lm-counts")
    n_train, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    n_train = n_train or 0
    log_all = math.log10(n_train + SMOOTH * (distinct + 1))
    model = fit(train, n_train, tokenizer)
    model.share = part_shares(counts, model, tokenizer)
    most = {bytes(r.word): math.log10(r.n + SMOOTH) - log_all
            for r in frequent(counts, head).collect()}
    sent = spark.sparkContext.broadcast(
        Scorer(uuid.uuid4().hex, model, most, tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            done = 0
            for some in slices(batch.column("text")):
                yield _score(batch.column("doc_id").slice(done, len(some)),
                             some, sent.value, row)
                done, row = done + len(some), row + len(some)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(docs.mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, n_head long, base "
        "double, tilt double, tail array<struct<word: binary, n: long>>"),
        "lm-rows")
    # few words a partition need no sort to be found
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (rows.select("row", F.inline("tail"))
             .withColumnRenamed("n", "times")
             .join(counts.hint("shuffle_hash")
                   if distinct <= HASHED * partitions else counts,
                   "word", "left")
             .groupBy("row").agg(
                 F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0))
                 .alias("n_rare"),
                 F.sum(F.col("times") * (
                     F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))
                     - F.lit(log_all))).alias("rare")))
    got = rows.drop("tail").join(found, "row", "left")
    base = F.col("base") + F.coalesce("rare", F.lit(0.0))
    return got.select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).cast("long")
        .alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + F.col("tilt")).alias("score"))


def op9_query(docs: DataFrame) -> DataFrame:
    return score_texts(docs)
