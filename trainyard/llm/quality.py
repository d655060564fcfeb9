"""Quality classifier by Bradley-Terry pairwise ranking.

Every preference pair is a document marked good against one marked bad; the
logistic loss on the difference of their features gives the weights of a
linear score.  The threshold is a quantile of the scores: as large a share of
the labelled rows scores below it as is marked bad.  Scores are mapped to
0..1 so that the threshold is at 0.7.

Features are taken from every text once.  Training goes over all labelled rows
in Spark and counts all their pairs: rows are grouped by label and score (bins
``WIDTH`` wide), and the loss of a pair depends on its two scores, so a Newton
step needs only sums over the bins, and a pass that weights the products of
features with them.  The threshold is found among the scores of all of them.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainyard.llm.common import written

WIDTH, SPAN = 0.05, 600     # of a bin of scores; bins on either side of 0
CUT = 0.7           # score of the threshold
RIDGE = 1e-2
FOLDS, HELD_OUT = 4, 2

FEATURES = ["upper", "digit", "space", "newline", "punctuation", "symbols",
            "marks", "pipes", "high bytes", "word length", "long words",
            "distinct words", "top word", "words ending in symbols",
            "distinct lines", "ended lines", "compressed", "compressed x size",
            "log words", "any words"]
_CLASSES = [bytes(range(65, 91)), b"0123456789", b" \t\x0b\x0c\r", b"\n",
            b".,;:'\"-()", b"#$%&*+/<=>@[\\]^_`{}~", b"!?", b"|",
            bytes(range(128, 256))]
_BY_CLASS = np.array([[c in k for k in _CLASSES] for c in range(256)], float)


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all 0 if it is null or empty."""
    data = (text or "").encode()
    n = len(data)
    if not n:
        return [0.0] * len(FEATURES)
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) \
        @ _BY_CLASS / n
    words = data.split()
    count = Counter(words)
    n_words = len(words)
    w = max(1, n_words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    packed = 0
    squeeze = zlib.compressobj(1)
    for i in range(0, n, 1 << 20):
        packed += len(squeeze.compress(data[i:i + (1 << 20)]))
    packed = min(1.5, (packed + len(squeeze.flush())) / n)
    size = math.log1p(n_words)
    return [*share, (n - share[2] * n) / w / 10,
            sum(len(x) > 20 for x in words) / w, len(count) / w,
            max(count.values(), default=0) / w,
            sum(x[-1] in b"#$%&*!|" for x in words) / w,
            len(set(lines)) / n_lines,
            sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / n_lines,
            packed, packed * size / 10, size / 10, float(n_words > 0)]


@dataclass
class Ranking:
    """score = weights . features; ``cut`` is the threshold."""
    weights: np.ndarray
    cut: float
    fitted: bool = True

    def score(self, x: np.ndarray) -> np.ndarray:
        """0..1, ``CUT`` at the threshold; ``CUT`` for all if nothing was
        learned (no pair of labels)."""
        if not self.fitted:
            return np.full(len(x), CUT)
        z = np.clip(x @ self.weights - self.cut, -500, 500)
        return np.where(z == 0, CUT, 1 / (1 + np.exp(-z) * (1 - CUT) / CUT))


def _bin(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z / WIDTH), -SPAN, SPAN).astype(int) + SPAN


def _sums(x: np.ndarray, label: np.ndarray, w: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, bin, [n, sum of features]) of the bins that have rows."""
    at, of = np.unique(label * (2 * SPAN + 1) + _bin(x @ w),
                       return_inverse=True)
    out = np.zeros((len(at), x.shape[1] + 1))
    np.add.at(out, of, np.column_stack([np.ones(len(x)), x]))
    return at // (2 * SPAN + 1), at % (2 * SPAN + 1), out


def _products(x: np.ndarray, label: np.ndarray, w: np.ndarray,
              weight: np.ndarray) -> np.ndarray:
    """Products of the features, each row by the weight of its bin."""
    return (x * weight[label, _bin(x @ w)][:, None]).T @ x


def _newton(sums, products, size: int) -> np.ndarray:
    """Weights that maximise the ridge penalised mean log-likelihood over all
    pairs of a row of label 1 and one of label 0.  ``sums(w)`` gives an array
    (label, bin, [n, *sums]) and ``products(w, weight)`` a matrix."""
    centre = (np.arange(2 * SPAN + 1) - SPAN) * WIDTH
    wrong = 1 / (1 + np.exp(centre[:, None] - centre[None, :]))
    w = np.zeros(size)
    for _ in range(25):
        bins = sums(w)
        (n0, x0), (n1, x1) = ((b[:, 0], b[:, 1:]) for b in bins)
        pairs = n0.sum() * n1.sum()
        p = wrong / pairs               # of the wrong order, by good and bad
        v = p * (1 - wrong)
        gradient = (p @ n0) @ x1 - (p.T @ n1) @ x0 - RIDGE * w
        both = x1.T @ v @ x0
        curve = products(w, np.stack([v.T @ n1, v @ n0])) - both - both.T
        step = np.linalg.solve(curve + RIDGE * np.eye(size), gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float) -> Ranking:
    """The ranking of rows at hand; the cut is their score quantile, where bad
    ones weigh ``bad_share`` in all."""
    if not len(good) or not len(bad):
        return Ranking(np.zeros(len(FEATURES)), 0.0, False)
    both = np.concatenate([good, bad])
    label = np.repeat([1, 0], [len(good), len(bad)])
    mean, scale = both.mean(axis=0), _scale(both.std(axis=0))
    x = (both - mean) / scale

    def sums(w):
        out = np.zeros((2, 2 * SPAN + 1, x.shape[1] + 1))
        lab, at, got = _sums(x, label, w)
        out[lab, at] = got
        return out

    w = _newton(sums, lambda w, weight: _products(x, label, w, weight),
                x.shape[1]) / scale
    scores = both @ w
    weight = np.where(label == 1, (1 - bad_share) / len(good),
                      bad_share / len(bad))
    order = np.argsort(scores, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-12))
    lo = scores[order[min(at, len(order) - 1)]]
    hi = scores[order[min(at + 1, len(order) - 1)]]
    return Ranking(w, float((lo + hi) / 2))


def _scale(std: np.ndarray) -> np.ndarray:
    return np.where(std < 1e-9, 1.0, std)


def held_out() -> Column:
    """Rows never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
                      % FOLDS == HELD_OUT, F.lit(False))


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash) and f (its features) of every row, as a
    written table."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"),
                 pa.array(_matrix(b.column("text")).tolist(),
                          pa.list_(pa.float64()))], ["doc_id", "h", "f"])

    return written(docs.select(
        "doc_id", F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("h")).mapInArrow(
        run, f"doc_id {kind}, h long, f array<double>"), "features")


def train(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on ``docs`` (doc_id, text) marked in ``labels`` (doc_id, quality
    0/1), on all of them.  Held out rows, null ids and null labels are not
    used; a document with both labels counts with each, one of several texts
    with the same id with one of them.  Null and empty texts have features
    too; other columns are ignored."""
    return train_featured(featured(docs), labels)


def train_featured(table: DataFrame, labels: DataFrame) -> Ranking:
    """:func:`train` on a table of :func:`featured`."""
    known = labels.where(~held_out()).where(
        "doc_id is not null and quality in (0, 1)").select(
        "doc_id", F.col("quality").cast("int").alias("label")).distinct()
    # a repeated id counts with one of its texts, always the same
    rows = written(table.join(known, "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("f", "h").alias("f")).select("label", "f"), "labelled")
    n = range(len(FEATURES))
    first = rows.agg(F.count_if(F.col("label") == 0), F.count_if(
        F.col("label") == 1), *[F.avg(F.col("f")[i]) for i in n],
        *[F.stddev_pop(F.col("f")[i]) for i in n]).first()
    n_bad, n_good, *moments = first
    if not n_bad or not n_good:
        return Ranking(np.zeros(len(FEATURES)), 0.0, False)
    mean = np.array(moments[:len(FEATURES)])
    scale = _scale(np.array(moments[len(FEATURES):]))
    columns = [f"c{i}" for i in range(len(FEATURES) + 1)]

    def total(of):
        """Sums by (label, at) of what ``of(x, label)`` makes of a batch."""
        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = (_listed(b.column("f")) - mean) / scale
                    lab, at, out = of(x, b.column("label").to_numpy())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lab, pa.int32()), pa.array(at, pa.int32()),
                         *map(pa.array, out.T.copy())],
                        ["label", "at", *columns])
        return rows.mapInArrow(run, "label int, at int, " + ", ".join(
            f"{c} double" for c in columns)).groupBy("label", "at").agg(
            *[F.sum(c).alias(c) for c in columns]).collect()

    def sums(w):
        out = np.zeros((2, 2 * SPAN + 1, len(columns)))
        for r in total(lambda x, label: _sums(x, label, w)):
            out[r[0], r[1]] = r[2:]
        return out

    def products(w, weight):
        def of(x, label):
            got = _products(x, label, w, weight)
            return (np.zeros(len(got), int), np.arange(len(got)),
                    np.column_stack([np.zeros(len(got)), got]))
        return np.array([r[3:] for r in sorted(total(of),
                                               key=lambda r: r[1])])

    # sums differ in their last digits by the order of tasks; weights do not
    w = np.round(_newton(sums, products, len(FEATURES)), 9) / scale

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_listed(b.column("f")) @ w)], ["z"])

    scores = written(rows.mapInArrow(score, "z double"), "scores")
    return Ranking(w, (_nth(scores, n_bad - 1) + _nth(scores, n_bad)) / 2)


def _listed(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(FEATURES))


def _nth(scores: DataFrame, n: int) -> float:
    """The n-th smallest ``z`` (from 0) of a table: a thousand ranges are
    counted, then the one that holds it is split again."""
    low, high = scores.agg(F.min("z"), F.max("z")).first()
    while low < high:
        width = (high - low) / 1000
        parts = scores.where(F.col("z").between(low, high)).groupBy(
            F.floor((F.col("z") - low) / width).alias("part")).agg(
            F.count("*").alias("n"), F.min("z").alias("low"),
            F.max("z").alias("high")).orderBy("part").collect() \
            if width > 0 else []
        if len(parts) < 2:
            break
        for r in parts:
            if n < r.n:
                low, high = r.low, r.high
                break
            n -= r.n
    return low


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in column]).reshape(
        -1, len(FEATURES))


def scored(table: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and score of every row of a :func:`featured` table; null and
    empty texts have a score too, repeated rows repeat, long texts count
    whole."""
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(model.score(_listed(
                    b.column("f"))))], ["doc_id", "score"])

    return table.select("doc_id", "f").mapInArrow(
        run, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, model: Ranking, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more, all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(
                model.score(_matrix(b.column("text"))) >= cut))

    return docs.mapInArrow(run, docs.schema)


def op3_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    table = featured(docs)
    return scored(table, train_featured(table, labels)).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
