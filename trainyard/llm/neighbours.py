"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are scaled to unit length, so that near in angle is near in distance,
and projected to some dimensions with Gaussian (2-stable) weights: for a pair
at distance d, the squared projected distance over d squared is chi-square
distributed.  A kd-tree holds the projected rows; for a query its leaves come
in the order of their projected distance, and their rows are verified by exact
cosine.  The search stops when, for a row as near as the k-th best so far, a
projected distance as large as the next leaf's would be too unlikely.

The upper levels of the tree are split on a bounded sample; they deal all rows
to at most ``CELLS`` cells, which Spark spreads (a cell with many rows in
parts of a bounded size).  A query is searched in its own cell first.  The
k-th best found there decides, by the same test on the cells' boxes, which
other cells it is sent to, so rows move once and queries only to the cells
they may have a neighbour in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trainyard.llm.common import hash_share, written

DIMENSIONS = 24     # projected; even, for the closed form of chi-square
CONFIDENCE = 0.95
CELLS = 1024        # at most; their boxes are broadcast
CELL_ROWS = 4096    # rows aimed at in a cell
PART_ROWS = 8192    # rows of a cell searched as one tree
BLOCK_QUERIES = 4096
SAMPLE = 20_000     # rows that the cells are split on
LEAF = 32
NEAREST = 5


def chi_square_cdf(x: np.ndarray | float, dims: int = DIMENSIONS):
    """P(chi-square with an even number of degrees of freedom <= x)."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for j in range(1, dims // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def leaves_of(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """kd-tree: rows split at the median of the widest dimension, down to
    ``leaf`` rows; returns the row numbers of every leaf."""
    out: list[np.ndarray] = []
    todo = [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            if len(rows):
                out.append(rows)
            continue
        p = points[rows]
        d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(p[:, d], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


class Cells:
    """The upper levels of the tree: splits at medians of a sample."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.at, self.kids = [], [], []
        self.n = 0
        self._split(sample, cells)

    def _split(self, p: np.ndarray, cells: int) -> int:
        node = len(self.dim)
        self.dim.append(-1)
        self.at.append(0.0)
        self.kids.append((0, 0))
        wide = p.max(axis=0) - p.min(axis=0) if len(p) > 1 else np.zeros(1)
        d = int(np.argmax(wide))
        if cells > 1 and wide[d] > 0:
            at = float(np.median(p[:, d]))
            left = p[:, d] < at
            if left.any() and not left.all():
                self.dim[node], self.at[node] = d, at
                self.kids[node] = (self._split(p[left], cells // 2),
                                   self._split(p[~left], cells // 2))
                return node
        self.kids[node] = (self.n, self.n)      # a cell's number
        self.n += 1
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.dim[node] < 0:
                out[rows] = self.kids[node][0]
                continue
            left = points[rows, self.dim[node]] < self.at[node]
            todo += [(self.kids[node][0], rows[left]),
                     (self.kids[node][1], rows[~left])]
        return out


def weights(dims_in: int, dims: int = DIMENSIONS, seed: int = 7
            ) -> np.ndarray:
    return np.random.default_rng((seed, dims_in)).standard_normal(
        (dims_in, dims))


def projected(vectors: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return (vectors / norms[:, None]) @ weights(vectors.shape[1], dims)


class Index:
    """Part of a cell: distinct vectors with their ids, projected, in a kd-tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray,
                 dims: int = DIMENSIONS):
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        self.vectors, inverse = np.unique(vectors, axis=0,
                                          return_inverse=True)
        by = np.argsort(inverse.ravel(), kind="stable")
        self.ids = ids[by]  # ascending per distinct vector
        self.first = np.searchsorted(inverse.ravel()[by],
                                     np.arange(len(self.vectors) + 1))
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.weights = weights(vectors.shape[1], dims)
        self.verified = 0       # rows, over all searches
        self.shadow = p = (self.vectors / self.norms[:, None]) @ self.weights
        leaves = leaves_of(p)
        self.low = np.array([p[x].min(axis=0) for x in leaves])
        self.high = np.array([p[x].max(axis=0) for x in leaves])
        self.rows = np.concatenate(leaves)
        self.edge = np.cumsum([0] + [len(x) for x in leaves])

    def search(self, own, query: np.ndarray, k: int = NEAREST,
               confidence: float = CONFIDENCE, least: float = -2.0
               ) -> list[tuple[float, int]]:
        """(score, id) of the ``k`` nearest found, without id ``own``.
        ``least``: the score of the k-th best that is known from elsewhere."""
        norm = math.sqrt((query * query).sum())
        y = query / norm @ self.weights
        gap = np.maximum(0, np.maximum(self.low - y, y - self.high))
        box = (gap * gap).sum(axis=1)
        order = np.argsort(box, kind="stable")
        best: list[tuple[float, int]] = []

        def unlikely(far: float) -> bool:
            bar = max(least, best[-1][0]) if len(best) >= k else least
            return bar > -2 and chi_square_cdf(
                far / max(2 - 2 * bar, 1e-12),
                self.weights.shape[1]) >= confidence

        # rows of the leaves seen, by projected distance; those no farther
        # than the next leaf's box are next in turn
        rows, far, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 4
        while at < len(order) or len(rows):
            leaves, at = order[at:at + step], at + step
            step *= 2
            if len(leaves):
                new = np.concatenate([self.rows[self.edge[x]:self.edge[x + 1]]
                                      for x in leaves])
                d = self.shadow[new] - y
                rows = np.concatenate([rows, new])
                far = np.concatenate([far, (d * d).sum(axis=1)])
            limit = box[order[at]] if at < len(order) else math.inf
            ready = far <= limit
            turn = np.flatnonzero(ready)
            turn = turn[np.argsort(far[turn], kind="stable")]
            i, some = 0, 8 * k
            while i < len(turn):
                if unlikely(far[turn[i]]):
                    return best
                self._verify(rows[turn[i:i + some]], own, query, norm, k,
                             best)
                i, some = i + some, min(2 * some, 256)
            rows, far = rows[~ready], far[~ready]
            if limit < math.inf and unlikely(limit):
                return best
        return best

    def _verify(self, rows: np.ndarray, own, query: np.ndarray, norm: float,
                k: int, best: list[tuple[float, int]]) -> None:
        """Exact cosines of some rows; the ``k`` best stay in ``best``."""
        self.verified += len(rows)
        score = (self.vectors[rows] * query).sum(axis=1) \
            / (self.norms[rows] * norm)
        if len(best) >= k:
            rows, score = (x[score >= best[-1][0]] for x in (rows, score))
        elif len(rows) > 4 * k:
            cut = np.partition(score, -2 * k)[-2 * k]
            rows, score = (x[score >= cut] for x in (rows, score))
        for s, r in zip(score.tolist(), rows.tolist()):
            same = self.ids[self.first[r]:self.first[r + 1]][:k + 1]
            best += [(s, i) for i in same.tolist() if i != own]
        best.sort(key=lambda x: (-x[0], x[1]))
        del best[k:]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can have an angle: (vec_id, embedding) without null, empty
    and zero vectors and those with null, NaN or infinite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return (vectors.select("vec_id", F.col("embedding").cast("array<double>")
                           .alias("embedding"))
            .where("vec_id is not null and embedding is not null")
            .where(finite & some).distinct())


def _search(asked: DataFrame, index: DataFrame, k: int, confidence: float
            ) -> DataFrame:
    """Queries (query_id, dim, q, least, cell) in the rows (vec_id, dim,
    embedding, cell) of their cells: query_id, vec_id, score.  Cells are
    searched in parts of bounded size, by blocks of queries."""
    sizes = index.groupBy("dim", "cell").agg(
        F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")).join(
        asked.groupBy("dim", "cell").agg(
            F.ceil(F.count("*") / BLOCK_QUERIES).cast("int")
            .alias("blocks")), ["dim", "cell"])
    sizes = written(sizes, "nn-sizes")  # at most a row per cell and length

    def dealt(df: DataFrame, key: str, mine: str, n: str, other: str,
              m: str) -> DataFrame:
        return df.join(sizes, ["dim", "cell"]).withColumn(
            mine, F.pmod(F.xxhash64(key, F.lit(3)), F.col(n)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0),
                                                    F.col(m) - 1))) \
            .drop("parts", "blocks")

    # both come from one table: new columns, so that their names are plain
    index, asked = (df.toDF(*df.columns) for df in (index, asked))
    rows = dealt(index, "vec_id", "part", "parts", "block", "blocks")
    queries = dealt(asked, "query_id", "block", "blocks", "part", "parts")
    rows, queries = (df.toDF(*df.columns) for df in (rows, queries))

    def run(queries: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(part):
            tree = Index(part["vec_id"].to_numpy(),
                         np.stack(part["embedding"].to_numpy()))
            for own, q, least in zip(queries["query_id"].tolist(),
                                     queries["q"], queries["least"]):
                out += [(own, i, s) for s, i in tree.search(
                    own, np.asarray(q), k, confidence, least)]
        return pd.DataFrame({
            "query_id": pd.Series([x[0] for x in out], dtype="int64"),
            "vec_id": pd.Series([x[1] for x in out], dtype="int64"),
            "score": pd.Series([x[2] for x in out], dtype="float64")})

    keys = ["dim", "cell", "part", "block"]
    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(
        run, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, rank, vec_id, score); ties: the smaller id."""
    one = found.groupBy("query_id", "vec_id").agg(F.max("score")
                                                  .alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(by)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST,
            cell_rows: int = CELL_ROWS, confidence: float = CONFIDENCE
            ) -> DataFrame:
    """The ``k`` nearest rows by cosine of every row with ``is_query``, its
    own id left out: query_id, rank (from 1), vec_id, score.

    Vectors that are null, zero or hold null or non-finite components take no
    part; only vectors of equal length are compared; ties go to the smaller
    vec_id; repeated rows count once; an id with several vectors counts with
    its nearest.  An empty table gives no rows; other columns are ignored.
    Every row is in a cell; a sample of some ``SAMPLE`` rows only sets where
    the cells are split."""
    vectors = vectors.withColumn("vec_id", F.col("vec_id").cast("long"))
    rows = usable(vectors).withColumn("dim", F.size("embedding"))
    flagged = vectors.where(is_query).select("vec_id").distinct() \
        .withColumn("is_query", F.lit(True))
    rows = written(rows.join(flagged, "vec_id", "left").select(
        "vec_id", "dim", "embedding",
        F.coalesce("is_query", F.lit(False)).alias("is_query")), "nn-rows")
    n = rows.count()
    spark = vectors.sparkSession

    def project(table: pa.RecordBatch) -> np.ndarray:
        """Projections, row by row of one length at a time."""
        out = np.zeros((len(table), DIMENSIONS))
        dim = table.column("dim").to_numpy()
        lists = table.column("embedding")
        for d in np.unique(dim).tolist():
            at = np.flatnonzero(dim == d)
            out[at] = projected(np.array(
                lists.take(pa.array(at)).to_pylist(), float))
        return out

    h = F.xxhash64("vec_id", "embedding", F.lit(7))

    def shadows(batches: Iterator[pa.RecordBatch]
                ) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(project(b)), pa.list_(pa.float64()))], ["p"])

    sample = rows.where(hash_share(h, SAMPLE, n)).select(
        "dim", "embedding").mapInArrow(shadows, "p array<double>").collect()
    sample = np.array([r.p for r in sample]).reshape(-1, DIMENSIONS)
    wanted = min(CELLS, max(1, n // cell_rows))
    sent = spark.sparkContext.broadcast(Cells(sample, wanted))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = project(b)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(sent.value.of(p)),
                 pa.array(list(p), pa.list_(pa.float64()))],
                [*b.schema.names, "cell", "p"])

    schema = ("vec_id long, dim int, embedding array<double>, is_query "
              "boolean, cell int, p array<double>")
    placed = written(rows.mapInArrow(place, schema), "nn-placed")
    index = placed.select("vec_id", "dim", "embedding", "cell")
    asked = placed.where("is_query").select(
        F.col("vec_id").alias("query_id"), "dim",
        F.col("embedding").alias("q"), "cell", "p")
    first = written(_search(asked.drop("p").withColumn("least", F.lit(-2.0)),
                            index, k, confidence), "nn-first")
    # a query's k-th best so far; none while it has fewer
    bar = _best(first, k).groupBy("query_id").agg(F.when(
        F.count("*") == k, F.min("score")).alias("bar"))
    # a row per cell and length: boxes of bounded number per length
    boxes = placed.groupBy("dim", "cell").agg(*[
        f(F.col("p")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS)
        for name, f in (("lo", F.min), ("hi", F.max))])
    boxes = written(boxes.select(
        "dim", F.col("cell").alias("other"), F.array(
            *[f"lo{i}" for i in range(DIMENSIONS)]).alias("lo"), F.array(
            *[f"hi{i}" for i in range(DIMENSIONS)]).alias("hi")), "nn-boxes")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, tuple] = {}
        for d in {r[0] for r in known.value}:
            mine = [r for r in known.value if r[0] == d]
            at[d] = (np.array([r[1] for r in mine]),
                     np.array([r[2] for r in mine]),
                     np.array([r[3] for r in mine]))
        for b in batches:
            row, cells = [], []
            for i, (d, cell, p, least) in enumerate(zip(
                    *[b.column(c).to_pylist()
                      for c in ("dim", "cell", "p", "least")])):
                number, lo, hi = at[d]
                y = np.array(p)
                gap = np.maximum(0, np.maximum(lo - y, y - hi))
                far = (gap * gap).sum(axis=1)
                ok = number != cell
                if least > -2:
                    ok &= chi_square_cdf(far / max(2 - 2 * least, 1e-12)) \
                        < confidence
                cells.append(number[ok])
                row.append(np.full(int(ok.sum()), i))
            row, cells = np.concatenate(row), np.concatenate(cells)
            yield pa.RecordBatch.from_arrays(
                [b.column(c).take(pa.array(row)) for c in
                 ("query_id", "dim", "q", "least")]
                + [pa.array(cells.astype(np.int32))],
                ["query_id", "dim", "q", "least", "cell"])

    known = spark.sparkContext.broadcast([tuple(r) for r in boxes.collect()])
    second = asked.join(bar, "query_id", "left").withColumn(
        "least", F.coalesce("bar", F.lit(-2.0))).drop("bar").mapInArrow(
        reach, "query_id long, dim int, q array<double>, least double, "
        "cell int")
    second = written(second, "nn-reached")
    return _best(first.unionByName(_search(second, index, k, confidence)), k)


def op7_query(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 50 == 0)

