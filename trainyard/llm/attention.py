"""A small causal self-attention language model in numpy.

Tokens are words, read as the ids of their subwords.  The model tilts the
corpus' unigram probabilities by what it has seen: the chance of the next word
w is

    p(w) * sum over parts k of  pi_k(context) * P(k | w) / P(k),

where pi comes from one attention head over the words of the window and from
the current word, P(k | w) from the subwords of w, and P(k) is the mean of
P(k | w) over the corpus, so that the chances of all words sum to 1.  A word's
vectors are sums or means over its subword ids; what is learned (Adam on the
log likelihood) has a row per subword id, so words never seen before have
vectors too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

CONTEXT = 32        # words a window sees
STRIDE = 16         # words a window scores; windows overlap by the rest
WIDTH = 16          # of keys, queries and values
PARTS = 16
BATCH = 128         # windows scored at once: their arrays stay in the cache
FAR = np.float32(-1e9)
RUN = 8             # rows added one by one
LEAST_STEPS = 200   # of a part's fit, if its windows are few


@dataclass
class Words:
    """Distinct words as subword ids: word i has ids[edge[i]:edge[i + 1]],
    one at least."""
    ids: np.ndarray
    edge: np.ndarray

    def total(self, table: np.ndarray, mean: bool) -> np.ndarray:
        """Sum (or mean) of the table's rows of each word's ids."""
        n = np.diff(self.edge)
        out = run_sums(table, self.ids, n)
        return out / n[:, None].astype(np.float32) if mean else out

    def take(self, at: np.ndarray) -> Words:
        n = np.diff(self.edge)[at]
        edge = np.concatenate(([0], np.cumsum(n)))
        where = np.arange(edge[-1]) - np.repeat(edge[:-1], n) \
            + np.repeat(self.edge[at], n)
        return Words(self.ids[where], edge)


def softmax(z: np.ndarray) -> np.ndarray:
    """Of each column."""
    z = z - z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def across(z: np.ndarray) -> np.ndarray:
    """Rows as columns, in this order in memory."""
    return np.ascontiguousarray(z.T)


@dataclass
class Model:
    """embed, current, output: a row per subword id; key, query, value, mix:
    small matrices; near: bias by distance; share: P(k) of the corpus."""
    embed: np.ndarray
    current: np.ndarray
    output: np.ndarray
    key: np.ndarray
    query: np.ndarray
    value: np.ndarray
    mix: np.ndarray
    near: np.ndarray
    share: np.ndarray = field(default_factory=lambda: np.ones(PARTS))

    @cached_property
    def side(self) -> np.ndarray:
        """The tables side by side."""
        return np.concatenate([self.embed, self.current, self.output], axis=1)

    def parts_of(self, words: Words) -> np.ndarray:
        """P(k | w) of distinct words."""
        return softmax(across(words.total(self.output, False))).T

    def tilt(self, texts: list[np.ndarray], words: Words, start: int
             ) -> np.ndarray:
        """Sum over the tokens of each text (numbers of ``words``) of the
        natural log of the tilt: windows overlap, each token is scored once.
        ``start`` stands before every text."""
        sums = words.total(self.side, False)
        n = np.diff(words.edge)[:, None].astype(np.float32)
        sums[:, :WIDTH + PARTS] /= n
        e = sums[:, :WIDTH]
        rho = (softmax(across(sums[:, WIDTH + PARTS:])).T
               / self.share).astype(np.float32, order="C")
        # of words as keys: key, value and 1; of words that are read last:
        # query and current.  Padding, number -1, is a row of zeros behind
        far = np.zeros((len(e) + 1, 2 * WIDTH + 1), np.float32)
        far[:-1, :-1] = e @ np.concatenate([self.key, self.value], axis=1)
        far[:-1, -1] = 1
        near = np.zeros((len(e) + 1, WIDTH + PARTS), np.float32)
        near[:-1, :WIDTH] = e @ self.query
        near[:-1, WIDTH:] = sums[:, WIDTH:WIDTH + PARTS]
        bias = causal(self.near)
        one = np.ones(PARTS, np.float32)
        inputs, targets, valid, owner = windows(texts, start)
        out = np.zeros(len(texts))
        for i in range(0, len(inputs), BATCH):
            x, y, ok = (a[i:i + BATCH] for a in (inputs, targets, valid))
            seen = np.take(far, x, axis=0)
            last = np.take(near, x[:, -STRIDE:], axis=0)
            a = last[:, :, :WIDTH] @ seen[:, :, :WIDTH].transpose(0, 2, 1)
            a += bias
            np.exp(np.minimum(a, 60, out=a), out=a)
            c = (a @ seen[:, :, WIDTH:]).reshape(-1, WIDTH + 1)
            # no word at all behind what is not real
            z = (c[:, :-1] / np.maximum(c[:, -1:], 1e-37)) @ self.mix
            z += last[:, :, WIDTH:].reshape(-1, PARTS)
            np.minimum(z, 60, out=z)
            np.exp(np.maximum(z, -60, out=z), out=z)
            u = np.einsum("tk,tk->t", z, np.take(rho, y.ravel(), axis=0)) \
                / (z @ one)
            u = np.where(ok, np.log(np.maximum(u, 1e-30)).reshape(ok.shape), 0)
            np.add.at(out, owner[i:i + BATCH],
                      u.sum(axis=1, dtype=np.float64))
        return out


def windows(texts: list[np.ndarray], start: int, stride: int = STRIDE):
    """Inputs (n, CONTEXT; -1: padding), targets (n, stride), which targets
    are real, and the text of each window.  Window w of a text scores tokens
    [w * stride, (w + 1) * stride) of it."""
    lead = CONTEXT - stride
    size = np.array([len(t) for t in texts], np.int64)
    count = -(-size // stride)
    owner = np.repeat(np.arange(len(texts)), count)
    # all texts in one array, each behind a padding of ``lead``
    room = lead + count * stride
    begin = np.cumsum(room) - room
    x = np.full(int(room.sum()) + 1, -1, np.int32)
    y = np.zeros(len(x), np.int32)
    ok = np.zeros(len(x), bool)
    for t, b, n in zip(texts, begin.tolist(), size.tolist()):
        if n:
            x[b + lead] = start
            x[b + lead + 1:b + lead + n] = t[:-1]
            y[b + lead:b + lead + n] = t
            ok[b + lead:b + lead + n] = True
    first = np.repeat(begin, count) + stride * (
        np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    at = first[:, None] + np.arange(CONTEXT)[None, :]
    return x[at], y[at[:, lead:]], ok[at[:, lead:]], owner


def causal(near: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    """(stride, CONTEXT) bias by distance, forbidding what lies ahead."""
    back = _back(stride)
    return np.where(back < 0, FAR, near[np.maximum(back, 0)]).astype(
        np.float32)


def _back(stride: int) -> np.ndarray:
    return (CONTEXT - stride + np.arange(stride))[:, None] \
        - np.arange(CONTEXT)[None, :]


def initial(vocabulary: int, seed: int = 9) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {"embed": normal(.3, vocabulary, WIDTH),
            "current": normal(.1, vocabulary, PARTS),
            "output": normal(.5, vocabulary, PARTS),
            "key": normal(WIDTH ** -.5, WIDTH, WIDTH),
            "query": normal(WIDTH ** -.5, WIDTH, WIDTH),
            "value": normal(WIDTH ** -.5, WIDTH, WIDTH),
            "mix": normal(.5, WIDTH, PARTS),
            "near": np.zeros(CONTEXT, np.float32)}


TABLES = ("embed", "current", "output")             # a row per subword id
SMALL = ("key", "query", "value", "mix", "near")
SIDE = {"embed": slice(0, WIDTH), "current": slice(WIDTH, WIDTH + PARTS),
        "output": slice(WIDTH + PARTS, WIDTH + 2 * PARTS)}  # side by side
COLUMNS = WIDTH + 2 * PARTS


class Adam:
    """Fits the weights ``P`` in place, one batch of windows at a time.  Of the
    tables only the rows of the batch's subwords are touched: they lie side by
    side with their moments, and ``P`` holds views of them."""

    def __init__(self, P: dict[str, np.ndarray]):
        self.steps = 0
        # weights, first and second moments, a row per subword
        self.rows = np.zeros((3, len(P["embed"]), COLUMNS), np.float32)
        self.P = {}
        for k, columns in SIDE.items():
            self.rows[0, :, columns] = P[k]
            self.P[k] = self.rows[0, :, columns]
        self.P |= {k: P[k] for k in SMALL}
        self.m1 = {k: np.zeros_like(P[k]) for k in SMALL}
        self.m2 = {k: np.zeros_like(P[k]) for k in SMALL}

    def step(self, x: np.ndarray, y: np.ndarray, ok: np.ndarray,
             words: Words, start: int, lr: float) -> None:
        """Sums over tokens that depend on their word alone are taken by
        distinct word."""
        P, f = self.P, np.float32
        pad = x < 0
        padded = pad.any()
        if padded:
            x = np.where(pad, start, x)
        here, number = present(len(words.edge) - 1, x, y)
        x, y = np.take(number, x), np.take(number, y)
        part = words.take(here)
        sizes = np.diff(part.edge)
        ids, number = present(self.rows.shape[1], part.ids)
        at = np.take(number, part.ids)
        rows = np.take(self.rows, ids, axis=1)
        sums = run_sums(rows[0], at, sizes)
        per = sizes[:, None].astype(f)
        sums[:, :WIDTH + PARTS] /= per
        e = sums[:, SIDE["embed"]]
        r = softmax(across(sums[:, SIDE["output"]]))
        stride = y.shape[1]
        last = x[:, -stride:]
        kqv = np.take(e @ np.concatenate([P["key"], P["query"], P["value"]],
                                         axis=1), x, axis=0)
        k, q, v = (kqv[:, :, :WIDTH], kqv[:, -stride:, WIDTH:2 * WIDTH],
                   kqv[:, :, 2 * WIDTH:])
        a = q @ k.transpose(0, 2, 1)
        a += causal(P["near"], stride)
        if padded and stride < CONTEXT:     # else all padding lies ahead
            a += FAR * pad[:, None, :]
        # against the word itself, so that no row is all zeros
        own = np.arange(stride)
        a -= a[:, own, CONTEXT - stride + own][:, :, None]
        np.exp(np.minimum(a, 60, out=a), out=a)
        a /= (a.reshape(-1, CONTEXT) @ np.ones(CONTEXT, f)).reshape(
            *a.shape[:2], 1)
        c = (a @ v).reshape(-1, WIDTH)
        # the mixture, a column per token
        pi = P["mix"].T @ c.T
        pi += np.take(across(sums[:, SIDE["current"]]), last.ravel(), axis=1)
        pi = softmax(pi)
        real = ok.ravel().astype(f)
        n = f(max(1, ok.sum()))
        times = np.bincount(y.ravel(), real, len(here)).astype(f)
        share = r @ times / n
        post = np.take(r / share[:, None], y.ravel(), axis=1)
        post *= pi
        post *= real / post.sum(axis=0)
        dz = pi
        dz *= real
        dz -= post
        dz /= n
        lean = post.sum(axis=1) / n / share
        d_out = across(times * (r + r * (lean[:, None] - lean @ r)))
        post = across(post).reshape(*y.shape, PARTS)

        g = {"mix": (dz @ c).T}
        dz = across(dz)
        dc = dz @ P["mix"].T
        back = np.einsum("tk,tk->t", dc, c).reshape(*a.shape[:2], 1)
        dc = dc.reshape(*a.shape[:2], WIDTH)
        ds = dc @ v.transpose(0, 2, 1)
        ds -= back
        ds *= a
        g["near"] = np.bincount(np.maximum(_back(stride), 0).ravel(),
                                ds.sum(axis=0).ravel(), CONTEXT).astype(f)
        # of key, value, query and current of each token read, and of the
        # one predicted where that is read next
        both = np.zeros((*x.shape, COLUMNS + 2 * WIDTH), f)
        np.matmul(ds.transpose(0, 2, 1), q, out=both[:, :, :WIDTH])
        np.matmul(a.transpose(0, 2, 1), dc, out=both[:, :, WIDTH:2 * WIDTH])
        np.matmul(ds, k, out=both[:, -stride:, 2 * WIDTH:3 * WIDTH])
        both[:, -stride:, 3 * WIDTH:-PARTS] = dz.reshape(*y.shape, PARTS)
        follows = np.array_equal(x[:, 1 - stride:], y[:, :-1])
        if follows:
            both[:, 1 - stride:, -PARTS:] = post[:, :-1]
            y, post = y[:, -1], post[:, -1]
        both = by_row(x, both, len(here))
        d_out -= both[:, -PARTS:] + by_row(y, post, len(here))
        d_out /= n
        of_words = both[:, :3 * WIDTH]          # of their k, v and q
        g |= zip(("key", "value", "query"),
                 np.split(e.T @ of_words, 3, axis=1))
        d = np.concatenate([of_words @ np.concatenate(
            [P["key"], P["value"], P["query"]], axis=1).T,
            both[:, 3 * WIDTH:-PARTS], d_out], axis=1)
        d[:, :WIDTH + PARTS] /= per
        of = np.repeat(np.arange(len(here)), sizes)

        self.steps += 1
        bias1, bias2 = f(1 - .9 ** self.steps), f(1 - .98 ** self.steps)

        def move(w, m1, m2, g) -> None:
            m1 += f(.1) * (g - m1)
            g *= g
            g -= m2
            g *= f(.02)
            m2 += g
            np.divide(m2, bias2, out=g)
            np.sqrt(g, out=g)
            g += f(1e-8)
            np.divide(m1, g, out=g)
            g *= f(lr) / bias1
            w -= g

        for name in SMALL:
            move(P[name], self.m1[name], self.m2[name], g[name])
        move(*rows, by_row(at, d, len(ids), of))
        self.rows[:, ids] = rows


def present(n: int, *numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the numbers below ``n`` that occur, in order, and the place of
    each among them."""
    found = np.zeros(n, bool)
    for x in numbers:
        found[x.ravel()] = True
    here = np.flatnonzero(found)
    place = np.zeros(n, np.int32)
    place[here] = np.arange(len(here), dtype=np.int32)
    return here, place


def by_row(at: np.ndarray, values: np.ndarray, rows: int,
           of: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows of ``values`` (or of those that ``of`` names) by their
    number ``at``."""
    at = at.ravel()
    # 16 bits are sorted by radix
    order = np.argsort(at.astype(np.uint16) if rows <= 1 << 16 else at,
                       kind="stable")
    return run_sums(values.reshape(-1, values.shape[-1]),
                    order if of is None else np.take(of, order),
                    np.bincount(at, minlength=rows))


def run_sums(values: np.ndarray, order: np.ndarray, times: np.ndarray
             ) -> np.ndarray:
    """Sums of the rows ``order`` of ``values``: those of the first
    ``times[0]``, of the next ``times[1]`` and so on.  Runs are cut into blocks
    of ``RUN`` rows; the first rows of all blocks are added at once, then the
    second, and so on, then the blocks of a run alike."""
    blocks = -(-times // RUN)
    first = np.cumsum(blocks) - blocks
    run = np.repeat(np.arange(len(times)), blocks)
    done = RUN * (np.arange(len(run)) - first[run])
    size = np.minimum(times[run] - done, RUN).astype(np.uint8)
    longest = np.argsort(RUN - size, kind="stable")
    begin = ((np.cumsum(times) - times)[run] + done)[longest]
    sums = np.take(values, order[begin], axis=0)
    more = len(run) - np.cumsum(np.bincount(size, minlength=RUN + 1))
    for j in range(1, RUN):
        n = more[j]
        sums[:n] += np.take(values, order[begin[:n] + j], axis=0)
    place = np.empty_like(longest)
    place[longest] = np.arange(len(longest))
    out = np.zeros((len(times), values.shape[1]), values.dtype)
    one = np.flatnonzero(blocks == 1)
    out[one] = np.take(sums, place[first[one]], axis=0)
    many = blocks > 1
    if many.any():
        out[many] = run_sums(sums, place[many[run]], blocks[many])
    return out


def train(texts: list[np.ndarray], words: Words, start: int,
          vocabulary: int, epochs: int = 3, batch: int = 256, seed: int = 9,
          rate: float = 0.02) -> Model:
    """Fit on texts in memory (arrays of numbers of ``words``)."""
    rng = np.random.default_rng(seed)
    adam = Adam(initial(vocabulary, seed))
    inputs, targets, valid, _ = windows(texts, start)
    total = max(1, epochs * -(-len(inputs) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            step = adam.steps + 1
            adam.step(inputs[rows], targets[rows], valid[rows], words, start,
                      rate * min(1.0, step / 20) * (1 - 0.9 * step / total))
    return Model(**adam.P)


class Local:
    """One part's share of a pass over all windows: Adam from the common
    weights, then the change of the weights, to be averaged over the parts.
    A subword's rows count as often as the part has seen it, the small
    matrices as often as it has seen windows.  The windows of a pass do not
    overlap, so each token is read and predicted once; a part too small for
    ``LEAST_STEPS`` steps goes over its windows again."""

    def __init__(self, model: Model, rate: float = 0.01, batch: int = 512,
                 seed: int = 9):
        self.model, self.rate, self.batch = model, rate, batch
        self.adam = Adam({k: getattr(model, k).copy()
                          for k in (*TABLES, *SMALL)})
        self.rng = np.random.default_rng(seed)
        self.seen = np.zeros(len(model.embed), np.float64)
        self.windows = 0
        self.kept: list[tuple] = []

    def add(self, texts: list[np.ndarray], words: Words, start: int) -> None:
        """Every window of the texts, each once."""
        made = windows(texts, start, CONTEXT)[:3]
        times = np.bincount(np.concatenate(texts),
                            minlength=len(words.edge) - 1)
        self.seen += np.bincount(words.ids, np.repeat(
            times, np.diff(words.edge)), len(self.seen))
        self.windows += len(made[0])
        if self.windows < LEAST_STEPS * self.batch:
            self.kept.append((*made, words, start))
        else:
            self.kept = []
        self._steps(*made, words, start)

    def _steps(self, inputs, targets, valid, words: Words, start: int
               ) -> None:
        order = self.rng.permutation(len(inputs))
        for i in range(0, len(order), self.batch):
            rows = order[i:i + self.batch]
            self.adam.step(inputs[rows], targets[rows], valid[rows], words,
                           start, self.rate * min(
                               1.0, (self.adam.steps + 1) / 20)
                           * len(rows) / self.batch)

    def finish(self) -> None:
        done = sum(-(-len(x[0]) // self.batch) for x in self.kept)
        for _ in range(min(20, LEAST_STEPS // done) - 1 if done else 0):
            for x in self.kept:
                self._steps(*x)
        self.kept = []

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(number, weight and weighted change of BLOCK subwords); the small
        matrices have number -1."""
        P, model = self.adam.P, self.model
        small = np.concatenate([(P[k] - getattr(model, k)).ravel()
                                for k in SMALL])
        yield -1, np.append(self.windows, small * self.windows).astype(
            np.float64)
        for b in range(0, len(self.seen), BLOCK):
            n = self.seen[b:b + BLOCK, None]
            if n.any():
                d = np.concatenate([P[k][b:b + BLOCK]
                                    - getattr(model, k)[b:b + BLOCK]
                                    for k in TABLES], axis=1)
                yield b, np.concatenate(
                    [n, n * d], axis=1).astype(np.float32).ravel()


BLOCK = 512


def averaged(model: Model, blocks: dict[int, np.ndarray]) -> Model:
    """The model moved by the summed blocks of all tasks."""
    P = {k: getattr(model, k).copy() for k in (*TABLES, *SMALL)}
    for b, x in blocks.items():
        if b < 0:
            at, x = 1, x / max(x[0], 1.0)
            for k in SMALL:
                P[k] += x[at:at + P[k].size].reshape(P[k].shape).astype(
                    np.float32)
                at += P[k].size
            continue
        x = x.reshape(-1, 1 + WIDTH + 2 * PARTS)
        d = x[:, 1:] / np.maximum(x[:, :1], 1)
        for k, lo, hi in (("embed", 0, WIDTH),
                          ("current", WIDTH, WIDTH + PARTS),
                          ("output", WIDTH + PARTS, WIDTH + 2 * PARTS)):
            P[k][b:b + len(d)] += d[:, lo:hi]
    return Model(**P)
