"""Operators 11 to 13 against brute force, with their edge cases."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trainyard.llm import alignment, lexical, minhash
from trainyard.llm.common import prepare, spread_join

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 40_000


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with all that can go wrong, and columns named like results."""
    prepare(spark)
    rows = [(1, None), (2, ""), (3, LONG), (3, LONG), (None, "no id here"),
            (4, "same text, same text"), (5, "same text, same text"),
            (-6, " \n\t "), (7, "É　x\u0085y <|endoftext|> 漢字 😀 "),
            (8, "a▁b"), (9, "No  ID here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("n", "row", "a", "b", "key", "t1", "bits", "groups", "score",
              "rank", "item_id", "terms", "node", "comp"):
        df = df.withColumn(c, F.lit("x"))
    return df


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# -- 11 -----------------------------------------------------------------
def aligned_by_hand(rows):
    """What the contract of the alignment says, pair by pair."""
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {
        chr(256 + i): b for i, b in enumerate(other)}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else \
            p.replace("▁", " ").encode()

    def placed(ids, parts):
        ends = np.cumsum([len(p) for p in parts])
        return [(i, int(e) - len(p), int(e))
                for i, p, e in zip(ids, parts, ends)]

    count, out = collections.Counter(), []
    for _, text in rows:
        out.append(None)
        if not text:
            continue
        e = a_tok.encode(" " + text, add_special_tokens=False)
        ab = [bytes(byte[c] for c in t) for t in e.tokens]
        ids = b_tok.encode(text)
        bb = [b_bytes(i) for i in ids]
        if not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            continue
        a, b = placed(e.ids, ab), placed(ids, bb)
        groups, low = [], 0
        for cut in sorted({x[2] for x in a} & {x[2] for x in b}):
            groups.append("|".join(",".join(
                str(i) for i, _, end in side if low < end <= cut)
                for side in (a, b)))
            low = cut
        links = [(i, j) for i, s, f in a for j, u, v in b if s < v and u < f]
        count.update(links)
        out[-1] = (len(a), len(b), len(groups), links, hashlib.sha256(
            ";".join(groups).encode()).hexdigest())
    best = collections.Counter()
    for (i, j), n in count.items():
        best[j] = max(best[j], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if r is None else
            (d, r[0], r[1], r[2], len(r[3]),
             sum(count[p] == best[p[1]] for p in r[3]),
             sum(count[p] for p in r[3]), r[4])
            for (d, _), r in zip(rows, out)]


ODD_TEXTS = ["", "  x", "a▁b", "tab\there\r\nyes", "日本𝕏 und 漢字 😀é",
             "x  y   z \n\n t ", "<|endoftext|> <s> <0x41>", "\x00a b", " ",
             "\n", "don't we'll I'M", "　a \u0085b", "1234 5678.90",
             "ｆｕｌｌ ﬁ", "\n\na", "a\n", "é́ ñ", None]


@pytest.mark.parametrize("head", [1 << 20, 40, 1])
def test_alignment(spark, docs, head):
    rows = list(enumerate(ODD_TEXTS)) + [
        (100 + r.doc_id, r.text) for r in docs.collect()
        if len(r.text or "") < 1500]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.align_tokens(df.repartition(3), head=head)
    assert sorted(rows_of(got)) == sorted(aligned_by_hand(rows))


def test_pieces_equal_whole_texts(docs):
    """Cutting texts into pieces and the cache change no result."""
    texts = [t for t in ODD_TEXTS if t] + [
        r.text for r in docs.collect() if r.text]
    path = (public_tokenizers.path(alignment.TOKENIZER),
            public_tokenizers.path(alignment.MODEL))
    apart, whole = alignment.Aligner(*path), alignment.Aligner(*path)
    assert apart.apart
    whole.apart = False
    want = whole.align(texts)
    for size in (len(texts), 5):    # the second time from both generations
        got = []
        for i in range(0, len(texts), size):
            got += apart.align(texts[i:i + size])
            if size == 5:
                apart.old, apart.new = apart.new, {}
        assert got == want


def test_spans_are_refined_by_bytes():
    def cuts(spans, sizes):
        x = np.array(spans)
        return alignment.byte_cuts(x[:, 0], x[:, 1],
                                   np.array(sizes)).tolist()
    # two ids inside one character, then an empty span before a whole one
    assert cuts([(0, 3), (0, 3), (3, 4)], [2, 1, 1]) == [2, 3, 4]
    assert cuts([(0, 0), (0, 0), (0, 3), (3, 5)], [1, 1, 1, 2]) == \
        [1, 2, 3, 5]
    assert alignment.char_bytes("aé漢".encode()).tolist() == [0, 1, 3, 6]


def test_lookup_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    t = alignment.Table(keys[::2], np.arange(len(keys[::2])) + 1)
    want = np.zeros(len(keys), np.int64)
    want[::2] = np.arange(len(keys[::2])) + 1
    assert (t.get(keys) == want).all()


def test_alignment_edges(spark, odd):
    got = rows_of(alignment.align_tokens(odd))
    assert len(got) == 11
    want = aligned_by_hand([(r.doc_id, r.text) for r in odd.collect()
                            if r.text != LONG])
    short = [(r[0], *r[1:4], r[4], r[7]) for r in got if r[0] != 3]
    assert sorted(short, key=str) == sorted(
        [(r[0], *r[1:4], r[4], r[7]) for r in want], key=str)
    three = [r for r in got if r[0] == 3]
    assert three[0] == three[1] and three[0][1] > 40_000
    assert alignment.op11_query(odd.limit(0)).count() == 0


# -- 12 -----------------------------------------------------------------
def groups_by_hand(rows, shingle=4, percent=80):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({" ".join(w[i:i + shingle]) for i in
                     range(max(1, len(w) - shingle + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (
                    len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows))
               if find(j) == find(i) and rows[j][0] is not None]
        comp = min(ids, default=None)
        out.append((doc, len(sets[i]), comp, doc == comp))
    return out


def test_minhash(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(rows_of(minhash.near_duplicates(docs))) == \
        sorted(groups_by_hand(rows))


def near_texts(seed, bases, copies, length=60):
    """Texts around the threshold: copies with some words changed, copies of
    copies, and middling similarity to all of a base."""
    rng, out = random.Random(seed), []
    for b in range(bases):
        base = [f"w{b}x{rng.randrange(900)}" for _ in range(length)]
        for _ in range(copies):
            text = list(rng.choice(out[-3:])) if out and rng.random() < .3 \
                else list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 9])):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            out.append(text)
    rng.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("bases, copies", [(40, 8), (2, 150)])
def test_minhash_loses_no_link(spark, bases, copies):
    rows = near_texts(bases, bases, copies)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(minhash.near_duplicates(df)))
    assert got == sorted(groups_by_hand(rows))


def test_strays_meet_every_block(spark, monkeypatch):
    """The same links when a group's strays and nodes fall into many blocks."""
    monkeypatch.setattr(minhash, "STRAYS", 3)
    monkeypatch.setattr(minhash, "NODES", 10)
    monkeypatch.setattr(minhash, "PER_TASK", 7)
    rows = near_texts(5, 2, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(rows_of(minhash.near_duplicates(df))) == \
        sorted(groups_by_hand(rows))


def test_chain_of_near_copies_behind_a_leader(spark):
    """A chain where the ends are far apart is one component."""
    words = [f"a{i}" for i in range(300)]
    rows = [(i, " ".join(words[3 * i:] + [f"z{j}" for j in range(3 * i)]))
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(minhash.near_duplicates(df))
    assert sorted(got) == sorted(groups_by_hand(rows))
    assert {r[2] for r in got} == {0}


def test_estimate_is_corrected_for_collisions(spark):
    """Estimates from packed low bits centre on the true similarity."""
    rng, errors = np.random.default_rng(3), []
    for j in (0.2, 0.5, 0.8, 0.95):
        n, guess = 400, []
        for _ in range(40):
            both = int(round(2 * n * j / (1 + j)))
            x = rng.integers(0, 1 << 63, 2 * n - both, np.uint64)
            sig = [minhash.signature(minhash.minima(np.sort(s)))[1]
                   for s in (x[:n], x[n - both:])]
            guess.append(tuple(s.tolist() for s in sig))
        df = spark.createDataFrame(guess, "a array<long>, b array<long>")
        got = df.select(F.avg(minhash.similarity(minhash.unequal(
            F.col("a"), F.col("b"))))).first()[0]
        errors.append(abs(got - both / (2 * n - both)))
    assert max(errors) < 0.03
    assert 0.5 < minhash.least_estimate() < 0.62


def test_minhash_edges(spark, odd):
    got = rows_of(minhash.near_duplicates(odd))
    assert sorted(got, key=str) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 3, 3, True), (3, 3, 3, True),
        (None, 1, 9, False), (4, 1, 4, True), (5, 1, 4, False),
        (-6, 0, -6, True), (7, 1, 7, True), (8, 1, 8, True),
        (9, 1, 9, True)], key=str)
    assert minhash.op12_query(odd.limit(0)).count() == 0


def test_spread_join_splits_hot_keys(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    one = spark.range(0, 9000, 2).select(F.col("id").alias("k"),
                                         (F.col("id") * 2).alias("w"))
    got = spread_join(rows, one, ["k"], least=100)
    assert "_part" in got._jdf.queryExecution().toString()
    assert sorted(rows_of(got.select("k", "v", "w"))) == sorted(
        rows_of(rows.join(one, "k").select("k", "v", "w")))


# -- 13 -----------------------------------------------------------------
def ranked_by_hand(docs, items, k=50):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                          lower(t))

    tf = [(d, collections.Counter(terms(t))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    total, n_docs = sum(sum(c.values()) for _, c in tf), len(tf)
    df = collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in tf:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2)
                                           / (2 * df[t] + 1)))
                * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for i, (s, _, _, d) in enumerate(sorted(scored)[:k]):
            out.append((item, i + 1, d, -s))
    return out


@pytest.mark.parametrize("block, k", [(lexical.BLOCK_TERMS, 50), (60, 7)])
def test_lexical(docs, bench, block, k):
    want = ranked_by_hand([(r.doc_id, r.text) for r in docs.collect()],
                          [(r.item_id, r.text) for r in bench.collect()], k)
    got = lexical.ranked(docs.repartition(3), bench, k, block)
    assert sorted(rows_of(got)) == sorted(want)


def test_lexical_ties_and_wide_items(spark, monkeypatch):
    """Many equal scores, and items wider than a tile."""
    prepare(spark)
    monkeypatch.setattr(lexical, "TILE_DOCS", 16)
    rows = [(i, ["red fish", "blue fish", "one fish two fish"][i % 3])
            for i in range(300)]
    random.Random(1).shuffle(rows)
    items = [(1, "fish"), (1, "Red"), (2, "one two red blue fish one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(rows_of(lexical.ranked(df, q, 9))) == sorted(
        ranked_by_hand(rows, items, 9))
    block = lexical.ItemBlock({}, [0, 1], [np.arange(10), np.array([2, 4])])
    plan = lexical.tiles(block, np.arange(10), 64, 4)
    assert [t.last for t in plan] == [False, False, True, True]
    assert sum(t.weight[0].sum() for t in plan[:3]) == 45


def test_partial_sums_stay_exact():
    """A tile's width shrinks so far that its sums stay below 2**53."""
    heavy = np.full(4000, 1 << 25)
    block = lexical.ItemBlock({}, [0], [np.arange(4000)])
    for t in lexical.tiles(block, heavy, 64, 4000):
        assert t.weight.sum() * (lexical.SCALE // lexical.COUNT) < 1 << 53


def test_lexical_edges(spark, odd):
    items = [(1, None), (2, ""), (None, "text SAME"), (3, "no id"),
             (3, "no id"), (4, LONG), (5, "nowhere")]
    q = spark.createDataFrame(items, "item_id long, text string") \
        .withColumn("doc_id", F.lit(1)).withColumn("n", F.lit(1))
    got = lexical.ranked(odd, q)
    want = ranked_by_hand([(r.doc_id, r.text) for r in odd.collect()], items)
    assert sorted(rows_of(got), key=str) == sorted(want, key=str)
    assert lexical.op13_query(odd.limit(0), q).count() == 0
    assert lexical.op13_query(odd, q.limit(0)).count() == 0
