"""Each operator against a brute-force version, and the edge cases every one
of them defines: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names."""

import collections
import hashlib
import html
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trainyard.llm import (attention, decontamination, html_text, licenses,
                           mixing, neighbours, quality, scoring, sharding,
                           simhash, token_files)
from trainyard.llm.common import permuted, prepare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor " * 40_000


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def blank_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


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
    rows = [(1, None, None, None, None), (2, "", "en", "b", 0),
            (3, LONG, "en", "b", 1), (3, LONG, "en", "b", 1),
            (None, "no id here at all", "en", None, 5),
            (4, "same text, same text", "xx", "a", 1),
            (5, "same text, same text", None, "a", 1), (-6, " \n\t ", "", "", 0),
            (7, "Émile 　x\u0085y <|endoftext|> 漢字 😀 ", "fr", "b", 9)]
    return (spark.createDataFrame(rows, DOCS)
            .withColumn("size", F.lit("x")).withColumn("shard", F.lit(None))
            .withColumn("score", F.lit(2)).withColumn("h", F.lit(1))
            .withColumn("fp", F.lit(1)).withColumn("key", F.lit("k"))
            .withColumn("file", F.lit(1)).withColumn("g", F.lit(0)))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# -- 1 ------------------------------------------------------------------
@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"),
    ("<p>A &amp; b&nbsp;c<p>d", "A & b c\nd"),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>one <b>two"
     "</b><br>three</p><div class=ad>buy</div><form>f</form></article>"
     "<footer>&copy;</footer></body>", "T\none two three"),
    ("<body><div class='with-sidebar'><article><p>hello my friend</p>"
     "<section id=comments><article><p>bad</p></article></section>"
     "</article></div></body>", "hello my friend"),
    ("<body><div id=w><div class=h><a href=1>home</a> <a href=2>more</a>"
     "</div><div class=post><h2>Title</h2><div><p>one long paragraph of "
     "words, many words</p><p>second long one <a href=3>link</a> and words"
     "</p></div></div><div><a href=4>terms</a> 2020</div></div></body>",
     "Title\none long paragraph of words, many words\n"
     "second long one link and words"),
    ("<article><script>var t='</p>';</script><p>x<ul><li>a<li>b</ul>"
     "<table><tr><td>1<td>2</table><!-- no -->", "x\na\nb\n1 2")])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_html_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.op1_query(pages).collect()}
    raw = pages.collect()
    assert len(got) == len(raw)
    for p in raw:
        m = re.search("<article>(.*)</article>", p.html or "", re.S)
        if not m or "class" in m[1]:
            continue
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split())
                  for b in re.split("</?(?:p|h1)>", re.sub(
                      "<!--.*?-->", "", m[1]).replace("<br>", " "))]
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_density_prefers_text_to_links():
    assert html_text.density(100, 2, 0, 0, .1) > html_text.density(
        100, 2, 90, 2, .1)
    assert html_text.density(0, 3, 0, 0, .1) == 0


def test_density_alone_finds_the_article(spark):
    """The given pages without their landmarks: the same texts."""
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        bare = re.sub(r"<(/?)(article|main)\b", r"<\1div", r.html or "")
        assert html_text.main_text(bare) == html_text.main_text(r.html)


@pytest.mark.parametrize("names", [
    "layout sidebar-right", "content share-top", "search-results",
    "story login-required", "widget", "hidden-print"])
def test_names_do_not_empty_a_page(names):
    page = (f"<body><nav><a href=1>x</a></nav><div class='{names}'><h1>T</h1>"
            "<p>some long text here and more words</p><p>again, a lot of "
            "words</p></div><div class='sidebar'><p>other</p></div></body>")
    assert html_text.main_text(page) == \
        "T\nsome long text here and more words\nagain, a lot of words"


@pytest.mark.parametrize("page", [
    "<div>" * 20_000, "<div><p>x" * 20_000, "<a " * 40_000,
    "<a x=\"" * 40_000 + ">", "<a '\"x>" * 40_000,
    "<div>" * 20_000 + "</b>" * 20_000, "<p><button>" + "<div>" * 20_000,
    "<ul><li>" * 20_000, "<table><tr><td>" * 20_000,
    "<div>" * 10_000 + "<header>x</header>" * 10_000, "<" * 100_000,
    "<div class=sidebar>" * 10_000 + "<article>" * 5_000,
    "<p>" + "word " * 300_000], ids=range(13))
def test_broken_and_long_pages_take_linear_time(page):
    at = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - at < 6


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None,
                               "<p>x</p>" * 3)],
                               "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("clash"))
    got = sorted(rows_of(html_text.extract(df)), key=str)
    assert got == [(1, "u", "", 0), (1, "u", "", 0),
                   (None, None, "x\nx\nx", 5)]
    assert html_text.extract(df.where("false")).count() == 0


# -- 2 ------------------------------------------------------------------
def contaminated(items, texts, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t))
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[k:k + n])].add(i)
    sizes = {len(k) for k in windows}
    for t in texts:
        w, hit, found = word.findall(lower(t)), set(), set()
        for s in sizes:
            for k in range(len(w) - s + 1):
                own = windows.get(tuple(w[k:k + s]))
                if own is not None:
                    hit |= set(range(k, k + s))
                    found |= own
        yield len(w), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("small", [False, True])
def test_decontamination(spark, docs, bench, small):
    got = decontamination.op2_query(docs, bench) if not small else \
        decontamination.contamination(docs, bench, shard_words=3000,
                                      block_chars=2000)
    got = {r.doc_id: r for r in got.collect()}
    raw = docs.collect()
    want = contaminated([tuple(r) for r in bench.collect()],
                        [r.text for r in raw])
    for r, (n, hit, items) in zip(raw, want):
        g = got[r.doc_id]
        if small:
            assert (g.n_words, len(g.hits), list(g.items)) == (n, hit, items)
        else:
            assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (
                n, hit, len(items), hit > 0)
            assert g.items_sha256 == hashlib.sha256(
                ",".join(items).encode()).hexdigest()


def test_longest_matches_and_removal(docs, bench):
    best = {}
    texts = [decontamination.words_of(r.text) for r in docs.collect()]
    padded = [b" " + b" ".join(t) + b" " for t in texts]
    rows = decontamination.longest_matches(docs, bench).where(
        "item_word % 7 = 0").collect()
    items = {r.item_id: decontamination.words_of(r.text)
             for r in bench.collect()}
    for r in rows:
        item = items[r.item_id][r.item_word:]
        n = max(k for k in range(len(item) + 1) if k == 0 or any(
            b" " + b" ".join(item[:k]) + b" " in p for p in padded)) \
            if r.length < 30 else r.length
        assert r.length == n
        best[r.item_id, r.item_word] = n
    clean = decontamination.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == decontamination.op2_query(
        docs, bench).where("not contaminated").count()


def longest_by_hand(items, text, window=10):
    """(length, word, item, item_word) of the longest match with a window."""
    w, best = decontamination.words_of(text), None
    for item, body in items:
        q = decontamination.words_of(body)
        need = min(window, len(q))
        for i in range(len(w)):
            for j in range(len(q)):
                n = 0
                while i + n < len(w) and j + n < len(q) \
                        and w[i + n] == q[j + n]:
                    n += 1
                if n and n >= need and (need == window or j == 0):
                    best = max(best or (0,), (n, -i, item, j),
                               key=lambda x: x[:2])
    return best and (best[0], -best[1], best[2], best[3])


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_longest_match_of_each_document(spark, block):
    """Two texts of one item, a long item, a short one, null ids, ties."""
    prepare(spark)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words[:90])
    items = [(1, long), (1, " ".join(words[100:190])), (2, "short one"),
             (None, " ".join(words[200:215])), (3, " ".join(words[300:312])),
             (4, "ends with a short one")]
    texts = [" ".join(rng.choices(words, k=5)) + " " + mid + " x" for mid in (
        long, " ".join(words[5:88]), " ".join(words[105:185]),
        " ".join(words[100:109]), " ".join(words[200:215]), "a short one",
        " ".join(words[300:311] + ["y"] + words[10:22]),
        " ".join(words[40:55] + words[120:135]), "nothing", "short")]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, None)],
                               "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.longest for r in decontamination.contamination(
        df, bench, block_chars=block).collect()}
    for i, t in enumerate(texts):
        want = longest_by_hand(items, t)
        assert (got[i] and (got[i].length, got[i].word)) == (
            want and want[:2]), t
        if want and want[2] is not None:
            assert got[i].item_word >= 0 and got[i].item is not None
    assert got[None] is None
    assert got[0].length == 90 and got[2].length == 80
    q = {r.doc_id: r for r in decontamination.op2_query(df, bench).collect()}
    assert (q[2].longest, q[2].longest_item, q[2].longest_item_word) == (
        80, "1", 5)
    clean = decontamination.remove_contaminated(df, bench, shard_words=20)
    assert sorted(r.doc_id for r in clean.dropna().collect()) == [
        i for i, t in enumerate(texts) if not longest_by_hand(items, t)]


def test_suffix_array_sorts():
    rng = np.random.default_rng(0)
    ids = np.concatenate([rng.integers(0, 4, 500), np.zeros(1, int)]) \
        .astype(np.int32)
    ids[100:140] = ids[200:240]

    def key(p, depth=64):
        out = []
        for x in ids[p:p + depth]:
            out.append(int(x))
            if not x:
                break
        return out
    sa = decontamination.suffix_array(ids, 64)
    keys = [key(p) for p in sa]
    assert keys == sorted(keys) and len(sa) == (ids > 0).sum()


def test_decontamination_edges(spark, odd):
    items = spark.createDataFrame(
        [(1, "same text"), (None, "no id here at all"), (2, None), (3, ""),
         (1, "same text"), (9, "same text")], "item_id long, text string")
    got = sorted(rows_of(decontamination.op2_query(odd, items).select(
        "doc_id", "n_words", "n_hit", "n_items")), key=str)
    assert (4, 4, 4, 2) in got and (None, 5, 5, 0) in got
    assert got.count((3, 120_000, 0, 0)) == 2 and (1, 0, 0, 0) in got
    none = decontamination.op2_query(odd, items.where("false"))
    assert none.where("contaminated").count() == 0 and none.count() == 9
    assert decontamination.op2_query(odd.where("false"), items).count() == 0


# -- 3 ------------------------------------------------------------------
def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.op3_query(docs, labels).toPandas()
    assert (got.held_out == got.doc_id.map(
        lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    # labels of held out rows are not read
    other = labels.withColumn("quality", F.when(
        quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.op3_query(docs, other).toPandas()
    assert got.sort_values("doc_id").score.tolist() == \
        again.sort_values("doc_id").score.tolist()


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1, 0), (None, 0, 0), (4, None, None)],
        "doc_id long, quality int, toxic int")
    got = quality.op3_query(odd, labels).collect()
    assert len(got) == 9 and all(r.score == 0.7 and r.predicted for r in got)
    assert quality.op3_query(odd.where("false"), labels).count() == 0
    model = quality.fit(np.ones((3, 20)), np.zeros((3, 20)), 0.5)
    kept = quality.accepted(odd, model)
    assert kept.columns == odd.columns
    s = quality.Ranking(np.ones(20), 3.0).score(np.array(
        [[.15] * 20, [1] * 20, [0] * 20]))
    assert s[0] == pytest.approx(.7) and s[1] > .7 > s[2] >= 0


# -- 4 ------------------------------------------------------------------
def token_rows(pairs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for i, x in pairs:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        yield i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files(docs):
    want = list(token_rows(sorted((r.doc_id, r.text)
                                  for r in docs.collect())))
    assert sorted(rows_of(token_files.op4_query(docs))) == want


def test_token_pieces_equal_whole_texts():
    random.seed(4)
    parts = ["a", "b ", "  ", "\n", "\t", "don't", " the", "é", " ", "123",
             "!!", " \n", "\r\n", "<|endoftext|>", "x\x1cy", "\u0085", "漢字 ",
             "😀", " 's", "word,", "Éa.", "×", "1.", "'ll", "\nNew***", "\xa0",
             "a.b", ".", "x!?", " .", "it's.", "z,'s", ";"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12)))
             for _ in range(5000)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    e = token_files.Encoder(path, limit=50)  # clears its cache again and again
    whole = Tokenizer.from_file(path)
    for i in range(0, len(texts), 500):
        ids, edge = e.encode(texts[i:i + 500])
        for k, t in enumerate(texts[i:i + 500]):
            assert ids[edge[k]:edge[k + 1]].tolist() == whole.encode(
                t, add_special_tokens=False).ids + [0], repr(t)


def test_names_of_added_tokens_are_their_ids(spark):
    """As the tokenizer itself takes them."""
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)),
                               "doc_id long, text string")
    got = sorted(rows_of(token_files.op4_query(df)))
    assert got == list(token_rows(enumerate(texts)))
    assert [r[2] for r in got] == [5, 2, 7, 3]


def test_token_files_edges(spark, odd, tmp):
    got = rows_of(token_files.op4_query(odd))
    assert len(got) == 9 and sum(r[2] for r in got) > 9
    assert sorted(r[1] for r in got)[0] == 0
    assert token_files.op4_query(odd.where("false")).count() == 0
    token_files.write_tokens(odd, tmp)
    one = token_files.read_tokens(spark, tmp).where("doc_id = 4")
    plan = one._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,4)" in plan and one.count() == 1


# -- 5 ------------------------------------------------------------------
def targets(sizes, weights=(5, 2, 1), cap=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s)
    names += [None] if None in sizes else []
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full = {}
    while True:
        free = [s for s in names if s not in full]
        left = sum(sizes.values()) - sum(full.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full.update((s, cap * sizes[s]) for s in over)


def mixed(df):
    got = mixing.op5_query(df).join(
        df.select("doc_id", "source").distinct(), "doc_id").toPandas()
    by = got.groupby("source", dropna=False)
    size = {None if s != s else s: int(n) for s, n in by["size"].sum().items()}
    want = targets(size)
    for s, g in by:
        s = None if s != s else s
        assert g.target.iloc[0] == pytest.approx(want[s])
        assert (g.source_size == size[s]).all()
        assert abs(g.taken.sum() - want[s]) <= 1
    assert (got.taken <= 3 * got["size"]).all()
    return got


def test_mixing(docs):
    a, b = mixed(docs), mixed(docs.repartition(3))
    assert a.sort_values("doc_id").taken.tolist() == \
        b.sort_values("doc_id").taken.tolist()
    sizes = {r.doc_id: len(blank_words(r.text)) for r in docs.collect()}
    assert dict(zip(a.doc_id, a["size"])) == sizes


def test_mixing_caps_and_hot_source(spark):
    rows = [(i, "w " * (i % 50 + 1), "en", "hot" if i % 3 else f"s{i % 30}", 0)
            for i in range(600)] + [(900, "one two", "en", "aa", 0),
                                    (901, None, "en", "ab", 0)]
    got = mixed(spark.createDataFrame(rows, DOCS))
    assert got[got.doc_id == 900].taken.iloc[0] == 6  # three times its size


def test_mix_slots_are_whole(docs):
    packed, mix = mixing.mix_sources(docs, block_words=64, shard_slots=16)
    slots = mix.groupBy("shard", "slot").agg(
        F.countDistinct("skey", "block", "pass").alias("k"),
        F.sum(F.col("w_to") - F.col("w_from")).alias("w"))
    assert slots.where("k <> 1 or w > 64 or w < 1").count() == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in mixing.mixed_documents(docs, packed, mix).collect():
        assert r.text == texts[r.doc_id] or set(blank_words(r.text)) <= set(
            blank_words(texts[r.doc_id]))
        assert r.n_chars == len(r.text)


def test_mix_keeps_sources_apart(spark):
    """One doc_id and text in several sources, null among them: each takes
    the words of its own source's blocks."""
    prepare(spark)
    rows = [(1, "a b c d", None)] * 3 + [(1, "a b c d", "a")] * 40 + [
        (2, " ".join(f"x{i}" for i in range(900)), "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    packed, mix = mixing.mix_sources(df)
    want = {(r.skey, r.doc_id): r.words for r in mix.join(
        packed.select("skey", "off", "doc_id"), ["skey", "off"]).groupBy(
        "skey", "doc_id").agg(F.sum(F.col("w_to") - F.col("w_from"))
                              .alias("words")).collect()}
    got = collections.Counter()
    for r in mixing.mixed_documents(df, packed, mix).collect():
        got["null" if r.source is None else "=" + r.source, r.doc_id] += \
            len(blank_words(r.text))
    assert got == want


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select("id", permuted(
            F.col("id"), F.lit(n).cast("long"), [F.lit("k")]).alias("p"))
        df = df.withColumn("back", permuted(
            F.col("p"), F.lit(n).cast("long"), [F.lit("k")], inverse=True))
        got = df.collect()
        assert sorted(r.p for r in got) == list(range(n))
        assert all(r.back == r.id for r in got)


def test_mixing_edges(spark, odd):
    got = sorted(rows_of(mixing.op5_query(odd)), key=str)
    assert len(got) == 9
    assert [r[4] for r in got if r[1] == 0] == [0, 0, 0]
    assert mixing.op5_query(odd.where("false")).count() == 0
    assert all(r[4] == 0 for r in rows_of(
        mixing.op5_query(odd.where("doc_id in (1, 2)"))))


# -- 6 ------------------------------------------------------------------
def test_licences():
    mit = [licenses.SENTENCES[k].capitalize() + "." for k in
           "mit-grant mit-notice mit-warranty mit-liability".split()]
    text = "Intro words.\n\nCopyright (c) 2020 X.\n" + " ".join(mit)
    (got,) = licenses.licences(text)
    assert got[0] == "MIT" and got[3] == 4
    assert text[got[1]:got[2]].strip().startswith("Permission")
    # out of order: the longest rules that still hold
    assert [x[0] for x in licenses.licences(" ".join(mit[::-1]))] == []
    assert licenses.licences(None) == [] == licenses.licences("")
    wrapped = "// Licensed under the Apache License,\n//   Version 2.0."
    assert licenses.licences("Some words\n" + wrapped)[0][0] == "Apache-2.0"
    bsd = ("Neither the name of Foo Bar Inc. nor the names")
    assert licenses.licences(bsd) == []
    names = licenses.SENTENCES["bsd-names"].replace("<>", "the foo project")
    assert licenses.sentence_id(names) == "bsd-names"
    assert licenses.sentence_id("3 " + names) == "bsd-names"


def test_every_rule_is_found():
    for name, seq in licenses.RULES:
        text = ". ".join(licenses.SENTENCES[k].replace("<>", "some one")
                         for k in seq.split()) + "."
        assert [x[0] for x in licenses.licences(text)] == [name], seq


def test_notices_of_every_licence():
    names = {
        "GPL-3.0-only": ["GNU General Public License, version 3", "GPLv3",
                         "GNU GPL version 3", "GPL-3.0"],
        "GPL-2.0-or-later": ["GNU General Public License v2 or later",
                             "GPLv2+", "GPL, version 2 or (at your option) "
                             "any later version"],
        "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1",
                          "LGPLv2.1", "GNU LGPL 2.1"],
        "AGPL-3.0-only": ["GNU Affero General Public License v3.0", "AGPLv3"],
        "GPL": ["GNU General Public License", "GPL"],
        "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution "
                      "4.0 International License"],
        "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-"
                         "ShareAlike 3.0 Unported License"],
        "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-"
                         "NonCommercial 4.0 International License (CC BY-NC "
                         "4.0)"],
        "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-"
                         "NoDerivatives 4.0 International License"],
        "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
        "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
        "CC0-1.0": ["CC0 1.0 Universal", "CC0"],
        "MIT": ["MIT License", "MIT licence", "MIT"],
        "ISC": ["ISC License", "ISC"],
        "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD license"],
        "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
        "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0",
                       "Apache-2.0 license", "Apache License 2.0"],
        "MPL-2.0": ["Mozilla Public License, v. 2.0", "MPL 2.0",
                    "Mozilla Public License version 2.0"],
        "BSL-1.0": ["Boost Software License, Version 1.0"],
        "EPL-2.0": ["Eclipse Public License 2.0", "EPL v2.0"],
        "Unlicense": ["Unlicense"]}
    heads = [f"{who}{verb} under {the}" for the in ("", "the ")
             for verb in ("licensed", "released", "distributed",
                          "made available")
             for who in ("", "This work is ", "This project is ",
                         "The software is ", "Foo and its tools are ")]
    for licence, forms in names.items():
        for form in forms:
            for head in heads:
                text = f"Some words. {head[0].upper()}{head[1:]}{form}. More."
                assert [x[0] for x in licenses.licences(text)] == [licence], \
                    text
            assert [x[0] for x in licenses.licences(
                f"# Foo\n#\n# Foo is licensed\n# under the {form}\n# by me"
            )] == [licence], form
    for text in ("This work is not licensed under the MIT License.",
                 "Drivers are licensed under the rules of the state.",
                 "If it is released under the GPL, tell me.",
                 "We talked about the MIT license and the GPL."):
        assert licenses.licences(text) == [], text
    assert [x[0] for x in licenses.licences(
        "Licensed under either of Apache License, Version 2.0 or MIT license "
        "at your option.")] == ["Apache-2.0", "MIT"]


@pytest.mark.parametrize("pad", [" ", "*", "-=", "/", " # "])
def test_padded_sentences_are_looked_up(pad):
    line = pad * 5_000 + "Licensed under the Apache License, Version 2.0"
    assert [x[0] for x in licenses.licences(line + pad * 5_000)] == [
        "Apache-2.0"]
    # padding between a rule's sentences is none
    mit = [licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice")]
    assert [x[3] for x in licenses.licences(
        mit[0] + ". " + pad * 5_000 + mit[1])] == [2]
    assert licenses.licences(line.replace(" License", " rule")) == []


@pytest.mark.parametrize("text, names", [
    ("The source files of this project, the tools that come with it and all "
     "of the documentation that we ship are released under the MIT License.",
     ["MIT"]),
    ("Foo is licensed under the MIT License, and " + "a long tail " * 60,
     ["MIT"]),
    ("Copyright of " + "many people " * 90 + ", licensed under the Apache "
     "License, Version 2.0.", ["Apache-2.0"]),
    ("Foo is\nlicensed under\nthe GPL version 3 or later\nfor all",
     ["GPL-3.0-or-later"]),
    ("All that was ever written here by any of us in the last many years was "
     "placed in the public domain by its authors and by their heirs too.",
     ["public-domain"]),
    ("Foo is not licensed under the MIT License.", []),
    ("Ask us whether it is licensed under the MIT License.", []),
    ("The work was released under MIT supervision in the lab.", [])])
def test_notices_of_any_length(text, names):
    assert [x[0] for x in licenses.licences(text)] == names


@pytest.mark.parametrize("text", [
    "licensed under the\n" * 6000, "licensed under the " * 6000,
    "permission is hereby\n" * 6000, "license " * 30_000], ids=range(4))
def test_licence_scan_takes_linear_time(text):
    at = time.process_time()
    licenses.licences(text)
    assert time.process_time() - at < 6


def test_notices_of_documents(spark):
    texts = spark.read.parquet(
        "/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.licences for r in licenses.op6_query(texts).collect()}
    notices = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, "
        "version 3.": "GPL-3.0-only",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    seen = collections.Counter()
    for r in texts.collect():
        t = r.text or ""
        want = sorted(k for s, k in notices.items() if s in t)
        assert got[r.doc_id] == want, r.doc_id
        # no notice but these
        assert bool(re.search("licen[sc]e", t, re.I)) == bool(want)
        seen.update(want)
    assert seen == {"Apache-2.0": 16, "MIT": 10, "GPL-3.0-only": 9,
                    "CC-BY-NC-4.0": 4}


def test_license_query(docs, odd):
    got = {r.doc_id: r for r in licenses.op6_query(docs).collect()}
    for r in docs.collect():
        has = "Licensed under the Apache License, Version 2.0." in r.text
        assert ("Apache-2.0" in got[r.doc_id].licences) == has
        for m in got[r.doc_id].matches:
            assert licenses.licences(r.text[m.start:m.end])[0][0] == m.licence
    assert licenses.op6_query(odd).count() == 9
    assert licenses.op6_query(odd.where("false")).count() == 0


# -- 7 ------------------------------------------------------------------
def near(ids, x, k=5):
    norm = np.sqrt((x * x).sum(1))
    for i in np.flatnonzero(ids % 50 == 0):
        s = (x * x[i]).sum(1) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        yield ids[i], [(int(ids[j]), s[j]) for j in order]


@pytest.mark.parametrize("cell_rows", [4096, 20])
def test_neighbours(spark, cell_rows, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(neighbours, "PART_ROWS", 8192 if cell_rows > 20
                        else 15)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = collections.defaultdict(dict)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0,
                                cell_rows=cell_rows).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    raw = df.toPandas()
    ids, x = raw.vec_id.to_numpy(), np.stack(raw.embedding).astype(float)
    found = total = 0
    for q, want in near(ids, x):
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        found += len({i for i, _ in want} & {v[0] for v in got[q].values()})
        total += 5
        for i, s in got[q].values():
            assert s == dict(near_scores(ids, x, q))[i]
    assert found / total >= 0.9


def test_the_test_stops_the_search():
    """On the given vectors and on clustered ones: recall of 0.9 or more, and
    a good part of the rows is never verified."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids = table["vec_id"].to_numpy()
    x = np.array(table["embedding"].to_pylist(), float)
    rng = np.random.default_rng(1)
    tight = rng.standard_normal((40, 64))[rng.integers(0, 40, 2000)] \
        + .2 * rng.standard_normal((2000, 64))
    for ids, x, most in ((ids, x, .8), (np.arange(2000), tight, .1)):
        index, found, queries = neighbours.Index(ids, x), 0, 0
        for q, want in near(ids, x):
            got = index.search(q, x[np.flatnonzero(ids == q)[0]])
            found += len({i for i, _ in want} & {i for _, i in got})
            queries += 1
        assert found >= .9 * 5 * queries
        assert index.verified <= most * queries * len(ids)


def test_queries_go_to_reached_cells_only(spark):
    """Clustered rows: a query moves to few cells, and loses no neighbour."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((16, 32))[np.arange(1600) % 16] \
        + .05 * rng.standard_normal((1600, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    written = []
    real = neighbours.written
    try:
        neighbours.written = lambda d, name: (
            written.append((name, real(d, name))) or written[-1][1])
        got = collections.defaultdict(set)
        for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0,
                                    cell_rows=100).collect():
            got[r.query_id].add(r.vec_id)
    finally:
        neighbours.written = real
    reached = [d for name, d in written if name == "nn-reached"][0].count()
    assert reached < 32 * 15 / 4
    found = sum(len({i for i, _ in want} & got[q])
                for q, want in near(np.arange(1600), x))
    assert found >= .95 * 5 * 32


def near_scores(ids, x, q):
    norm = np.sqrt((x * x).sum(1))
    i = int(np.flatnonzero(ids == q)[0])
    return zip(ids.tolist(), (x * x[i]).sum(1) / (norm * norm[i]))


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, []),
            (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [1.0, None]), (6, [1.0, 0.0, 0.0]), (7, [1.0, 0.0]),
            (7, [1.0, 0.0]), (None, [1.0, 0.0]), (8, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>") \
        .withColumn("rank", F.lit(1)).withColumn("shard", F.lit("x"))
    got = sorted(rows_of(neighbours.op7_query(df)))
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 7, 1.0),
                   (0, 4, 8, -1.0)]
    assert neighbours.op7_query(df.where("false")).count() == 0


def test_chi_square():
    # fixed values: the 0.5 and 0.99 quantiles for 8 degrees of freedom
    assert neighbours.chi_square_cdf(7.344, 8) == pytest.approx(.5, abs=1e-3)
    assert neighbours.chi_square_cdf(20.09, 8) == pytest.approx(.99, abs=1e-3)


# -- 8 ------------------------------------------------------------------
def sharded(df):
    got = sharding.op8_query(df).toPandas()
    n = got.groupby("shard").size()
    assert n.max() - n.min() <= 1 or len(got) < 8
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert set(got.law) <= {"rows"} and got.grown_shard.isna().all()
    return got


def test_sharding(docs):
    got = sharded(docs).merge(docs.toPandas(), on="doc_id")
    assert len(got) == docs.count()
    assert (got["size"] == got.text.map(
        lambda t: len(t.encode()) + 1)).all()
    assert (got.text_crc32 == got.text.map(
        lambda t: zlib.crc32(t.encode()))).all()
    assert got.groupby("text").shard.nunique().max() == 1


def test_sharding_splits_only_what_is_too_large(spark):
    rows = [(i, "copy" if i < 40 else f"pair {i // 2}" if i < 80 else f"t{i}",
             "", "", 0) for i in range(120)]
    got = sharded(spark.createDataFrame(rows, DOCS))
    text = {r[0]: r[1] for r in rows}
    spread = got.assign(t=got.doc_id.map(text)).groupby("t").shard.nunique()
    assert spread["copy"] <= 4 and (spread.drop("copy") > 1).sum() <= 7
    cut = sharding.cut_edges(sharding.shard_documents(
        spark.createDataFrame(rows, DOCS))).first()
    # shards hold 15 rows: at the least, 40 copies cut 780 - 105 - 105 - 45
    assert cut.links == 800 and 525 <= cut.cut <= 545


@pytest.mark.parametrize("sizes", [[3], [10], [2, 3, 5, 7, 10], [5] * 9 + [1],
                                   [40, 2], [300, 4]])
def test_sharding_keeps_groups_whole_on_linked_rows(spark, sizes):
    rows, group = [], 0
    while len(rows) < 1200:
        n = sizes[group % len(sizes)]
        if n >= 300 and group:
            n = 4
        rows += [(len(rows) + i, f"text {group}", "", "", 0)
                 for i in range(n)]
        group += 1
    got = sharded(spark.createDataFrame(rows, DOCS))
    assert sorted(got.doc_id) == [r[0] for r in rows]
    text = {r[0]: r[1] for r in rows}
    by = got.assign(t=got.doc_id.map(text)).groupby("t").shard
    fits = by.size() <= len(rows) // 8
    assert (by.nunique()[fits] > 1).sum() <= 7
    if sizes == [3] or 1 in sizes:      # shards can be filled with no split
        assert (by.nunique() > 1).sum() == 0


def test_departures_count_as_room():
    # full shards that want to swap all rows may do so
    assert sharding.accepted_shares([[5, 5], [5, 5]], [10, 10]) == [1, 1]
    a, b = sharding.accepted_shares([[6, 4], [2, 8]], [10, 10])
    assert a == 1 and b == pytest.approx(.5)
    assert sharding.accepted_shares([[5, 5], [0, 10]], [10, 10]) == [0, 0]


def test_sharding_edges(spark, odd):
    got = sharded(odd)
    assert len(got) == 9
    kept = sharding.shard_documents(odd, keep=odd.columns)
    assert sorted(kept.columns) == sorted(odd.columns + ["text_crc32", "slot"])
    assert kept.where("text is null").select("size", "text_crc32") \
        .collect() == [(1, 0)]
    assert sharding.op8_query(odd.where("false")).count() == 0


# -- 9 ------------------------------------------------------------------
@pytest.mark.parametrize("head", [100_000, 30])
def test_scoring(docs, head):
    got = scoring.score_texts(docs, head=head).toPandas().set_index("doc_id")
    raw = [(r.doc_id, blank_words(lower(r.text))) for r in docs.collect()]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in raw}
    count = collections.Counter(
        x for i, w in raw if not held[i] for x in [*w, None])
    n, v = sum(count.values()), len(count)
    for i, w in raw:
        c = [count[x] for x in [*w, None]]
        g = got.loc[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            held[i], len(c), sum(x > 0 for x in c), n)
        assert g.base_score == pytest.approx(sum(math.log10(
            (x + .1) / (n + .1 * (v + 1))) for x in c))
    g = got[got.held_out]
    assert g.score.sum() > g.base_score.sum()


def test_tilt_is_causal_and_normalised():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[7], rng.integers(0, 40, 59)])
    words = attention.Words(ids, np.arange(61))
    texts = [rng.integers(1, 60, 90).astype(np.int32) for _ in range(20)]
    model = attention.train(texts, words, 0, 40, epochs=1)
    p = rng.random(60)
    p /= p.sum()
    model.share = p @ model.parts_of(words)
    # the tilted chances of all words after a context sum to 1
    context = texts[0][:40]
    before = model.tilt([context], words, 0)[0]
    tilts = model.tilt([np.append(context, np.int32(w)) for w in range(60)],
                       words, 0) - before
    assert np.exp(tilts) @ p == pytest.approx(1, abs=1e-4)


def test_fit_reaches_every_text(spark):
    """Words of any text, and at the end of a text of more than 50,000
    characters, change the network's weights; the split of the input and
    repeated rows do not."""
    path = public_tokenizers.path(scoring.TOKENIZER)
    sub = scoring.Subwords(path)
    rows = [(i, f"the cat and the dog saw a {w} by the old house " * 3)
            for i, w in enumerate(["quokka", "zeppelin", "xylophone"] * 20)]
    rows += [(100, "the cat sat on the old mat " * 4_000 + "kaleidoscope")]
    rows += [(7, "many equal rows")] * 50
    train = spark.createDataFrame(rows, "doc_id long, text string")
    model = scoring.fit(train.repartition(3), len(rows), path)
    first = attention.initial(sub.end + 1)["output"]
    for w in (b"quokka", b"zeppelin", b"xylophone", b"kaleidoscope"):
        ids = sub.of([w]).ids
        assert (model.output[ids] != first[ids]).any(axis=1).all(), w
    again = scoring.fit(train.repartition(6), len(rows), path)
    for name in (*attention.TABLES, *attention.SMALL):
        assert (getattr(again, name) == getattr(model, name)).all(), name


def test_scores_do_not_depend_on_the_split(docs):
    two, six = (sorted(rows_of(scoring.score_texts(docs.repartition(n))
                               .select("doc_id", "score")))
                for n in (2, 6))
    assert [i for i, _ in two] == [i for i, _ in six]
    assert np.allclose([s for _, s in two], [s for _, s in six], rtol=1e-6)


def test_pass_over_all_windows_is_averaged():
    rng = np.random.default_rng(2)
    words = attention.Words(np.arange(60), np.arange(61))
    texts = [rng.integers(1, 30, 90).astype(np.int32) for _ in range(20)]
    model = attention.Model(**attention.initial(60))
    one, two = attention.Local(model), attention.Local(model)
    one.add(texts, words, 0)
    two.add(texts, words, 0)
    assert one.windows == sum(-(-len(t) // attention.CONTEXT) for t in texts)
    assert one.seen.sum() == sum(map(len, texts))
    # two tasks of the same texts move the weights as far as one does
    sums = {k: x for k, x in one.blocks()}
    both = {k: x + sums[k] for k, x in two.blocks()}
    for name in (*attention.TABLES, *attention.SMALL):
        a = getattr(attention.averaged(model, sums), name)
        b = getattr(attention.averaged(model, both), name)
        assert np.allclose(a, b, atol=1e-6), name
        assert np.allclose(a, one.adam.P[name], atol=1e-5) or \
            name in attention.TABLES
    # words never seen as a token keep their place
    assert (attention.averaged(model, sums).output[30:]
            == model.output[30:]).all()


def test_step_follows_the_gradient():
    """The first moments after one step are a tenth of the gradient."""
    rng = np.random.default_rng(3)
    size = rng.integers(1, 12, 40)
    words = attention.Words(rng.integers(0, 50, size.sum()).astype(np.int32),
                            np.concatenate([[0], np.cumsum(size)]))
    texts = [np.append(rng.integers(1, 40, n), 0).astype(np.int32)
             for n in (3, 40, 70)] + [np.full(90, 5, np.int32)]
    for stride in (attention.STRIDE, attention.CONTEXT):
        x, y, ok, _ = attention.windows(texts, 0, stride)

        def loss(P):
            def mean(table):
                return np.array([table[words.ids[i:j]].mean(axis=0) for i, j
                                 in zip(words.edge, words.edge[1:])])

            e, now = mean(P["embed"]), mean(P["current"])
            r = np.exp(mean(P["output"]) * size[:, None])
            r /= r.sum(axis=1, keepdims=True)
            r = r[y]
            at, last = np.maximum(x, 0), np.maximum(x, 0)[:, -stride:]
            a = (e @ P["query"])[last] @ (e @ P["key"])[at].transpose(0, 2, 1)
            a += attention.causal(P["near"], stride)
            a = np.where((x < 0)[:, None, :], -1e9, a)
            a = np.exp(a - a.max(axis=2, keepdims=True))
            a /= a.sum(axis=2, keepdims=True)
            z = np.exp(a @ (e @ P["value"])[at] @ P["mix"] + now[last])
            z /= z.sum(axis=2, keepdims=True)
            return -np.log((z * r / r[ok].mean(axis=0)).sum(axis=2)[ok]).mean()

        first = attention.initial(50)
        adam = attention.Adam({k: v.copy() for k, v in first.items()})
        adam.step(x, y, ok, words, 0, .01)
        exact = {k: v.astype(float) for k, v in first.items()}
        for name in (*attention.TABLES, *attention.SMALL):
            got = (adam.rows[1][:, attention.SIDE[name]]
                   if name in attention.TABLES else adam.m1[name]) * 10
            for i in rng.integers(0, got.size, 6).tolist():
                at = np.unravel_index(i, got.shape)
                was, both = exact[name][at], []
                for d in (1e-5, -1e-5):
                    exact[name][at] = was + d
                    both.append(loss(exact))
                exact[name][at] = was
                assert got[at] == pytest.approx(
                    (both[0] - both[1]) / 2e-5, rel=2e-2, abs=2e-6), name


def test_run_sums():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 9, (3_000, 5)).astype(np.float32)
    for most in (1, 8, 9, 100):
        at = np.minimum(rng.integers(0, 400, 3_000),
                        rng.integers(0, 4 * most, 3_000))
        want = np.zeros((500, 5), np.float32)
        np.add.at(want, at, values)
        assert (attention.by_row(at, values, 500) == want).all()


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **kwargs):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **kwargs)

    def encode(self, text, **kwargs):
        return self.tokenizer.encode(text, **kwargs)


def test_words_are_encoded_together():
    """Ids are those of each word alone, found in few calls; words asked for
    again are kept."""
    path = public_tokenizers.path(scoring.TOKENIZER)
    rng = random.Random(5)
    signs = list("ab1,'s<|>\u00e9\u4e2d\u0308\u0120\x00\U0001f600")
    blanks = list("\u00a0\u3000\u0085\x1c\u180e")
    plain, odd = ([w.encode() for w in dict.fromkeys(
        "".join(rng.choices(c, k=rng.randint(1, 6))) for _ in range(2_000))]
        for c in (signs, signs + blanks))
    plain += [b"<|endoftext|>", b"x" * 3_000]
    for words in (plain, odd + [b""], [b""]):
        sub = scoring.Subwords(path)
        got = sub.of(words)
        want = [sub.tokenizer.encode(" " + w.decode(), add_special_tokens=False
                                     ).ids if w else [sub.end] for w in words]
        assert [got.ids[i:j].tolist() for i, j in
                zip(got.edge, got.edge[1:])] == want
    sub = scoring.Subwords(path, limit=1_000)
    sub.tokenizer = counted = Counted(sub.tokenizer)
    sub.of(plain)
    assert counted.texts < len(plain) / 100
    often, counted.texts = b" ".join(plain[:300]).decode(), 0
    for i in range(5):
        sub.numbered(pa.array([often + f" new{i}-" + f" new{i}-".join(
            map(str, range(400)))]))
    assert len(sub.known) < 1_800
    assert counted.texts <= 2 + 5 * 3


def test_numbers_of_words():
    path = public_tokenizers.path(scoring.TOKENIZER)
    texts = [" The cat\tTHE  dog\n", None, "", "dog \x1c\u00a0 \u00c9", " "]
    for texts in (texts, texts[1:], texts[1:3]):
        flat, subs, words, _ = scoring.Subwords(path).numbered(
            pa.array(texts, pa.string()))
        words = words.to_pylist()
        assert words[0] == b"" and len(subs.edge) == len(words) + 1
        assert [[words[i] for i in t] for t in flat] == [
            [w.encode() for w in [*blank_words(lower(t)), ""]] for t in texts]


def test_windows_score_each_token_once():
    texts = [np.arange(1, n + 1, dtype=np.int32) for n in (0, 1, 16, 17, 100)]
    for stride in (attention.STRIDE, attention.CONTEXT):
        x, y, ok, owner = attention.windows(texts, 0, stride)
        for i, t in enumerate(texts):
            assert y[owner == i][ok[owner == i]].tolist() == t.tolist()
        last = x[:, -stride:]
        assert ((y - last == 1) | ~ok).all()  # each follows its input


def test_scoring_edges(spark, odd):
    got = scoring.op9_query(odd).collect()
    assert len(got) == 9
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, -6)} == {1}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert scoring.op9_query(odd.where("false")).count() == 0


# -- 10 -----------------------------------------------------------------
def simhash_of(text):
    w = blank_words(lower(text))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64)
               if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, ids, bits=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = x if r not in least or least[r] is None else \
            least[r] if x is None else min(x, least[r])
    return [least[find(i)] for i in range(len(fps))]


def test_simhash(docs):
    raw = docs.collect()
    fps = [simhash_of(r.text) for r in raw]
    ids = [r.doc_id for r in raw]
    got = {r.doc_id: r for r in simhash.op10_query(docs).collect()}
    assert [got[i].fingerprint for i in ids] == [f"{x:016x}" for x in fps]
    assert [got[i].component_id for i in ids] == groups(fps, ids)
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        {got[i].component_id for i in ids})


def test_links_are_complete(spark):
    prepare(spark)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for x in list(fps):
        for n in (1, 1, 2, 2, 3):
            y = x
            for b in rng.sample(range(64), n):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {(a, b) for i, b in enumerate(fps) for a in fps[:i]
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2}
    got = rows_of(simhash.links(df))
    assert len(got) == len(want) and set(got) == want
    named = dict(rows_of(simhash.components(simhash.links(df))))
    for a, b in want:
        assert named[a] == named[b] <= min(a, b)


def test_components_of_a_long_chain(spark):
    prepare(spark)
    df = spark.range(300).selectExpr(
        "id * 7919 % 301 u", "(id + 1) * 7919 % 301 v")
    assert {r.root for r in simhash.components(df).collect()} == {0}


def test_kept_rows_keep_their_columns(spark):
    """Columns named like the operator's own come back as they were."""
    rows = [(1, "one two three four", 7, "a", 2.0),
            (2, "one two three four", 8, "b", 3.0)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, __th int, _h string, __n double")
    assert rows_of(simhash.keep_one(df)) == [rows[0]]


def test_simhash_edges(spark, odd):
    got = sorted(rows_of(simhash.op10_query(odd)), key=str)
    assert len(got) == 9
    zero = [r for r in got if r[1] == "0" * 16]
    assert {r[0] for r in zero} == {1, 2, -6} and {r[2] for r in zero} == {-6}
    assert [r[2] for r in got if r[0] is None] == [None]
    assert simhash.op10_query(odd.where("false")).count() == 0
    kept = rows_of(simhash.keep_one(odd).select("doc_id"))
    assert sorted(kept, key=str) == [(-6,), (3,), (4,), (7,), (None,)]


# -- all ----------------------------------------------------------------
def test_pipeline(spark, docs, bench):
    import corpus_pipeline
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = corpus_pipeline.run(spark, SF).toPandas()
    raw = docs.toPandas().set_index("doc_id")
    model = quality.train(docs, labels)
    good = raw[model.score(np.array([quality.features(t)
                                     for t in raw.text])) >= .7]
    rep = groups([simhash_of(t) for t in good.text], good.index.tolist())
    one = good[[i == r for i, r in zip(good.index, rep)]]
    bad = [h > 0 for _, h, _ in contaminated(
        [tuple(r) for r in bench.collect()], one.text)]
    clean = one[[not b for b in bad]]
    assert set(got.doc_id) <= set(clean.index)
    sizes = {i: len(blank_words(t)) for i, t in clean.text.items()}
    want = targets(clean.assign(n=pandas_map(clean.index, sizes)).groupby(
        "source").n.sum().to_dict())
    for s, g in got.groupby("source"):
        assert abs(sum(len(blank_words(t)) for t in g.text) - want[s]) <= 1
    n = got.groupby("shard").size()
    assert n.max() - n.min() <= 1


def pandas_map(index, values):
    return [values[i] for i in index]


def test_pipeline_stages_on_odd_rows(spark, odd, tmp):
    import corpus_pipeline
    for name, kind in (("labels", "doc_id long, quality int, toxic int"),
                       ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp}/{name}.parquet")
    for rows in (odd.select(*[c.split()[0] for c in DOCS.split(", ")]),
                 odd.drop("shard", "size"),
                 odd.where("false").drop("shard")):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, tmp)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == rows.columns
            out.count()


def test_entry_lists_the_operators():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names)
               for i in range(1, 14)) and "pipeline" in names
    assert {"op12_minhash", "op13_lexical"} <= set(entry.oracle_sql())


def test_quality_is_fitted_on_all_pairs(spark):
    """At the fitted weights the loss over every pair has no slope, and as
    many rows as are marked bad score below the cut."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad = rng.random() < 0.4
        words = ["alpha", "beta.", "gamma", "x1", "##", "||", "Delta", "7"]
        rows.append((i, " ".join(rng.choice(words[3:] if bad and
                     rng.random() < 0.6 else words[:6])
                     for _ in range(rng.randint(3, 40))), int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(df.select("doc_id", "text"),
                          df.select("doc_id", "quality"))
    learned = [r for r in rows
               if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    x = np.array([quality.features(r[1]) for r in learned])
    good = np.array([r[2] for r in learned]) == 1
    scale = np.where(x.std(axis=0) < 1e-9, 1.0, x.std(axis=0))
    z, x = x @ model.weights, x / scale
    wrong = 1 / (1 + np.exp(z[good][:, None] - z[~good][None, :]))
    slope = (np.einsum("ij,ik->k", wrong, x[good])
             - np.einsum("ij,jk->k", wrong, x[~good])) / wrong.size
    assert np.abs(slope - quality.RIDGE * model.weights * scale).max() < 1e-4
    assert (z < model.cut).sum() == (~good).sum()
