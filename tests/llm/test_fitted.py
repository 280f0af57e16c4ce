"""Toxicity, quality, page text and tokens."""

import os
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import html_extraction, quality, queries, repair, token_binary, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
has_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def area(y, s):
    r = pd.Series(s).rank().to_numpy()
    n = y.sum()
    return (r[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@has_tables
def test_toxicity_on_held_out_documents(spark):
    sf = SF.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op6_toxicity(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    y = got["toxic"].to_numpy()
    assert got["score"].between(0, 1).all()
    assert area(y, got["score"]) > 0.88
    assert got["predicted"][y == 1].mean() > 0.65 and got["predicted"][y == 0].mean() < 0.04


def test_toxicity_without_labels_or_text(spark):
    none = toxicity.fit_texts([], ["a"] * 10)
    assert (none.score(["", "anything"]) < 1e-6).all()
    words = [f"w{i}" for i in range(300)]
    r = random.Random(1)
    plain = [" ".join(r.choice(words) for _ in range(60)) for _ in range(60)]
    nasty = [" ".join([*(r.choice(words) for _ in range(50)), *["horrid"] * 4, *["vile thing"] * 3]) for _ in range(30)]
    model = toxicity.fit_texts(nasty, plain)
    assert model.score(["horrid vile thing, horrid vile thing " * 3])[0] > model.score(["w1 w2 w3 w4 w5"])[0]
    rows = [(1, None, "x", "s", 1), (1, "", "x", "s", 1), (2, "horrid " * 50000, "x", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("keep"))
    out = toxicity.without_toxic(df, model)
    assert out.columns == df.columns
    scored = toxicity.scored(df.drop("score"), model).collect()
    assert len(scored) == 3 and scored[0].score == scored[1].score and all(0 <= x.score <= 1 for x in scored)
    assert toxicity.without_toxic(df.limit(0), model).count() == 0


def test_toxicity_uses_every_typical_word():
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    nasty = ["".join(r.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(60)]
    plain = [" ".join(r.choice(words) for _ in range(60)) for _ in range(200)]
    toxic = [" ".join([*(r.choice(words) for _ in range(50)), *r.sample(nasty, 10)]) for _ in range(100)]
    model = toxicity.fit_texts(toxic, plain)
    usual = model.score([" ".join(r.choice(words) for _ in range(60)) for _ in range(50)])
    some = model.score([" ".join([*(r.choice(words) for _ in range(50)), *r.sample(nasty, 4)]) for _ in range(60)])
    assert some.min() > usual.max()
    assert sum(x.encode() in model.toxic for x in nasty) > 40
    assert not any(x.encode() in model.ordinary for x in nasty)
    assert all((" " + x).encode() in model.all_words for x in nasty)


def slow_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    ]


def test_statistics_match_brute_force(spark):
    r = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b c a b c", "x x x x x", "l\nl\n l\n\n\nl", "#*$%&|<> é\x0b\x0cü"]
    texts += ["".join(r.choice(["a ", "b ", "c\n", "# ", "é ", " "]) for _ in range(r.randrange(400))) for _ in range(60)]
    for t in texts:
        assert quality.statistics(t or "")[0] == slow_statistics(t)
    df = spark.createDataFrame([(i, t, "l", "s", 0) for i, t in enumerate(texts)], DOCS).withColumn("kept", F.lit(1))
    trees = quality.fit_trees(np.zeros((0, len(quality.FEATURES))), np.zeros(0), list(quality.FEATURES.values()))
    got = {x.doc_id: x for x in quality.judged(df, trees).collect()}
    for i, t in enumerate(texts):
        want = slow_statistics(t)
        assert [got[i][c] for c in quality.BASE] == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert got[i].kept == (not got[i].base_failed)
    assert quality.judged(df.limit(0), trees).count() == 0


def test_trees_keep_their_directions():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + np.sin(3 * x[:, 2]) + r.normal(size=3000) > 0).astype(float)
    trees = quality.fit_trees(x, y, [1, -1, 0])
    assert area(y, trees.probability(x)) > 0.85
    grid = np.linspace(-3, 3, 61)
    for base in r.normal(size=(20, 3)):
        for f, sign in ((0, 1), (1, -1)):
            probe = np.repeat(base[None], len(grid), 0)
            probe[:, f] = grid
            assert (sign * np.diff(trees.probability(probe)) >= -1e-12).all()


@has_tables
def test_quality_on_held_out_labels(spark):
    sf = SF.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = quality.judged(docs.join(held.select("doc_id"), "doc_id"), quality.fit(docs, known)).toPandas()
    rest = got[~got["base_failed"]]
    assert (rest["kept"] == (rest["quality"] >= quality.THRESHOLD)).all()
    label = held.select("doc_id", F.col("quality").alias("label")).toPandas().set_index("doc_id")["label"]
    y = rest["doc_id"].map(label)
    assert (rest["kept"][y == 1]).mean() > 0.97 and (rest["kept"][y == 0]).mean() < 0.1


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>if (a<b) document.write("</p>")</script>
<style>p{}</style></head><body class="home"><header><h2>Site</h2></header><nav><ul><li><a href="/x>y">Menu one</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- <p>not this</p> --><div id="wrap"><%s><h1>Head &lt;1&gt;</h1>
<p>First   <b>bold</b>
text &eacute;&#233;&nbsp;x.<p>Second one<br>after break.<div class="ad">Buy now</div><aside>Related</aside>
<form><input value="p>q"><label>Mail</label></form><blockquote>Quote here that is long enough to count.</blockquote>
<div class="comments"><p>I disagree</p></div></%s></div><div class="sidebar"><p>Side text</p></div><footer>&copy; site</footer></body></html>"""
TEXT = "Head <1>\nFirst bold text éé x.\nSecond one\nafter break.\nQuote here that is long enough to count."


@pytest.mark.parametrize("element", ["article", "main", "div", "section"])
def test_page_text(element):
    weights = html_extraction.learn_weights([PAGE % ("article", "article")] * 3)
    assert html_extraction.extract(PAGE % (element, element), weights) == TEXT


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "id='page' class='no-sidebar'", "class='container with-nav'", "class='sidebar'", "id='widgets'"])
def test_names_discard_no_article(wrapper):
    weights = html_extraction.learn_weights([PAGE % ("article", "article")] * 3)
    body = "<%s><div class='article-header'><h1>Title</h1></div><p>%s</p><section id='discussion'><p>It was discussed.</p></section><p class='legal'>By law.</p><p><math>x = 1</math> holds.</p></%s>"
    for element in ("article", "main"):
        page = f"<body><div {wrapper}><div class='site-nav'>Menu one two</div>{body % (element, 'word ' * 40, element)}</div></body>"
        lines = html_extraction.extract(page, weights).split("\n")
        assert lines == ["Title", " ".join(["word"] * 40), "It was discussed.", "By law.", "x = 1 holds."]
    page = f"<body><div {wrapper}><div class='comments'>Me too</div><p>{'word ' * 40}</p></div></body>"
    assert html_extraction.extract(page, weights) == " ".join(["word"] * 40)


def test_region_grows_to_blocks_and_headings():
    weights = {"word": 0.2}  # tags cost 0.5 each: short blocks don't pay for their own
    text = "word " * 40
    body = f"<div class='top'><h1>Short <i>title</i></h1></div><p>By me</p><p>{text}</p><p>{text}</p><p>The end.</p><h2>More</h2>"
    page = f"<body><ul><li><a href='/'>Home</a></li></ul><p><a href='/x'>All of our pages</a></p><div id='content'>{body}</div><div>Elsewhere</div></body>"
    want = ["Short title", "By me", text.strip(), text.strip(), "The end."]
    assert html_extraction.extract(page, weights).split("\n") == want
    wrapped = page.replace("<div id='content'>", "<article>").replace("<h2>More</h2></div>", "<h2>More</h2></article>")
    assert html_extraction.extract(wrapped, weights).split("\n") == [*want, "More"]
    cut = f"<body><p>a <b>b</b> <code>c</code> {text}<i>x</i> <u>y</u></p></body>"
    assert html_extraction.extract(cut, weights) == f"a b c {text}x y"
    assert html_extraction._grown([("text", "a", True, False)], 0, 1) == (0, 1)


def test_weights_score_inside_the_article():
    """Of two articles the one that the learned weights favour, whatever the number of its words."""
    weights = {"word": 0.5, "open p": -0.1, "close p": -0.1, "open li": -5.0, "close li": -5.0}
    teasers = "<article>" + "<li>one two three four</li>" * 20 + "</article>"
    page = f"<body>{teasers}<article><p>{'word ' * 30}</p></article></body>"
    assert html_extraction.extract(page, weights) == " ".join(["word"] * 30)


def test_odd_pages(spark):
    weights = html_extraction.learn_weights([])
    cases = [None, "", "   ", "plain words only", "<p>unclosed <b>bold", "</div></p>stray", "<article>cut <p>off &amp", "<<>< a < b >",
             "<script>never closed", "<!-- never closed", "<p title='a>b\">x</p>"]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(cases)], "page_id bigint, url string, html string")
    got = {x.page_id: x.main_text for x in html_extraction.extracted(df.withColumn("text", F.lit(1)), weights).collect()}
    assert [got[i] for i in range(7)] == ["", "", "", "plain words only", "unclosed bold", "stray", "cut\noff &"]
    assert got[8] == got[9] == ""
    assert html_extraction.extracted(df.limit(0), html_extraction.fit(df)).count() == 0
    long = "<article>" + "<p>word </p>" * 20000 + "</article>"
    assert html_extraction.extract(long, weights) == "\n".join(["word"] * 20000)


def test_pair_grammar_round_trip():
    r = np.random.default_rng(1)
    for ids in (np.zeros(0, int), np.array([5]), np.zeros(1000, int), r.integers(0, 30, 5000), np.tile([1, 2, 3], 999), r.integers(0, 50000, 3000)):
        symbols, rules, lengths = repair.compress(ids, 50257, rounds=4)
        assert (repair.expand(symbols, rules, 50257) == ids).all()
        for k in range(len(rules)):
            assert len(repair.expand(np.array([50257 + k]), rules, 50257)) == lengths[k]
        for a in range(0, len(ids), 97):
            b = a + int(r.integers(0, 300))
            assert (repair.slice_ids(symbols, rules, lengths, 50257, a, b) == ids[a:b]).all()
    assert len(repair.compress(np.tile([1, 2, 3, 4], 500), 10)[0]) < 700


def test_pair_grammar_leaves_no_frequent_pair():
    r = np.random.default_rng(2)
    passage = r.integers(0, 50000, 60)
    ids = np.concatenate([x for _ in range(300) for x in (r.integers(0, 3000, 40), passage)])
    symbols, rules, lengths = repair.compress(ids, 50257)
    assert (repair.expand(symbols, rules, 50257) == ids).all()
    assert lengths.max() >= 60
    left = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    assert max(left.values()) < repair.LEAST_COUNT
    # So many pairs that a table by hash would lose some.
    many = np.tile(r.permutation(40000), 4)
    symbols, rules, lengths = repair.compress(many, 50257)
    assert (repair.expand(symbols, rules, 50257) == many).all()
    assert lengths.max() >= 40000 and len(symbols) < 100
    assert len(set(map(tuple, rules.tolist()))) == len(rules)


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path(queries.TOKENIZER)


def test_encoder_is_the_librarys():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    r = random.Random(0)
    signs = [" ", "  ", "\n", "\n\n", "\t", "a", "The", "été", "Ñu", ",", ".", "...", "'s", "'ll", "12", "日本", "\xa0", "<|endoftext|>", "\x01", "\x85", "-", "€", "ſ", "\U0001f600", "\x00"]
    texts = ["", " ", "\n", " a", "a ", "a, b. c.\nd", "a ,b .c\n"] + ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(3000)]
    encoder = token_binary.Encoder(tokenizer())
    for batch in (texts, texts[::-1], texts[:1]):
        flat, sizes = encoder(pa.array(batch))
        parts = np.split(flat, np.cumsum(sizes)[:-1])
        for t, p in zip(batch, parts):
            assert p.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_encoder_keeps_white_space_together():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    r = random.Random(3)
    white = [c for c in map(chr, range(0x3001)) if c.isspace()]
    texts = ["Intro\n\u00a0\u00a0Text", "Intro\n\u00a0", "Intro\n\u00a0\tText", "a\n\t\tb", "a\n\x1c", "a.\n", "a,\u2028b."]
    texts += ["".join(r.choice([*white, "\n", "\n", "a", "Text", "é", ".", ",", " b"]) for _ in range(r.randrange(12))) for _ in range(20000)]
    encoder = token_binary.Encoder(tokenizer())
    flat, sizes = encoder(pa.array(texts))
    for t, p in zip(texts, np.split(flat, np.cumsum(sizes)[:-1])):
        assert p.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    r = random.Random(6)
    rows = [(r.randrange(-50, 400), " ".join(r.choice(["alpha", "beta", "é,", "x.\ny"]) for _ in range(r.randrange(90)))) for _ in range(500)]
    rows += [(None, "no id"), (7, None), (7, ""), (11, "word " * 30000)]
    df = spark.createDataFrame([(i, t, "l", "s", 0) for i, t in rows], DOCS).withColumns({"range": F.lit(1), "start": F.lit("x")})
    path = str(tmp_path / "tokens")
    token_binary.write_tokens(df.repartition(5), path, tokenizer(), shard_ids=5000)
    got = token_binary.read_tokens(spark, path).orderBy("start").collect()
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    at = 0
    assert len(got) == len(ordered)
    for x, (i, t) in zip(got, ordered):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert (x.doc_id, x.start, x.n_tokens) == (i, at, len(ids))
        assert x.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    shards = spark.read.parquet(path).orderBy("range", "shard").collect()
    assert len(shards) > 5
    some = shards[2].asDict()
    k = some["n_docs"] // 2
    doc = token_binary.read_document(some, k)
    assert len(doc) == some["doc_tokens"][k] and doc[-1] == 2
    token_binary.write_tokens(df.limit(0), str(tmp_path / "none"), tokenizer())
    assert token_binary.read_tokens(spark, str(tmp_path / "none")).count() == 0


@has_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit(1), "target": F.lit("t")})
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF).persist()
        assert out.columns == docs.columns, name
        a = {(x.doc_id, x.text) for x in seen.select("doc_id", "text").collect()}
        b = {(x.doc_id, x.text) for x in out.select("doc_id", "text").collect()}
        assert b <= a and len(b) > 0.5 * len(a), name
        seen = out
    n = seen.count()
    assert corpus_pipeline.STAGES[-1][1](spark, seen, SF).count() == n


@has_tables
def test_pipeline_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 500 and len({x.start for x in rows}) == len(rows)
    total = max(rows, key=lambda x: x.start)
    assert sum(x.n_tokens for x in rows) == total.start + total.n_tokens


def test_copies_of_a_passage_share_their_rules():
    """However many copies there are, and wherever they stand."""
    r = np.random.default_rng(1)
    for copies, n in ((4, 20_000), (5, 20_000), (5, 5_000), (10, 3_000)):
        passage = r.integers(0, 50_000, n)
        gaps = [r.integers(0, 50_000, r.integers(1, 9)) for _ in range(copies)]
        ids = np.concatenate([x for gap in gaps for x in (gap, passage)])
        symbols, rules, _ = repair.compress(ids, 50_257)
        assert len(symbols) < sum(map(len, gaps)) + 12 * copies
        assert (repair.expand(symbols, rules, 50_257) == ids).all()


def test_packed_numbers():
    r = np.random.default_rng(2)
    for bits in (1, 3, 8, 17, 31):
        for n in (0, 1, 7, 1000):
            x = r.integers(0, 1 << bits, n)
            data = token_binary._packed(x, bits)
            assert len(data) == -(-n * bits // 8) and (token_binary._unpacked(data, n, bits) == x).all()


def test_short_comments_are_whole():
    for page in ("<!--><p>four", "<!---><p>four", "<!-- a --><p>four", "<!----><p>four", "<!-- a --!><p>four"):
        assert html_extraction._TOKEN.match(page).end() == page.index("<p>")
    assert html_extraction._TOKEN.match("<!-- open <p>four").end() == len("<!-- open <p>four")


def test_a_worker_keeps_little_memory(monkeypatch):
    """While a shard is compressed, and between tasks."""
    ids = np.random.default_rng(4).integers(0, 3000, token_binary.SHARD_IDS)
    tracemalloc.start()
    repair.compress(ids, 50_257)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6

    class Task:
        def partitionId(self):
            return 0

    monkeypatch.setattr(token_binary, "TaskContext", type("Context", (), {"get": staticmethod(Task)}))
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["Some words, some more.", "Other words"]})
    encode = token_binary._encode_range(tokenizer(), token_binary.END_ID, 1000)
    (shard,) = encode(iter([batch]))
    assert shard.column("n_docs").to_pylist() == [2]
    assert not token_binary._encoders[tokenizer()].known
    (again,) = encode(iter([batch]))
    assert again.equals(shard)


def test_encoder_cuts_texts_with_white_space_runs(monkeypatch):
    """Plain texts reach the library as distinct parts only, and what is remembered has an end."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    monkeypatch.setattr(token_binary, "REMEMBERED", 300)
    encoder = token_binary.Encoder(tokenizer())
    given = []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: given.extend(texts) or encode(texts))
    r = random.Random(8)
    bits = [" ", "  ", "\n\n", " \n", "\t", "Été", "word", "it's", "'", "'s", "42", "3.14", "(a)", ",", "...", "слово", "日本", "”", "×", "​", "x" * 20]
    for _ in range(30):
        texts = ["".join(r.choice(bits) for _ in range(r.randrange(30))) + "q" * r.randrange(25) for _ in range(200)]
        flat, sizes = encoder(pa.array(texts))
        for t, p in zip(texts, np.split(flat, np.cumsum(sizes)[:-1])):
            assert p.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
        assert len(encoder.known) <= 450
    given.clear()
    flat, _ = encoder(pa.array(["One  line.\n\nAnother\t line, 42 (end)\n" * 50]))
    assert not given


def test_pairs_are_counted_when_they_arise(monkeypatch):
    """A round sorts only the pairs that the last one made."""
    sorted_, frequent = [], repair._frequent
    monkeypatch.setattr(repair, "_frequent", lambda first, *rest: sorted_.append(len(first)) or frequent(first, *rest))
    ids = np.random.default_rng(5).zipf(1.3, 50_000) % 5_000
    symbols, rules, _ = repair.compress(ids, 50_257)
    assert (repair.expand(symbols, rules, 50_257) == ids).all()
    assert len(sorted_) > 5 and sum(sorted_) <= len(ids) + 2 * (len(ids) - len(symbols))
