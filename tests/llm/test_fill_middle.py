"""Fill-in-the-middle against a plain version, and the way back."""

import hashlib
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import fill_middle as fm

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
SCHEMA = "doc_id bigint, text string"


def numbers(doc_id):
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]


def plain_version(doc_id, text):
    text, h = text or "", numbers(doc_id)
    t = TOKEN.findall(text)
    a, b = sorted(x % (len(t) + 1) for x in h[:2])
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts_of(seed, n):
    r = random.Random(seed)
    parts = ["a", "Zz", "é", "漢", "😀", " ", "\n", "<P", "<S>", ">", "<", "M>", "İ", "0", "\x00"]
    return ["".join(r.choice(parts) for _ in range(r.choice([0, 1, 2, 5, 30, 300]))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_batches_match_the_plain_version(monkeypatch, block):
    monkeypatch.setattr(fm, "BLOCK", block)
    texts = texts_of(block, 300)
    raw = [t.encode() for t in texts]
    at = np.append(0, np.cumsum([len(x) for x in raw]))
    data = np.frombuffer(b"".join(raw), np.uint8)
    r = fm.rearrange(data, at, np.array([numbers(i) for i in range(len(texts))], np.int64))
    assert r["restored"].tobytes() == data.tobytes()
    for i, text in enumerate(texts):
        form = "plain" if r["plain"][i] else "spm" if r["spm"][i] else "psm"
        lengths = (None, None) if r["plain"][i] else (r["prefix_chars"][i], r["middle_chars"][i])
        out = r["output"][r["output_at"][i] : r["output_at"][i + 1]].tobytes().decode()
        assert (r["n"][i], form, *lengths, out) == plain_version(i, text)


def test_texts_and_digests(spark, monkeypatch):
    texts = [None, "", "word", *texts_of(5, 400)]
    rows = [(None if i == 2 else i // 2, t) for i, t in enumerate(texts)]  # repeated and null ids
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(((i, *plain_version(i, t), t or "") for i, t in rows), key=str)
    got = fm.fill_in_middle(df).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = fm.fill_in_middle(df, digests=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=str)


def test_empty_table_clashing_names_and_ties(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
    wide = spark.createDataFrame(
        [(1, "one two", 5, "x", 0.5)] * 2, SCHEMA + ", n int, form string, output double"
    )
    first, second = fm.fill_in_middle(wide).collect()
    assert first == second and (first.n, first.restored) == (3, "one two")
    assert tuple(first)[1:6] == plain_version(1, "one two")


def test_a_very_long_text(spark, monkeypatch):
    r = random.Random(1)
    text = "".join(r.choice(["wort ", "é", "x1", "\n"]) for _ in range(1_500_000))
    got = fm.fill_in_middle(spark.createDataFrame([(3, "a b"), (4, text), (5, "c")], SCHEMA)).collect()
    row = next(x for x in got if x.doc_id == 4)
    assert tuple(row) == (4, *plain_version(4, text), text)


def test_forms_occur_in_their_shares():
    n = 20_000
    at = np.arange(n + 1)
    r = fm.rearrange(np.full(n, 97, np.uint8), at, np.array([numbers(i) for i in range(n)], np.int64))
    moved = (~r["plain"]).mean()
    assert abs(moved - 0.9) < 0.02 and abs(r["spm"].sum() / (~r["plain"]).sum() - 0.2) < 0.02
