"""N-gram Jaccard join against brute force."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def members(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if len(w) < k:
        return {" ".join(w)} if w else set()
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)


def brute(texts):
    sets = [members(t) for t in texts]
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [len(s) for s in sets], [top(i) for i in range(len(sets))]


def texts_of(seed, n):
    """Chains of edited texts, so that components are longer than single links, and strangers."""
    r = random.Random(seed)
    vocabulary = [f"wort{i}" for i in range(400)] + ["Été", "日本", "ÄÖ", "X"]
    out = []
    while len(out) < n:
        w = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 4, 8, 12, 20, 60, 150, 400]))]
        out.append(" ".join(w))
        for _ in range(r.choice([0, 0, 2, 6])):
            for _ in range(max(1, len(w) // r.choice([20, 40, 80]))):
                at = r.randrange(len(w))
                w = w[:at] + r.choice([[], [r.choice(vocabulary)], [w[at], r.choice(vocabulary)]]) + w[at + 1 :]
                w = w or ["again"]
            out.append(r.choice(["", "\t", "\n "]) + r.choice([str.lower, str])(" ".join(w)))
    return out[:n]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def check(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.similarity_groups(frame(spark, texts)).collect()}
    sizes, roots = brute(texts)
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def test_components_match_brute_force(spark):
    check(spark, texts_of(1, 260) + [None, "", " \n", "A b", "a B", "a b c d", "A B C D", "a b c d a b c d"])


def test_large_pages_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(jj, "PIECE", 5)
    common = " ".join(f"shared{i}" for i in range(60))
    r = random.Random(7)
    alike = [common + " " + " ".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(40)]
    apart = [common + " " + " ".join(f"own{i}x{j}" for j in range(25)) for i in range(30)]
    check(spark, alike + apart)


def test_all_links_between_classes(spark):
    texts = texts_of(3, 150) + ["a b c d e", "A b c d e", None]
    links, of = jj.similar_pairs(frame(spark, texts))
    classes = {}
    for row in of.collect():
        classes.setdefault(row["class"], []).append(row.doc_id)
    assert classes.pop(None) == [len(texts) - 1]
    sets = {c: members(texts[ids[0]]) for c, ids in classes.items()}
    assert all(members(texts[i]) == sets[c] for c, ids in classes.items() for i in ids)
    want = {(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b])}
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_edges_of_the_table(spark):
    rows = [(None, "a b c d e", 1), (5, "a b c d e", 1), (5, "a b c d e", 1), (None, None, 1), (7, "", 2), (8, "", 2)]
    schema = "doc_id bigint, text string, n int"
    got = sorted(map(tuple, jj.similarity_groups(spark.createDataFrame(rows, schema)).collect()), key=str)
    want = [(None, 2, 5), (5, 2, 5), (5, 2, 5), (None, 0, None), (7, 0, 7), (8, 0, 8)]
    assert got == sorted(want, key=str)
    only = spark.createDataFrame([(None, "x y z w", 1)], schema)
    assert [tuple(r) for r in jj.similarity_groups(only).collect()] == [(None, 1, None)]
    none = spark.createDataFrame([], schema)
    assert jj.similarity_groups(none).collect() == []
    # Columns named like the operator's own do no harm.
    clash = spark.createDataFrame(
        [(1, "p q r s t", 9, b"x", [1], 3, 4), (2, "P q r s t", 9, b"y", [2], 3, 4)],
        "doc_id bigint, text string, cid bigint, digest binary, keys array<bigint>, root int, id int",
    )
    assert sorted(map(tuple, jj.similarity_groups(clash).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(jj, "SLICE", 1000)
    monkeypatch.setattr(jj, "HELD", 500)
    r = random.Random(2)
    long = [f"w{r.randrange(50000)}" for _ in range(60000)]
    near = list(long)
    near[30000:30500] = ["new"] * 500
    check(spark, [" ".join(long), "short text", " ".join(near), " ".join(long[:40000])])


def test_points_in_the_far_corner(spark, monkeypatch):
    monkeypatch.setattr(jj, "MOST", 2)
    check(spark, texts_of(8, 80))


@pytest.mark.parametrize("n", [1, 5, 6, 7, 12, 15, 16, 17, 31, 32, 63, 64, 120, 127, 128, 300, 511, 512, 2000])
def test_linked_sets_share_a_page(n):
    """Sets edited up to the limit, by additions, by removals and by both."""
    r = random.Random(n)
    for trial in range(60):
        a = {r.getrandbits(64) for _ in range(n)}
        b, more = set(a), True
        while more:
            c = set(b)
            if trial % 3 == 0 or (trial % 3 == 2 and r.random() < 0.5):
                c.add(r.getrandbits(64))
            else:
                c.pop()
            more = linked(a, c)
            b = c if more else b
        pages = [set(jj.page_keys(np.array(sorted(s), np.uint64), jj.SIMILARITY).tolist()) for s in (a, b)]
        assert pages[0] & pages[1]


def test_other_similarity_shares_a_page():
    r, s = random.Random(4), Fraction(6, 10)
    for n in (5, 40, 333):
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(list(a)[: -(-n * 6 // 10)])
        pages = [set(jj.page_keys(np.array(sorted(x), np.uint64), s).tolist()) for x in (a, b)]
        assert pages[0] & pages[1]


def test_tree_finds_what_its_bound_allows():
    r = np.random.default_rng(1)
    points = r.poisson(3, (700, jj.GROUPS)).astype(np.int8)
    points[350:] = points[:350] + r.integers(0, 2, (350, jj.GROUPS))
    sizes = points.sum(1, dtype=np.int64)
    tree = jj.Tree(points, sizes)
    tested = 0
    for i in range(0, 700, 7):
        overlap = np.minimum(points, points[i]).sum(1, dtype=np.int64)
        want = set(np.flatnonzero(185 * overlap >= 85 * (sizes + sizes[i])))
        assert set(tree.near(points[i], int(sizes[i]), jj.SIMILARITY)) == want
        tested += len(want)
    assert tested > 100


def test_word_hashes_are_of_words():
    r = random.Random(9)
    texts = ["".join(r.choice("aBé漢 \t\n😀xyzw") for _ in range(r.choice([0, 1, 9, 40]))) for _ in range(200)]
    raw = [t.encode() for t in texts]
    at = np.append(0, np.cumsum([len(x) for x in raw]))
    hashes, ranges = jj.word_hashes(np.frombuffer(b"".join(raw), np.uint8), at)
    seen = {}
    for i, t in enumerate(texts):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        got = hashes[ranges[i] : ranges[i + 1]].tolist()
        assert len(got) == len(words)
        for w, h in zip(words, got):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
