"""Near-duplicates and decontamination against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, simhash_dedup
from ledgerloom.llm.common import lower_ascii, words
from ledgerloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, linked):
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return [top(i) for i in range(n)]


def random_texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["Wort", "été", "ÉTÉ", "alpha", "Beta", "x", "—", "naïve", "日本", "q9"]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 2, 5, 40, 200]))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        w = r.choice(base).split(" ")
        w[r.randrange(len(w))] = r.choice(vocabulary)
        out.append(r.choice(["", " ", "\t"]) + " ".join(w) + r.choice(["", "\n"]))
    return out


def test_groups_match_brute_force(spark):
    texts = random_texts(1, 240) + [None, "", "  \n ", "A b", "a B", "a b"]
    ids = list(range(100, 100 + len(texts)))
    df = spark.createDataFrame([(i, t, "h", "s", 1) for i, t in zip(ids, texts)], DOCS)
    got = {r.doc_id: r for r in simhash_dedup.simhash_groups(df).collect()}
    fps = [fingerprint(t) for t in texts]
    linked = [
        (i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3
    ]
    want = roots(len(fps), linked)
    assert len(got) == len(texts)
    for i, doc in enumerate(ids):
        assert got[doc].fingerprint == f"{fps[i]:016x}", texts[i]
        assert got[doc].component_id == ids[want[i]]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    r = random.Random(radius)
    masks = simhash_dedup.covering_masks(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(500):
        differing = sum(1 << b for b in r.sample(range(64), radius))
        assert any(not m & differing for m in masks)
    inner = simhash_dedup.covering_masks([3, 9, 17, 40, 41, 60], radius)
    for _ in range(100):
        differing = sum(1 << b for b in r.sample([3, 9, 17, 40, 41, 60], radius))
        assert any(not m & differing for m in inner)


def test_large_buckets_are_split_without_loss(spark):
    """More distinct fingerprints around one centre than a bucket may compare."""
    r = random.Random(7)
    around = {0} | {sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 5]))) for _ in range(900)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in around)
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    before = simhash_dedup.PAIRED
    simhash_dedup.PAIRED = 16
    try:
        got = {(x.a, x.b) for x in simhash_dedup._links(fps, 3).distinct().collect()}
    finally:
        simhash_dedup.PAIRED = before
    mask = (1 << 64) - 1
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & mask).bit_count() <= 3}
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rows = [(7, "one two three four", "a", "s", 1), (3, "one two three four", "b", "s", 2),
            (3, "one two three four", "b", "s", 2), (9, "something else entirely here", None, None, None),
            (None, "one two three four", "c", "s", 3), (None, "no id but a text", "c", "s", 3), (4, None, "x", "s", 0),
            (5, "", "x", "s", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"component_id": F.lit(1), "fp": F.lit("x"), "copies": F.lit(2)})
    kept = simhash_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "no id but a text"), (3, "one two three four"), (4, None), (9, "something else entirely here")
    ]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c d e f g", "l", "s", 1)], DOCS)
    assert simhash_dedup.simhash_groups(none).count() == 0
    assert simhash_dedup.keep_one(none).count() == 0
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.contaminated(one, items).count() == 0
    assert decontamination.decontaminated(one, items).count() == 1
    assert decontamination.decontaminated(none, items).count() == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 40)]
    edges += [tuple(r.sample(range(200, 300), 2)) for _ in range(60)] + [(5, 5)]
    df = spark.createDataFrame(edges + edges[:10], "a bigint, b bigint")
    got = {x.node: x.root for x in components(df).collect()}
    want = roots(300, edges)
    used = {n for e in edges for n in e if e[0] != e[1]}
    assert got == {n: want[n] for n in used}


def grams(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w


def jaccard(a, b):
    from collections import Counter

    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def best_windows(docs, items, k=5):
    out = {}
    for d, text in docs:
        w = grams(text)
        for i, item in items:
            v = grams(item)
            if not v:
                continue
            size = min(k, len(v))
            mine = [tuple(v[j : j + size]) for j in range(len(v) - size + 1)]
            for start in range(max(1, len(w) - len(v) + 1)):
                part = w[start : start + len(v)]
                theirs = [tuple(part[j : j + size]) for j in range(len(part) - size + 1)]
                s = jaccard(mine, theirs)
                if s >= 0.8 and s > out.get((d, i), (0, 0))[0] + 1e-12:
                    out[d, i] = (s, start)
    return out


def test_contamination_matches_brute_force(spark):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 6, 20, 36, 50, 60, 60])]
    items += [(90, None), (91, " "), (92, "la " * 12)]
    docs = []
    for d in range(80):
        w = [r.choice(vocabulary) for _ in range(r.choice([0, 4, 30, 150]))]
        item = r.choice(items)[1]
        if d % 3 == 0 and item:
            part = item.split()
            if d % 2 and len(part) > 40:
                part[r.randrange(len(part))] = "changed"
            if d % 5 == 0 and len(part) > 30:
                part = part[1:]
            at = r.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((d, " ".join(w).title() if d % 4 == 0 else "\n".join(w)))
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (502, "la " * 40)]
    df = spark.createDataFrame([(d, t, "l", "s", 1) for d, t in docs], DOCS).withColumn("similarity", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n", F.lit(3))
    got = {(x.doc_id, x.item_id): x for x in decontamination.contaminated(df, bench).collect()}
    want = best_windows(docs, items)
    assert set(got) == set(want) and len(want) > 15
    for key, (s, start) in want.items():
        assert got[key].similarity == pytest.approx(s, abs=1e-6) and got[key].start == start
    clean = decontamination.decontaminated(df, bench)
    assert clean.columns == df.columns
    bad = {d for d, _ in want}
    assert sorted(x.doc_id for x in clean.collect() if x.doc_id != 502) == sorted(d for d, _ in docs if d not in bad and d != 502)


def test_items_that_end_in_a_run_of_one_word(spark):
    items, docs = [], []
    for i in range(30):
        own = [f"w{i}x{j}" for j in range(168)]
        items.append((i, " ".join(own + ["la"] * 20)))
        docs.append((i, " ".join(own + [f"o{i}x{j}" for j in range(20)]), "l", "s", 1))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contaminated(spark.createDataFrame(docs, DOCS), bench).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == [(i, i) for i in range(30)]
    assert all(x.similarity == round(164 / 204, 6) for x in got)


def test_words_and_lower_case(spark):
    rows = [("  a\tb\x0bc\x0c\n",), ("\xa0x y",), (None,), ("ÀB İZ ⅣQ",), (" \r\n",)]
    got = spark.createDataFrame(rows, "t string").select(words(F.col("t")).alias("w"), lower_ascii(F.col("t")).alias("l")).collect()
    assert [list(x.w) for x in got] == [WORD.findall(t or "") for (t,) in rows]
    assert got[3].l == "Àb İz Ⅳq"


def test_filters_keep_columns_of_any_name(spark):
    text, item = "one two three four five six seven eight nine ten", "red orange yellow green blue indigo violet"
    rows = [(1, text, 5, 6, 7, 8), (2, text, 5, 6, 7, 8), (3, f"so {item} it goes", 1, 1, 1, 1), (3, f"so {item} it goes", 2, 0, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __id int, __hash int, __copies int, __text_hash int")
    kept = sorted(map(tuple, simhash_dedup.keep_one(docs).collect()))
    assert kept == [rows[0], min(rows[2:])]
    items = spark.createDataFrame([("a", item, 1)], "item_id string, text string, __id int")
    left = sorted(map(tuple, decontamination.decontaminated(docs, items).collect()))
    assert left == rows[:2]
    assert simhash_dedup.keep_one(docs.limit(0)).collect() == decontamination.decontaminated(docs.limit(0), items).collect() == []
