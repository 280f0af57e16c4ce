"""Mixing, chat formatting, archives and URL filters."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, mixing, url_filters, warc

DOCS = "doc_id bigint, text string, source string"
PAGES = "page_id bigint, url string, html string"


def fill(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by sharing again and again what is above a cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, still = share * sum(sizes.values()), {}, list(names)
    while still:
        level = left / sum(weight[s] for s in still)
        full = [s for s in still if level * weight[s] > cap * sizes[s]]
        if not full:
            return target | {s: level * weight[s] for s in still}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
            still.remove(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_sharing(spark, seed):
    r = random.Random(seed)
    sizes = {s: r.choice([0, 3, 50, 1000, 20000]) for s in ["a", "B", "é", "src10", "src2", None][: seed + 3]}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {x.source: x.target for x in mixing.source_targets(df).collect()}
    want = fill(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s])
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" * r.randrange(0, 30)), f"s{i % 5}" if i % 9 else None) for i in range(4000)]
    rows += [(4000, None, "s1"), (None, "a b", "s1"), (7, "a b c", "s2")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit("x"), "target": F.lit(0), "copies": F.lit(1)})
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(rows)
    taken = {}
    for x in plan:
        assert 0 <= x.taken <= 2 * x.size
        key = (x.source_size, x.target)
        taken[key] = taken.get(key, 0) + x.taken
    for (_, target), got in taken.items():
        assert abs(got - target) < 0.08 * target
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(x.copies for x in plan)
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.mix_plan(df.limit(0)).count() == 0
    assert [tuple(x) for x in sorted(mixing.mix_plan(df).collect(), key=str)] == [tuple(x) for x in sorted(plan, key=str)]


EVENTS = "conv_id bigint, slot bigint, seq bigint, kind string, role string, text string"


def folded(spark, rows):
    out = chat.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv", "slot").collect()
    return [(x.conv, x.slot, x.role, x.text) for x in out]


def test_fold_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "hello"),
        (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "Hi "), (1, 1, 3, "delta", None, "there"),
        (1, 0, 4, "edit", None, "hello!"),
        (1, 2, 5, "message", "user", "more"), (1, 3, 6, "delta", "assistant", "gone"),
        (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "Good day"),
        (2, 0, 0, None, None, None),
    ]
    assert folded(spark, rows) == [(1, 0, "user", "hello!"), (1, 1, "assistant", "Good day"), (2, 0, "", "")]
    assert folded(spark, list(reversed(rows))) == folded(spark, rows)
    assert folded(spark, []) == []


def test_rendering_is_read_back(spark):
    texts = ["", "\\", "<|", "<\\|", "<|im_end|>\n<|im_start|>assistant\nx", "a\\|b<", "|x|>", "é\n\n日本", "<<|\\\\|", None]
    roles = ["user", "assistant", "sys\ntem", "<|im_end|>", "\\", None, "assistant", "assistant", "user", "assistant"]
    rows = [(1, i, i, "message", r, t) for i, (r, t) in enumerate(zip(roles, texts))]
    back = chat.read_back(chat.render(chat.fold(spark.createDataFrame(rows, EVENTS)))).collect()[0]
    assert [(t.role, t.text) for t in back.turns] == [(r or "", t or "") for r, t in zip(roles, texts)]
    assert list(back.learned) == [t or "" for r, t in zip(roles, texts) if r == "assistant"]
    whole = chat.render(chat.fold(spark.createDataFrame(rows, EVENTS))).collect()[0]
    for span in whole.loss:
        assert whole.formatted[span.start : span.start + span.length] == whole.formatted.split("<|im_end|>\n")[span.turn - 1][span.offset :]


def test_conversation_rows_of_one_turn_all_count(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "first"), (None, 2, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("slot", F.lit(9))
    back = {x.conv: [t.text for t in x.turns] for x in chat.read_back(chat.render(chat.fold(chat.conversation_events(df)))).collect()}
    assert back == {1: ["first", "a", "a", "b"], None: [""]}


def test_archive_round_trip(spark, tmp_path):
    long, short = "<p>" + "é" * 80, "short"
    rows = [(5, "http://x/\n1", long), (3, "http://x/2", long), (9, None, long), (None, "u", long), (3, "again", long),
            (1, "u", short), (2, "u", short), (4, "u", None), (6, "u", ""), (7, "u", "y" * 100000)]
    df = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit("x"), "payload": F.lit(1)})
    warc.write_archive(df, str(tmp_path / "a"))
    got = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    assert sorted((x.id or 0, x.record_type, x.refers_to or "") for x in got) == sorted(
        [(5, "revisit", "3"), (3, "response", ""), (9, "revisit", "3"), (0, "revisit", "3"), (3, "response", "")]
        + [(i, "response", "") for i in (1, 2, 4, 6, 7)]
    )
    assert sorted(bytes(x.payload) for x in got) == sorted((h or "").encode() for _, _, h in rows)
    for x in got:
        head, body = bytes(x.record).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + x.record_type.encode())
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert int(fields[b"Content-Length"]) == len(body) - 4 and body.endswith(b"\r\n\r\n")
        assert fields[b"WARC-Payload-Digest"].decode() == "sha256:" + x.payload_digest
        if x.record_type == "response":
            assert body[:-4] == bytes(x.payload)
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 4
    warc.write_archive(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_a_damaged_payload_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 200)], PAGES)
    warc.write_archive(df, str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b" / "payloads"))
    rows = stored.withColumn("payload", F.lit(b"other")).collect()
    spark.createDataFrame(rows, stored.schema).write.mode("overwrite").parquet(str(tmp_path / "c" / "payloads"))
    spark.read.parquet(str(tmp_path / "b" / "headers")).write.parquet(str(tmp_path / "c" / "headers"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, str(tmp_path / "c")).select("payload_digest").collect()


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


def test_urls_match_brute_force(spark):
    r = random.Random(2)
    labels = ["net", "example", "org", "a", "b", "net2", "x-y", "ne"]
    hosts = [".".join(r.choice(labels) for _ in range(r.choice([1, 2, 3, 4]))) for _ in range(200)]
    paths = ["", "/", "/en/", "/en", "/en/x", "/de/y", "/EN/"]
    rules = list(url_filters.RULES) + [
        (r.choice(["allow", "block"]), ".".join(r.choice(labels) for _ in range(r.choice([1, 2, 3]))), r.choice(["/", "/en/", "/de/"]))
        for _ in range(40)
    ]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = [f"https://{h}{p}{t}" for h in hosts for p in r.sample(paths, 3) for t in [r.choice(["", "?q=1", "#f"])]]
    urls += [None, "", "no scheme", "http://", "http://EXAMPLE.net/en/", "http://net", "http://net.", "x://a://b/c", "http://.net/", "http://é.net/ü"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns(
        {"host": F.lit(1), "rules": F.lit(1), "verdict": F.lit("q")}
    )
    df = df.union(df.limit(3))
    got = url_filters.judge_urls(df, url_filters.rule_table(spark, rules)).collect()
    assert len(got) == len(urls) + 3
    for x in got:
        assert (x.host, x.path, x.rule, x.verdict) == judge(urls[x.page_id], rules), urls[x.page_id]
    assert url_filters.judge_urls(df.limit(0), url_filters.rule_table(spark)).count() == 0
    assert {x.verdict for x in url_filters.judge_urls(df, url_filters.rule_table(spark, [])).collect()} == {"allow"}
