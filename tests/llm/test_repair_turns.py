"""Conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

from ledgerloom.llm import conversation_repair as cr

INITIALS = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
DUE = {"u": "user", "a": "assistant"}


def cheapest(turns):
    """All edit sequences in order of (cost, audit): the first that is accepted. Turns are (role, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, out = heappop(heap)
        if i == len(turns) and INITIALS.fullmatch(initials):
            return cost, audit, out
        if (i, initials) in seen or len(initials) > 2 * len(turns) + 4:
            continue
        seen.add((i, initials))
        for x in "ua":
            heappush(heap, (cost + 5, audit + "I", i, initials + x, (*out, f"{DUE[x]}:")))
        if i < len(turns):
            role, text, fault = turns[i]
            heappush(heap, (cost + 2, audit + "D", i + 1, initials, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                heappush(heap, (cost + more, audit + "K", i + 1, initials + role[:1], (*out, f"{role}:{text}")))
                for x in "ua":
                    heappush(heap, (cost + 1 + more, audit + "R", i + 1, initials + x, (*out, f"{DUE[x]}:{text}")))


def brute(rows):
    """The contract, conversation by conversation."""
    made = {}
    for conv, turn, role, text in rows:
        turns = made.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        b = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if b == 0:
            continue
        text = "" if b == 1 else re.sub("[.!?]", "", text) if b == 2 else text
        turns.extend([(turn is not None, turn, "user" if b == 4 else role, text)] * (2 if b == 3 else 1))
    out = {}
    for conv, turns in made.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2].encode(), t[3].encode()))
        seen, marked = set(), []
        for _, _, role, text in turns:
            said = WORD.findall(text)
            fault = (
                "blank" if not said
                else "duplicate" if (role, text) in seen
                else "truncated" if said[-1] not in ".!?"
                else None
            )
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [t[1] for t in turns if t[0]]
        cost, audit, texts = cheapest(marked)
        faults = [f for _, _, f in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(texts).encode()).hexdigest(),
        )
    return out


def repaired(df):
    rows = cr.repair(cr.damaged(df), df).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def random_rows(seed, n):
    r, rows = random.Random(seed), []
    for conv in [None, *range(n)]:
        for _ in range(r.choice([1, 1, 2, 4, 7])):
            rows.append((
                conv, r.choice([None, *range(6)]),
                r.choice(["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]),
                r.choice(["Yes.", "No?", "cut", "", " \n", None, "Ünd so weiter!", "é", ". \t", "one. two"]),
            ))
    return rows


def test_repair_matches_brute_force(spark):
    rows = random_rows(1, 260)
    assert repaired(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_conversation_that_the_damage_removes(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(conv, 0, "user", "x.")], SCHEMA))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.repair(cr.damaged(none), none).collect() == []
    rows = random_rows(5, 20)
    wide = spark.createDataFrame(
        [(*row, 1, "x", "y", 2) for row in rows], SCHEMA + ", copies int, fault string, conv string, ord int"
    )
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair(cr.damaged(wide), wide).collect()}
    assert got == brute(rows)


def test_repaired_turns_are_rows(spark):
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "user", "Hm"), (1, 3, "assistant", "Bye."), (2, 1, "user", " ")]
    turns = cr.marked(spark.createDataFrame(rows, SCHEMA))
    out = cr.repaired(turns, cr.plans(turns)).orderBy("conv", "place").collect()
    assert [tuple(r) for r in out] == [(1, 1, "R", "user", "Hello."), (1, 2, "K", "assistant", "Bye.")]


def test_search_in_one_long_conversation():
    r = random.Random(3)
    codes = bytes(cr.code(r.choice("sua"), r.choice([0, 0, 0, 1, 2])) for _ in range(50_000))
    cost, audit = cr.cheapest(codes)
    assert len(audit.replace("I", "")) == len(codes)
    assert cr.cheapest(bytes([cr.code("user", cr.SOUND)]) * 50_000) == (25_000, "KR" * 25_000)
    assert cr.cheapest(b"") == (0, "")


def test_a_very_long_text_and_many_copies(spark):
    long = "word " * 400_000 + "end."
    rows = [(1, 1, "user", long), (1, 2, "assistant", long)] + [(1, 3, "user", "Again.")] * 300
    df = spark.createDataFrame(rows, SCHEMA)
    (got,) = cr.repair(df, df).collect()
    assert (got.duplicate, got.cost, got.audit) == (299, 600, "KK" + "D" * 300)
    kept = f"user:{long}\nassistant:{long}"
    assert got.repaired_sha256 == hashlib.sha256(kept.encode()).hexdigest()
