"""Conversation structure repair by iterative-deepening A*.

A conversation is a row of turns whose role initials should read ``(s?(ua)+)?``. Four edits make it so:
``D`` deletes a turn, ``I`` inserts an empty one, ``K`` keeps one, ``R`` gives one the role that is due.
The search goes depth first, in ASCII order of the edits, under a cost bound that grows until a path is
accepted. That path is the cheapest, and of the cheapest the one whose edits come first in ASCII order,
as no smaller bound had any. What failed is remembered with the budget it failed on.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import SPACES, WORD, private, staged

#: Cost of an edit, and what a truncated turn that stays costs on top.
COSTS = {"D": 2, "I": 5, "K": 0, "R": 1}
TRUNCATED = 5
SOUND, HELD, CUT = 0, 1, 2  # a turn without fault; blank or duplicate; truncated

# What has been read of s?(ua)+: nothing, the s, up to a u, up to an a. Only the first and last may end.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_DUE = ("user", "user", "assistant", "user")
_DUE_NEXT = (2, 2, 3, 2)
_MAY_END = (True, False, False, True)
_FAR = 1 << 60
_INITIALS = "sua"
_OTHER, _NONE = 3, 4
_PAIRS = {"su", "ua", "au"}


def code(role: str, fault: int) -> int:
    """A turn as the search sees it, in one byte: the role's initial and the fault."""
    at = _INITIALS.find(role[:1]) if role else _NONE
    return (at if at >= 0 else _OTHER) * 3 + fault


def _steps() -> list[list[list[tuple[int, int, int]]]]:
    """For each code and state the edits that consume the turn, as (edit, cost, next state)."""
    made = []
    for initial in (*_INITIALS, "?", ""):
        for fault in (SOUND, HELD, CUT):
            per_state = []
            for state in range(4):
                steps = [(ord("D"), COSTS["D"], state)]
                more = TRUNCATED if fault == CUT else 0
                # A role without a first character adds nothing to the initials.
                kept = state if not initial else _NEXT.get((state, initial))
                if fault != HELD and kept is not None:
                    steps.append((ord("K"), COSTS["K"] + more, kept))
                if fault != HELD:
                    steps.append((ord("R"), COSTS["R"] + more, _DUE_NEXT[state]))
                per_state.append(steps)
            made.append(per_state)
    return made


_STEPS = _steps()
_INSERT = COSTS["I"]


def remaining(codes: bytes) -> array:
    """For each place and state a lower bound of what is still to pay: the cost of the rest if it might
    end in any state. Four numbers a turn."""
    n = len(codes)
    least = array("q", [0]) * (4 * (n + 1))
    for i in range(n - 1, -1, -1):
        per_state, after = _STEPS[codes[i]], 4 * (i + 1)
        for state in range(4):
            least[4 * i + state] = min(cost + least[after + to] for _, cost, to in per_state[state])
        for _ in range(3):  # a chain of inserts is at most three long before a state comes again
            for state in range(4):
                least[4 * i + state] = min(least[4 * i + state], _INSERT + least[4 * i + _DUE_NEXT[state]])
    return least


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, the ASCII-least of them. A turn takes some 80 bytes."""
    n, least = len(codes), remaining(codes)
    failed = array("q", [-1]) * (4 * (n + 1))
    bound = least[0]
    while True:
        found = _within(codes, n, least, failed, bound)
        if found is not None:
            return bound, found
        bound += 1


def _within(codes: bytes, n: int, least: array, failed: array, bound: int) -> str | None:
    """The first accepting path that costs no more than the bound, or None. ``failed`` keeps, over all
    bounds, the largest budget with which a place and state are known to lead nowhere."""
    edits = bytearray()
    nodes, budgets, tried = [0], array("q", [bound]), bytearray([0])
    if least[0] > bound:
        return None
    while nodes:
        node, budget, k = nodes[-1], budgets[-1], tried[-1]
        i, state = node >> 2, node & 3
        if k == 0 and i == n and _MAY_END[state]:
            return edits.decode("ascii")
        steps = _STEPS[codes[i]][state] if i < n else ()
        # ASCII order: delete (0), insert (1), then keep and rerole.
        if k == 1:
            step = (ord("I"), _INSERT, _DUE_NEXT[state])
            to = node - state + step[2]
        else:
            at = 0 if k == 0 else k - 1
            if at >= len(steps):
                if k == 0:
                    tried[-1] = 1
                    continue
                failed[node] = max(failed[node], budget)
                nodes.pop(), budgets.pop(), tried.pop()
                if edits:
                    edits.pop()
                continue
            step = steps[at]
            to = 4 * (i + 1) + step[2]
        tried[-1] = k + 1
        left = budget - step[1]
        if left < least[to] or left <= failed[to]:
            continue
        nodes.append(to), budgets.append(left), tried.append(0)
        edits.append(step[0])
    return None


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows after a fixed damage, told by crc32(``conv:turn``) % 20: 0 drops a row, 1 empties its
    text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user. Nulls in role and text, and in
    the hashed text, are one space."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    b = private("b")
    rows = rows.select(
        conv, turn, F.coalesce(role, F.lit(" ")).alias(role), F.coalesce(text, F.lit(" ")).alias(text),
        (F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20).alias(b),
    ).where(F.col(b) != 0)
    said = F.when(F.col(b) == 1, "").when(F.col(b) == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.when(F.col(b) == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        conv, turn, F.when(F.col(b) == 4, "user").otherwise(F.col(role)).alias(role), said.alias(text),
        F.explode(copies).alias(b),
    ).drop(b)


def marked(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, fault) with each turn's first fault: blank, duplicate, truncated or null.

    Rows equal in all four columns become one with a count before anything is compared, so a turn that
    is repeated any number of times is one row of the window."""
    bare = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    folded = bare.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    same = Window.partitionBy("conv", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    first = folded.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).withColumn(
        "again", F.row_number().over(same) > 1
    )
    each = first.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    last = F.right(F.btrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    fault = (
        F.when(~F.regexp_like("text", F.lit(WORD)), "blank")
        .when(F.col("again") | (F.col("copy") > 1), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    return each.select("conv", "turn", "role", "text", fault.alias("fault"))


_FAULTS = {None: SOUND, "blank": HELD, "duplicate": HELD, "truncated": CUT}
_COUNTED = ("blank", "duplicate", "truncated")
_PLAN = [("gaps", "long"), *[(c, "long") for c in _COUNTED], ("illegal", "long"), ("cost", "long"), ("audit", "string")]


class _Reading:
    """Counts and codes of one conversation whose turns come in order; one byte a turn is kept."""

    def __init__(self, conv):
        self.conv, self.codes, self.counts = conv, bytearray(), dict.fromkeys(_COUNTED, 0)
        self.first = self.last = self.role = None
        self.distinct = self.illegal = 0

    def add(self, turn, role, fault) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if self.codes and self.role + role[:1] not in _PAIRS:
            self.illegal += 1
        if fault:
            self.counts[fault] += 1
        self.role = role[:1]
        self.codes.append(code(role, _FAULTS[fault]))

    def plan(self) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        cost, audit = cheapest(bytes(self.codes))
        return (self.conv, gaps, *[self.counts[c] for c in _COUNTED], self.illegal, cost, audit)


def _batches(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _plan_turns(schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, done = None, []
        for batch in batches:
            for conv, turn, role, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if reading is None or conv != reading.conv:
                    if reading is not None:
                        done.append(reading.plan())
                    reading = _Reading(conv)
                reading.add(turn, role, fault)
            yield _batches(done, schema)
            done = []
        if reading is not None:
            yield _batches([reading.plan()], schema)

    return work


class _Writing:
    """Follows the audit of one conversation while its turns come by."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.state, self.place = conv, audit, 0, 0, 0

    def _put(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        self.state = _NEXT[self.state, role[0]] if role else self.state
        return self.conv, self.place, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put("I", _DUE[self.state], "")

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(edit, _DUE[self.state] if edit == "R" else role, text)


def _write_turns(schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writing = None
        for batch in batches:
            out = []
            for conv, audit, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if audit is not None:  # the plan goes before the turns
                    if writing is not None:
                        out.extend(writing.inserted())
                    writing = _Writing(conv, audit)
                else:
                    out.extend(writing.turn(role, text))
            yield _batches(out, schema)
        if writing is not None:
            yield _batches(list(writing.inserted()), schema)

    return work


def _schema(kind: T.DataType, fields: list[tuple[str, str]]) -> T.StructType:
    types = {"long": T.LongType(), "string": T.StringType()}
    return T.StructType([T.StructField("conv", kind), *[T.StructField(n, types[t]) for n, t in fields]])


def plans(turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of marked turns, one row per
    conversation that has any.

    Turns are read in order of turn (nulls first), role and text. A conversation is read by one task,
    sorted by Spark and streamed: the task holds some 80 bytes a turn, no texts. Empty tables give none."""
    schema = _schema(turns.schema["conv"].dataType, _PLAN)
    ordered = turns.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv", "turn", "role", "fault").mapInArrow(_plan_turns(to_arrow_schema(schema)), schema)


def repaired(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the conversations after their audits, turn by turn from place 1.
    The rows of a conversation lie in one partition, in order; turns are streamed past their audit."""
    fields = [("place", "long"), ("edit", "string"), ("role", "string"), ("text", "string")]
    schema = _schema(turns.schema["conv"].dataType, fields)
    none = F.lit(None).cast("string")
    rows = turns.select("conv", F.lit(1).alias("ord"), "turn", none.alias("audit"), "role", "text").unionByName(
        planned.select(
            "conv", F.lit(0).alias("ord"), F.lit(None).cast("long").alias("turn"), "audit",
            none.alias("role"), none.alias("text"),
        )
    )
    ordered = rows.repartition("conv").sortWithinPartitions(
        "conv", "ord", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.select("conv", "audit", "role", "text").mapInArrow(_write_turns(to_arrow_schema(schema)), schema)


def _digest_turns(schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            done = []
            for of, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if place == 1:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = of, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _batches(done, schema)
        if digest is not None:
            yield _batches([(conv, digest.hexdigest())], schema)

    return work


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) over ``role:text`` of all turns joined by line ends; straight after ``repaired``,
    whose order it relies on. Text by text: nothing is gathered."""
    schema = _schema(turns.schema["conv"].dataType, [("sha256", "string")])
    narrow = turns.select("conv", "place", "role", "text")
    return narrow.mapInArrow(_digest_turns(to_arrow_schema(schema)), schema)


def repair(
    rows: DataFrame, ids: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row per id
    of ``ids`` (null counts as one), also of conversations without a row: zeros, an empty audit and the
    digest of nothing.

    gaps: turn numbers missing between the least and the greatest, null turns ignored. Faults are counted
    by each turn's first. illegal: neighbouring initials other than su, ua, au. Null roles and texts are
    one space; a null turn comes first; rows equal in all columns are copies of one turn, all but one
    duplicates; other ties go by role and text. A role without characters has no initial. Other columns
    are ignored, whatever their names. Texts of any length are streamed. An empty table gives an empty one.
    """
    turns = staged(marked(rows, conv, turn, role, text), "turns")
    planned = staged(plans(turns), "plans")
    digest = digests(repaired(turns, planned)).withColumnRenamed("conv", "digested")
    known = planned.join(digest, F.col("conv").eqNullSafe(F.col("digested")), "left").drop("digested")
    every = ids.select(F.col(conv).alias("id")).distinct()
    joined = every.join(known, F.col("id").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c, t in _PLAN if t == "long"]
    return joined.select(
        F.col("id").alias(conv), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
