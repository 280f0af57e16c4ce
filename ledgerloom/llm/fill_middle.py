"""Fill-in-the-middle by displacement scatter.

Texts are handled as one run of UTF-8 bytes per batch. Cuts are positions in that run; each of them
moves the bytes that follow by one more amount, so that a difference array with one entry a cut holds
the whole rearrangement. Its cumulative sum is every byte's shift: a scatter by it builds the outputs,
and gathering by it brings the texts back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import private

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of the texts that are rearranged, and of these that put the suffix first.
RATE, SPM_RATE = 90, 20
#: Bytes of whole texts handled at once, and of one text's bytes that have their shifts in memory.
SLICE, BLOCK = 4 << 20, 1 << 20
_MARK = {m: np.frombuffer(m.encode(), np.uint8) for m in (PREFIX, SUFFIX, MIDDLE)}
_MARK_BYTES = len(PREFIX)

_RESULT = [
    ("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"),
    ("output", "string"), ("restored", "string"),
]


def group_numbers(id: Column) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``1:`` and the id (null: nothing after the
    colon), as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _contains(data: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Positions at which the mark starts."""
    if len(data) < len(mark):
        return np.empty(0, np.int64)
    hit = data[: len(data) - len(mark) + 1] == mark[0]
    for i in range(1, len(mark)):
        hit &= data[i : len(data) - len(mark) + 1 + i] == mark[i]
    return np.flatnonzero(hit)


def _token_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True for each byte that starts a token ``[A-Za-z]+|[^A-Za-z]`` of its text."""
    starts = np.empty(len(data), bool)
    last = False
    for low in range(0, len(data), BLOCK):
        part = data[low : low + BLOCK]
        lower = part | 0x20
        letter = (lower >= 97) & (lower <= 122) & (part < 128)
        inside = letter & np.append(last, letter[:-1])
        # The bytes of a code point after its first are 10xxxxxx.
        starts[low : low + BLOCK] = ((part & 0xC0) != 0x80) & ~inside
        last = letter[-1]
    first = at[:-1][np.diff(at) > 0]
    starts[first] = True
    return starts


def _ranks(mask: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """How many are set before each of the ascending positions."""
    ranks, total, done = np.zeros(len(upto), np.int64), 0, 0
    for low in range(0, len(mask) + 1, BLOCK):
        seen = np.append(0, np.cumsum(mask[low : low + BLOCK]))
        next_ = int(np.searchsorted(upto, low + BLOCK, "left"))
        ranks[done:next_] = total + seen[upto[done:next_] - low]
        total, done = total + int(seen[-1]), next_
    return ranks


def _selected(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The positions of the set ones with the given ascending numbers; the length beyond the last."""
    places, total, done = np.full(len(ranks), len(mask), np.int64), 0, 0
    for low in range(0, len(mask), BLOCK):
        here = np.flatnonzero(mask[low : low + BLOCK])
        next_ = int(np.searchsorted(ranks, total + len(here), "left"))
        places[done:next_] = low + here[ranks[done:next_] - total]
        total, done = total + len(here), next_
    return places


def _shifted(data: np.ndarray, out: np.ndarray, where: np.ndarray, step: np.ndarray, back: bool) -> np.ndarray:
    """Scatter ``data`` to ``out`` by the running sum of the steps, or gather it back from there.
    Shifts are held for a block of bytes at a time; a sum is carried from block to block."""
    back_to = np.empty(len(data), np.uint8) if back else data
    order = np.argsort(where, kind="stable")
    where, step = where[order], step[order]
    carried, done = 0, 0
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        difference = np.zeros(high - low, np.int64)
        upto = int(np.searchsorted(where, high, "left"))
        np.add.at(difference, where[done:upto] - low, step[done:upto])
        done = upto
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        target = shift + np.arange(low, high)
        if back:
            back_to[low:high] = out[target]
        else:
            out[target] = data[low:high]
    return back_to


def rearrange(data: np.ndarray, at: np.ndarray, h: np.ndarray, rate: int = RATE, spm_rate: int = SPM_RATE) -> dict:
    """All texts of a run of bytes: text i is ``data[at[i]:at[i + 1]]`` and h[i] holds its four numbers.

    Gives the token counts, forms, lengths in code points, the bytes of the outputs with their
    offsets, and the bytes of the texts as gathered back from these outputs."""
    size = np.diff(at)
    starts = _token_starts(data, at)
    bounds = _ranks(starts, at)
    n = np.diff(bounds)
    marked = np.zeros(len(size), bool)
    for mark in _MARK.values():
        found = _contains(data, mark)
        of = np.searchsorted(at, found, "right") - 1
        marked[of[found + _MARK_BYTES <= at[of + 1]]] = True
    plain = (size == 0) | marked | (h[:, 2] % 100 >= rate)
    spm = ~plain & (h[:, 3] % 100 < spm_rate)

    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # The byte at which token number t starts; the end of the text for t = n.
    cut = [np.where(cuts[:, i] == n, at[1:], _selected(starts, bounds[:-1] + cuts[:, i])) for i in range(2)]
    a, b = cut[0] - at[:-1], cut[1] - cut[0]
    c = size - a - b
    points = (data & 0xC0) != 0x80
    first, second = _ranks(points, cut[0]), _ranks(points, cut[1])
    prefix_chars, middle_chars = first - _ranks(points, at[:-1]), second - first

    grown = np.where(plain, 0, 3 * _MARK_BYTES)
    out_at = np.append(0, np.cumsum(size + grown))
    base = out_at[:-1] - at[:-1]
    moved = ~plain
    k = _MARK_BYTES
    # Shift of each part against its place in the run.
    to_prefix = base + np.where(spm, 2 * k + c, k) * moved
    to_middle = base + (3 * k + c) * moved
    to_suffix = base + np.where(spm, k - a - b, 2 * k - b) * moved
    # Steps at the three starts of each text; empty parts add up at one place.
    before = np.append(0, to_suffix[:-1])
    where = np.concatenate([at[:-1], cut[0], cut[1]])
    step = np.concatenate([to_prefix - before, to_middle - to_prefix, to_suffix - to_middle])
    held = where < len(data)
    out = np.empty(int(out_at[-1]), np.uint8)
    _shifted(data, out, where[held], step[held], False)
    o = out_at[:-1]
    for mark, place in (
        (PREFIX, np.where(spm, k + c, 0)),
        (SUFFIX, np.where(spm, 0, k + a)),
        (MIDDLE, np.where(spm, 2 * k + c + a, 2 * k + a + c)),
    ):
        spot = (o + place)[moved]
        for i in range(k):
            out[spot + i] = _MARK[mark][i]
    restored = _shifted(data, out, where[held], step[held], True)
    return {
        "n": n, "plain": plain, "spm": spm, "prefix_chars": prefix_chars, "middle_chars": middle_chars,
        "output": out, "output_at": out_at, "restored": restored,
    }


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about SLICE bytes; a longer text is a range of its own."""
    low, held = 0, 0
    for i, size in enumerate(sizes):
        if i > low and held + size > SLICE:
            yield low, i
            low, held = i, 0
        held += int(size)
    if len(sizes) > low:
        yield low, len(sizes)


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def _digests(data: np.ndarray, at: np.ndarray) -> list[str]:
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[at[i] : at[i + 1]]).hexdigest() for i in range(len(at) - 1)]


def _worker(text_at: int, number_at: int, rate: int, spm_rate: int, digests: bool, schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_at).cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            body = text.buffers()[2]
            body = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
            h = np.stack([batch.column(number_at + i).to_numpy(zero_copy_only=False) for i in range(4)], 1)
            for low, high in _slices(np.diff(offsets)):
                at = offsets[low : high + 1] - offsets[low]
                data = body[offsets[low] : offsets[high]]
                r = rearrange(data, at, h[low:high].astype(np.int64), rate, spm_rate)
                form = np.where(r["plain"], PLAIN, np.where(r["spm"], SPM, PSM))
                made = [
                    pa.array(r["n"], pa.int64()),
                    pa.array(form.tolist(), pa.string()),
                    pa.array(r["prefix_chars"], pa.int64(), mask=r["plain"]),
                    pa.array(r["middle_chars"], pa.int64(), mask=r["plain"]),
                ]
                if digests:
                    made.append(pa.array(_digests(r["output"], r["output_at"]), pa.string()))
                    made.append(pa.array(_digests(r["restored"], at), pa.string()))
                else:
                    made.append(_strings(r["output"], r["output_at"]).cast(pa.string()))
                    made.append(_strings(r["restored"], at).cast(pa.string()))
                kept = [batch.column(i).slice(low, high - low) for i in range(text_at)]
                yield pa.RecordBatch.from_arrays(kept + made, schema=schema)

    return work


def fill_in_middle(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    digests: bool = False,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, restored), one row per row of ``docs``.

    A text is cut between two of its n tokens ``[A-Za-z]+|[^A-Za-z]`` into prefix, middle and suffix
    and put out as ``plain`` (unchanged), ``psm`` or ``spm``, all by numbers drawn from the id alone:
    reruns agree. ``restored`` is the text as gathered back from ``output``. With ``digests`` both are
    replaced by the lowercase hex SHA-256 of their UTF-8 bytes (output_sha256, restored_sha256).

    Null and empty texts are empty and plain; texts that hold a mark are plain; a null id draws from an
    empty one. Rows with one id share their numbers, repeated rows give equal rows, an empty table an
    empty one. Further columns are left out, whatever their names. A text of any length is one row;
    a task holds a text, its output and the shifts of a block of bytes.
    """
    names = {c: private(c) for c in ("id", "text", "h0", "h1", "h2", "h3")}
    numbers = group_numbers(F.col(id))
    rows = docs.select(
        F.col(id).alias(names["id"]),
        F.col(text).alias(names["text"]),
        *[h.alias(names[f"h{i}"]) for i, h in enumerate(numbers)],
    )
    made = [(c + "_sha256" if digests and c in ("output", "restored") else c, t) for c, t in _RESULT]
    kind = docs.schema[id].dataType
    fields = [T.StructField(id, kind)] + [
        T.StructField(c, T.LongType() if t == "long" else T.StringType()) for c, t in made
    ]
    schema = T.StructType(fields)
    return rows.mapInArrow(_worker(1, 2, rate, spm_rate, digests, to_arrow_schema(schema)), schema)
