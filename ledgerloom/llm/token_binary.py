"""Token ids in binary shards, grammar-compressed for random access.

A shard is one row of the files: its documents' ids and token counts, the Re-Pair symbols of all their
tokens, the rules, and the length every rule expands to. Shards are in order of document id; a document
is never cut.
"""

from __future__ import annotations

import ctypes
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import repair
from .common import staged

#: Ids after which a shard ends with the document at hand. Compressing a shard takes some 50 bytes an id.
SHARD_IDS = 1 << 19
#: A worker remembers the ids of this many parts and then of half as many that occur twice in a slice;
#: after that the memory starts anew.
REMEMBERED = 200_000
#: Bytes of text encoded at a time; a longer text is encoded by itself.
SLICE = 1 << 20
END_ID = 2
#: Rows of the Arrow batches that are encoded and decoded.
TEXTS_A_BATCH, SHARDS_A_BATCH = 1000, 1
FILE = (
    "range int, shard int, n_docs int, n_tokens bigint, base int, doc_ids array<bigint>, "
    "doc_tokens array<int>, n_symbols int, n_rules int, symbol_bits int, length_bits int, "
    "symbols binary, rules binary, lengths binary"
)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level pre-tokenizers put for each byte: printing ones stand for themselves, the
    others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Kinds of bytes. Solid ones belong to characters other than white space that may be letters, digits or signs;
#: of unknown ones not even that much is said.
_SPACE, _WHITE, _LETTER, _DIGIT, _SIGN, _QUOTE, _SOLID, _UNKNOWN = range(8)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _UNKNOWN, np.uint8)
    kinds[33:127] = _SIGN
    for chars, kind in ((b" ", _SPACE), (b"\t\n\r", _WHITE), (b"0123456789", _DIGIT), (b"'", _QUOTE)):
        kinds[list(chars)] = kind
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[128:] = _SOLID
    kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = _UNKNOWN  # white space may begin so
    return kinds


def _cuts() -> np.ndarray:
    """Where the pre-tokenizer always cuts between two bytes, by 8 * kind + kind. It looks ahead in white space
    only, and puts a single space, and a quote sign that may open a contraction, to what follows."""
    cuts = np.zeros((8, 8), bool)
    solid = [_LETTER, _DIGIT, _SIGN, _QUOTE, _SOLID]
    cuts[np.ix_(solid, [_SPACE, _WHITE])] = True
    cuts[_WHITE, solid] = True
    cuts[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = True
    cuts[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    cuts[_SIGN, [_LETTER, _DIGIT]] = True
    return cuts.ravel()


def _white_ends() -> np.ndarray:
    """The last two bytes, as 256 * byte + byte, of white space characters beyond ASCII."""
    ends = np.zeros(1 << 16, bool)
    for char in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))):
        ends[int.from_bytes(char.encode()[-2:])] = True
    return ends


_KINDS, _CUTS, _WHITE_ENDS = _byte_kinds(), _cuts(), _white_ends()


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8 texts; À to ÿ are letters too, but for the signs × and ÷."""
    kinds = _KINDS.take(data, mode="wrap")
    high = np.flatnonzero(data >= 128)
    if len(high):
        pair = data[high - 1].astype(np.int32) << 8 | data[high]
        kinds[high[_WHITE_ENDS[pair]]] = _UNKNOWN
        latin = high[(pair >> 8 == 0xC3) & (pair != 0xC397) & (pair != 0xC3B7)]
        kinds[latin] = kinds[latin - 1] = _LETTER
    return kinds


def _bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of the texts begin, and the end. ``data`` holds the texts end to end, at ``offsets``."""
    kinds = _kinds(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _CUTS.take(kinds[:-1] << 3 | kinds[1:], mode="wrap")
    white = kinds <= _WHITE
    run = np.flatnonzero(white[:-1] & white[1:]) + 1
    if len(run):
        # Of several white spaces before something else the last is cut off; at the end of a text they stay together.
        run = run[run < len(data) - 1]
        follows = kinds[run + 1]
        cut[run[(follows > _WHITE) & (follows < _UNKNOWN)]] = True
        last = offsets[1:][offsets[1:] > 1] - 1
        cut[last[white[last] & white[last - 1]]] = False
    cut[offsets] = True
    return np.flatnonzero(cut).astype(np.int32)


#: Bytes of a part that fit into the two numbers by which it is remembered.
_SHORT = 16
_MASKS = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(_SHORT + 1)], np.uint64)


def _numbers(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's first and last eight bytes as numbers; longer parts and those with a zero byte get zeros."""
    padded = np.zeros(len(data) + _SHORT, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
    begins, size = bounds[:-1], np.diff(bounds)
    short = size <= _SHORT
    if not data.all():
        short &= np.add.reduceat(data == 0, begins, dtype=np.int32) == 0
    size = np.where(short, size, 0)
    low, high = eights[begins] & _MASKS[size], np.zeros(len(size), np.uint64)
    more = np.flatnonzero(size > 8)
    high[more] = eights[begins[more] + 8] & _MASKS[size[more] - 8]
    return low, high


class _Parts:
    """Remembered parts and their places in a table of ids: short ones by their two numbers, in the first free
    row from where a hash points to; others by their bytes. ``low`` is 0 for none but long parts."""

    BITS = max(1, (2 * REMEMBERED).bit_length())

    def __init__(self):
        self.rows = np.zeros((0, 4), np.uint64)
        self.short, self.long = 0, {}

    def __len__(self) -> int:
        return self.short + len(self.long)

    def _row(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The parts' places, -1 for those not found."""
        at = np.full(len(low), -1, np.int64)
        todo = np.flatnonzero(low) if len(self.rows) else at[:0]
        low, high = low.take(todo), high.take(todo)
        row = self._row(low, high)
        while len(todo):
            there = self.rows.take(row, axis=0)
            hit = (there[:, 0] == low) & (there[:, 1] == high)
            at[todo.compress(hit)] = there[:, 2].compress(hit)
            on = np.flatnonzero(~hit & (there[:, 0] != 0))
            todo, low, high, row = todo.take(on), low.take(on), high.take(on), (row.take(on) + 1) % len(self.rows)
        return at

    def add(self, low: np.ndarray, high: np.ndarray, places: np.ndarray) -> None:
        """Remember short parts, all different and none of them there yet."""
        if not len(self.rows):
            self.rows = np.zeros((1 << self.BITS, 4), np.uint64)
        self.short += len(low)
        new = np.stack([low, high, places.astype(np.uint64), np.zeros_like(low)], 1)
        row = self._row(low, high)
        while len(new):
            free = self.rows[row, 0] == 0
            self.rows[row[free]] = new[free]  # of several for one row the last stays
            on = np.flatnonzero((self.rows[row, :2] != new[:, :2]).any(1))
            new, row = new[on], (row[on] + 1) % len(self.rows)


class Encoder:
    """Texts to ids, the library's own for every text.

    Texts are cut where the tokenizer's pre-tokenizer cuts whatever stands further on, and every distinct part is
    encoded once by the library. Texts with a string that the tokenizer treats as special are given to it whole.
    Parts seen at least twice are remembered for the worker's later texts, rarer ones while there is room.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        # The tokenizer's model sees bytes as letters; none of them is a line end.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = CharDelimiterSplit("\n")
        letters = _byte_letters() | {0xFF: "\n"}
        self.letters = np.array([ord(letters[b]) for b in range(256)], "<u4")
        self.lengths = np.zeros(self.base, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = _Parts()
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _pieces(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, end to end, and their sizes. Parts of letters, digits, signs or white space alone are
        one pre-token each and go to the library's model at once; others go through all of the tokenizer."""
        width = np.fromiter(map(len, new), np.int64, len(new))
        data = np.frombuffer(b"\xff".join([*new, b""]), np.uint8)
        ends = np.cumsum(width + 1) - 1
        other = _kinds(data) >= _QUOTE
        other[ends] = False
        other = np.add.reduceat(other, ends - width, dtype=np.int64) > 0 if len(new) else np.zeros(0, bool)
        text = self.letters.take(data.compress(np.repeat(~other, width + 1))).tobytes().decode("utf-32-le")
        flat = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        # Each id stands for so many bytes.
        seen, stops = np.cumsum(self.lengths[flat]), np.cumsum(width[~other])
        if len(stops) and (len(seen) == 0 or seen[-1] != stops[-1]):
            raise ValueError("the tokenizer's model leaves out bytes")
        sizes = np.zeros(len(new), np.int64)
        sizes[~other] = np.diff(np.searchsorted(seen, stops, "right"), prepend=0)
        rest = np.flatnonzero(other).tolist()
        return _put_in(flat, sizes, rest, self._encode([new[i].decode() for i in rest])), sizes

    def _places(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each part its place in a table of ids; the table is as long as needed."""
        if len(self.known) >= 1.5 * REMEMBERED:
            self._forget()
        low, high = _numbers(data, bounds)
        at = self.known.find(low, high)
        rest = np.flatnonzero(at < 0)
        self.table, self.table_bounds = self.flat, self.bounds
        if len(rest):
            parts = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            coded = parts.take(pa.array(rest)).dictionary_encode()
            index = coded.indices.to_numpy(zero_copy_only=False)
            one = np.zeros(len(coded.dictionary), np.int64)
            one[index] = rest  # one of its places in the texts
            often = np.bincount(index, minlength=len(one)) > 1
            names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
            at[rest] = self._new_places(names, low[one], high[one], often).take(index)
        return at

    def _new_places(self, names: list[bytes], low: np.ndarray, high: np.ndarray, often: np.ndarray) -> np.ndarray:
        long = low == 0
        at = np.full(len(names), -1, np.int64)
        for i in np.flatnonzero(long).tolist():
            at[i] = self.known.long.get(names[i], -1)
        new = np.flatnonzero(at < 0)
        if len(self.known) >= REMEMBERED:
            new = new[np.argsort(~often[new], kind="stable")]  # those to remember come first
            kept = int(often[new].sum())
        else:
            kept = len(new)
        kept = min(kept, int(1.5 * REMEMBERED) - len(self.known))
        flat, sizes = self._pieces([names[i] for i in new.tolist()])
        first = len(self.bounds) - 1
        at[new] = first + np.arange(len(new))
        keep = new[:kept]
        short = keep[~long[keep]]
        self.known.add(low[short], high[short], at[short])
        self.known.long.update((names[i], int(at[i])) for i in keep[long[keep]].tolist())
        self.table = np.concatenate([self.flat, flat])
        self.table_bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.flat, self.bounds = self.table[: self.table_bounds[first + kept]], self.table_bounds[: first + kept + 1]
        return at

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the number of each."""
        whole = np.zeros(len(texts), bool)
        if self.special:
            whole = pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._plain(texts)
        odd = np.flatnonzero(whole).tolist()
        sizes = np.zeros(len(texts), np.int64)
        flat, sizes[~whole] = self._plain(texts.filter(pa.array(~whole)))
        return _put_in(flat, sizes, odd, self._encode([texts[i].as_py() for i in odd])), sizes

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts.cast(pa.large_binary())
        if not pc.sum(pc.binary_length(texts)).as_py():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        bounds = _bounds(data, offsets)
        at = self._places(data, bounds)
        begin = self.table_bounds.take(at, mode="wrap").astype(np.int32)
        size = np.diff(self.table_bounds).astype(np.int32).take(at, mode="wrap")
        ends = np.cumsum(size, dtype=np.int64)
        where = np.repeat((begin - (ends - size)).astype(np.int32), size)
        where += np.arange(len(where), dtype=np.int32)
        ids = self.table.take(where, mode="wrap")
        self.table = self.table_bounds = None
        pa.default_memory_pool().release_unused()
        return ids, np.diff(np.concatenate([[0], ends])[np.searchsorted(bounds, offsets)])


def _put_in(flat: np.ndarray, sizes: np.ndarray, at: list[int], ids: list[list[int]]) -> np.ndarray:
    """``flat``, of rows of ``sizes``, with the ids of the rows ``at``, which were empty."""
    begins = np.cumsum(sizes) - sizes
    out, done = [], 0
    for i, own in zip(at, ids):
        out += [flat[done : begins[i]], np.array(own, np.int32)]
        done, sizes[i] = begins[i], len(own)
    return np.concatenate([*out, flat[done:]])


_encoders: dict[str, Encoder] = {}


def _keep_freed() -> None:
    """From now on freed memory of up to 64 MB is used again instead of being mapped anew for each array, where the
    C library can do that; ``_give_back`` still returns it."""
    option = getattr(ctypes.CDLL(None), "mallopt", None)
    if option is not None:
        option(_MMAP_THRESHOLD, 32 << 20)
        option(_TRIM_THRESHOLD, 64 << 20)


#: As in malloc.h.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that: workers stay between tasks, and
    what they keep for later counts against their executor."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _width(greatest: int) -> int:
    return max(1, int(greatest).bit_length())


def _packed(numbers: np.ndarray, bits: int) -> bytes:
    """Numbers of so many bits each, end to end, lowest bit first."""
    numbers = np.asarray(numbers).ravel()
    eights = np.zeros((-(-len(numbers) // 8), 8), np.uint64)  # eight numbers fill whole bytes
    eights.ravel()[: len(numbers)] = numbers
    out = np.zeros((len(eights), bits), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        lane = eights[:, k] << np.uint64(shift)
        for j in range(-(-(shift + bits) // 8)):
            out[:, byte + j] |= (lane >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()[: -(-len(numbers) * bits // 8)]


def _unpacked(data: bytes, n: int, bits: int) -> np.ndarray:
    eights = np.zeros((-(-n // 8), bits), np.uint8)
    eights.ravel()[: len(data)] = np.frombuffer(data, np.uint8)
    numbers = np.empty((len(eights), 8), np.int32)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        lane = np.zeros(len(eights), np.uint64)
        for j in range(-(-(shift + bits) // 8)):
            lane |= eights[:, byte + j].astype(np.uint64) << np.uint64(8 * j)
        numbers[:, k] = (lane >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return numbers.ravel()[:n]


def _shard(number: int, base: int, ids: list, sizes: np.ndarray, flat: np.ndarray) -> pa.RecordBatch:
    symbols, rules, lengths = repair.compress(flat, base)
    bits, length_bits = _width(base + len(rules) - 1), _width(lengths.max() if len(lengths) else 0)
    row = {
        "range": TaskContext.get().partitionId(),
        "shard": number,
        "n_docs": len(ids),
        "n_tokens": len(flat),
        "base": base,
        "doc_ids": ids,
        "doc_tokens": sizes,
        "n_symbols": len(symbols),
        "n_rules": len(rules),
        "symbol_bits": bits,
        "length_bits": length_bits,
        "symbols": _packed(symbols, bits),
        "rules": _packed(rules, bits),
        "lengths": _packed(lengths, length_bits),
    }
    return pa.RecordBatch.from_pylist([row], _SHARD_TYPE)


_SHARD_TYPE = pa.schema([
    ("range", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()),
    ("base", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())),
    ("n_symbols", pa.int32()), ("n_rules", pa.int32()), ("symbol_bits", pa.int32()), ("length_bits", pa.int32()),
    ("symbols", pa.binary()), ("rules", pa.binary()), ("lengths", pa.binary()),
])


def _with_end(flat: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(flat, np.cumsum(sizes), end_id), sizes + 1


def _encode_range(tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        _keep_freed()
        held: list[tuple] = []  # slices of (ids, sizes, flat) that no shard has yet
        number = 0

        def flush() -> pa.RecordBatch:
            parts = [sum((list(h[0]) for h in held), []), *(np.concatenate([h[i] for h in held]) for i in (1, 2))]
            held.clear()
            return _shard(number, encoder.base, *parts)

        for batch in batches:
            texts = batch.column(1)
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(batch):
                upto = (ends[start - 1] if start else 0) + SLICE
                stop = max(start + 1, int(np.searchsorted(ends, upto, "right")))
                flat, sizes = _with_end(*encoder(texts.slice(start, stop - start)), end_id)
                ids = batch.column(0).slice(start, stop - start).to_pylist()
                start = stop
                bounds = np.r_[0, np.cumsum(sizes)]
                a = 0
                while a < len(sizes):
                    room = shard_ids - sum(len(h[2]) for h in held)
                    b = int(np.searchsorted(bounds, bounds[a] + room, "left"))  # the first document that fills it
                    full, b = b < len(bounds), min(b, len(sizes))
                    held.append((ids[a:b], sizes[a:b], flat[bounds[a] : bounds[b]]))
                    a = b
                    if full:
                        yield flush()
                        number += 1
        if held:
            yield flush()
        # An idle worker holds no parts. A task of some 15 MB fills the memory of parts anew anyway.
        encoder._forget()
        _give_back()

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every text of ``docs`` (null: empty), each followed by ``end_id``, into shards at ``path``.

    Order is by id, nulls first, then by text; repeated rows are repeated. ``tokenizer`` is the path
    of a tokenizers file that every executor can read. Nothing but one shard and one slice of texts is
    held by a task. An empty table makes an empty file set."""
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Rows of one id stay in one range, where their texts order them; the bounds come from ids alone.
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "text"
    )
    with _rows_a_batch(docs.sparkSession, TEXTS_A_BATCH):
        ordered.mapInArrow(_encode_range(tokenizer, end_id, shard_ids), FILE).write.option(
            "compression", "zstd"
        ).parquet(path)


def _load(row: dict) -> tuple[np.ndarray, np.ndarray]:
    bits = row["symbol_bits"]
    return _unpacked(row["symbols"], row["n_symbols"], bits), _unpacked(row["rules"], 2 * row["n_rules"], bits).reshape(-1, 2)


def read_document(shard: dict, k: int) -> np.ndarray:
    """The ids of the k-th document of a shard row, without expanding the others."""
    ends = np.cumsum(shard["doc_tokens"])
    symbols, rules = _load(shard)
    lengths = _unpacked(shard["lengths"], shard["n_rules"], shard["length_bits"]).astype(np.int64)
    return repair.slice_ids(symbols, rules, lengths, shard["base"], int(ends[k] - shard["doc_tokens"][k]), int(ends[k]))


@contextmanager
def _rows_a_batch(spark: SparkSession, rows: int):
    """Arrow batches of so many rows for the jobs that run inside: texts and shards are large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


_READ_TYPE = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ("range", pa.int32()), ("shard", pa.int32()),
])


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            symbols, rules = _load(row)
            flat = repair.expand(symbols, rules, row["base"]).astype("<u4")
            if len(flat) != row["n_tokens"]:
                raise ValueError(f"shard {row['range']}/{row['shard']} is damaged")
            sizes = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(sizes)
            crcs = [zlib.crc32(flat[b - n : b].tobytes()) for b, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes), pa.array(sizes),
                    pa.array(crcs, pa.int64()), pa.array(np.full(len(sizes), row["range"], np.int32)),
                    pa.array(np.full(len(sizes), row["shard"], np.int32)),
                ],
                schema=_READ_TYPE,
            )


def read_tokens(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, range, shard), one row per document, decoded from the files.

    start counts the ids of all documents before it. The counts are summed per range of shards, then
    over the ranges, of which there is one per write task."""
    shards = spark.read.schema(FILE).parquet(path)
    sizes = shards.select("range", "shard", "n_tokens")
    within = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("range").agg(F.sum("n_tokens").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_start")
    )
    firsts = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(ranges, "range").select(
        "range", "shard", (F.col("base_start") + F.col("inner")).alias("first")
    )
    # Shards are decoded where they are read; only the documents' numbers meet the shards' places.
    needed = shards.drop("lengths", "length_bits")
    with _rows_a_batch(spark, SHARDS_A_BATCH):
        read = staged(
            needed.mapInArrow(
                _read_shards, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, range int, shard int"
            ),
            "decoded",
        )
    out = read.join(firsts, ["range", "shard"]).select(
        "id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "range", "shard"
    )
    return out.withColumnRenamed("id", id)
