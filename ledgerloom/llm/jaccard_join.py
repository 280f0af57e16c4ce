"""N-gram Jaccard join over a forest of count-vector R-trees.

A document is the set of its distinct shingles. Hashing the shingles into groups and counting makes it a
point, and the summed minima of two points' coordinates bound the overlap of their sets. Boxes around
points bound it for all points inside, which is what the R-tree prunes by; survivors are verified on the
sets themselves.

One tree over all points prunes little, as unrelated texts of one length have much the same counts. So
the coordinates are laid out in more blocks than a linked pair can differ in, and there is a small tree (a
*page*) for each block and block content. Sets of a and b members whose similarity reaches s differ in at
most (1 - s) / s * a members, and each of these changes one block: with K blocks a pair agrees in at least
K - D of them, D being that number. Every set leaves out its K - D - 1 emptiest blocks (by a rank that
depends on the content alone), so that the fullest block in which a linked pair agrees is a page of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import private, staged
from .components import components

SHINGLE = 4
#: Similarity from which documents are linked, as an exact fraction.
SIMILARITY = Fraction(85, 100)
#: Coordinates of a point, and groups that a block of the page layout tells apart.
GROUPS, BLOCK_GROUPS = 256, 1 << 20
#: Greatest count a coordinate holds. A point beyond it in any is put into the far corner of all.
MOST = 127
#: Sizes of sets grow by this factor from one layout of blocks to the next; blocks per difference.
CLASS, SPARE = 2, 1.25
#: Points of a leaf, children of a node, and points of the pieces in which a large page is joined.
LEAF, FANOUT, PIECE = 16, 8, 2048
#: Points from which a page that is still open has every point ask one more of its points before all pairs.
LOOSE = 64
#: Least pages of a point that travel with it, by which a pair knows where else it meets.
SKETCH = 16
_NEVER = (1 << 63) - 1
#: Bytes of text that are cut into words at once.
SLICE = 1 << 20

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (the finishing step of a common generator; fixed values)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_ODD = _U(0x9E3779B97F4A7C15)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a run of texts, A-Z lower-cased, and each text's range of words. Text i is
    ``data[at[i]:at[i + 1]]``."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    begins = ~space
    begins[1:] &= space[:-1] | first[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    low = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    lanes_all = np.lib.stride_tricks.as_strided(padded, (len(low) + 1, 8), (1, 1))
    size = end - start
    lanes = (size + 7) // 8
    of = np.repeat(np.arange(len(start)), lanes)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    place = start[of] + 8 * nth
    value = np.ascontiguousarray(lanes_all[place]).view(np.uint64).ravel()
    here = np.minimum(end[of] - place, 8).astype(np.uint64)
    value = value & (~_U(0) >> (_U(64) - here * _U(8)))
    mixed = _mix(value + _ODD * (nth.astype(np.uint64) + _U(1)))
    # Sums of the lanes, each mixed with its place; they wrap at 64 bits.
    total = np.append(_U(0), np.cumsum(mixed, dtype=np.uint64))
    upto = np.cumsum(lanes)
    sums = total[upto] - total[upto - lanes]
    return _mix(sums + size.astype(np.uint64)), np.searchsorted(start, at, "left")


def shingle_hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of all windows of ``shingle`` words; of fewer words the one of all of them."""
    k = min(shingle, len(words))
    if k == 0:
        return words
    made = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        made = _mix(made * _ODD + words[i : len(words) - k + 1 + i] + _U(i + 1))
    return made


def most_different(n: int, similarity: Fraction) -> int:
    """How many members a set of n and any set linked with it can differ in, both sides together."""
    # i >= s * (n + m - i) and m <= n / s give n + m - 2i <= (1 - s) / s * n.
    return int((1 - similarity) / similarity * n)


def _layout(n: int, similarity: Fraction) -> tuple[int, int]:
    """(number, blocks) of the layout for sets of n."""
    number = 0
    while CLASS ** (number + 1) <= n:
        number += 1
    return number, _blocks(number, similarity)


def _blocks(number: int, similarity: Fraction) -> int:
    return int(SPARE * (most_different(CLASS ** (number + 1) - 1, similarity) + 1)) + 1


def page_keys(members: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The pages of a set given as ascending hashes: its fullest blocks, one more than it may differ in,
    in the layout of its size, and in the next if a linked set can be that large."""
    n = len(members)
    number, _ = _layout(n, similarity)
    keys = [_fullest(members, number, similarity)]
    if int(n / similarity) >= CLASS ** (number + 1):
        keys.append(_fullest(members, number + 1, similarity))
    return np.concatenate(keys)


def _fullest(members: np.ndarray, number: int, similarity: Fraction) -> np.ndarray:
    blocks, wanted = _blocks(number, similarity), most_different(len(members), similarity) + 1
    # Blocks are ranges of the upper bits, so that ascending hashes are in order of their blocks.
    block = ((members >> _U(32)) * _U(blocks)) >> _U(32)
    group = members & _U(BLOCK_GROUPS - 1)
    layout = _U(int(_ODD) * (number + 1) % (1 << 64))
    unit = _mix(block * _U(BLOCK_GROUPS) + group + layout)
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    count = np.diff(np.append(starts, len(members)))
    # The sum over the members is a hash of the block's number and group counts.
    content = _mix(np.add.reduceat(unit, starts))
    rank = ((_U(255) - np.minimum(count, 255).astype(np.uint64)) << _U(56)) | (content >> _U(8))
    if len(rank) < wanted:  # the emptiest count as well
        missing = np.setdiff1d(np.arange(blocks, dtype=np.uint64), block[starts])
        empty = _mix(layout + ~missing)
        rank = np.concatenate([rank, (_U(255) << _U(56)) | (empty >> _U(8))])
    if len(rank) > wanted:
        rank = np.partition(rank, wanted - 1)[:wanted]
    return rank


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of some SLICE bytes: (first row, bytes, offsets). Null texts are empty."""
    text = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    body = text.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(text):
        high = max(int(np.searchsorted(offsets, offsets[low] + SLICE, "right")) - 1, low + 1)
        yield low, body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def _members(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle hashes) of each text."""
    for low, data, at in _texts(column):
        if len(data):
            words, ranges = word_hashes(data, at)
        else:
            words, ranges = np.empty(0, np.uint64), np.zeros(len(at), int)
        for i in range(len(at) - 1):
            yield low + i, np.unique(shingle_hashes(words[ranges[i] : ranges[i + 1]], shingle))


def _digest(members: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    parts = [np.add.reduce(_mix(members + _U(salt))) if len(members) else _U(0) for salt in (1, 2)]
    return np.array([*parts], np.uint64).tobytes()


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


#: Page keys or shingles after which a batch is handed on.
HELD = 1 << 18


def _describe(shingle: int, similarity: Fraction, schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, counts, keys = [], [], [], []
            low = held = 0
            for i, members in _members(batch.column(1), shingle):
                point = np.bincount((members >> _U(8)).astype(np.int64) & (GROUPS - 1), minlength=GROUPS)
                point = point if point.max() <= MOST else np.full(GROUPS, MOST)
                pages = page_keys(members, similarity) if len(members) else members
                n.append(len(members))
                digests.append(_digest(members))
                counts.append(point.astype(np.int8))
                keys.append(pages.view(np.int64))
                held += len(pages)
                if held >= HELD or i == batch.num_rows - 1:
                    columns = [
                        batch.column(0).slice(low, i + 1 - low), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                        _lists(counts, pa.int8()), _lists(keys, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
                    n, digests, counts, keys = [], [], [], []
                    low, held = i + 1, 0

    return work


def described(docs: DataFrame, id: str, text: str, shingle: int, similarity: Fraction) -> DataFrame:
    """(id, n, digest, counts, keys) of each row: size and digest of its set, its point and its pages."""
    kind = docs.schema[id].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("counts", T.ArrayType(T.ByteType())), T.StructField("keys", T.ArrayType(T.LongType())),
    ])
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_describe(shingle, similarity, to_arrow_schema(schema)), schema)


def _sets(shingle: int, schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, parts, held = [], [], 0
            for _, members in _members(batch.column(0), shingle):
                digests.append(_digest(members))
                parts.append(members.view(np.int64))
                held += len(members)
                if held >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _lists(parts, pa.int64())], schema=schema)
                    digests, parts, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _lists(parts, pa.int64())], schema=schema)

    return work


def _set_table(docs: DataFrame, text: str, wanted: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(cid, members) of the wanted classes, from one text of each."""
    schema = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("members", T.ArrayType(T.LongType()))])
    known = staged(classes.join(wanted, "cid", "left_semi").select("cid", "digest", "text_hash"), "wanted")
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    texts = hashed.join(known.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    sets = texts.select("text").mapInArrow(_sets(shingle, to_arrow_schema(schema)), schema)
    return staged(known.select("cid", "digest").join(sets, "digest").select("cid", "members"), "sets")


# The tree of a page


def _str_order(points: np.ndarray, low: int, high: int, order: np.ndarray) -> None:
    """Sort-tile order: split at the median of the widest coordinate until a leaf is reached."""
    todo = [(low, high)]
    while todo:
        a, b = todo.pop()
        if b - a <= LEAF:
            continue
        part = order[a:b]
        spread = points[part].max(0) - points[part].min(0)
        middle = (b - a) // 2
        order[a:b] = part[np.argpartition(points[part, int(spread.argmax())], middle)]
        todo += [(a, a + middle), (a + middle, b)]


class Tree:
    """R-tree over points, bulk-loaded: levels of boxes from the leaves up, FANOUT children to a node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.arange(len(points))
        _str_order(points, 0, len(points), self.order)
        self.points, self.sizes = points[self.order], sizes[self.order]
        high, low = self.points, self.sizes
        self.levels, width = [], LEAF
        while True:
            cut = np.arange(0, len(high), width)
            high, low = np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut)
            self.levels.append((high, low, width))
            if len(high) == 1:
                break
            width = FANOUT

    def near(self, point: np.ndarray, size: int, similarity: Fraction) -> np.ndarray:
        """Numbers of the points whose overlap with the given one may reach the similarity."""
        found = np.zeros(1, int)
        for level in range(len(self.levels) - 1, -1, -1):
            high, low, width = self.levels[level]
            found = found[_may_link(high[found], low[found], point, size, similarity)]
            below = len(self.levels[level - 1][0]) if level else len(self.points)
            found = (found[:, None] * width + np.arange(width)).ravel()
            found = found[found < below]
        return self.order[found[_may_link(self.points[found], self.sizes[found], point, size, similarity)]]


def _may_link(high: np.ndarray, least: np.ndarray, point: np.ndarray, size: int, similarity: Fraction) -> np.ndarray:
    """Where the summed minima leave room for the overlap: (1 + s) * overlap >= s * (size + other size). Two
    points in the far corner say nothing of their overlap."""
    overlap = np.minimum(high, point).sum(1, dtype=np.int64)
    p, q = similarity.numerator, similarity.denominator
    return ((p + q) * overlap >= p * (size + least)) | (overlap == GROUPS * MOST)


def _candidates(points: np.ndarray, sizes: np.ndarray, asking: np.ndarray, asked: np.ndarray, similarity: Fraction):
    """(i, numbers of the asked points that may be linked with point i) for every asking point."""
    if len(asked) <= LEAF:  # the tree is one leaf
        for i in asking:
            yield i, asked[_may_link(points[asked], sizes[asked], points[i], int(sizes[i]), similarity)]
    else:
        tree = Tree(points[asked], sizes[asked])
        for i in asking:
            yield i, asked[tree.near(points[i], int(sizes[i]), similarity)]


def page_pairs(
    key: int, cids: np.ndarray, roots: np.ndarray, sides: np.ndarray, sizes: np.ndarray, points: np.ndarray,
    sketches: np.ndarray, similarity: Fraction,
) -> list[tuple[int, int]]:
    """The pairs of a page, or of two of its pieces, that survive the tree. Side 1 asks, side 0 is asked; side
    2 does both. Left out are pairs under one root, and pairs whose sketches name a lesser page of both: they
    meet there as well. No sketch names one lesser than the least, so a pair is never left out everywhere."""
    asked, asking = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    pairs = []
    if not len(asked) or not len(asking):
        return pairs
    for i, found in _candidates(points, sizes, asking, asked, similarity):
        found = found[roots[found] != roots[i]]
        if sides[i] == 2:
            found = found[cids[found] > cids[i]]
        lesser = sketches[i][sketches[i] < key]
        if len(found) and len(lesser):
            found = found[~np.isin(sketches[found], lesser).any(1)]
        pairs.extend((min(int(cids[i]), int(cids[j])), max(int(cids[i]), int(cids[j]))) for j in found)
    return pairs


def _join_pages(similarity: Fraction, schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; one cell of at most two pieces is held."""
        cell, held = None, []
        a, b = [], []

        def close() -> None:
            if held:
                columns = [np.concatenate(c) for c in zip(*held)]
                for x, y in page_pairs(int(columns[0][0]), *columns[1:], similarity):
                    a.append(x)
                    b.append(y)
                held.clear()

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
            a.clear(), b.clear()
            return batch

        for batch in batches:
            key, p, q, *rest = [batch.column(i).to_numpy() for i in range(7)]
            counts = batch.column(7).flatten().to_numpy().reshape(-1, GROUPS)
            sketches = batch.column(8).flatten().to_numpy().reshape(-1, SKETCH)
            new = (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(key)] if len(key) else []
            for low, high in zip(edges, edges[1:]):
                name = (int(key[low]), int(p[low]), int(q[low]))
                if name != cell:
                    close()
                    cell = name
                held.append([c[low:high] for c in (key, *rest, counts, sketches)])
            yield made()
        close()
        yield made()

    return work


def _cells(pages: DataFrame) -> DataFrame:
    """(key, p, q, cid, root, side) of open pages. A page of more than PIECE points is cut into pieces in order
    of their roots; piece p is asked by piece q in a cell of their own, unless both lie under one root."""
    inside = Window.partitionBy("key").orderBy("root", "cid")
    placed = pages.withColumn("piece", F.floor((F.row_number().over(inside) - 1) / F.lit(PIECE)).cast("int"))
    pieces = placed.groupBy("key", "piece").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    pieces = staged(pieces, "pieces")
    left = pieces.select("key", F.col("piece").alias("p"), F.col("least").alias("l1"), F.col("most").alias("m1"))
    right = pieces.select("key", F.col("piece").alias("q"), F.col("least").alias("l2"), F.col("most").alias("m2"))
    met = left.join(right, "key").where("p <= q and (l1 <> m1 or l2 <> m2 or l1 <> l2)")

    def part(name: str, side: int):
        return F.struct(F.col(name).alias("piece"), F.lit(side).alias("side"))

    parts = F.when(F.col("p") == F.col("q"), F.array(part("p", 2))).otherwise(F.array(part("p", 0), part("q", 1)))
    sides = met.select("key", "p", "q", F.explode(parts).alias("s")).select("key", "p", "q", "s.piece", "s.side")
    return placed.join(sides, ["key", "piece"]).select("key", "p", "q", "cid", "root", "side")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs whose sets reach the similarity."""
    one = sets.select(F.col("cid").alias("a"), F.col("members").alias("x"))
    two = sets.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - both
    p, q = similarity.numerator, similarity.denominator
    joined = pairs.join(two, "b").join(one, "a")
    return joined.where(both * q >= union * p).select("a", "b")


def _point_bound(pairs: DataFrame, points: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs that the summed minima of their points leave possible."""
    one = points.select(F.col("cid").alias("a"), F.col("n").alias("n1"), F.col("counts").alias("c1"))
    two = points.select(F.col("cid").alias("b"), F.col("n").alias("n2"), F.col("counts").alias("c2"))
    least = F.zip_with("c1", "c2", lambda x, y: F.least(x, y))
    overlap = F.aggregate(least, F.lit(0).cast("long"), lambda s, x: s + x)
    p, q = similarity.numerator, similarity.denominator
    room = ((p + q) * F.col("o") >= p * (F.col("n1") + F.col("n2"))) | (F.col("o") == GROUPS * MOST)
    return pairs.join(two, "b").join(one, "a").select("a", "b", "n1", "n2", overlap.alias("o")).where(room).select("a", "b")


def _open_pages(pages: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, cid, root, m) of the pages whose m points lie under several roots (without roots, each point under
    its own). Of pages with the same points one is kept: they would make the same pairs."""
    if roots is None:
        rooted = pages.select("key", "cid", F.col("cid").alias("root"))
    else:
        known = roots.select(F.col("node").alias("cid"), "root")
        rooted = pages.join(known, "cid", "left").select("key", "cid", F.coalesce("root", "cid").alias("root"))
    same = [F.bit_xor(F.xxhash64("cid", F.lit(salt))).alias(f"same{salt}") for salt in (1, 2)]
    sized = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("m"), *same)
    kept = sized.where("least < most").groupBy("m", "same1", "same2").agg(F.min("key").alias("key")).select("key", "m")
    return staged(rooted.join(kept, "key"), "open")


def _linked(
    docs: DataFrame, text: str, classes: DataFrame, shingle: int, similarity: Fraction, every: bool
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of classes, and (node, root) of their components. With ``every`` all links, else as many
    as the components need."""
    routes = classes.select(F.explode(F.array_distinct("keys")).alias("key"), "cid")
    page = Window.partitionBy("key")
    met = routes.select(
        "key", "cid", F.min("cid").over(page).alias("seed"), F.max("cid").over(page).alias("last")
    ).where("seed < last")
    pages = staged(met.select("key", "cid", "seed"), "pages")
    met = pages.select("cid").distinct()
    points = staged(classes.select("cid", "n", "counts").join(met, "cid", "left_semi"), "points")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
        sets = _set_table(docs, text, wanted, classes, shingle)
        return staged(_verified(pairs, sets, similarity), "links")

    def asked(rows: DataFrame) -> DataFrame:
        """Each point's question to the page's chosen one, where the summed minima leave it open."""
        pairs = rows.select(F.least("seed", "cid").alias("a"), F.greatest("seed", "cid").alias("b")).distinct()
        return _point_bound(pairs, points, similarity)

    # A page's first point alone is asked by the others: one question a point, however large the page.
    links = verified(asked(pages.where("cid <> seed")))
    roots = components(links)
    left = _open_pages(pages, None if every else roots)
    large = left.where(F.col("m") > LOOSE)
    if not every and not large.isEmpty():
        # Near copies that are copies of a text far from the first point: now each page has another one asked.
        chosen = large.groupBy("key").agg(F.min_by(F.struct("cid", "root"), F.xxhash64("key", "cid")).alias("seed"))
        rows = large.join(chosen, "key").where("root <> seed.root").select("cid", F.col("seed.cid").alias("seed"))
        links = links.union(verified(asked(rows)))
        roots = components(links)
        left = _open_pages(pages, roots)
    # At last all pairs that are not under one root, in trees.
    sketch = F.slice(F.concat(F.array_sort(F.collect_set("key")), F.array_repeat(F.lit(_NEVER), SKETCH)), 1, SKETCH)
    about = points.join(left.groupBy("cid").agg(sketch.alias("sketch")), "cid")
    rows = _cells(left).join(about, "cid").select("key", "p", "q", "cid", "root", "side", "n", "counts", "sketch")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    cell = ["key", "p", "q"]
    pairs = rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(
        _join_pages(similarity, to_arrow_schema(schema)), schema
    )
    more = verified(pairs.distinct())
    if more.isEmpty():
        return links, roots
    links = links.union(more).distinct()
    return links, components(links)


def _classes(docs: DataFrame, id: str, text: str, shingle: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """Rows (id, n, digest), and one class per set that has members: (cid, digest, n, counts, keys,
    text_hash, least). cid is a number fixed by the written table."""
    hash_, own = private("hash"), private("id")
    both = docs.select(F.struct(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("hash")).alias(own), F.col(text).alias(hash_))
    rows = staged(described(both, own, hash_, shingle, similarity), "described")
    flat = rows.select("id.id", "id.hash", "n", "digest", "counts", "keys")
    sets = flat.where("n > 0").groupBy("digest").agg(
        F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("keys").alias("keys"),
        F.min("hash").alias("text_hash"), F.min("id").alias("least"),
    )
    classes = staged(sets.withColumn("cid", F.monotonically_increasing_id()), "classes")
    return flat.select("id", "n", "digest"), classes


def similar_pairs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: Fraction = SIMILARITY
) -> tuple[DataFrame, DataFrame]:
    """All links between different sets as (a, b), a < b, numbers of classes; and the membership
    (id, n, class), a row per row of ``docs``, class null for texts without words."""
    rows, classes = _classes(docs, id, text, shingle, similarity)
    links, _ = _linked(docs, text, classes, shingle, similarity, True)
    of = rows.join(classes.select("digest", F.col("cid").alias("class")), "digest", "left")
    return links, of.select(F.col("id").alias(id), "n", "class")


def similarity_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: Fraction = SIMILARITY
) -> DataFrame:
    """(id, n_shingles, component_id), one row per row of ``docs``.

    component_id is the least id reachable over links of sets whose Jaccard similarity reaches the given
    one; equal sets are linked. Null, empty and blank texts have an empty set, are linked with nothing, not
    even with each other, and are components of their own. Fewer words than a shingle are one shingle.
    Null ids count for nothing in the least; a component of null ids alone has a null one. Repeated rows
    are copies. Other columns are ignored, whatever their names; an empty table gives an empty one. Whole
    texts are used, of any length; sets are of 64-bit hashes of shingles.

    Equal sets are one class before anything is compared. One point of a page is asked by the others first,
    which links a group of near copies in proportion to its size; what is still apart after that is asked
    for pair by pair, in pieces of bounded size. No link between different components is left out.
    """
    rows, classes = _classes(docs, id, text, shingle, similarity)
    _, roots = _linked(docs, text, classes, shingle, similarity, False)
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "digest", "least", F.coalesce("root", "cid").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of = rooted.select("digest", "root").join(least, "root").select("digest", "component")
    out = rows.join(of, "digest", "left")
    return out.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )
