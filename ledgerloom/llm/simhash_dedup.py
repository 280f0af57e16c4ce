"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero vector of radius + 1 bits. For each of the 2**(radius+1) - 1
non-zero vectors v there is one table, whose mask keeps the bits whose vector has an odd product
with v. Fingerprints that differ in at most ``radius`` bits put that many linear conditions on v, one
fewer than v has bits, so that some v has an even product with all of them: its mask hides every
differing bit and the pair collides there. Nothing is left to chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, private, shifted, simhash_counts, simhash_value, staged, words
from .components import components

#: Members of a bucket up to which its pairs are compared; a larger bucket is split by further
#: covering masks over the bits its own mask hides, which loses no pair either.
PAIRED = 64
LEVELS = 3


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions under which every pair that differs there in ``radius``
    bits or fewer collides at least once. Masks that keep none of the bits are left out unless it
    is the only one."""
    vectors = (1 << (radius + 1)) - 1
    of = {bit: j % vectors + 1 for j, bit in enumerate(bits)}
    masks = {
        sum(1 << bit for bit in bits if (of[bit] & v).bit_count() % 2) for v in range(1, vectors + 1)
    }
    # A pair may differ in all the bits there are if these are so few: then only 0 hides them all.
    return sorted(masks) if len(bits) > radius else [0]


def fingerprints(docs: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """(id, text_hash, fp, copies): one row per id and text; ``copies`` counts the rows equal in both.

    Copies double every count alike and so leave the majorities as they are. Null, empty and blank
    texts have fingerprint 0; fewer words than ``shingle`` are one shingle.
    """
    rows = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        words(lower_ascii(F.col(text))).alias("w"),
    )
    last = f"s.`{shingle - 1}`"
    grams = rows.select("id", "text_hash", F.posexplode_outer(shifted(F.col("w"), shingle)).alias("p", "s"))
    grams = grams.where(f"p is null or p = 0 or {last} is not null")
    hashed = grams.select(
        "id",
        "text_hash",
        F.when(F.coalesce("p", F.lit(0)) == 0, 1).otherwise(0).alias("first"),
        F.when(
            F.col("p").isNotNull(),
            F.xxhash64(F.concat_ws(" ", *[F.col(f"s.`{i}`") for i in range(shingle)])),
        ).alias("h"),
    )
    summed = hashed.groupBy("id", "text_hash").agg(
        F.sum("first").alias("copies"), F.count("h").alias("n"), *simhash_counts(F.col("h"))
    )
    return summed.select("id", "text_hash", simhash_value(F.col("n")).alias("fp"), "copies")


def _links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b), a < b, of all pairs of distinct fingerprints within the radius that share a
    bucket which was compared; every pair within the radius shares one."""
    spark = fps.sparkSession
    todo = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    parents = [0]
    edges = None
    for level in range(1, LEVELS + 1):
        children = {
            p: [p | m for m in covering_masks([i for i in range(64) if not p >> i & 1], radius)]
            for p in parents
        }
        grid = spark.createDataFrame(
            [(_signed(p), [_signed(c) for c in cs]) for p, cs in children.items()],
            "mask bigint, masks array<bigint>",
        )
        if level == 1:
            masks = F.array(*[F.lit(_signed(c)) for c in children[0]])
            dealt = todo.select("fp", F.explode(masks).alias("mask"))
        else:
            dealt = todo.join(grid, "mask").select("fp", F.explode("masks").alias("mask"))
        dealt = dealt.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")).distinct()
        sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        shared = staged(dealt.join(sizes, ["mask", "key"]), "buckets")
        small = shared if level == LEVELS else shared.where(F.col("n") <= PAIRED)
        a = small.select("mask", "key", F.col("fp").alias("a"))
        b = small.select("mask", "key", F.col("fp").alias("b"))
        pairs = a.join(b, ["mask", "key"]).where("a < b")
        near = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        near = near.select("a", "b").distinct()
        edges = near if edges is None else edges.union(near)
        if level < LEVELS:
            todo = shared.where(F.col("n") > PAIRED).select("fp", "mask").distinct()
            if todo.isEmpty():
                break
            parents = sorted({c for cs in children.values() for c in cs})
    return edges


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(id, text_hash, fingerprint, component_id, copies, root): one row per id and text, ``copies``
    rows of ``docs`` being equal in both.

    component_id is the least id reachable over links of at most ``radius`` differing bits; null ids
    count for nothing there, and a component of null ids alone has a null one. Rows with one id and
    different texts are told apart by ``text_hash`` (xxhash64 of the text). Texts without words
    share fingerprint 0 and are linked like any other. An empty table gives an empty one.

    Equal texts meet in one row before any bucket is built, so that a group of copies of any size
    costs one fingerprint; what is joined inside a bucket is bounded by PAIRED, and at the last level
    by the few values its hidden bits can take.
    """
    fps = staged(fingerprints(docs, id, text, shingle), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    linked = components(_links(distinct, radius))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    # Singletons are most of the rows; only linked fingerprints need their component's minimum.
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(least, "root")
    out = fps.join(of, "fp")
    return out.select(
        F.col("id").alias(id),
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "copies",
        "root",
    )


def one_per_row(groups: DataFrame) -> DataFrame:
    """Groups with a row for each copy."""
    return groups.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop(
        "copies"
    )


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One document of each component: the one whose id is the component's. All columns stay.

    Of rows equal in id and text one stays; which, is decided by all their columns. If two different
    texts of a component have the least id, the one with the smaller hash stays. Of a component whose
    ids are all null one row stays. Other columns may have any names; an empty table gives an empty one."""
    names = docs.columns
    own_hash, best_id, best_hash, copies, row = (private(n) for n in ("text_hash", "id", "hash", "copies", "row"))
    groups = simhash_groups(docs, id, text, shingle, radius)
    best = groups.where(F.col(id).eqNullSafe(F.col("component_id")))
    chosen = best.groupBy("root").agg(F.min(F.struct("text_hash", F.col(id).alias("id"), "copies")).alias("k"))
    chosen = chosen.select(
        F.col("k.text_hash").alias(best_hash), F.col("k.id").alias(best_id), F.col("k.copies").alias(copies)
    )
    chosen = staged(chosen, "kept")
    hashed = docs.withColumn(own_hash, F.xxhash64(F.col(text)))
    kept = hashed.join(chosen, F.col(id).eqNullSafe(F.col(best_id)) & (F.col(own_hash) == F.col(best_hash)))
    once = kept.where(F.col(copies) == 1).select(*names)
    again = kept.where(F.col(copies) > 1)
    rest = [F.col(f"`{n}`") for n in names if n != id]
    again = again.groupBy(F.col(id), own_hash).agg(F.min(F.struct(*rest)).alias(row))
    again = again.select(*[F.col(id) if n == id else F.col(f"{row}.`{n}`") for n in names])
    return once.unionByName(again)
