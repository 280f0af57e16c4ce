"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, then the
exact weighted similarity of the shingles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, private, shifted, simhash_counts, simhash_value, staged, words

SHINGLE, SIMILARITY = 5, 0.8
#: Two windows of weighted similarity 0.8 have a cosine of 8/9 or more, hence differ in some
#: 64 * arccos(8/9) / pi = 9.7 bits, standard deviation 2.9. 20 bits lie over three of these beyond.
RADIUS = 20
BLOCKS, BLOCK_BITS = 8, 8


def _grams(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a word array, in order, repeats included."""
    zipped = F.filter(shifted(w, k), lambda s: s[str(k - 1)].isNotNull())
    return F.transform(zipped, lambda s: F.xxhash64(*[s[str(i)] for i in range(k)]))


def _variants(flips: int) -> Column:
    """All patterns of at most ``flips`` set bits in a block."""
    return F.array(
        *[F.lit(sum(1 << i for i in c)).cast("long") for f in range(flips + 1) for c in combinations(range(BLOCK_BITS), f)]
    )


def _block(fp: Column, b: Column) -> Column:
    return F.call_function("shiftrightunsigned", fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _numbered(grams: Column) -> Column:
    """A multiset as a set: repeated hashes get the number of their occurrence mixed in, so that set
    sizes are the sums of multiplicities."""
    def occurrence(x: Column, i: Column) -> Column:
        return F.xxhash64(x, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda y: y == x)))

    plain = F.transform(grams, lambda x: F.xxhash64(x, F.lit(0)))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), plain).otherwise(F.transform(grams, occurrence))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the lesser over the sum of the greater multiplicities of two arrays of shingles."""
    x, y = _numbered(a), _numbered(b)
    both = F.size(F.array_intersect(x, y)).cast("double")
    return both / F.greatest(F.size(x) + F.size(y) - both, F.lit(1.0))


def _items(items: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """(item, n, k, grams): items with words; those shorter than a shingle are one shorter shingle."""
    rows = items.select(F.col(id).alias("item"), words(lower_ascii(F.col(text))).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("n", F.size("w"))
    k = F.least("n", F.lit(shingle))
    grams = _grams(F.col("w"), shingle)
    for size in range(1, shingle):
        grams = F.when(F.col("n") == size, _grams(F.col("w"), size)).otherwise(grams)
    return rows.select("item", "n", k.alias("k"), grams.alias("grams"))


def _fingerprint(rows: DataFrame, keys: list[str], grams: Column) -> DataFrame:
    """Fingerprints of the shingles as a set of numbered occurrences: of the plain hashes a repeated one
    would weigh by its square, and the bound of RADIUS would not hold."""
    each = rows.select(*keys, F.explode(_numbered(grams)).alias("h"))
    summed = each.groupBy(*keys).agg(F.count("h").alias("total"), *simhash_counts(F.col("h")))
    return summed.select(*keys, simhash_value(F.col("total")).alias("fp"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, item_id, start, n_words, similarity, bits): for each document and item the most similar
    window of the item's length (the first of equals), where the similarity is reached.

    A window that holds no shingle of any item has similarity 0 and gets no fingerprint; every other
    window of every item length does. Fingerprints meet items of the same length that differ in at
    most ``radius`` bits: of 8 blocks one differs in at most radius // 8, and the item side lists all
    such values of each block. Documents shorter than an item are one window. A-Z are lower-cased.

    Null ids are kept as null; rows with one id and different texts are judged apart and give one row
    per item; null, empty and blank texts match nothing, and neither do such items. An item shorter
    than a shingle is matched as a whole. Either table may be empty.
    """
    target = staged(_items(items, item_id, item_text, shingle), "items")
    sizes = [r["k"] for r in target.select("k").distinct().collect()]  # shingle values at most
    hashes = staged(target.select("k", F.explode("grams").alias("h")).distinct(), "grams")
    source = docs.select(
        F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), words(lower_ascii(F.col(text))).alias("w")
    )
    hits = None
    for k in sizes or [shingle]:
        each = source.select("id", "text_hash", F.posexplode(shifted(F.col("w"), k)).alias("p", "s"))
        each = each.where(f"s.`{k - 1}` is not null").select(
            "id", "text_hash", "p", F.xxhash64(*[F.col(f"s.`{i}`") for i in range(k)]).alias("h")
        )
        # The item side is read from its written table: the planner broadcasts it by its true size or
        # shuffles, and then filters the document side with a Bloom filter by itself.
        found = each.join(hashes.where(F.col("k") == k).select("h"), "h", "left_semi").withColumn("k", F.lit(k))
        hits = found if hits is None else hits.union(found)
    hits = staged(hits, "hits")
    lengths = target.select("n", "k", F.explode("grams").alias("h")).distinct()
    regions = (
        hits.join(lengths, ["k", "h"])
        .groupBy("id", "text_hash", "k", "n")
        .agg(F.collect_set("p").alias("positions"))
    )
    regions = staged(regions, "regions")
    # Only documents with a hit are read again; repeated rows are one.
    touched = regions.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    again = source.join(
        touched, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left_semi"
    ).dropDuplicates(["id", "text_hash"])
    arrays = None
    for k in sizes or [shingle]:
        one = again.select("id", "text_hash", F.lit(k).alias("k"), _grams(F.col("w"), k).alias("grams"))
        arrays = one if arrays is None else arrays.union(one)
    arrays = staged(arrays, "documents")
    m = F.col("n") - F.col("k") + 1
    last = F.greatest(F.size("grams") - m, F.lit(0))

    def starts(p: Column) -> Column:
        return F.sequence(F.least(F.greatest(p - m + 1, F.lit(0)), last), F.least(p, last))

    arrays = arrays.select(*[F.col(c).alias(f"of_{c}") for c in ("id", "text_hash", "k")], "grams")
    same = (
        F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text_hash")) & (F.col("k") == F.col("of_k"))
    )
    window = F.slice("grams", F.col("start") + 1, m)
    windows = regions.join(arrays, same).select(
        "id", "text_hash", "k", "n", "grams",
        F.explode(F.array_distinct(F.flatten(F.transform("positions", starts)))).alias("start"),
    )
    windows = windows.select("id", "text_hash", "k", "n", "start", window.alias("grams"))
    prints = _fingerprint(windows, ["id", "text_hash", "k", "n", "start"], F.col("grams"))
    item_prints = _fingerprint(target, ["item", "n"], F.col("grams"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("b")
    lookup = (
        item_prints.select("item", "n", F.col("fp").alias("item_fp"), blocks)
        .select("*", F.explode(_variants(radius // BLOCKS)).alias("flip"))
        .select("item", "n", "item_fp", "b", _block(F.col("item_fp"), F.col("b")).bitwiseXOR(F.col("flip")).alias("value"))
    )
    lookup = staged(lookup, "blocks")
    asked = prints.select("*", blocks).select("*", _block(F.col("fp"), F.col("b")).alias("value"))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = (
        asked.join(lookup, ["n", "b", "value"])
        .select("id", "text_hash", "k", "n", "start", "item", bits.alias("bits"))
        .where(F.col("bits") <= radius)
        .distinct()
    )
    near = staged(near, "candidates")
    checked = near.join(arrays, same).select(
        "id", "text_hash", "n", "start", "item", "bits", window.alias("grams")
    ).join(target.select("item", "n", F.col("grams").alias("item_grams")), ["item", "n"])
    scored = checked.withColumn("similarity", weighted_similarity(F.col("grams"), F.col("item_grams")))
    best = (
        scored.where(F.col("similarity") >= similarity)
        .groupBy("id", "text_hash", "item")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n", "bits")).alias("best"))
    )
    return best.select(
        F.col("id").alias(id),
        F.col("item").alias(item_id),
        (-F.col("best.s")).cast("long").alias("start"),
        F.col("best.n").cast("long").alias("n_words"),
        F.round("best.similarity", 6).alias("similarity"),
        F.col("best.bits").cast("long").alias("bits"),
        "text_hash",
    )


def decontaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that match no item, all columns unchanged, whatever the names of the others. Rows
    without an id are judged by their text like any other; of repeated rows all stay or none. Null, empty
    and blank texts stay; either table may be empty."""
    bad_id, bad_hash = private("id"), private("hash")
    bad = contaminated(docs, items, id, text, **options).select(
        F.col(id).alias(bad_id), F.col("text_hash").alias(bad_hash)
    )
    bad = staged(bad.distinct(), "contaminated")
    same = F.col(id).eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.col(text)) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")
