"""Mixing sources to target weights: repetition rates and one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fraction, private, staged, word_count

SHARE, CAP, WEIGHTS, SEED = 1.5, 2.0, (3, 1, 2), "mix"


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, size) rows to (source, source_size, target), one row per source.

    Weights repeat over the sources in code point order, null last. Targets fill ``share`` of all
    sizes by weight; none exceeds ``cap`` times its source, what is cut goes to the others by weight.
    Sorted by the level at which each source is full, the level of the rest is a ratio of running
    sums. The first one that its own source does not overflow holds; it is the greatest such, as from
    there on the ratios fall. If even all sources full are short of the share, all are full.

    The windows run over one row per source, after aggregation.
    """
    total = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = total.select("source", "source_size", weight.alias("weight"))
    full = (F.col("source_size") * cap / F.col("weight")).alias("full")
    by_full = Window.orderBy("full", F.col("source").asc_nulls_last())
    before = by_full.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    levels = ranked.select("*", full).select(
        "*",
        (
            (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap)
            / F.sum("weight").over(rest)
        ).alias("level"),
    )
    level = F.max(F.when(F.col("level") <= F.col("full"), F.col("level"))).over(everything)
    capped = F.col("source_size") * cap
    target = F.least(capped, F.coalesce(F.col("weight") * F.col("the_level"), capped))
    return levels.select("source", "source_size", "weight", level.alias("the_level")).select(
        "source", "source_size", target.alias("target")
    )


def copies(rate: Column, *key: Column, seed: str = SEED) -> Column:
    """floor(rate) copies and one more with the probability of the fraction, decided by the key."""
    return (F.floor(rate) + F.when(fraction(F.lit(seed), *key) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)


def mix_plan(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """(id, size, source_size, target, copies, taken), one row per row of ``docs``.

    size counts words (null and empty texts: 0). A null source is a source of its own. Rows with one
    id are treated alike; a null id counts as the empty one. Texts are read once; what is written,
    aggregated and joined has numbers only.
    """
    sized = staged(
        docs.select(F.col(id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")),
        "sizes",
    )
    targets_of = staged(source_targets(sized, **targets), "targets")
    joined = sized.alias("d").join(
        targets_of.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))
    )
    n = copies(rate(), F.coalesce(F.col("id").cast("string"), F.lit("")))
    return joined.select(
        F.col("id").alias(id), "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken")
    )


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, all columns unchanged."""
    names = docs.columns
    sizes = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    of = staged(source_targets(sizes, **targets), "targets")
    key, rated = private("source"), private("rate")
    of = of.select(F.col("source").alias(key), rate().alias(rated))
    joined = docs.join(of, F.col(source).eqNullSafe(F.col(key)))
    n = copies(F.col(rated), F.coalesce(F.col(id).cast("string"), F.lit("")))
    repeat = private("copy")
    return joined.withColumn(repeat, F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select(*names)
