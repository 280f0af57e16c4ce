"""Helpers the training-data operators share: tables, staging, words, SimHash."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace

#: One or more blanks, tabs, line ends or form feeds; everything else belongs to words.
SPACES = " \t\n\x0b\f\r"
SEPARATOR = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the cluster's shared folder and read back. The result is computed once, outlives
    any executor, and its true size is known to the planner."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private(name: str) -> str:
    """A column name that no caller's column can clash with."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null, empty and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    # Only a text without words splits into an empty string.
    return F.array_remove(F.split(bare, SEPARATOR, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that unless the text holds another letter
    with a lower case; only those texts pay for ``translate``, which looks up every character."""
    other = F.regexp_like(text, F.lit(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"))
    return F.when(other, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def shifted(array: Column, k: int) -> Column:
    """Array of structs 0..k-1: each element with the k-1 that follow, null beyond the end."""
    parts = [array] + [F.slice(array, i + 1, F.greatest(F.size(array), F.lit(1))) for i in range(1, k)]
    return F.arrays_zip(*[p.alias(str(i)) for i, p in enumerate(parts)])


_LANES = 0x0000000100000001


def simhash_counts(h: Column, weight: Column | None = None) -> list[Column]:
    """32 sums that hold the 64 per-bit counts of a group's hashes, two 32-bit lanes to a sum.
    Exact for groups of less than 2**32 total weight."""
    lane = [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES)) for k in range(32)]
    return [F.sum(x if weight is None else x * weight).alias(f"__b{k}") for k, x in enumerate(lane)]


def simhash_value(total: Column) -> Column:
    """Fingerprint from the sums: a bit is set if more than half of the total weight has it."""
    bits = []
    for k in range(32):
        low = F.col(f"__b{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"__b{k}"), 32)
        for count, bit in ((low, k), (high, k + 32)):
            value = 1 << bit if bit < 63 else -(1 << 63)
            bits.append(F.when(count * 2 > total, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fraction(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts; the first 52 bits of their MD5."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows given in the program, as literals of the plan. ``schema`` as in ``name type, ...``."""
    fields = [f.split() for f in schema.split(", ")]
    made = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, fields)]) for r in rows]
    if not made:
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))
