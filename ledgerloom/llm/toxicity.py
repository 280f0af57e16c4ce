"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary text and one on
toxic text; windows of a text that the second shortens more speak for toxicity. In addition, what lists
of the words typical of toxic documents shorten in narrower windows."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import private

#: The sample that a model is fitted on: documents of each class, by the hash of their id, and the
#: longest text taken into it.
SAMPLE = {1: 2000, 0: 4000}
SAMPLE_CHARS = 200_000
#: Bytes of each trained dictionary and of the windows that the two are compared on.
TRAINED, WIDE = 8192, 512
#: The word lists: bytes of a window and from one to the next, of the ordinary text both sides know, and
#: of the strongest words, which are also compared by themselves. The list of all words has no limit.
WINDOW, STEP, SHARED, STRONGEST = 36, 22, 4096, 192
#: Least log-likelihood ratio of a word start to count as typical.
TYPICAL = 8.0
THRESHOLD = 0.3

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _windows(data: bytes, window: int, step: int) -> list[bytes]:
    return [data[i : i + window] for i in range(0, max(1, len(data) - window + step), step)]


def _distinct(texts: list[str], hashes: int = 24, shared: int = 2) -> list[str]:
    """Texts without those near an earlier one: copies would make one document's words typical."""
    seen, out = set(), []
    for text in texts:
        words = _WORDS.findall(text)
        grams = {_hash(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        x = np.fromiter(grams, np.uint64, len(grams))
        factors = np.arange(1, 2 * hashes, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        least = (x[None, :] * factors[:, None]).min(1)
        keys = list(enumerate(least.tolist()))
        if sum(k in seen for k in keys) < shared:
            seen.update(keys)
            out.append(text)
    return out


def _hash(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words))


def _starts(text: str) -> set[str]:
    return {w[:n] for w in set(_WORDS.findall(text)) for n in range(4, min(len(w), 12) + 1)}


def _typical(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Word starts that far more toxic than ordinary documents hold, the strongest and then longest
    first, none the beginning of another."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(_starts(t))
    for t in ordinary:
        b.update(_starts(t))
    n1, n0 = len(toxic), len(ordinary)
    scored = []
    for start, k in a.items():
        m = b[start]
        if k >= 3 and k * n0 > 2 * m * n1:
            expected = (k + m) * n1 / (n1 + n0)
            score = 2 * (k * math.log(k / expected) + (m * math.log(m / (k + m - expected)) if m else 0.0))
            if score > TYPICAL:
                scored.append((-score, -len(start), start))
    chosen: list[str] = []
    taken: set[str] = set()
    for _, _, start in sorted(scored):
        beginnings = {start[:n] for n in range(4, len(start) + 1)}
        if not beginnings & set(chosen) and start not in taken:
            chosen.append(start)
            taken |= beginnings
    return chosen


def _joined(parts: list[str], size: int | None = None) -> bytes:
    """Strongest last, where a match is cheapest to name; all parts, or those that fit a size."""
    out, length = [], 0
    for p in parts:
        piece = (" " + p).encode("utf-8", "surrogatepass")
        if size is None or length + len(piece) <= size:
            out.append(piece)
            length += len(piece)
    return b"".join(reversed(out))


def _trained(texts: list[str], size: int) -> bytes:
    samples = [w for t in texts for w in _windows(t.encode("utf-8", "surrogatepass"), 512, 512)]
    try:
        return zstd.train_dictionary(2 * size, samples, k=64, d=8, level=3).as_bytes()[-size:]
    except zstd.ZstdError:  # too little text to train on
        return b" ".join(samples)[-size:]


def _compressor(known: bytes):
    """All of ``known`` can be matched, whatever its size."""
    log = max(13, (len(known) + WIDE).bit_length())
    params = zstd.ZstdCompressionParameters(
        window_log=log, hash_log=log - 1, chain_log=log - 1, search_log=6, min_match=5, target_length=64,
        strategy=zstd.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstd.FORMAT_ZSTD1_MAGICLESS,
    )
    return zstd.ZstdCompressor(
        compression_params=params, dict_data=zstd.ZstdCompressionDict(known, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    ).compress


def _listed(gains: np.ndarray) -> tuple:
    """Statistics of the gains by a word list."""
    over, n = np.clip(gains - 1, 0, None).sum(), len(gains)
    strong, stronger = (gains >= 3).sum(), (gains >= 5).sum()
    return (
        min(gains.max(), 12), math.log1p(over), math.log1p(strong), over / n**0.5, over / n, gains.mean(), math.log(n),
        math.log1p(stronger), stronger / n**0.5, strong / n,
    )


@dataclass
class ToxicityModel:
    #: Trained on text of the two classes.
    ordinary: bytes
    toxic: bytes
    #: Ordinary text and ordinary words; the strongest typical words in their place; all typical words.
    plain: bytes
    strongest: bytes
    all_words: bytes
    opening: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    #: Statistics of a text's gains.
    FEATURES = 24

    def features(self, texts: list[str]) -> np.ndarray:
        """Statistics of the bytes by which every window of the whole text is shorter with the toxic
        dictionary, the strongest words, and all typical words. Narrow windows open with a stretch that
        all lists know, without which zstandard stores short ones as they are."""
        ordinary, toxic, plain, strongest, all_words = map(
            _compressor, (self.ordinary, self.toxic, self.plain, self.strongest, self.all_words)
        )
        rows = np.zeros((len(texts), self.FEATURES))
        for i, text in enumerate(texts):
            data = text.lower().encode("utf-8", "surrogatepass")
            g = np.array([len(ordinary(w)) - len(toxic(w)) for w in _windows(data, WIDE, WIDE)], float)
            narrow = [self.opening + w for w in _windows(data, WINDOW, STEP)]
            size = np.array([len(plain(w)) for w in narrow], float)
            rows[i] = (
                g.max(), g.mean(), g.min(), g.sum() / len(g) ** 0.5,
                *_listed(size - [len(strongest(w)) for w in narrow]),
                *_listed(size - [len(all_words(w)) for w in narrow]),
            )
        return rows

    def score(self, texts: list[str]) -> np.ndarray:
        x = (self.features(texts) - self.mean) / self.scale
        z = self.weights[0] + x @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + penalty * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - penalty * w)
    return w


def fit_texts(toxic: list[str], ordinary: list[str]) -> ToxicityModel:
    """A model from texts of the two classes: the dictionaries and lists from all that are not near copies
    of each other, the weights of the windows' gains from all. With less than six texts of a class the score is
    the share of toxic ones, whatever the text."""
    n = ToxicityModel.FEATURES
    blank = ToxicityModel(*[b" " * 64] * 5, b"", np.zeros(n), np.ones(n), np.zeros(n + 1))
    if min(len(toxic), len(ordinary)) < 6:
        share = len(toxic) / max(1, len(toxic) + len(ordinary))
        blank.weights[0] = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return blank
    make = [_distinct([t.lower() for t in c]) for c in (toxic, ordinary)]
    usual, there = (Counter(w for t in make[k] for w in set(_WORDS.findall(t))) for k in (1, 0))
    shared, typical = _trained(make[1], SHARED), _typical(*make)
    own = _joined(typical, STRONGEST)
    common = [w for w, c in usual.most_common(8000) if len(w) > 3 and there[w] * len(make[1]) < c * len(make[0])]
    other = _joined(common, len(own)).rjust(len(own), b" ")
    model = ToxicityModel(
        _trained(make[1], TRAINED), _trained(make[0], TRAINED),
        shared + other, shared + own, _joined(typical) + shared + own,
        shared[100:132], blank.mean, blank.scale, blank.weights,
    )
    x = model.features(toxic + ordinary)
    y = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = _logistic((x - model.mean) / model.scale, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """A model from labelled documents. Rows of ``labels`` without id or label are left out; so are
    texts that are null or longer than SAMPLE_CHARS. Only the bounded sample SAMPLE reaches the driver,
    chosen from the ids before any text is read."""
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("y")).dropna().distinct()
    picked, counts = None, {}
    for y, most in SAMPLE.items():
        of = known.where(F.col("y") == y)
        counts[y] = of.count()
        of = of.orderBy(F.xxhash64("id"), "id").limit(most)
        picked = of if picked is None else picked.union(of)
    rows = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        .where(F.length("text") <= SAMPLE_CHARS)
        .join(picked, "id")
        .select("id", "text", "y")
        .toPandas()
        .sort_values(["id", "text"])
    )
    model = fit_texts(*[rows.loc[rows.y == y, "text"].tolist() for y in (1, 0)])
    taken = {y: max(1, min(n, SAMPLE[y])) for y, n in counts.items()}
    if min(counts.values()) >= 6:
        model.weights[0] += math.log(counts[1] / taken[1]) - math.log(counts[0] / taken[0])
    return model


def scored(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of every whole text, 0 to 1; null and empty texts are scored
    as empty. Texts go through Arrow in batches; a task holds one batch and the dictionaries."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.fillna("").tolist()))

    return docs.withColumn(score, of(F.coalesce(F.col(text), F.lit(""))))


def without_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, columns unchanged."""
    score = private("score")
    return scored(docs, model, text, score).where(F.col(score) < threshold).drop(score)
