"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier per bit says from the byte n-grams of
a text whether that bit is set.  The classifiers are naive Bayes on hashed n-grams: their
weights follow from how often each n-gram occurs in each language, which one distributed
count over all labelled texts gives.  Decoding sums, for each codeword, the logistic loss
of all bits, weighted by how reliably that bit is predicted for that language, and takes
the codeword of least loss.  A text whose two best codewords are nearly as good is flagged
as ambiguous.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytewords import LOWER, slices

BUCKETS = 1 << 14
SLICE_BYTES = 1 << 18
EXHAUSTIVE = 5  # languages for which all distinct bits are used
SMOOTHING = 0.5
PRIOR_GRAMS = 12  # n-grams without a say that each text starts with: short texts decide less
STEEPNESS = 12.0
AMBIGUOUS = 0.05  # least difference of the two best losses, whose scale is that of one bit
RELIABILITY_ROWS = 4096  # labelled rows, in expectation, that the reliability of the bits is measured on
UNDETERMINED = "und"
PREDICTION = "lang_pred string, score double, margin double, ambiguous boolean"

# What isn't a letter or part of one counts as a space.
_SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in LOWER)
_ASCII_LETTER = re.compile("[A-Za-z]")


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # language x bit, +1 or -1
    weights: np.ndarray  # bucket x bit
    trust: np.ndarray  # language x bit, rows sum to 1


def codewords(n: int) -> np.ndarray:
    """A codeword of +1 and -1 for each of ``n`` languages, far from all others.

    For few languages all bits that tell some of them apart; for more the best of a fixed
    series of random codes with ten bits for each doubling of the languages.
    """
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= EXHAUSTIVE:
        masks = np.arange(1, 1 << (n - 1))
        return np.where((masks[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).astype(np.int8)
    bits = math.ceil(10 * math.log2(n))
    best, distance = None, -1
    for seed in range(32):
        codes = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        agree = codes.astype(np.int32) @ codes.T
        np.fill_diagonal(agree, -bits)
        mixed = (codes != codes[0]).any(axis=0).all()
        if mixed and (bits - agree.max()) // 2 > distance:
            best, distance = codes, (bits - agree.max()) // 2
    return best


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text)))


def gram_buckets(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the texts, a space put around each, and how many each text has."""
    counts = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
    data = np.frombuffer((b" " + b"  ".join(raws) + b" ").translate(_SPACED), dtype=np.uint8).astype(np.uint32)
    key = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    key *= np.uint32(0x9E3779B1)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x85EBCA77)
    key >>= np.uint32(32 - 14)
    # Between two texts lie two trigrams that belong to neither.
    if len(raws) > 1:
        ends = np.cumsum(counts + 2)[:-1]
        key = np.delete(key, np.concatenate([ends - 2, ends - 1]))
    return key, counts


def count_grams(labelled: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all labelled texts; summed up in the tasks before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_numpy()
            for first, raws in slices(batch["text"].tolist(), SLICE_BYTES):
                buckets, counts = gram_buckets(raws)
                names, codes = np.unique(langs[first : first + len(raws)].astype(str), return_inverse=True)
                of_gram = np.repeat(codes, counts)
                for k, name in enumerate(names):
                    own = np.bincount(buckets[of_gram == k], minlength=BUCKETS)
                    totals[name] = totals[name] + own if name in totals else own
        for name, n in totals.items():
            used = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "bucket": used, "n": n[used]})

    counted = labelled.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def bit_weights(shares: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log odds of each bucket for each bit; all languages of a side count alike."""
    weights = np.empty((shares.shape[1], codes.shape[1]), dtype=np.float32)
    for bit, side in enumerate(codes.T):
        weights[:, bit] = np.log(shares[side > 0].mean(axis=0)) - np.log(shares[side < 0].mean(axis=0))
    return weights


def bit_margins(model: LanguageModel, raws: list[bytes]) -> np.ndarray:
    """The classifiers' outputs for each text: mean log odds, less for short texts."""
    buckets, counts = gram_buckets(raws)
    margins = np.zeros((len(raws), model.codes.shape[1]))
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        margins[full] = np.add.reduceat(model.weights[buckets], starts, axis=0, dtype=np.float64)
    return margins / (counts + PRIOR_GRAMS)[:, None]


def losses(model: LanguageModel, margins: np.ndarray) -> np.ndarray:
    """The weighted loss of each codeword for each text."""
    bits = np.logaddexp(0.0, -STEEPNESS * margins[:, None, :] * model.codes[None, :, :])
    return (bits * model.trust[None, :, :]).sum(axis=2)


def train(labelled: DataFrame) -> LanguageModel:
    """Learns from all rows of ``lang, text`` in which both are given and the text has a letter.

    Only the counts come to the driver, at most ``BUCKETS`` for each language.  The
    reliability of the bits is measured on about ``RELIABILITY_ROWS`` of the rows.
    """
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = count_grams(labelled).toPandas()
    languages = sorted(found["lang"].unique())
    codes = codewords(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, codes, np.zeros((BUCKETS, 1), dtype=np.float32), np.ones(codes.shape))
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    place = {name: i for i, name in enumerate(languages)}
    counts[found["lang"].map(place), found["bucket"]] += found["n"]
    weights = bit_weights(counts / counts.sum(axis=1, keepdims=True), codes)
    flat = np.full(codes.shape, 1.0 / codes.shape[1])
    model = LanguageModel(languages, codes, weights, flat)
    model.trust = _reliability(labelled, model)
    return model


def _reliability(labelled: DataFrame, model: LanguageModel) -> np.ndarray:
    """How often each bit is right for each language, as weights that sum to 1 for a language."""
    known = labelled.sparkSession.sparkContext.broadcast(model)
    rows = labelled.count()
    share = min(1.0, RELIABILITY_ROWS / max(1, rows))
    sample = labelled.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = known.value
        place = {name: i for i, name in enumerate(model.languages)}
        for batch in batches:
            langs = batch["lang"].map(place).to_numpy()
            for first, raws in slices(batch["text"].tolist(), SLICE_BYTES):
                own = langs[first : first + len(raws)]
                right = bit_margins(model, raws) * model.codes[own] > 0
                for k in np.unique(own):
                    for bit, n in enumerate(right[own == k].sum(axis=0)):
                        yield pd.DataFrame({"lang": [k], "bit": [bit], "n": [n], "of": [int((own == k).sum())]})

    judged = sample.mapInPandas(judge, "lang int, bit int, n long, of long").groupBy("lang", "bit").agg(F.sum("n").alias("n"), F.sum("of").alias("of"))
    trust = np.full(model.codes.shape, 0.5)
    for r in judged.collect():
        trust[r["lang"], r["bit"]] = (r["n"] + 1) / (r["of"] + 2)
    return trust / trust.sum(axis=1, keepdims=True)


def predict(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """``lang_pred, score, margin, ambiguous`` of a text; ``und`` and 0 where it has no letter."""
    known = spark.sparkContext.broadcast(model)

    def decode(texts: pd.Series) -> pd.DataFrame:
        model = known.value
        rows: list[tuple] = []
        for _, raws in slices(texts.tolist(), SLICE_BYTES):
            if not model.languages:
                rows += [(UNDETERMINED, 0.0, 0.0, True)] * len(raws)
                continue
            loss = losses(model, bit_margins(model, raws))
            # How much better a codeword is than the others, as a share of 1.
            odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * len(model.codes[0]))
            best = loss.argmin(axis=1)
            ordered = np.sort(loss, axis=1)
            gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(raws), np.inf)
            for k, raw in enumerate(raws):
                if has_letter(raw.decode("utf-8", "surrogatepass")):
                    rows.append((model.languages[best[k]], float(odds[k, best[k]] / odds[k].sum()), float(gap[k]), bool(gap[k] < AMBIGUOUS)))
                else:
                    rows.append((UNDETERMINED, 0.0, 0.0, True))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "ambiguous"])

    return F.pandas_udf(decode, PREDICTION)(text.cast("string"))


def identify(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang", into: str = "language") -> DataFrame:
    """Adds a struct ``into`` with the predicted language of every whole text.

    Learns from ``training`` alone.  Null texts and texts without a letter are ``und`` with
    score 0; with nothing to learn from, all are.  Ties go to the first language in order.
    A column named as ``into`` is replaced; others and repeated rows are kept.
    """
    model = train(training.select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    return docs.withColumn(into, predict(docs.sparkSession, model, F.col(text)))


def remainder(key: Column, divisor: int) -> Column:
    """CRC-32 of a key's text, modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))
