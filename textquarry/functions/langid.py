"""Scoring of texts against language profiles of runs of one to three characters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import shingle_text

ORDERS = (1, 2, 3)  # characters of a gram
LONGEST = max(ORDERS)
MICRO = 1_000_000  # log-probabilities are stored in millionths, as integers
MIN_CHARS = 3  # of a text that is detected; less is enough for the scores
CHUNK_CODE_POINTS = 250_000

RESULT = "language string, language_score double"


def profile_text(text: Column) -> Column:
    return shingle_text(text)


def _pack(codes: Sequence[np.ndarray]) -> np.ndarray:
    """Up to three code points of 21 bits each in one integer; 0 stands for none, so each is one more."""
    packed = np.zeros(len(codes[0]), dtype=np.int64)
    for k, code in enumerate(codes):
        packed |= code.astype(np.int64) << (21 * (LONGEST - 1 - k))
    return packed


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)


def _spell(codes: Sequence[np.ndarray]) -> list[str]:
    size = len(codes)
    joined = (np.stack(codes, axis=1) - 1).astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + size] for i in range(0, len(joined), size)]


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHUNK_CODE_POINTS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The first position of every text, for each position the number of its triple, and the distinct triples.

    A text is followed by two positions without a character, so that every
    gram of a text begins one triple: its character, that and the next, and
    all three.  Triples of code points, each one more and 0 for none; those
    that begin with none have no gram.
    """
    starts = np.cumsum([0] + [len(t) + LONGEST - 1 for t in texts])
    codes = np.frombuffer("".join([t + "\0\0" for t in texts] + ["\0\0"]).encode("utf-32-le"), dtype="<u4") + np.uint32(1)
    for k in range(1, LONGEST):
        codes[starts[1:] - k] = codes[-k] = 0
    present = np.zeros(int(codes.max()) + 1, dtype=bool)
    present[codes] = True
    alphabet = np.flatnonzero(present)
    width = len(alphabet)
    dense = (np.cumsum(present) - 1).astype(np.int32 if width**LONGEST < 1 << 31 else np.int64)[codes]
    which, keys = pd.factorize((dense[:-2] * width + dense[1:-1]) * width + dense[2:])
    return starts[:-1], which, [alphabet[keys // width**2], alphabet[keys // width % width], alphabet[keys % width]]


def _counted(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Distinct grams of each order in some texts, and how often they occur."""
    _, which, triples = _triples(texts)
    n = np.bincount(which)
    for size in ORDERS:
        own = np.flatnonzero(triples[size - 1] * triples[0])
        if len(own):
            parts = [codes[own] for codes in triples[:size]]
            group, first = pd.factorize(_pack(parts))
            at = np.empty(len(first), dtype=np.int64)
            at[group] = np.arange(len(own))
            counts = np.zeros(len(first), dtype=np.int64)
            np.add.at(counts, group, n[own])
            yield _spell([codes[at] for codes in parts]), counts


def count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of the grams of (lang, t) rows, for Spark to add up."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["t"]:
            for part in _chunks(texts.tolist()):
                for grams, n in _counted(part):
                    yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})


def count_row_grams(batches: Iterator[pd.DataFrame], min_chars: int = MIN_CHARS) -> Iterator[pd.DataFrame]:
    """Counts of the grams of each of (_row, t) rows that is long enough to be scored."""
    for batch in batches:
        for row, text in zip(batch["_row"], batch["t"]):
            if len(text.strip()) >= min_chars:
                for grams, n in _counted([text]):
                    yield pd.DataFrame({"_row": row, "gram": grams, "n": n})


class Profile:
    """A trained profile laid out for look-up: sorted grams, one row of
    log-probabilities per gram, one column per language."""

    def __init__(self, languages: list[str], grams: list[str], micro: np.ndarray):
        sizes = np.array([len(g) for g in grams], dtype=np.int64)
        starts, codes = np.cumsum(sizes) - sizes, _codes("".join(grams)) + 1
        packed = np.empty(len(grams), dtype=np.int64)
        for size in ORDERS:
            own = np.flatnonzero(sizes == size)
            packed[own] = _pack([codes[starts[own] + k] for k in range(size)])
        order = np.argsort(packed)
        self.languages = languages
        self.grams = packed[order]
        self.micro = np.ascontiguousarray(micro[order])

    def score(self, texts: list[str]) -> np.ndarray:
        """Summed log-probabilities, one row per text, and how many grams are known;
        integers, so that no order of summation can change them."""
        sums = np.zeros((len(texts), len(self.languages) + 1), dtype=np.int64)
        if not len(self.grams) or not texts:
            return sums
        starts, which, triples = _triples(texts)
        # What the grams that begin a triple add, so that each position is looked up once.
        rows = np.zeros((len(self.languages) + 1, len(triples[0])), dtype=np.int64)
        for size in ORDERS:
            own = np.flatnonzero(triples[size - 1] * triples[0])
            packed = _pack([codes[own] for codes in triples[:size]])
            at = np.minimum(np.searchsorted(self.grams, packed), len(self.grams) - 1)
            known = self.grams[at] == packed
            rows[:-1, own[known]] += self.micro[at[known]].T
            rows[-1, own[known]] += 1
        values = np.empty(len(which), dtype=np.int64)
        for j, row in enumerate(rows):
            np.take(row, which, out=values, mode="clip")
            np.add.reduceat(values, starts, out=sums[:, j])
        return sums


def best_language(text: Column, profile, min_chars: int = MIN_CHARS) -> Column:
    """Most likely language and its confidence, by a broadcast ``Profile``.

    Null for texts of fewer than ``min_chars`` characters once stripped, and for
    texts none of whose grams the profile knows.  Of equally likely languages
    the alphabetically first is taken.
    """

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model: Profile = profile.value
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            language = np.full(len(batch), None, dtype=object)
            confidence = np.full(len(batch), np.nan)
            usable = [
                i
                for i, t in enumerate(batch)
                if t is not None and len(t.strip()) >= min_chars
            ]
            if usable:
                parts = _chunks([batch.iat[i] for i in usable])
                sums = np.concatenate([model.score(part) for part in parts])
                logp = sums[:, :-1]
                best = logp.argmax(axis=1)
                gap = (logp - logp.max(axis=1, keepdims=True)) / MICRO
                conf = np.round(1.0 / np.exp(gap).sum(axis=1), 6)
                ok = sums[:, -1] > 0
                at = np.array(usable)[ok]
                language[at] = names[best[ok]]
                confidence[at] = conf[ok]
            yield pd.DataFrame(
                {"language": language, "language_score": pd.Series(confidence).astype("Float64").where(~np.isnan(confidence), None)}
            )

    return score(profile_text(text))
