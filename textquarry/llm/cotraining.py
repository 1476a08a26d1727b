"""Quality of documents by co-training two views: what a text says, and its metadata and layout.

Each view has a logistic classifier of its own.  Both start from labelled documents; in every
round each gives the unlabelled documents that it is surest of to the other as further
examples.  What the two say is calibrated on labelled documents that neither was fitted on, and
the calibrated views are combined into one probability.  The same is done for toxicity.

The features of all documents are written once.  In every round both views score every unlabelled
document where it lies, and the surest of the whole corpus are passed on.  The classifiers are
fitted on the driver, on at most about ``LABELLED`` labelled documents, chosen by a hash of their
ids, and those passed on, at most ``PER_ROUND`` per view and round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from . import bytewords as B

LABELLED = 8_000
ROUNDS = 3
PER_ROUND = 200  # documents of either class that a view passes on in a round
SURE = 0.95
WORD_BITS = 20
LEAST_DOCUMENTS = 5  # of the sample, for a word to be a feature
BINS = 8
CALIBRATION = 5  # every fifth labelled document is kept for it
TARGETS = ("quality", "toxic")
NUMBERS = 10


# --------------------------------------------------------------------------
# views


def word_features(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct words of each text, as hashes of ``WORD_BITS`` bits; symbols around words don't count."""
    out = []
    for _, raws in B.slices(texts):
        hashes, counts = B.word_hashes(raws, B.SYMBOLS)
        small = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32)
        out += [np.unique(w) for w in np.split(small, np.cumsum(counts)[:-1])]
    return out


_SYMBOL = re.compile(r"[^\w\s]")
_UPPER = re.compile(r"[A-Z]")
_DIGIT = re.compile(r"[0-9]")


def layout(text: str | None) -> list[float]:
    """Figures of a text's form: sizes, kinds of characters, repetition."""
    text = text or ""
    n = max(1, len(text))
    lines, words = text.split("\n"), text.split()
    return [
        np.log1p(len(text)),
        np.log1p(len(lines)),
        len(_SYMBOL.findall(text)) / n,
        len(_UPPER.findall(text)) / n,
        len(_DIGIT.findall(text)) / n,
        text.count("|") / n,
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / len(lines),
        sum(map(len, words)) / max(1, len(words)),
        sum(w[-1] in ".,;:" for w in words) / max(1, len(words)),
    ]


def name_bucket(kind: str, value: str | None) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % 256


@dataclass
class View:
    """A logistic classifier of binary features, some of which may be bins of numbers."""

    edges: np.ndarray | None = None  # number x inner bin edges
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    bias: float = 0.0

    def active(self, words: np.ndarray | None, numbers: np.ndarray, names: tuple) -> np.ndarray:
        """Places of the features that a document has."""
        if self.edges is None:
            return words
        bins = [256 + i * BINS + int(np.searchsorted(e, x)) for i, (e, x) in enumerate(zip(self.edges, numbers))]
        return np.array([name_bucket("source", names[0]), name_bucket("lang", names[1]), *bins])

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        of = np.repeat(np.arange(len(rows)), sizes)
        places = np.concatenate(rows) if len(rows) else np.empty(0, dtype=np.int64)
        return self.bias + np.bincount(of, weights=self.weights[places], minlength=len(rows))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_view(view: View, rows: list[np.ndarray], y: np.ndarray, n_features: int, epochs: int = 12, seed: int = 0) -> None:
    """Adaptive stochastic gradient steps on the logistic loss with a slight pull towards zero.

    A word is worth as much as its log odds between the classes, so that few telling words outweigh
    many that hardly differ; features of the other view, which are few, are worth the same.  Those
    that fewer than ``LEAST_DOCUMENTS`` of the rows have keep the weight 0.
    """
    sizes = [len(r) for r in rows]
    often = np.bincount(np.concatenate(rows), minlength=n_features)
    ones = np.bincount(np.concatenate(rows), weights=np.repeat(y, sizes), minlength=n_features)
    total = max(1.0, y.sum())
    worth = np.abs(np.log((ones + 0.5) / (total + 1)) - np.log((often - ones + 0.5) / (len(y) - total + 1)))
    worth = np.where(often >= LEAST_DOCUMENTS, worth if view.edges is None else 1.0, 0.0)
    rows = [r[worth[r] > 0.2] for r in rows]
    w, squares = np.zeros(n_features), np.full(n_features, 1e-2)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    bias, bias_squares = float(np.log(share / (1 - share))), 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 64):
            own = order[start : start + 64]
            sizes = [len(rows[i]) for i in own]
            of = np.repeat(np.arange(len(own)), sizes)
            places = np.concatenate([rows[i] for i in own])
            values = worth[places]
            error = _sigmoid(bias + np.bincount(of, weights=w[places] * values, minlength=len(own))) - y[own]
            used, back = np.unique(places, return_inverse=True)
            gradient = np.bincount(back, weights=error[of] * values, minlength=len(used)) / len(own) + 1e-4 * w[used]
            squares[used] += gradient**2
            w[used] -= 0.3 * gradient / np.sqrt(squares[used])
            bias_squares += error.mean() ** 2
            bias -= 0.1 * error.mean() / np.sqrt(bias_squares)
    view.weights, view.bias = w * worth, bias


def calibrate(columns: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on a few columns, by Newton steps."""
    x = np.column_stack([columns, np.ones(len(columns))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + 1e-2 * w)
    return w


@dataclass
class TwoViews:
    """Both views of one target, their calibration, and the weights that combine them."""

    text: View
    page: View
    scales: list[np.ndarray]
    mixing: np.ndarray
    prior: float

    def probability(self, words: list[np.ndarray], pages: list[np.ndarray]) -> np.ndarray:
        if self.mixing is None:
            return np.full(len(words), self.prior)
        calibrated = [_scaled(v.margin(r), s) for v, r, s in zip((self.text, self.page), (words, pages), self.scales)]
        return _sigmoid(np.column_stack([*calibrated, np.ones(len(words))]) @ self.mixing)


def _scaled(margin: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip(margin * scale[0] + scale[1], -12, 12)


def co_train(words: list, pages: list, y: np.ndarray, edges: np.ndarray, rounds: int, n_features: int, n_page: int, pool: Unlabelled | None = None) -> TwoViews:
    """Trains both views; ``y`` is 0, 1, or -1 where there is no label.  Further documents without one are in ``pool``."""
    prior = float(y[y >= 0].mean()) if (y >= 0).any() else 0.5
    views = [View(), View(edges=edges)]
    known = np.flatnonzero(y >= 0)
    kept, fitted = known[::CALIBRATION], np.setdiff1d(known, known[::CALIBRATION])
    if len(np.unique(y[fitted])) < 2 or len(np.unique(y[kept])) < 2:
        return TwoViews(*views, [], None, prior)
    data, sizes = (list(words), list(pages)), (n_features, n_page)
    given: dict[int, int] = {}  # places of the documents from the pool
    examples = [dict(zip(fitted, y[fitted])) for _ in views]
    free = np.flatnonzero(y < 0)
    for turn in range(rounds + 1):
        for view, rows, size, own in zip(views, data, sizes, examples):
            places = np.array(list(own))
            fit_view(view, [rows[i] for i in places], np.array([own[i] for i in places], dtype=float), size, seed=turn)
        if turn == rounds or not (len(free) or pool):
            break
        # Both classes in the shares that labels have.
        most = [max(1, round(PER_ROUND * s)) for s in (1 - prior, prior)]
        if pool is not None:
            scales = [calibrate(v.margin([rows[i] for i in kept])[:, None], y[kept]) for v, rows in zip(views, data)]
            for k, doc_id, label, *row in pool.choose(views, scales, most, list(given)):
                if doc_id not in given:
                    given[doc_id] = len(data[0])
                    for rows, own in zip(data, row):
                        rows.append(own)
                examples[1 - k].setdefault(given[doc_id], label)
            continue
        margins = [v.margin([rows[i] for i in free]) for v, rows in zip(views, data)]
        for k, margin in enumerate(margins):
            scale = calibrate(views[k].margin([data[k][i] for i in kept])[:, None], y[kept])
            p = _sigmoid(_scaled(margin, scale))
            order = np.argsort(p, kind="stable")
            # None that the view isn't sure of.
            chosen = [(i, 0) for i in order[: most[0]] if p[i] <= 1 - SURE] + [(i, 1) for i in order[::-1][: most[1]] if p[i] >= SURE]
            for i, label in chosen:
                examples[1 - k].setdefault(free[i], label)
        free = np.setdiff1d(free, [i for e in examples for i in e])
    scales = [calibrate(v.margin([rows[i] for i in kept])[:, None], y[kept]) for v, rows in zip(views, data)]
    columns = np.column_stack([_scaled(v.margin([rows[i] for i in kept]), s) for v, rows, s in zip(views, data, scales)])
    return TwoViews(*views, scales, calibrate(columns, y[kept]), prior)


# --------------------------------------------------------------------------
# tables


def _sampled(ids: DataFrame, rows: int, size: int) -> DataFrame:
    """About ``size`` of the ids, by hash; all if there are fewer."""
    share = min(1.0, size / max(1, rows))
    return ids.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 24)) < int(share * (1 << 24)) + 1)


def _columns(docs: DataFrame, key: str) -> DataFrame:
    named = {"doc_id": F.col(key).cast("long"), "text": F.col("text").cast("string")}
    for name in ("source", "lang"):
        named[name] = F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
    return docs.select(*[c.alias(n) for n, c in named.items()])


FEATURES = "doc_id long, source string, lang string, words array<int>, numbers array<double>"


def features(docs: DataFrame) -> DataFrame:
    """The features of all documents that have an id; written."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            out = batch[["doc_id", "source", "lang"]].copy()
            out["words"] = word_features(texts)
            out["numbers"] = [layout(t) for t in texts]
            yield out

    return write_table(docs.filter("doc_id IS NOT NULL").mapInPandas(read, FEATURES))


@dataclass
class Unlabelled:
    """The documents without a label: all of ``features`` that ``labelled`` does not name."""

    features: DataFrame
    labelled: DataFrame

    def choose(self, views: list[View], scales: list[np.ndarray], most: list[int], taken: list[int]) -> Iterator[tuple]:
        """Per view and class at most ``most`` documents, those that the view is surest of among all that are not ``taken``.

        Gives the view, the id, the class, and the document's features in both views.
        """
        known = self.features.sparkSession.sparkContext.broadcast((views, scales))

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            views, scales = known.value
            for batch in batches:
                rows = _active(views[1], batch)
                p = [_sigmoid(_scaled(v.margin(r), s)) for v, r, s in zip(views, rows, scales)]
                sure = np.any([(x <= 1 - SURE) | (x >= SURE) for x in p], axis=0)
                yield pd.DataFrame({"doc_id": batch["doc_id"], "p0": p[0], "p1": p[1]})[sure]

        judged = self.features.mapInPandas(judge, "doc_id long, p0 double, p1 double")
        # Of repeated ids one row counts.
        judged = judged.groupBy("doc_id").agg(F.min(F.struct("p0", "p1")).alias("p")).select("doc_id", "p.*")
        judged = write_table(judged.join(self.labelled.select("doc_id"), "doc_id", "left_anti").filter(~F.col("doc_id").isin(taken)))
        chosen = []
        for k in range(2):
            p = F.col(f"p{k}")
            for label, sure, order in ((0, p <= 1 - SURE, p.asc()), (1, p >= SURE, p.desc())):
                surest = judged.filter(sure).orderBy(order, F.xxhash64("doc_id", F.lit(11))).limit(most[label])
                chosen += [(k, r["doc_id"], label) for r in surest.select("doc_id").collect()]
        if not chosen:
            return
        found = _of_ids(self.features, sorted({doc_id for _, doc_id, _ in chosen}))
        rows = dict(zip(found["doc_id"], zip(*_active(views[1], found))))
        for k, doc_id, label in chosen:
            yield k, doc_id, label, *rows[doc_id]


def _of_ids(table: DataFrame, ids: list[int]) -> pd.DataFrame:
    """The rows of a few thousand documents, one for each id."""
    wanted = table.sparkSession.createDataFrame([(int(i),) for i in ids], "doc_id long")
    return table.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()


def _active(page: View, rows: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places of the features of both views."""
    words = [np.asarray(w, dtype=np.int32) for w in rows["words"]]
    return words, [page.active(None, n, (s, g)) for n, s, g in zip(rows["numbers"], rows["source"], rows["lang"])]


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> dict[str, TwoViews]:
    by_doc = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(t).cast("int").alias(t) for t in TARGETS])
    by_doc = write_table(by_doc)
    table = features(docs)
    shares = [i / BINS for i in range(1, BINS)]
    found = table.agg(*[F.percentile_approx(F.col("numbers")[i], shares).alias(f"n{i}") for i in range(NUMBERS)]).first()
    edges = np.array([e or [0.0] * len(shares) for e in found])
    page = View(edges=edges)
    # At most about LABELLED rows are broadcast and collected.
    labelled = _sampled(by_doc, by_doc.count(), LABELLED)
    found = table.join(F.broadcast(labelled), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    words, pages = _active(page, found)
    # A hash puts the labelled documents in an order that has nothing to do with their ids.
    order = np.argsort([zlib.crc32(str(i).encode()) for i in found["doc_id"]], kind="stable")
    words, pages = [words[i] for i in order], [pages[i] for i in order]
    targets = {t: found[t].fillna(-1).astype(int).to_numpy()[order] if len(found) else np.empty(0, dtype=int) for t in TARGETS}
    pools = {t: Unlabelled(table, by_doc.filter(F.col(t).isNotNull())) for t in TARGETS}
    return {t: co_train(words, pages, y, edges, rounds, 1 << WORD_BITS, 256 + NUMBERS * BINS, pools[t]) for t, y in targets.items()}


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """``key, quality, toxic, keep`` of every document: probabilities, and good and not toxic.

    ``labels`` has ``doc_id, quality, toxic``, 0 or 1 or null; of repeated labels the larger counts.
    Null texts have the layout of an empty text; columns ``source`` and ``lang`` are used where they
    exist.  Where labels of one class only are given, all documents get the share of that class, and
    without any 0.5, which keeps them.  Repeated rows give a row each; an empty table gives none.
    """
    rows = _columns(docs, key)
    models = train(rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), *TARGETS), rounds)
    known = docs.sparkSession.sparkContext.broadcast(models)

    def judge(texts: pd.Series, sources: pd.Series, langs: pd.Series) -> pd.DataFrame:
        models = known.value
        page = models[TARGETS[0]].page
        words = word_features(texts.tolist())
        pages = [page.active(None, layout(t), (s, g)) for t, s, g in zip(texts, sources, langs)]
        return pd.DataFrame({t: models[t].probability(words, pages) for t in TARGETS})

    judged = rows.select("doc_id", F.pandas_udf(judge, "quality double, toxic double")("text", "source", "lang").alias("p"))
    keep = (F.col("p.quality") >= 0.5) & (F.col("p.toxic") <= 0.5)
    return judged.select(F.col("doc_id").alias(key), "p.quality", "p.toxic", keep.alias("keep"))
