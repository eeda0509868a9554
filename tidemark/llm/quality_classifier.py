"""Quality and toxicity by co-training of a text view and a metadata view.

Two logistic models see disjoint views of a document: its words and characters, and its
metadata (source, language, declared size). In every round each model labels the unlabelled
sample's documents of which it is most certain, for the other to learn from. Both are then
calibrated on labelled documents kept out of training, and their log-odds, less the prior that
both contain, add up to the score of every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import slices, text_buffer, words

# Bounds of the training sample, in documents.
LABELLED, UNLABELLED = 4_000, 2_000
ROUNDS = 3
# Share of the unlabelled documents that a view labels in a round, and how certain it must be.
SHARE, CERTAIN = 0.1, 0.95
# A word is a feature if it is in so many documents of the sample.
MIN_DOCS = 8
META_BINS = 512
TARGETS = ("quality", "toxic")

_MARKS = np.flatnonzero([33 <= i < 127 and not chr(i).isalnum() for i in range(128)])


def _document_words(data, offsets):
    of, _, _, hashes = words(data, offsets, plain=True)
    return of, hashes


def dense_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of signs, capitals and digits, word sizes and repetition of every text."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(text * 256 + data, minlength=n * 256).reshape(n, 256)
    of, starts, ends, hashes = words(data, offsets)
    size = np.maximum(np.bincount(of, minlength=n), 1)
    total = np.maximum(np.diff(offsets), 1)
    pairs = np.unique(np.stack([of.astype(np.uint64), hashes]), axis=1)[0] if len(of) else np.zeros(0, np.uint64)
    distinct = np.bincount(pairs.astype(np.int64), minlength=n)
    columns = [np.log1p(counts[:, mark] / size) for mark in _MARKS]
    columns += [
        counts[:, 65:91].sum(1) / total, counts[:, 48:58].sum(1) / total, counts[:, 10] / size,
        np.bincount(of, ends - starts, n) / size, np.log1p(size), distinct / size, (size < 20).astype(float),
    ]
    return np.stack(columns, 1)


def meta_bins(source, lang, n_chars) -> np.ndarray:
    """Bins of source, language and declared size of each row (three per row)."""

    def bin_of(kind: int, value) -> int:
        hashed = 0
        for byte in repr(value).encode():
            hashed = (hashed * 1_000_003 + byte + kind) & 0xFFFFFFFF
        return hashed % META_BINS

    return np.array(
        [[bin_of(1, s), bin_of(2, l), bin_of(3, None if c is None else int(np.log2(max(c, 1)) * 2))] for s, l, c in zip(source, lang, n_chars)],
        np.int64,
    ).reshape(-1, 3)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse rows of a feature matrix."""

    def __init__(self, row, column, n_rows: int, n_columns: int, values=None):
        self.row, self.column, self.shape = row, column, (n_rows, n_columns)
        self.values = np.ones(len(row)) if values is None else values

    def __matmul__(self, w):
        return np.bincount(self.row, self.values * w[self.column], self.shape[0])

    def back(self, g):
        return np.bincount(self.column, self.values * g[self.row], self.shape[1])


def fit_logistic(rows: Rows, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (the last is the bias) by Adam on the weighted log loss; rows of weight 0 are unseen."""
    w = np.zeros(rows.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    total = max(weight.sum(), 1)
    for step in range(1, steps + 1):
        error = (_sigmoid(rows @ w[:-1] + w[-1]) - y) * weight
        gradient = np.append(rows.back(error) + l2 * w[:-1], error.sum()) / total
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        w -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (0 or more) and offset that make margins log-odds of y."""
    if len(y) < 10 or y.min() == y.max():
        return 1.0, 0.0
    scale = margin.std() + 1e-9
    rows = Rows(np.arange(len(y)), np.zeros(len(y), np.int64), len(y), 1, margin / scale)
    slope, offset = fit_logistic(rows, y, np.ones(len(y)), 0.1, 200)
    return max(slope, 0.0) / scale, offset


@dataclass
class View:
    weights: np.ndarray
    slope: float
    offset: float

    def log_odds(self, rows: Rows) -> np.ndarray:
        return self.slope * (rows @ self.weights[:-1] + self.weights[-1]) + self.offset


@dataclass
class Model:
    vocabulary: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    views: dict[str, tuple[View, View]]
    prior: dict[str, float]

    def text_rows(self, data, offsets) -> Rows:
        n = len(offsets) - 1
        of, hashes = _document_words(data, offsets)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), max(len(self.vocabulary) - 1, 0))
        known = self.vocabulary[at] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)
        pairs = np.unique(of[known] * len(self.vocabulary) + at[known]) if known.any() else np.zeros(0, np.int64)
        dense = np.clip((dense_features(data, offsets) - self.mean) / self.spread, -5, 5)
        k = dense.shape[1]
        width = max(len(self.vocabulary), 1)
        return Rows(
            np.concatenate([pairs // width, np.repeat(np.arange(n), k)]), np.concatenate([pairs % width + k, np.tile(np.arange(k), n)]),
            n, k + len(self.vocabulary), np.concatenate([np.ones(len(pairs)), dense.ravel()]),
        )

    def score(self, data, offsets, bins) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per target: probabilities by text, by metadata and by both."""
        n = len(offsets) - 1
        text, meta = self.text_rows(data, offsets), Rows(np.repeat(np.arange(n), 3), bins.ravel(), n, META_BINS)
        out = {}
        for target, (by_text, by_meta) in self.views.items():
            a, b = by_text.log_odds(text), by_meta.log_odds(meta)
            out[target] = _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior[target])
        return out


def co_train(text: Rows, meta: Rows, y: np.ndarray, train: np.ndarray, held: np.ndarray, rounds: int = ROUNDS) -> tuple[tuple[View, View], float]:
    """Both views of a target; ``y`` is -1 where unlabelled, ``held`` marks labelled rows for calibration."""
    prior = float(np.clip(y[train].mean() if train.any() else 0.5, 1e-3, 1 - 1e-3))
    # Both classes weigh the same, so that rare ones count.
    balance = np.where(y == 1, 0.5 / prior, 0.5 / (1 - prior))
    views = (text, meta)
    labels = [np.where(train, y, -1).astype(float) for _ in views]
    weights = [np.zeros(0), np.zeros(0)]
    for turn in range(rounds + 1):
        for k, rows in enumerate(views):
            seen = labels[k] >= 0
            weight = np.where(seen, np.where(train, balance, np.where(labels[k] == 1, 0.5 / prior, 0.5 / (1 - prior)) * 0.5), 0.0)
            weights[k] = fit_logistic(rows, np.maximum(labels[k], 0), weight)
        if turn == rounds:
            break
        for k, rows in enumerate(views):
            p = _sigmoid(rows @ weights[k][:-1] + weights[k][-1])
            free = np.flatnonzero((y < 0) & (labels[1 - k] < 0))
            sure = free[np.argsort(-np.abs(p[free] - 0.5), kind="stable")][: int(SHARE * len(free)) + 1]
            sure = sure[np.abs(p[sure] - 0.5) >= CERTAIN - 0.5]
            labels[1 - k][sure] = p[sure] > 0.5
    done = []
    for rows, w in zip(views, weights):
        done.append(View(w, *calibrate((rows @ w[:-1] + w[-1])[held], y[held])))
    return tuple(done), float(np.log(prior / (1 - prior)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from at most LABELLED labelled and UNLABELLED other documents, drawn by a hash of the id.

    Labels outside 0 and 1, null labels and labels of unknown documents are left out; of several
    labels of a document the least counts.
    """
    known = labels.where(" OR ".join(f"{t} IN (0, 1)" for t in TARGETS)).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.min(F.when(F.col(t).isin(0, 1), F.col(t))).alias(t) for t in TARGETS]
    )
    order = F.xxhash64("doc_id", F.lit(11))
    some = known.orderBy(order, "doc_id").limit(LABELLED)
    others = docs.select("doc_id").where("doc_id IS NOT NULL").join(known.select("doc_id"), "doc_id", "left_anti").orderBy(order, "doc_id").limit(UNLABELLED)
    ids = some.union(others.select("doc_id", *[F.lit(None).cast("int").alias(t) for t in TARGETS]))
    drawn = docs.select("doc_id", "text", "source", "lang", "n_chars").join(F.broadcast(ids), "doc_id")  # LABELLED + UNLABELLED rows
    rows = drawn.withColumn("text", F.coalesce("text", F.lit(""))).toArrow().combine_chunks()
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    batches = rows.to_batches() or []
    bins = meta_bins(*(rows.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
    parts, dense = [], []
    for part in slices(batches):
        data, offsets = text_buffer(part.column(1))
        of, hashes = _document_words(data, offsets)
        parts.append(np.unique(np.stack([of.astype(np.uint64), hashes]), axis=1)[1])
        dense.append(dense_features(data, offsets))
    terms, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, int))
    dense = np.concatenate(dense) if dense else np.zeros((0, len(_MARKS) + 7))
    mean, spread = (dense.mean(0), dense.std(0) + 1e-6) if len(dense) else (np.zeros(dense.shape[1]), np.ones(dense.shape[1]))
    model = Model(terms[count >= MIN_DOCS], mean, spread, {}, {})
    made = [model.text_rows(*text_buffer(part.column(1))) for part in slices(batches)]
    shift = np.cumsum([0] + [m.shape[0] for m in made])
    n = int(shift[-1])
    width = len(mean) + len(model.vocabulary)
    text = Rows(
        np.concatenate([m.row + s for m, s in zip(made, shift)] or [np.zeros(0, int)]), np.concatenate([m.column for m in made] or [np.zeros(0, int)]),
        n, width, np.concatenate([m.values for m in made] or [np.zeros(0)]),
    )
    meta = Rows(np.repeat(np.arange(n), 3), bins.ravel(), n, META_BINS)
    held_out = (np.arange(n) % 5) == 0
    for target in TARGETS:
        y = np.array([-1 if v is None else v for v in rows.column(target).to_pylist()], np.int64)
        views, prior = co_train(text, meta, y, (y >= 0) & ~held_out, (y >= 0) & held_out)
        model.views[target], model.prior[target] = views, prior
    return model


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, scores by view and by both for quality and toxicity, and ``kept``, for every row.

    The whole text is read; a null text is an empty one, null metadata are values like others.
    ``kept``: quality of 0.5 or more and toxicity below 0.5. Repeated rows are judged alike,
    columns besides the documents' own are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        own = shared.value
        for part in slices(batches):
            data, offsets = text_buffer(part.column(1))
            scores = own.score(data, offsets, meta_bins(*(part.column(i).to_pylist() for i in (2, 3, 4))))
            (text, meta, score), (_, _, toxic) = scores["quality"], scores["toxic"]
            kept = (score >= 0.5) & (toxic < 0.5)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, (text, meta, score, toxic, kept))],
                names=["doc_id", "text_score", "meta_score", "score", "toxic_score", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "source", "lang", "n_chars").mapInArrow(
        run, f"doc_id {kind}, text_score double, meta_score double, score double, toxic_score double, kept boolean"
    )


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
