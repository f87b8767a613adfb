"""Quality classifier: a generalised additive model with pairwise interactions.

Each whole text becomes a short vector of counts and shares. Every feature is cut into bins at training quantiles;
cyclic boosting visits the features in turn and adds a shallow tree (four leaves at most) on the residuals to the
feature's lookup table. The feature pairs whose quadrants still explain most residual get two-dimensional tables by
trees of two cuts, one along either feature. A score is the logistic of the intercept and one table entry per feature and pair: bin
lookups and additions over whole batches. Fitting uses a bounded sample (`labelled.MAX_PER_CLASS` a class).

Edge cases: null texts are empty and score as such; labels other than 0 and 1 are ignored, a document labelled twice
counts as good if one label says so; with one class only every score is that class's smoothed share; a null doc_id is
scored, never held out, never trained on; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import MAX_PER_CLASS, training_rows
from .textarrays import row_bounds, runs, slices, span_hashes, words

BINS, ROUNDS, PAIRS, PAIR_ROUNDS, STEP, MIN_LEAF = 32, 150, 8, 60, 0.15, 20
THRESHOLD = 0.3

CLASSES = ["lower", "upper", "digit", "space", "newline", "stop", "comma", "mark", "bar", "symbol", "high", "other"]
_CLASS = np.full(256, CLASSES.index("other"))
for _name, _bytes in {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": [32, 9, 11, 12, 13], "newline": [10], "stop": [46],
    "comma": [44, 58, 59], "mark": [33, 63], "bar": [124], "symbol": [ord(c) for c in "#$%&*@^~=+_<>{}[]\\/"], "high": range(128, 256),
}.items():
    _CLASS[list(_bytes)] = CLASSES.index(_name)
FEATURES = ["bytes", *CLASSES, "words", "word_bytes", "long_words", "capitals", "same_as_last", "distinct_words", "commonest_word", "lines", "distinct_lines", "words_a_stop"]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, features) of a slice; empty rows are all zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row_of = np.repeat(np.arange(n), size)
    kinds = np.bincount(row_of * len(CLASSES) + _CLASS[data], minlength=n * len(CLASSES)).reshape(n, -1)
    per = lambda a, b: np.divide(a, b, out=np.zeros(n), where=np.asarray(b) > 0, casting="unsafe")
    starts, ends, row = words(data, offsets)
    h = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=n)
    length = ends - starts
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    upper = (_CLASS[data[starts]] == CLASSES.index("upper")) if len(starts) else np.zeros(0, bool)
    line_start, line_end, line_row = runs(data != 10, offsets)
    lines = span_hashes(data, line_start, line_end)
    distinct, commonest, distinct_lines = np.zeros(n), np.zeros(n), np.zeros(n)
    wb, lb = row_bounds(row, n), row_bounds(line_row, n)
    for i in range(n):
        if wb[i] < wb[i + 1]:
            s = np.sort(h[wb[i] : wb[i + 1]])
            new = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            distinct[i] = len(new)
            commonest[i] = np.diff(np.append(new, len(s))).max()
        if lb[i] < lb[i + 1]:
            distinct_lines[i] = len(np.unique(lines[lb[i] : lb[i + 1]]))
    n_lines = np.diff(lb)
    byte_share = [per(kinds[:, j], size) for j in range(len(CLASSES))]
    word = lambda x: per(np.bincount(row, weights=x, minlength=n), count)
    cols = [np.log1p(size), *byte_share, np.log1p(count), word(length), word(length > 14), word(upper), word(same), per(distinct, count), per(commonest, count), per(n_lines, count), per(distinct_lines, n_lines)]
    cols.append(np.log1p(per(count, kinds[:, CLASSES.index("stop")] + 1)))
    out = np.stack(cols, axis=1)
    out[size == 0] = 0
    return out


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]  # by feature
    tables: np.ndarray  # (features, BINS)
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray  # (pairs, BINS * BINS)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        if len(self.edges):
            b = self.bins(x)
            for j, table in enumerate(self.tables):
                z += table[b[:, j]]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                z += table[b[:, i] * BINS + b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _cut(g: np.ndarray, c: np.ndarray) -> tuple[int, float]:
    """The best split point of a histogram of residual sums and weights, and its gain."""
    left, weight = np.cumsum(g)[:-1], np.cumsum(c)[:-1]
    if not len(left):
        return 0, 0.0
    right, rest = g.sum() - left, c.sum() - weight
    gain = np.where((weight > 0) & (rest > 0), left**2 / (weight + 1) + right**2 / (rest + 1) - g.sum() ** 2 / (c.sum() + 1), 0)
    k = int(np.argmax(gain))
    return k + 1, float(gain[k])


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Newton steps of a tree of depth 2 over the bins of one feature."""
    out = np.zeros(len(g))
    first, gain = _cut(g, h)
    parts = [(0, first), (first, len(g))] if gain > 0 else [(0, len(g))]
    for a, b in parts:
        k, more = _cut(g[a:b], h[a:b])
        for x, y in [(a, a + k), (a + k, b)] if more > 0 else [(a, b)]:
            if n[x:y].sum() >= MIN_LEAF:
                out[x:y] = g[x:y].sum() / (h[x:y].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over two features: one cut along the first, then one along the second on either side, or the other way round."""
    best, most = np.zeros_like(g), 0.0
    for turn in (False, True):
        gg, hh, nn = (x.T if turn else x for x in (g, h, n))
        k, _ = _cut(gg.sum(axis=1), hh.sum(axis=1))
        out, gain = np.zeros_like(gg), 0.0
        for a, b in ((0, k), (k, len(gg))):
            if a == b:
                continue
            m, _ = _cut(gg[a:b].sum(axis=0), hh[a:b].sum(axis=0))
            for x, y in ((0, m), (m, gg.shape[1])):
                if nn[a:b, x:y].sum() >= MIN_LEAF:
                    s, w = gg[a:b, x:y].sum(), hh[a:b, x:y].sum() + 1
                    out[a:b, x:y] = s / w
                    gain += s * s / w
        if gain > most:
            best, most = (out.T if turn else out), gain
    return best, most


def train(x: np.ndarray, y: np.ndarray) -> Model:
    share = (y.sum() + 1) / (len(y) + 2)
    none = Model(float(np.log(share / (1 - share))), [], np.zeros((0, BINS)), [], np.zeros((0, BINS * BINS)))
    if not len(y) or y.all() or not y.any():
        return none
    f = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(f)]
    model = Model(none.intercept, edges, np.zeros((f, BINS)), [], np.zeros((0, BINS * BINS)))
    b = model.bins(x)
    z = np.full(len(y), model.intercept)
    weight = np.where(y, 0.5 / y.mean(), 0.5 / (1 - y.mean()))

    def residuals():
        p = 1 / (1 + np.exp(-z))
        return weight * (y - p), weight * p * (1 - p)

    sizes = [np.bincount(b[:, j], minlength=BINS) for j in range(f)]
    for _ in range(ROUNDS):
        for j in range(f):
            g, h = residuals()
            step = STEP * _tree(np.bincount(b[:, j], weights=g, minlength=BINS), np.bincount(b[:, j], weights=h, minlength=BINS), sizes[j])
            model.tables[j] += step
            z += step[b[:, j]]
    g, h = residuals()
    grid = lambda i, j, v: np.bincount(b[:, i] * BINS + b[:, j], weights=v, minlength=BINS * BINS).reshape(BINS, BINS)
    ones = np.ones(len(y))
    found = sorted((-_quadrants(grid(i, j, g), grid(i, j, h), grid(i, j, ones))[1], i, j) for i in range(f) for j in range(i))
    model.pairs = [(i, j) for _, i, j in found[:PAIRS]]
    model.pair_tables = np.zeros((len(model.pairs), BINS * BINS))
    counts = [grid(i, j, ones) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = residuals()
            step = STEP * _quadrants(grid(i, j, g), grid(i, j, h), counts[k])[0].ravel()
            model.pair_tables[k] += step
            z += step[b[:, i] * BINS + b[:, j]]
    return model


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            x = features(data, offsets)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), lists], names=["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = MAX_PER_CLASS) -> Model:
    rows = training_rows(docs, labels, "quality", held_out, per_class)
    table = rows.mapInArrow(_featurise, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    y = table.column("label").to_numpy().astype(bool)
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1) if len(y) else np.zeros((0, len(FEATURES)))
    return train(x, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (the chance of label 1 under equally frequent classes)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(shared.value.predict(features(data, offsets)))], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")
