"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, learnt from document labels.

A sentence's score is the logistic of a bias and the weights of its distinct hashed features: words, and beginnings of
words, which stay when endings change. A document is toxic unless
all its sentences are clean: P = 1 - prod(1 - p). Gradients of the document loss train the sentence weights: first with an
L1 step that leaves weights only on words that explain labels, then over these words alone. The same scores locate
offending sentences.
Fitting uses a bounded sample (`PER_CLASS` documents a class); scoring reads every whole text.

Edge cases: null, empty and wordless texts have score 0; labels other than 0 and 1 are ignored, a document labelled
twice counts as toxic if one label says so; without both classes every score is 0; a null doc_id is scored, is never
held out and never trained on; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import _bit_test, _bitmap
from .labelled import training_rows
from .shared import Scratch
from .textarrays import LOWER, U64, runs, slices, span_hashes

#: Most labelled documents of either class that are fitted on.
PER_CLASS = 2000
BUCKETS = 1 << 22
#: Pairs of word and sentence that a gradient takes at once.
BLOCK = 1 << 18
PREFIXES = (4, 5, 6)
MIN_DOCUMENTS = 3
CHOOSE_EPOCHS, CHOOSE_RATE, L1, BIAS = 60, 0.3, 1e-3, -4.0
SET_EPOCHS, SET_RATE, L2 = 500, 0.1, 1e-4
THRESHOLD = 0.3

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    bias: float
    buckets: np.ndarray  # of weights other than 0, ascending
    weights: np.ndarray


def sentences(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: start, end, row and sentence; sentences are numbered over the slice and end at . ! ? or a newline."""
    starts, ends, row = runs(WORD[low], offsets)
    raw = np.searchsorted(np.flatnonzero(STOP[low]), starts) + row
    new = np.ones(len(raw), bool)
    new[1:] = (raw[1:] != raw[:-1]) | (row[1:] != row[:-1])
    return starts, ends, row, np.cumsum(new) - 1


def features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of every feature: the word, and its first bytes where it is longer."""
    word = np.arange(len(starts))
    found = [(span_hashes(low, starts, ends), word)]
    for n in PREFIXES:
        long = np.flatnonzero(ends - starts > n)
        found.append((span_hashes(low, starts[long], starts[long] + n) ^ U64(n), long))
    bucket, word = (np.concatenate(x) for x in zip(*found, strict=True))
    return (bucket % U64(BUCKETS)).astype(np.int64), word


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: label, and its distinct (sentence, bucket) pairs."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            low, n = LOWER[data], hi - lo
            starts, ends, row, sentence = sentences(low, offsets)
            bucket, word = features(low, starts, ends)
            pair = np.unique(sentence[word] * BUCKETS + bucket)
            of = np.zeros(int(sentence[-1]) + 1 if len(sentence) else 0, np.int64)
            of[sentence] = row
            bounds = pa.array(np.searchsorted(of[pair // BUCKETS], np.arange(n + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (pair // BUCKETS, pair % BUCKETS)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), batch.column("label").slice(lo, n), *lists], names=["doc_id", "label", "sentence", "bucket"])


SAMPLE = "doc_id long, label int, sentence array<int>, bucket array<int>"


def _telling(shared):
    """The pairs whose bucket is known, and of a sentence without any its first pair, so that it still counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            size = pc.list_value_length(batch.column("bucket")).to_numpy()
            sentence, bucket = (batch.column(c).flatten().to_numpy() for c in ("sentence", "bucket"))
            doc = np.repeat(np.arange(len(size)), size)
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (sentence[1:] != sentence[:-1])
            own = np.cumsum(new) - 1
            keep = _bit_test(known, bucket.astype(U64))
            keep |= new & (np.bincount(own, weights=keep) == 0)[own] if len(own) else keep
            bounds = pa.array(np.append(0, np.cumsum(np.bincount(doc[keep], minlength=len(size)))), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *(pa.ListArray.from_arrays(bounds, pa.array(x[keep])) for x in (sentence, bucket))], names=["doc_id", "label", "sentence", "bucket"])

    return run


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = PER_CLASS) -> Model:
    rows = training_rows(docs, labels, "toxic", held_out, per_class)
    # Features of few documents say nothing: Spark counts them, and the driver gets the pairs of the others.
    found = Scratch(docs.sparkSession, "toxicity").write(rows.mapInArrow(_featurise, SAMPLE), "features")
    often = found.select(F.explode(F.array_distinct("bucket")).alias("v")).groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    known = docs.sparkSession.sparkContext.broadcast(_bitmap(often.select(F.col("v").cast("long").alias("v")), BUCKETS))
    table = found.mapInArrow(_telling(known), SAMPLE).orderBy("doc_id").toArrow()
    y = table.column("label").to_numpy().astype(bool)
    if not len(y):
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), y)
    size = pc.list_value_length(table.column("bucket")).to_numpy()
    # Chunk by chunk, so that no second table is held.
    words, local = (np.concatenate([x.flatten().to_numpy() for x in table.column(c).chunks]) for c in ("bucket", "sentence"))
    del table
    return train(words, local, np.repeat(np.arange(len(y), dtype=np.int32), size), y)


def train(words: np.ndarray, local: np.ndarray, doc: np.ndarray, y: np.ndarray) -> Model:
    """Two fits of the noisy-or log loss: one with an L1 step chooses words, one over these alone sets weights and bias.

    words: buckets; local: sentence within the document; doc ascends.
    """
    if not len(words) or y.all() or not y.any():
        return Model(-50.0, np.zeros(0, np.int64), np.zeros(0))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (local[1:] != local[:-1])
    sentence, doc_of = np.cumsum(new, dtype=np.int32) - 1, doc[new]
    # Features of few documents can't be told from chance. Counted a document at a time, which holds no second copy of all pairs.
    count = np.zeros(int(words.max()) + 1, np.int32)
    bounds = np.searchsorted(doc, np.arange(len(y) + 1))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        count[np.unique(words[lo:hi])] += 1
    often = count >= MIN_DOCUMENTS
    names, keep = np.flatnonzero(often), often[words]
    words, in_sentence = (np.cumsum(often, dtype=np.int32) - 1)[words[keep]], sentence[keep]
    del new, sentence, local, doc, count, often, keep
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    w, b = np.zeros(len(names)), BIAS
    gw = np.full(len(names), 1e-10)
    plain = np.ones(len(doc_of))
    for _ in range(CHOOSE_EPOCHS):
        g, gb = _gradient(w, b, words, in_sentence, doc_of, plain, y, share)
        gw += g * g
        step = CHOOSE_RATE / np.sqrt(gw)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b -= 3 * gb
    some = np.flatnonzero(w)
    if not len(some):
        return Model(-50.0, np.zeros(0, np.int64), np.zeros(0))
    # Sentences without a chosen word differ in nothing: one stands for all of a document, with their number.
    keep = np.isin(words, some)
    words, sentence = np.searchsorted(some, words[keep]), in_sentence[keep]
    with_word, sentence = np.unique(sentence, return_inverse=True)
    rest = np.bincount(doc_of, minlength=len(y)) - np.bincount(doc_of[with_word], minlength=len(y))
    doc_of = np.concatenate([doc_of[with_word], np.arange(len(y))])
    times = np.concatenate([np.ones(len(with_word)), rest])
    x = np.append(w[some], b)
    mean, square = np.zeros(len(x)), np.zeros(len(x))
    for k in range(1, SET_EPOCHS + 1):
        g = np.append(*_gradient(x[:-1], x[-1], words, sentence, doc_of, times, y, share))
        g[:-1] += L2 * x[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        x = x - SET_RATE * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return Model(float(x[-1]), names[some], x[:-1])


def _gradient(w, b, words, sentence, doc_of, times, y, share) -> tuple[np.ndarray, float]:
    """Of the mean loss by word weights and bias. Sentence i stands `times[i]` times in its document; sentences ascend.

    Pairs are worked on in blocks, so that no array of their number is made beside them.
    """
    z, out = np.full(len(doc_of), b), np.zeros(len(w))
    blocks = [slice(lo, lo + BLOCK) for lo in range(0, len(words), BLOCK)]
    for x in blocks:
        first = int(sentence[x.start])
        part = np.bincount(sentence[x] - first, weights=w[words[x]])
        z[first : first + len(part)] += part
    q = np.bincount(doc_of, weights=times * np.logaddexp(0, z), minlength=len(y))
    slope = np.where(y, -1 / np.maximum(np.expm1(np.minimum(q, 500)), 1e-6), 1.0) * share
    d = slope[doc_of] * times / (1 + np.exp(-np.clip(z, -500, 500)))
    for x in blocks:
        out += np.bincount(words[x], weights=d[sentence[x]], minlength=len(w))
    return out, float(d.sum())


def sentence_scores(model: Model, bucket: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """softplus(z) of every sentence of a slice: -log of the chance that it is clean. bucket, sentence: of each feature."""
    z = np.full(n, model.bias)
    if len(model.buckets):
        at = np.minimum(np.searchsorted(model.buckets, bucket), len(model.buckets) - 1)
        hit = model.buckets[at] == bucket
        pair = np.unique(sentence[hit] * len(model.buckets) + at[hit])
        z += np.bincount(pair // len(model.buckets), weights=model.weights[pair % len(model.buckets)], minlength=n)
    return np.logaddexp(0, z)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = np.zeros(BUCKETS, bool)
        known[model.buckets] = True
        cut = -np.log1p(-0.5)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                n, low = hi - lo, LOWER[data]
                starts, ends, row, sentence = sentences(low, offsets)
                bucket, word = features(low, starts, ends)
                some = known[bucket]
                first = np.flatnonzero(np.diff(sentence, prepend=-1))
                q = sentence_scores(model, bucket[some], sentence[word[some]], len(first))
                owner = row[first]
                total = np.bincount(owner, weights=q, minlength=n)
                bad = np.bincount(owner, weights=q >= cut, minlength=n).astype(np.int64)
                order = np.lexsort((-np.arange(len(q)), q, owner))
                worst = order[np.flatnonzero(np.append(owner[order][1:] != owner[order][:-1], True))] if len(q) else np.zeros(0, np.int64)
                last = np.append(first[1:], len(sentence)) - 1
                where = np.full((2, n), -1)
                where[0, owner[worst]] = starts[first[worst]] - offsets[owner[worst]]
                where[1, owner[worst]] = ends[last[worst]] - offsets[owner[worst]]
                cols = [pa.array(-np.expm1(-total)), pa.array(bad), *(pa.array(x, pa.int64(), mask=bad == 0) for x in where)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), *cols], names=["doc_id", "score", "offending_sentences", "worst_start", "worst_end"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, how many sentences are likelier toxic than not, and the worst one's UTF-8 byte span (null if none is)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score(shared), "doc_id long, score double, offending_sentences long, worst_start long, worst_end long")


def not_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the model does not reject, scored in place."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _score(shared)
        for batch in batches:
            text = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], names=["doc_id", "text"])
            scores = np.concatenate([np.zeros(0), *(x.column("score").to_numpy() for x in own([text]))])
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
