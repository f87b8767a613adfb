"""Substring dedup: content-defined chunks with a gear rolling hash find what repeats, exact windows say how far.

1. A gear hash of the last `WINDOW` bytes decides where a chunk ends, so equal passages get equal chunks wherever they
   stand, and an insertion moves no other chunk. Where no cut came for `DRY` bytes (periodic text), words are chunks. No
   least or greatest length is enforced, so that cuts depend on the bytes just before them alone.
2. Chunks are deduplicated by digest: digests that occur more than once fill a bitmap of fixed size.
3. A window of `min_words` words can occur elsewhere only if every chunk that its own bytes determine is such a chunk.
   Those windows are hashed whole and counted. One is repeated where it stands, byte for byte, in a lesser doc_id or
   earlier in its own row; overlapping and neighbouring repeated windows are one passage. Chunks prune alone, so no
   passage is missed, whatever the bitmap's size; a fuller one only prunes less.

Edge cases: null texts are empty and repeat nothing; within one text later occurrences are repeated too; a null doc_id
takes no part; a text that repeats itself without a break keeps its first period only, since every later window overlaps
the first one (a word a hundred times stays once); rows that share a doc_id don't repeat each other and each keeps its first occurrence, `text_hash` (32
bits of a hash of the text) tells their passages apart; rows with equal doc_id and text count as one; texts of any
length are worked on as a whole, one at a time; extra columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import _bit_test, _bitmap
from .shared import Scratch
from .textarrays import IS_SPACE, U64, keyed, signed, slices, span_hashes, words

WINDOW, DRY = 16, 64
CUT_BITS = 5
PASSAGE_WORDS = 50
DIGEST_BITS = 1 << 26
_GEAR = keyed(256, 23).astype(np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, reach): where chunks begin inside rows, and how many bytes before a place decide that it is one."""
    h = _GEAR[data]
    shift = 1
    while shift < WINDOW:
        h[shift:] += h[:-shift] << np.uint32(shift)
        shift *= 2
    at = np.flatnonzero((h >> np.uint32(WINDOW - CUT_BITS)) & np.uint32((1 << CUT_BITS) - 1) == 0) + 1
    begin = offsets[np.searchsorted(offsets, at, side="right") - 1]
    at = at[at - begin >= WINDOW]
    # Gaps of more than DRY bytes, of a row's own: there the beginnings of words cut.
    bound = np.union1d(at, offsets)
    wide = np.flatnonzero(np.diff(bound) > DRY)
    if not len(wide):
        return at, np.full(len(at), WINDOW)
    own_row = np.isin(bound[wide], offsets)
    lo, hi = bound[wide] + np.where(own_row, DRY + WINDOW, DRY), bound[wide + 1]
    size = np.maximum(hi - lo, 0)
    place = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
    dry = place[IS_SPACE[data[place - 1]] & ~IS_SPACE[data[place]]]
    both = np.concatenate([at, dry])
    order = np.argsort(both, kind="stable")
    return both[order], np.concatenate([np.full(len(at), WINDOW), np.full(len(dry), WINDOW + DRY)])[order]


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, reach) of the chunks between two cuts of a row; its first and last bytes, which no two cuts enclose, are none."""
    at, reach = cuts(data, offsets)
    row = np.searchsorted(offsets, at, side="right")
    inner = row[1:] == row[:-1]
    return at[:-1][inner], at[1:][inner], reach[:-1][inner]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the chunks of a slice of documents, and whether a digest occurs there more than once."""
    for batch in batches:
        for _, _, data, offsets in slices(batch.column("text")):
            starts, ends, _ = chunks(data, offsets)
            if len(starts):
                digest, n = np.unique(span_hashes(data, starts, ends), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(digest)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["v", "n"])


def _repeatable(n: int, shared):
    """The windows of n words that may occur elsewhere. `place` packs the text's hash, the first word's number and whether the row had the window before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for lo, _, data, offsets in slices(batch.column("text")):
                w0, w1, row = words(data, offsets)
                if len(w0) < n:
                    continue
                first = np.flatnonzero(row[: len(w0) - n + 1] == row[n - 1 :])
                start, end = w0[first], w1[first + n - 1]
                begins, stops, reach = chunks(data, offsets)
                once = ~_bit_test(known, span_hashes(data, begins, stops)) if len(begins) else np.zeros(0, bool)
                free = np.ones(len(first), bool)
                for r in (WINDOW, WINDOW + DRY):
                    a, b = begins[once & (reach == r)] - r, stops[once & (reach == r)]
                    free &= np.searchsorted(b, end, side="right") <= np.searchsorted(a, start)
                first, start, end = first[free], start[free], end[free]
                if not len(first):
                    continue
                rows = row[first]
                digest = span_hashes(data, start, end)
                before = np.zeros(len(first), bool)
                order = np.lexsort((first, digest, rows))
                before[order[1:]] = (digest[order[1:]] == digest[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
                number = first - np.searchsorted(row, rows)
                own = pa.array(lo + rows)
                place = np.asarray(batch.column("text_hash").take(own)) << 32 | number << 1 | before
                yield pa.RecordBatch.from_arrays([pa.array(signed(digest)), batch.column("doc_id").take(own), pa.array(place), pa.array(start - offsets[rows]), pa.array(end - start)], names=["digest", "doc_id", "place", "start", "size"])

    return run


def _text_hash() -> Column:
    """32 bits, so that a place holds it beside the number of a word."""
    return F.shiftright(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), 32)


def repeated_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """Per repeated passage of min_words words or more that is not its first occurrence: doc_id, text_hash, start, end (UTF-8 bytes), n_words, first_doc_id."""
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _text_hash().alias("text_hash"))
    twice = texts.select("text").mapInArrow(_digests, "v long, n int").groupBy("v").agg(F.sum("n").alias("n")).where("n > 1")
    known = docs.sparkSession.sparkContext.broadcast(_bitmap(twice.select("v"), DIGEST_BITS))
    places = texts.mapInArrow(_repeatable(min_words, known), "digest long, doc_id long, place long, start long, size long")
    shared = places.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = scratch.write(shared.select("digest", "first"), "shared")
    hits = places.join(shared, "digest").where("doc_id > first or place % 2 <> 0")
    hits = hits.select("doc_id", F.expr("shiftright(place, 32)").alias("text_hash"), "first", F.expr("shiftright(place & 4294967295, 1)").alias("word"), "start", (F.col("start") + F.col("size")).alias("end"))
    # Rows with equal doc_id and text give equal windows: once is enough.
    row = ["doc_id", "text_hash"]
    w = Window.partitionBy(*row).orderBy("word", "start")
    before = F.lag("word").over(w)
    opened = hits.withColumn("new", (before.isNull() | (F.col("word") > before + min_words)).cast("int"))
    runs = opened.withColumn("run", F.sum("new").over(w)).groupBy(*row, "run")
    runs = runs.agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("word") - F.min("word") + min_words).alias("n_words"), F.min("first").alias("first_doc_id"))
    return runs.select(*row, "start", "end", "n_words", "first_doc_id")


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans (ascending)."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : max(a, at)])
        at = max(at, b)
    return b"".join([*out, text[at:]])


def without_repeats(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """`docs` with the repeated passages cut out of `text`, and `n_chars` (where there is one) counted again.

    Texts without repeats and rows without doc_id pass as they are.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    spans = repeated_passages(docs, min_words).groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
    spans = scratch.write(spans.agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans")), "spans")
    names = docs.columns
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i) for i in range(len(names))]
            hit = pc.and_(pc.is_valid(batch.column("__spans")), pc.is_valid(cols[text_at]))
            spans = batch.column("__spans").filter(hit).to_pylist()
            texts = [cut_spans(t.encode(), [(x["start"], x["end"]) for x in s]).decode() for t, s in zip(cols[text_at].filter(hit).to_pylist(), spans, strict=True)]
            cols[text_at] = pc.replace_with_mask(cols[text_at], hit, pa.array(texts, cols[text_at].type))
            if chars_at is not None:
                cols[chars_at] = pc.replace_with_mask(cols[chars_at], hit, pa.array([len(t) for t in texts], cols[chars_at].type))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    mine = docs.withColumn("__own", _text_hash())
    mine = mine.join(spans, (mine["doc_id"] == spans["__doc"]) & (mine["__own"] == spans["__hash"]), "left")
    return mine.select(*(mine[c] for c in names), "__spans").mapInArrow(run, docs.schema)
