"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit check.

Edit distance counts inserted, deleted and replaced words (lower-cased runs of letters, digits and non-ASCII bytes).
A document leaks an item of n words where some window of it, of any length, is within d = floor(rate * n) edits of it.

1. An edit touches at most two of the item's n - 1 word pairs, so a match keeps n - 1 - 2d of them within n + d words.
   Windows without so many pairs known from items of n words (a bitmap of fixed size) can't match and go first.
2. The CGK walk embeds a window: at step j it emits the current word and moves on if the word's j-th random bit is
   set, so that windows few edits apart agree at most steps. A window has no end of its own: the walk goes on into the
   text behind it, so dropped and inserted words cost one edit each. Windows begin every 1 + d // 4 words. A repeat
   samples `SAMPLES` steps as its LSH key.
3. The number of repeats is found for each length apart: copies with all d edits, seen from the window that begins
   nearest, are embedded, and repeats are added, without a limit, until the target share of the copies has met its item.
   Other copies confirm it (tests).
4. Windows that share a key with an item of their length are joined with it, and verified by exact edit distance.

An item of more than SEGMENT words is cut into segments of equal length, one word more or less. Of floor(rate * n) edits
one segment at least has no more than its own share, so it meets its window as often as an item of its length does;
lengths, repeats and memory are those of short items, whatever the item. A document that holds such a window brings all
its words once, and the whole item is verified where the segment puts it.

Edge cases: null texts are empty and leak nothing; items of 2 to 4 words must occur word for word; items of fewer than
`min_words` words (2: a single word stands in too many texts to identify anything) are left out; a null doc_id or item_id is reported as null; rows
that repeat a doc_id or item_id are told apart only by their texts; empty tables give no rows; extra columns are
ignored. A rate of 0.4 or more leaves short items without pairs and is refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .textarrays import LOWER, U64, keyed, mix, row_bounds, runs, signed, slices, span_hashes

RATE, RECALL = 0.2, 0.999
MIN_WORDS = 2
#: Longest item, or segment of one, that is looked for as a whole.
SEGMENT = 60
#: Steps of a key, and how far apart they are: steps close to each other are in step or out of step together.
SAMPLES, APART = 3, 3
#: Edited copies that the repeats of a length are measured with.
COPIES = 1000
MAP_BITS = 1 << 24
KEY_ROWS, HELD_ROWS, VERIFY_ROWS, HELD_WORDS = 256, 4096, 1024, 1 << 20
#: Repeats that are walked at once, and cells of a row of all tables of edit distances that are filled at once.
SLAB, VERIFY_CELLS = 16, 1 << 18
_PAD = U64(0x2545F4914F6CDD1D)

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, bounds by row)."""
    low = LOWER[data]
    starts, ends, row = runs(WORD_BYTE[low], offsets)
    return span_hashes(low, starts, ends), row_bounds(row, len(offsets) - 1)


def _pairs(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:])


def _of_length(pairs: np.ndarray, n: int) -> np.ndarray:
    """The pair's entry in the bitmap for items of n words."""
    with np.errstate(over="ignore"):
        return mix(pairs + U64(n) * U64(0xD1342543DE82EF95))


def edits(n: int, rate: float) -> int:
    return math.floor(rate * n + 1e-9)


def stride(n: int, rate: float) -> int:
    """Windows begin at every so many words of a text: a walk that begins some words off falls into step like one after edits."""
    return 1 + edits(n, rate) // 4


def window_words(n: int, rate: float) -> int:
    """Words that a walk for items of n words sees."""
    return n + edits(n, rate) + stride(n, rate) // 2


def keys_at(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int, width: int, first: int, last: int) -> np.ndarray:
    """LSH keys (windows, repeats first to last) of the windows of `width` words of h from `starts`; _PAD stands from `ends` on.

    Word by word, all windows and repeats at once: a walk that comes to a word at step j leaves it after the word's next
    set bit. Bits are made once for each place of h, however many windows hold it.
    """
    salts = keyed(last, 41)[first:]
    padded = np.append(h, _PAD)
    out = np.empty((len(starts), len(salts)), U64)
    for lo in range(0, len(starts), KEY_ROWS):
        start, end = starts[lo : lo + KEY_ROWS], ends[lo : lo + KEY_ROWS]
        place = start[:, None] + np.arange(width + 1)
        place[(place >= end[:, None]) | (np.arange(width + 1) == width)] = len(h)
        used, own = np.unique(place, return_inverse=True)
        words = padded[used]
        for slab in range(0, len(salts), SLAB):
            out[lo : lo + KEY_ROWS, slab : slab + SLAB] = _walk(words, own.reshape(place.shape), salts[slab : slab + SLAB], n, width)
    return out


def _walk(words: np.ndarray, own: np.ndarray, salts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Keys (windows, salts) of windows given as places in `words`."""
    begin = mix(salts) % U64(max(1, 2 * n - (SAMPLES - 1) * APART))
    sampled = begin[None, :] + U64(APART) * np.arange(SAMPLES, dtype=U64)[:, None]
    blocks = int(sampled.max()) // 64 + 1
    one, low = U64(1), U64(63)
    with np.errstate(over="ignore"):
        base = words[:, None] + salts[None, :]
        bits = [mix(base + U64(64 * q)) for q in range(blocks)]
        step = np.zeros((len(own), len(salts)), U64)
        at = np.zeros((SAMPLES, *step.shape), np.int16)
        for i in range(width):
            of = own[:, i]
            q0, q1 = int(step.min()) >> 6, int(step.max()) >> 6
            if q0 >= blocks:
                break
            x = bits[q0].take(of, axis=0)
            for q in range(q0 + 1, min(q1, blocks - 1) + 1):
                np.copyto(x, bits[q].take(of, axis=0), where=step >> U64(6) >= U64(q))
            x >>= step & low
            empty = np.nonzero(x == 0)
            step += np.bitwise_count((x & (~x + one)) - one) + one
            if len(empty[0]):  # the next bit lies in a later block
                nxt = (step[empty] - U64(65) >> U64(6)).astype(np.int64) + 1
                new = nxt.astype(U64) * U64(64)
                for q in range(1, blocks):
                    sel = np.flatnonzero(nxt == q)
                    y = bits[q][of[empty[0][sel]], empty[1][sel]]
                    new[sel] += np.bitwise_count((y & (~y + one)) - one) + one
                step[empty] = new
            for k in range(SAMPLES):
                at[k] += step <= sampled[k]
        key = np.broadcast_to(salts + U64(n), step.shape)
        for k in range(SAMPLES):
            key = mix(key * U64(0x9E3779B97F4A7C15) + words[own[np.arange(len(own))[:, None], at[k]]])
    return key


def keys(windows: np.ndarray, n: int, first: int, last: int) -> np.ndarray:
    """The same of windows given as rows of word hashes, _PAD behind a text's or item's end."""
    rows, width = windows.shape
    starts = np.arange(rows) * width
    return keys_at(windows.ravel(), starts, starts + width, n, width, first, last)


def edited_copies(n: int, rate: float, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(items, windows): rows of n random words, padded, and copies of them with all edits allowed in a text of other words,
    seen from the window that begins nearest."""
    rng = np.random.default_rng([seed, n])
    d, apart, width = edits(n, rate), stride(n, rate), window_words(n, rate)
    items = rng.integers(1 << 63, size=(count, n)).astype(U64)
    copies = rng.integers(1 << 63, size=(count, width)).astype(U64)
    for item, copy in zip(items.tolist(), copies, strict=True):
        for kind in rng.integers(3, size=d).tolist():
            at = int(rng.integers(len(item) + (kind == 1)))
            item[at : at + (kind != 1)] = [] if kind == 2 else [int(rng.integers(1 << 63))]
        off = int(rng.integers(apart)) - apart // 2
        item, at = item[max(-off, 0) :], max(off, 0)
        copy[at : at + len(item)] = item[: width - at]
    return np.concatenate([items, np.full((count, width - n), _PAD, U64)], axis=1), copies


def repeats_for(n: int, rate: float, recall: float = RECALL) -> int:
    """How many repeats let the share `recall` of the copies of an item of n words with all edits allowed meet the item;
    and half as many again, since the same copies decide where to stop."""
    if not edits(n, rate):
        return 1
    items, copies = edited_copies(n, rate, COPIES, 5)
    repeats, step = 0, 8
    while len(items) > (1 - recall) * COPIES:
        met = (keys(items, n, repeats, repeats + step) == keys(copies, n, repeats, repeats + step)).any(axis=1)
        items, copies = items[~met], copies[~met]
        repeats += step
    return repeats + repeats // 2


def _bit_test(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values % U64(8 * len(bitmap))).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _bitmap(values: DataFrame, bits: int = MAP_BITS) -> bytes:
    """A bitmap (2 MB) of the 64-bit values (column v), whatever their number; a full one only prunes less."""
    b = values.select((F.expr(f"cast(pmod(v, {bits}) as bigint)") + 1).alias("b"))
    out = bytearray(bits // 8)
    for r in b.groupBy(F.expr("bitmap_bucket_number(b)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("m")).collect():
        out[(r.k - 1) * 4096 : r.k * 4096] = r.m
    return bytes(out)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            h, bounds = tokens(data, offsets)
            n = np.diff(bounds)
            words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(h)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(lo, hi - lo), pa.array(n), words], names=["item_id", "n", "words"])


def segment_bounds(n: int) -> list[int]:
    """Where the segments of an item of n words begin, and n: equal parts of SEGMENT words at most."""
    parts = -(-n // SEGMENT)
    return [i * n // parts for i in range(parts + 1)]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, words in zip(batch.column("item").to_pylist(), batch.column("words"), strict=True):
            bounds = segment_bounds(len(words))
            own = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.values)
            n = pa.array(np.diff(bounds), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(n), pa.int64()), pa.array(bounds[:-1], pa.int64()), pa.array([len(n) == 1] * len(n)), n, own], names=["item", "offset", "whole", "n", "words"])


def _item_keys(repeats: dict[int, int], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, offset, whole, words in zip(*(batch.column(c).to_pylist() for c in ("item", "offset", "whole")), batch.column("words"), strict=True):
                n = len(words)
                wide = np.concatenate([words.values.to_numpy().view(U64), np.full(window_words(n, rate) - n, _PAD, U64)])
                key = keys(wide[None, :], n, 0, repeats[n])[0]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(key), pa.int64()), pa.array([offset] * len(key), pa.int64()), pa.array([whole] * len(key)), pa.array(signed(key))], names=["item", "offset", "whole", "key"])

    return run


def window_starts(at: np.ndarray, rows: np.ndarray, bounds: np.ndarray, need: int, width: int) -> np.ndarray:
    """Ascending words at which windows of `width` words begin that hold `need` of the pairs at the ascending places `at`."""
    if len(at) < need:
        return at[:0]
    i = np.flatnonzero((at[need - 1 :] - at[: len(at) - need + 1] < width - 1) & (rows[need - 1 :] == rows[: len(at) - need + 1]))
    lo, hi = np.maximum(at[i + need - 1] - (width - 2), bounds[rows[i]]), at[i] + 1
    lo = np.maximum(lo, np.append(0, np.maximum.accumulate(hi)[:-1])) if len(hi) else lo
    size = np.maximum(hi - lo, 0)
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())


def nearest_starts(starts: np.ndarray, bounds: np.ndarray, apart: int) -> np.ndarray:
    """For each of the ascending places the nearest one that is a multiple of `apart` words into its row, once."""
    if apart == 1:
        return starts
    row = bounds[np.searchsorted(bounds, starts, side="right") - 1]
    end = bounds[np.searchsorted(bounds, starts, side="right")] - 1
    near = row + (starts - row + apart // 2) // apart * apart
    return np.unique(np.minimum(near, row + (end - row) // apart * apart))


def _scan(repeats: dict[int, int], whole: set[int], cut: set[int], pair_map, key_map, rate: float):
    """Stretches of documents around windows that share keys with items: doc_id, at (number of the first word), words, keys.
    For lengths in `cut`, which segments have, also a row a document: at -1, all its words, keys and the `spots` where their windows begin."""

    def found(batch: pa.RecordBatch, first_row: int, parts: list) -> Iterator[pa.RecordBatch]:
        pairs_known, keys_known = (np.frombuffer(m.value, np.uint8) for m in (pair_map, key_map))
        h = np.concatenate([x for x, _ in parts])
        sizes = np.concatenate([np.diff(b) for _, b in parts])
        bounds = np.append(0, np.cumsum(sizes))
        if len(h) < 2:
            return
        pairs = _pairs(h)
        some = _bit_test(pairs_known, pairs)
        cross = bounds[1:-1]
        some[cross[(cross > 0) & (cross < len(h))] - 1] = False
        some = np.flatnonzero(some)
        pairs, rows = pairs[some], np.searchsorted(bounds, some, side="right") - 1
        parts_of = []
        for n in repeats:
            d, apart, width = edits(n, rate), stride(n, rate), window_words(n, rate)
            known = _bit_test(pairs_known, _of_length(pairs, n))
            starts = window_starts(some[known], rows[known], bounds, n - 1 - 2 * d, n + d)
            starts = nearest_starts(starts, bounds, apart)
            hits = []
            for lo in range(0, len(starts), HELD_ROWS):
                at = starts[lo : lo + HELD_ROWS]
                end = bounds[np.searchsorted(bounds, at, side="right")]
                k = keys_at(h, at, end, n, width, 0, repeats[n])
                of, r = np.nonzero(_bit_test(keys_known, k))
                hits.append((at[of], k[of, r]))
            if not sum(len(x) for x, _ in hits):
                continue
            at, key = (np.concatenate(x) for x in zip(*hits, strict=True))
            # Windows that begin within the same d + 1 words of a text are verified together.
            row = np.searchsorted(bounds, at, side="right") - 1
            if n in cut:
                parts_of.append((row, at - bounds[row], key))
            if n not in whole:
                continue
            group, last = np.unique(row << 32 | (at - bounds[row]) // (d + 1), return_inverse=True)
            row, b = group >> 32, (group & 0xFFFFFFFF) * (d + 1)
            from_, to = bounds[row] + np.maximum(b - d, 0), np.minimum(bounds[row] + b + n + 2 * d + apart, bounds[row + 1])
            ends = np.append(0, np.cumsum(to - from_))
            words = h[np.repeat(from_ - ends[:-1], to - from_) + np.arange(ends[-1])]
            split = np.append(0, np.cumsum(np.bincount(last)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(first_row + row)), pa.array(from_ - bounds[row]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(words))),
                    pa.ListArray.from_arrays(pa.array(split, pa.int32()), pa.array(signed(key[np.argsort(last, kind="stable")]))), pa.nulls(len(row), pa.list_(pa.int64())),
                ], names=["doc_id", "at", "words", "keys", "spots"],
            )
        if parts_of:
            row, spot, key = (np.concatenate(x) for x in zip(*parts_of, strict=True))
            by = np.argsort(row, kind="stable")
            docs, counts = np.unique(row, return_counts=True)
            split, ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32()), np.append(0, np.cumsum(sizes[docs]))
            words = np.concatenate([h[bounds[r] : bounds[r + 1]] for r in docs.tolist()])
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(words))), *(pa.ListArray.from_arrays(split, pa.array(x[by])) for x in (signed(key), spot))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(first_row + docs)), pa.array(np.full(len(docs), -1)), *lists], names=["doc_id", "at", "words", "keys", "spots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, first_row, held = [], 0, 0
            for lo, hi, data, offsets in slices(batch.column("text")):
                parts.append(tokens(data, offsets))
                held += len(parts[-1][0])
                if held >= HELD_WORDS or hi == batch.num_rows:
                    yield from found(batch, first_row, parts)
                    parts, first_row, held = [], hi, 0

    return run


def nearest_windows(item: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, words) of the window of any length that is nearest to the item; of equal ones the first, then the shortest.

    The table of edit distances with a free start: a cell holds its edits and, in the lower bits, where its window began.
    """
    one = np.int64(1 << 32)
    steps = np.arange(wide.shape[1] + 1) * one
    row = np.broadcast_to(np.arange(wide.shape[1] + 1), (len(item), wide.shape[1] + 1)).copy()
    for i in range(1, item.shape[1] + 1):
        new = np.empty_like(row)
        new[:, 0] = i * one
        np.minimum(row[:, 1:] + one, row[:, :-1] + (wide != item[:, i - 1 : i]) * one, out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    end = row.argmin(axis=1)
    least = row[np.arange(len(row)), end]
    return least >> 32, least & (one - 1), end - (least & (one - 1))


def _verify(rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, VERIFY_ROWS):
                batch = whole.slice(lo, VERIFY_ROWS)
                a, b = batch.column("words"), batch.column("item_words")
                m, n = (np.asarray(x.value_lengths()).astype(np.int64) for x in (a, b))
                flat_a, flat_b = (x.flatten().to_numpy().view(U64) for x in (a, b))
                at_a, at_b = np.cumsum(m) - m, np.cumsum(n) - n
                far, start, size = (np.zeros(len(m), np.int64) for _ in range(3))
                for x in np.unique(n).tolist():
                    same = np.flatnonzero(n == x)
                    step = max(1, VERIFY_CELLS // int(m[same].max()))
                    for of in np.split(same, range(step, len(same), step)):
                        place = np.arange(int(m[of].max()))
                        wide = np.where(place < m[of][:, None], flat_a[np.minimum(at_a[of][:, None] + place, len(flat_a) - 1)], _PAD)
                        far[of], start[of], size[of] = nearest_windows(flat_b[at_b[of][:, None] + np.arange(x)], wide)
                most = np.array([edits(int(x), rate) for x in n])
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item"), pa.array(batch.column("at").to_numpy() + start), pa.array(size), pa.array(far)], names=["doc_id", "item_id", "start_word", "n_words", "edits"])
                yield out.filter(pa.array(far <= most))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, recall: float = RECALL, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document and leaked item, the nearest window found: doc_id, item_id, start_word, n_words, edits."""
    if not 0 <= rate < 0.4 or not 0 < recall < 1 or min_words < 2:
        raise ValueError("rate is at least 0 and less than 0.4, recall between 0 and 1, min_words at least 2")
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.mapInArrow(_items, "item_id long, n long, words array<long>").where(F.col("n") >= min_words)
    items = scratch.write(items.withColumn("item", F.xxhash64("words")), "items")
    distinct = items.dropDuplicates(["item"])
    parts = distinct.select("item", "words").mapInArrow(_segments, "item long, offset long, whole boolean, n long, words array<long>")
    parts = scratch.write(parts, "segments")
    lengths = parts.groupBy("n").agg(F.bool_or("whole").alias("whole"), F.bool_or(~F.col("whole")).alias("cut")).orderBy("n").collect()  # SEGMENT rows at most
    repeats = {r.n: repeats_for(r.n, rate, recall) for r in lengths}
    kinds = [{r.n for r in lengths if r[kind]} for kind in ("whole", "cut")]
    item_keys = scratch.write(parts.mapInArrow(_item_keys(repeats, rate), "item long, offset long, whole boolean, key long"), "keys")
    pairs = parts.select("words").mapInArrow(_item_pairs, "v long")
    maps = [spark.sparkContext.broadcast(_bitmap(x)) for x in (pairs, item_keys.select(F.col("key").alias("v")))]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_scan(repeats, *kinds, *maps, rate), "doc_id long, at long, words array<long>, keys array<long>, spots array<long>")
    found = scratch.write(found.withColumn("id", F.monotonically_increasing_id()), "stretches")
    wanted = distinct.select("item", F.col("words").alias("item_words"))
    near = found.where("at >= 0").select("id", F.explode("keys").alias("key")).join(item_keys.where("whole").select("key", "item"), "key").select("id", "item").distinct()
    near = near.join(found.where("at >= 0").select("id", "doc_id", "at", "words"), "id").join(wanted, "item")
    # A segment puts the whole item at its spot less its offset; edits move that by as many words at most.
    spots = found.where("at < 0").select("id", F.explode(F.arrays_zip("keys", "spots")).alias("hit")).select("id", F.col("hit.keys").alias("key"), F.col("hit.spots").alias("spot")).distinct()
    spots = spots.join(item_keys.where("not whole"), "key").select("id", "item", (F.col("spot") - F.col("offset")).alias("from")).join(distinct.select("item", F.size("words").alias("n")), "item")
    most = F.floor(F.col("n") * rate + 1e-9)
    spots = spots.groupBy("id", "item", "n", F.floor(F.col("from") / (most + 1))).agg(F.min("from").alias("from"), F.max("from").alias("to"))
    spots = spots.select("id", "item", F.greatest(F.lit(0), F.col("from") - most - SEGMENT).cast("int").alias("at"), (F.col("to") + F.col("n") + most + SEGMENT).cast("int").alias("end"))
    long = spots.join(found.where("at < 0").select("id", "doc_id", "words"), "id").join(wanted, "item")
    long = long.withColumn("words", F.slice("words", F.col("at") + 1, F.greatest(F.col("end") - F.col("at"), F.lit(0))))
    near = near.select("doc_id", "item", "at", "words", "item_words").unionByName(long.select("doc_id", "item", F.col("at").cast("long").alias("at"), "words", "item_words"))
    near = near.mapInArrow(_verify(rate), "doc_id long, item_id long, start_word long, n_words long, edits long")
    best = near.groupBy("doc_id", F.col("item_id").alias("item")).agg(F.min(F.struct("edits", "start_word", "n_words")).alias("best"))
    named = items.select("item", "item_id")
    return best.join(named, "item").select("doc_id", "item_id", "best.start_word", "best.n_words", "best.edits").distinct()


def _item_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in batch.column("words"):
            pairs = _pairs(words.values.to_numpy().view(U64))
            both = np.concatenate([pairs, _of_length(pairs, len(words))])
            yield pa.RecordBatch.from_arrays([pa.array(signed(both))], names=["v"])


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that leak no item; rows without doc_id stay."""
    gone = leaks(docs, benchmark, rate).where("doc_id is not null").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
