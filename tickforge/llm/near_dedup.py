"""MinHash near-duplicate detection with odd sketches.

Documents are sets of word shingles. A pass over the texts gives each set its size, a fingerprint, MinHash band keys
and an odd sketch: MinHash samples of 256 bins folded into a parity bitmap, so that the population count of the XOR
of two sketches counts differing samples. Equal sets are merged by fingerprint first. Then:

1. star: in each band bucket every set is paired with the bucket's pivot, the set that shares most buckets (the
   original of edited copies shares more with them than they do with each other);
2. rest: in buckets that still hold more than one component, blocks of at most `BLOCK` sets meet pairwise. Sets whose
   sketches come near another component's are written as differences from the pivot's set, from which a cell gets
   the exact similarity of all its pairs at once; it returns what its links join, a row a set at most.

Star pairs whose sketches differ too much go; the others are confirmed on the full shingle sets. Components are those
of all confirmed links; what can be missed is what no band caught, (1 - s**4)**16 of the pairs at a similarity s: 7e-6
at 0.85, 2e-4 at 0.8 (less above), unless another link joins them.

Edge cases: null text is empty; a text without words has no shingles, size 0 and links with nothing; a text with
fewer words than `k` is one shingle; a null doc_id takes no part (component null, kept); rows that repeat a doc_id
each come out with their own size, and a link of one of them is a link of that doc_id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import Scratch
from .textarrays import LOWER, U64, keyed, mix, row_bounds, signed, slices, span_hashes, words

BANDS, ROWS = 16, 4
BINS = 256
SKETCH_LONGS = 16
BLOCK = 512
SKETCH = [f"o{j}" for j in range(SKETCH_LONGS)]
_PAD = U64(0x5851F42D4C957F2D)
MEMBER_BITS = 1 << 26


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingle hashes of each row, sorted within the row."""
    low = LOWER[data]
    starts, ends, row = words(low, offsets)
    n = len(offsets) - 1
    h = span_hashes(low, starts, ends)
    bounds = row_bounds(row, n)
    if not len(h):
        return h, bounds
    end = bounds[1:][row]
    at = np.arange(len(h))
    sh = np.zeros(len(h), U64)
    with np.errstate(over="ignore"):
        for j, salt in enumerate(keyed(k, 5)):
            there = at + j < end
            w = np.where(there, h[np.minimum(at + j, len(h) - 1)], _PAD)
            sh = mix(sh + w * (salt | U64(1)))
    whole = (at + k <= end) | (at == bounds[row])
    out, sizes = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        if a < b:
            s = np.unique(sh[a:b][whole[a:b]])
            out.append(s)
            sizes[i + 1] = len(s)
    return np.concatenate(out), np.cumsum(sizes)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Size, fingerprint, band keys and odd sketch of each row's set; rows without a set get zeros."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    bands = np.zeros((n, BANDS), U64)
    sketch = np.zeros((n, SKETCH_LONGS), U64)
    prints = np.zeros((n, 2), U64)
    if len(full):
        starts = bounds[:-1][full]
        mins = np.empty((BANDS * ROWS, len(full)), U64)
        with np.errstate(over="ignore"):
            for j, (a, b) in enumerate(zip(keyed(BANDS * ROWS, 1), keyed(BANDS * ROWS, 2), strict=True)):
                mins[j] = np.minimum.reduceat((sets ^ a) * (b | U64(1)), starts)
            for b, salt in enumerate(keyed(BANDS, 3)):
                key = np.full(len(full), salt, U64)
                for m in mins[b * ROWS : (b + 1) * ROWS]:
                    key = mix(key * U64(0x9E3779B97F4A7C15) + m)
                bands[full, b] = key
            prints[full, 0] = np.add.reduceat(sets, starts)
            prints[full, 1] = np.bitwise_xor.reduceat(mix(sets + U64(77)), starts)
            row = np.repeat(np.arange(n), size)
            slot = row * BINS + (mix(sets + U64(99)) % U64(BINS)).astype(np.int64)
            # Sets are sorted, so a bin's first entry is its least hash.
            order = np.argsort(slot, kind="stable")
            first = order[np.append(True, slot[order][1:] != slot[order][:-1])]
            bit = row[first] * 64 * SKETCH_LONGS + (mix(sets[first] * U64(0x9E3779B97F4A7C15) + U64(13)) % U64(64 * SKETCH_LONGS)).astype(np.int64)
        odd = np.bincount(bit, minlength=n * 64 * SKETCH_LONGS) & 1
        sketch = np.packbits(odd.astype(bool).reshape(n, -1), axis=1, bitorder="little").view(U64)
    return {"n_shingles": size, "prints": prints, "bands": bands, "sketch": sketch}


def _most_bits(similarity: float, size, power, root):
    """The largest XOR population count that a linked pair shows whose larger set has `size` shingles.

    Of the bins that the pair's union fills (at most size / similarity shingles over BINS bins), a share 1 - similarity
    differs, give or take 5 standard deviations; a bin that differs flips two bits at most, and bits may meet.
    """
    bits = 64 * SKETCH_LONGS
    filled = BINS * (1 - power(1 - 1 / BINS, size / similarity))
    differ = filled * (1 - similarity) + 5 * root(filled * similarity * (1 - similarity)) + 1
    return bits * (1 - power(1 - 2 / bits, 2 * differ)) / 2 + 1


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                s = signatures(*shingle_sets(data, offsets, k))
                cols = [batch.column("doc_id").slice(lo, hi - lo), pa.array(s["n_shingles"])]
                cols += [pa.array(signed(s["prints"][:, j])) for j in range(2)]
                cols += [pa.FixedSizeListArray.from_arrays(pa.array(signed(s["bands"].ravel())), BANDS).cast(pa.list_(pa.int64()))]
                cols += [pa.array(signed(s["sketch"][:, j])) for j in range(SKETCH_LONGS)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_shingles", "f0", "f1", "bands", *SKETCH])

    return run


def _member_bit():
    return F.pmod(F.xxhash64("doc_id"), F.lit(MEMBER_BITS)) + 1


def _member_filter(ids: DataFrame) -> bytes:
    """A bitmap of fixed size (8 MB) over hashed ids: a document that is not in it is in no pair. Built by SQL bitmap functions."""
    parts = ids.select(_member_bit().alias("b")).groupBy(F.expr("bitmap_bucket_number(b)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("m")).collect()
    out = bytearray(MEMBER_BITS // 8)
    for r in parts:
        out[(r.k - 1) * 4096 : r.k * 4096] = r.m
    return bytes(out)


def _sets(k: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            at = np.asarray(batch.column("bit")) - 1
            batch = batch.filter(pa.array((member[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0))
            for lo, hi, data, offsets in slices(batch.column("text")):
                sets, bounds = shingle_sets(data, offsets, k)
                blob = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer((bounds * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(sets))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), blob.cast(pa.binary())], names=["doc_id", "shingles"])

    return run


def _confirm(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("su"), batch.column("sv"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), U64) for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(den * both >= num * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar(a: str, b: str, num: int, den: int):
    """Sketches near enough, and sizes that the threshold allows."""
    limit = _most_bits(num / den, F.greatest(f"{a}.n_shingles", f"{b}.n_shingles"), lambda x, y: F.pow(F.lit(x), y), F.sqrt)
    bits = sum((F.bit_count(F.col(f"{a}.o{j}").bitwiseXOR(F.col(f"{b}.o{j}"))) for j in range(1, SKETCH_LONGS)), F.bit_count(F.col(f"{a}.o0").bitwiseXOR(F.col(f"{b}.o0"))))
    return (bits <= limit) & (F.least(f"{a}.n_shingles", f"{b}.n_shingles") * den >= F.greatest(f"{a}.n_shingles", f"{b}.n_shingles") * num)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Documents are linked where den * intersection >= num * union."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, f0 long, f1 long, bands array<long>, " + ", ".join(f"{o} long" for o in SKETCH)
    signs = scratch.write(texts.mapInArrow(_sign(k), schema), "signs")

    live = signs.where("doc_id is not null and n_shingles > 0")
    same = scratch.write(live.groupBy("n_shingles", "f0", "f1").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "same")
    reps = live.join(same.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sketches = scratch.write(reps.select("doc_id", "n_shingles", *SKETCH), "sketches")

    keys = reps.select("doc_id", F.explode("bands").alias("key"))
    sized = keys.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).where("least < most").select("key", "n")
    shared = scratch.write(keys.join(sized, "key"), "shared")
    weight = scratch.write(shared.groupBy("doc_id").agg(F.sum("n").alias("weight")), "weight")
    heavy = shared.join(weight, "doc_id").groupBy("key").agg(F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("pivot"))
    buckets = scratch.write(shared.select("key", "doc_id").join(heavy, "key"), "buckets")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Of pairs (u, v): those whose sketches agree and whose full sets confirm the link."""
        a, b = sketches.alias("a"), sketches.alias("b")
        near = pairs.join(a, F.col("u") == F.col("a.doc_id")).join(b, F.col("v") == F.col("b.doc_id")).where(_similar("a", "b", num, den)).select("u", "v").distinct()
        return confirmed(scratch.write(near, f"{name}-near"), name)

    def with_sets(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (u, v) with the shingle sets su and sv. Only the texts of documents in pairs are read to sets."""
        bitmap = spark.sparkContext.broadcast(_member_filter(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()))
        sets = texts.where("doc_id is not null").select("doc_id", "text", _member_bit().alias("bit")).mapInArrow(_sets(k, bitmap), "doc_id long, shingles binary")
        sets = scratch.write(sets, f"{name}-sets")
        joined = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su")), "u").join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv")), "v")
        return joined.select("u", "v", "su", "sv")

    def confirmed(near: DataFrame, name: str) -> DataFrame:
        return scratch.write(with_sets(near, name).mapInArrow(_confirm(num, den), "u long, v long").distinct(), f"{name}-links")

    def cells(rows: DataFrame, names: list[str]) -> DataFrame:
        """The blocks of a bucket (n rows) meet pairwise: a row goes to the cells (own, j) and (i, own) of its bucket."""
        cut = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks")).cast("int"))
        cut = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cut = cut.select("key", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("j"), "doc_id", *names)
        return cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc_id")

    star = buckets.where("doc_id <> pivot").select(F.least("pivot", "doc_id").alias("u"), F.greatest("pivot", "doc_id").alias("v")).distinct()
    links = linked(star, "star")
    parts = components(links, scratch, "star-parts")

    placed = buckets.select("key", "pivot", "doc_id").join(parts, buckets.doc_id == parts.node, "left").select("key", "pivot", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    open_ = placed.groupBy("key").agg(F.min("part").alias("p0"), F.max("part").alias("p1"), F.count("*").alias("n")).where("p0 < p1 and n > 2").select("key", "n")
    left = scratch.write(placed.join(open_, "key").join(sketches, "doc_id"), "left")
    seen = cells(left, ["pivot", "part", "n_shingles", *SKETCH]).mapInArrow(_by_cell(_near_across(num, den), ["key", "doc_id"]), "key long, doc_id long").distinct()
    seen = scratch.write(seen.join(left.select("key", "doc_id", "pivot", "part"), ["key", "doc_id"]).distinct(), "seen")
    deltas = scratch.write(with_sets(seen.select(F.col("pivot").alias("u"), F.col("doc_id").alias("v")).distinct(), "rest").mapInArrow(_deltas, "pivot long, doc_id long, added binary, removed binary, n_shingles long"), "deltas")
    counted = seen.join(seen.groupBy("key").agg(F.count("*").alias("n")), "key").join(deltas, ["pivot", "doc_id"])
    exact = cells(counted, ["part", "n_shingles", "added", "removed"]).mapInArrow(_by_cell(_linked_exactly(num, den), ["u", "v"]), "u long, v long").distinct()
    parts = components(links.union(scratch.write(exact, "rest-links")), scratch, "parts")

    rep = same.join(parts, same.rep == parts.node, "left").select("n_shingles", "f0", "f1", F.coalesce("component", "rep").alias("part"))
    own = signs.select("doc_id", "n_shingles", "f0", "f1").join(rep, ["n_shingles", "f0", "f1"], "left")
    out = own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("part", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _near_across(num: int, den: int):
    """Of a cell: the rows whose sketch is near enough that of a row of another component."""

    def run(t: pa.Table) -> dict[str, np.ndarray]:
        ids, part, size = (t.column(c).to_numpy() for c in ("doc_id", "part", "n_shingles"))
        sketch = np.stack([t.column(c).to_numpy() for c in SKETCH], axis=1).view(U64)
        hit = np.zeros(len(ids), bool)
        for x in range(len(ids) - 1):
            y = slice(x + 1, len(ids))
            big = np.maximum(size[y], size[x])
            ok = (part[y] != part[x]) & (np.minimum(size[y], size[x]) * den >= big * num)
            ok &= np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1, dtype=np.int64) <= _most_bits(num / den, big, np.power, np.sqrt)
            hit[y] |= ok
            hit[x] |= ok.any()
        return {"key": t.column("key").to_numpy()[hit], "doc_id": ids[hit]}

    return run


def _deltas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a set has beyond its bucket's pivot, and what it lacks of it: exact, and short where both are alike."""
    for batch in batches:
        out = []
        for a, b in zip(batch.column("su"), batch.column("sv"), strict=True):
            a, b = (np.frombuffer(x.as_buffer(), U64) for x in (a, b))
            out.append((np.setdiff1d(b, a, assume_unique=True).tobytes(), np.setdiff1d(a, b, assume_unique=True).tobytes(), len(b)))
        added, removed, size = zip(*out, strict=True) if out else ((), (), ())
        cols = [batch.column("u"), batch.column("v"), pa.array(added, pa.binary()), pa.array(removed, pa.binary()), pa.array(size, pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["pivot", "doc_id", "added", "removed", "n_shingles"])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; elements of one set alone play no part."""
    size = [len(x) for x in sets]
    row = np.repeat(np.arange(len(sets)), size)
    _, col, count = np.unique(np.concatenate([*sets, np.zeros(0, U64)]), return_inverse=True, return_counts=True)
    shared = count > 1
    row, col = row[shared[col]], (np.cumsum(shared) - 1)[col[shared[col]]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for a in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(col, [a, a + 2048])
        m = np.zeros((len(sets), 2048), np.float32)
        m[row[lo:hi], col[lo:hi] - a] = 1
        out += m @ m.T
    return out.astype(np.int64)


def _linked_exactly(num: int, den: int):
    """Of a cell: rows of other components that exact links inside the cell join, as (least row, row)."""

    def run(t: pa.Table) -> dict[str, np.ndarray]:
        ids, part, size = (t.column(c).to_numpy() for c in ("doc_id", "part", "n_shingles"))
        added, removed = ([np.frombuffer(x.as_buffer(), U64) for c in t.column(name).chunks for x in c] for name in ("added", "removed"))
        lacks = np.array([len(x) for x in removed])
        pivot = size[0] - len(added[0]) + lacks[0]
        both = pivot - (lacks[:, None] + lacks[None, :] - _common(removed)) + _common(added)
        linked = den * both >= num * (size[:, None] + size[None, :] - both)
        label = np.arange(len(ids))
        while True:
            new = np.where(linked, label[None, :], len(ids)).min(axis=1)
            new = np.minimum(np.minimum(new, label), label[np.minimum(new, label)])
            if (new == label).all():
                break
            label = new
        far = part[label] != part
        return {"u": np.minimum(ids[label], ids)[far], "v": np.maximum(ids[label], ids)[far]}

    return run


def _by_cell(each, out: list[str]):
    """Applies a function to the rows of each cell (key, i, j); rows come sorted by cell, and one cell is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell = None

        def flush():
            found = each(pa.Table.from_batches(held))
            return pa.RecordBatch.from_arrays([pa.array(found[v], pa.int64()) for v in out], names=out)

        for batch in batches:
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                now = tuple(at[:, a].tolist()) if b > a else cell
                if held and now != cell:
                    yield flush()
                    held = []
                cell = now
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    return run


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents that stay, one of each near-duplicate component; rows without doc_id stay."""
    gone = near_duplicates(docs, k, num, den).where("not kept").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
