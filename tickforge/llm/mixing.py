"""Mixing of sources to target weights by balanced sampling (the cube method).

A source's target over its size says how often each of its documents is taken: whole times by all, and a fraction by
some, which is every document's inclusion probability. The flight moves these probabilities: three documents at a time
go along the vector that keeps both the sum of probabilities (documents) and that of probability times size (words),
until one of them is 0 or 1; which way is drawn so that expectations stay. So both totals are kept exactly while all
but LANDING documents of a block get decided. Blocks are hashes of the document within its source; what is left
undecided of FAN blocks makes a block of the next round, until a source has a single block. The landing takes, of all
ways to decide its last LANDING documents, the one with the least error in words and documents.

Draws are hashes of the document and the round, and blocks are sorted, so a rerun takes the same whatever the layout.
What the driver learns are counts and sums over all sources. A hot source has as many blocks as its rows need.

Edge cases: null texts have size 0 and are taken like others; a null source is a source of its own, the last one; rows
that repeat a doc_id are documents of their own (equal rows are alike, so it makes no difference which is taken); a
source without words has target 0; very long texts count whole; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .places import placed, source_key
from .shared import Scratch
from .textarrays import U64, mix

#: Most copies of a document; rows of a block, some; blocks that make one of the next round; documents left to the landing.
MOST, BLOCK_ROWS, FAN, LANDING = 3, 2000, 64, 12
#: Rows that a task holds at once; a group is cut where it has more.
HELD_ROWS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, weights: tuple[int, ...], most: float, scratch: Scratch) -> DataFrame:
    """key, source_size, target of each source of `sized` (key, size).

    Sources in the order of their code points, null last, weigh `weights`, over and over, and share all sizes. A target
    above `most` times its source's size stops there, and the rest is shared by weight among the others, until none is
    above. That is one level of target per weight, found from sums over the sources that have stopped and those that
    have not, so the driver gets a few numbers a round.
    """
    sizes = scratch.write(sized.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("last", F.col("key") == ""), "source-sizes")
    ranked = placed(sizes.withColumn("all", F.lit(0)), ["all"], ["last", "key"], scratch, "source-parts")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("pos"), F.lit(len(weights))) + 1).cast("int"))
    table = scratch.write(ranked.select("key", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("ceiling")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("ceiling") <= F.col("weight") * level if stopped >= 0 else F.lit(False)
        now = table.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("ceiling"))).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if now.n == stopped or not now.open:
            break
        stopped, level = now.n, (total - (now.held or 0.0)) / now.open
    return table.select("key", "source_size", F.least(F.col("ceiling"), F.col("weight") * level).alias("target"))


def flight(group: np.ndarray, h: np.ndarray, size: np.ndarray, pi: np.ndarray, level: int, landing: int = LANDING) -> np.ndarray:
    """The probabilities after all groups (ascending numbers) have at most `landing` undecided rows; all groups at once."""
    pi = pi.astype(np.float64).copy()
    size = size.astype(np.float64)
    live = np.flatnonzero((pi > 0) & (pi < 1))
    turn = 0
    while len(live):
        first = np.concatenate([[True], group[live][1:] != group[live][:-1]])
        starts = np.flatnonzero(first)
        counts = np.diff(np.append(starts, len(live)))
        # Each triple decides one row at least; a group makes no more of them than it has rows to decide.
        triples = np.clip(np.minimum(counts // 3, counts - landing), 0, None)
        total = int(triples.sum())
        if not total:
            break
        at = np.repeat(starts, triples) + 3 * (np.arange(total) - np.repeat(np.cumsum(triples) - triples, triples))
        a = live[at[:, None] + np.arange(3)]
        z, p = size[a], pi[a]
        u = np.stack([z[:, 1] - z[:, 2], z[:, 2] - z[:, 0], z[:, 0] - z[:, 1]], axis=1)
        u[(u == 0).all(axis=1)] = (1.0, -1.0, 0.0)  # equal sizes: any two of them
        u /= np.abs(u).max(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - p) / u, np.where(u < 0, p / -u, np.inf))
            down = np.where(u > 0, p / u, np.where(u < 0, (1 - p) / -u, np.inf))
        most, least = up.min(axis=1), down.min(axis=1)
        with np.errstate(over="ignore"):
            dice = (mix(h[a[:, 0]].view(U64) ^ mix(np.asarray([(level << 32) + turn + 1], U64))) >> U64(11)).astype(np.float64) / float(1 << 53)
        rising = dice * (most + least) < least
        new = np.where(rising[:, None], p + most[:, None] * u, p - least[:, None] * u)
        # The row that ends the step is decided whatever rounding says; others within rounding of a bound are too.
        ends = np.where(rising, up.argmin(axis=1), down.argmin(axis=1))
        rows = np.arange(len(a))
        new[rows, ends] = np.where((u[rows, ends] > 0) == rising, 1.0, 0.0)
        new[new < 1e-12] = 0.0
        new[new > 1 - 1e-12] = 1.0
        pi[a] = new
        live = live[(pi[live] > 0) & (pi[live] < 1)]
        turn += 1
    return pi


def land(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few undecided rows of one source: the least error in words plus that in documents; ties to the first way."""
    ways = (np.arange(1 << len(pi))[:, None] >> np.arange(len(pi))) & 1
    error = np.abs(ways @ size - pi @ size) + np.abs(ways.sum(axis=1) - pi.sum())
    return ways[int(np.argmin(np.round(error, 6)))].astype(np.float64)


def _flown(level: int, last: bool):
    """Arrow batches sorted by key, block and h -> the same rows with probabilities after the flight (and the landing)."""

    def decide(t: pa.Table) -> pa.RecordBatch:
        key, block = t["key"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), t["block"].to_numpy()
        group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
        h, size = t["h"].to_numpy(), t["size"].to_numpy()
        pi = flight(group, h, size, t["pi"].to_numpy(), level)
        if last:
            open_ = np.flatnonzero((pi > 0) & (pi < 1))
            for rows in np.split(open_, np.flatnonzero(np.diff(group[open_])) + 1):
                pi[rows] = land(size[rows], pi[rows])
        return t.set_column(t.schema.get_field_index("pi"), "pi", pa.array(pi)).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < HELD_ROWS:
                continue
            # The last group may go on in the next batch; one that fills all that is held (equal rows only) is cut.
            key, block = held["key"], held["block"].to_numpy()
            same = pc.equal(key, key[held.num_rows - 1]).combine_chunks().to_numpy(zero_copy_only=False) & (block == block[-1])
            begin = int(np.argmax(same)) or held.num_rows
            yield decide(held.slice(0, begin))
            held = held.slice(begin)
        if held is not None and held.num_rows:
            yield decide(held)

    return run


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Per row: doc_id, source, size (words), source_size, target, copies (how often the mix takes the document), taken (words)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h = F.xxhash64("doc_id", F.crc32(text.cast("binary")), F.octet_length(text))
    sized = scratch.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), h.alias("h")), "sized")
    targets = scratch.write(source_targets(sized, weights, most, scratch), "targets")
    blocks = max(1, -(-sized.count() // BLOCK_ROWS))
    # Sources have a row each: Spark broadcasts them where they are few, and splits a hot one where it must sort.
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rated = sized.join(targets, "key").withColumn("rate", rate)
    whole = F.floor(F.col("rate") + 1e-12)
    pi = F.greatest(F.lit(0.0), F.col("rate") - whole)
    todo = rated.select("key", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(blocks)).alias("block"), "h", "doc_id", "size", F.when(pi < 1e-12, 0.0).otherwise(pi).alias("pi"))
    schema = "key string, block long, h long, doc_id long, size long, pi double"
    done, level = None, 0
    while True:
        dealt = todo.repartition("key", "block").sortWithinPartitions("key", "block", "h", "doc_id", "size", "pi")
        flown = scratch.write(dealt.mapInArrow(_flown(level, blocks == 1), schema), f"flight-{level}")
        decided = flown.where("pi = 0 or pi = 1").select("key", "doc_id", "size", "pi")
        done = decided if done is None else done.unionByName(decided)
        if blocks == 1:
            break
        blocks, level = -(-blocks // FAN), level + 1
        todo = flown.where("pi > 0 and pi < 1").withColumn("block", F.floor(F.col("block") / FAN))
    out = done.join(targets, "key").withColumn("copies", (F.floor(rate + 1e-12) + F.col("pi")).cast("int"))
    source = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))
    return out.select("doc_id", source.alias("source"), "size", "source_size", F.col("target").cast("double").alias("target"), "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
