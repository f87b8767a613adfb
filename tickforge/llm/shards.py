"""Sharding by balanced label propagation.

Documents that belong to a common group (equal texts by default) are linked. Every linked document starts on a shard
by hash. In each round Spark joins tell how many members of a group sit on each shard; those elsewhere want to go
where most are, of the shards with room (ties by a hash of group and shard). How many may go from one shard to
another is a quota: as many as come back the other way, and a part of the room left; which ones go follows from a
hash, so the quota needs counts only, no ranking. Documents without links then fill each shard's room. A last step
makes the law hold exactly: documents are put in one order, by label, then group, and shard s takes its equal share of
that order, so few groups are cut at a bound.

The law here is `rows`: shards differ by one document at most. Ranks are counts of buckets before plus a rank within
the bucket. Buckets are cut by hashes of group and document and grow in number with the table, so no task gets a
whole shard or a whole group.

Edge cases: null texts are empty (size 1) and equal to empty ones; a null doc_id is placed like any other; repeated
rows are linked and each gets a slot; fewer documents than shards leave shards empty; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

ROUNDS, SLACK = 12, 0.02
#: Groups below this part of a shard move as one.
WHOLE = 50
BUCKET_ROWS = 2000


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and `grp`, a 128-bit digest by which equal texts are linked."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("grp"))


def _propagate(nodes: DataFrame, shards: int, total: int, scratch: Scratch, rounds: int) -> DataFrame:
    """Linked nodes (uid, grp) -> (uid, grp, label) after rounds of moves under quotas.

    Documents without links take what room is left afterwards, so the linked ones may use a shard's whole share.
    """
    linked_groups = nodes.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select("grp")
    linked = nodes.join(linked_groups, "grp").select("uid", "grp")
    labels = scratch.write(linked.withColumn("label", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")), "labels-0")
    room = total // shards
    for k in range(1, rounds + 1):
        on = labels.groupBy("grp", "label").agg(F.count("*").alias("here")).withColumn("tie", F.xxhash64("grp", "label"))
        on = scratch.write(on, f"on-{k}")
        used = {r.label: r.n for r in on.groupBy("label").agg(F.sum("here").alias("n")).collect()}
        open_ = [s for s in range(shards) if used.get(s, 0) < room * (1 - SLACK)]
        if not open_:
            break
        # A group has a row for each shard at most. It gathers where most members are, of the shards with room.
        place = F.struct("here", "tie", "label")
        best = on.where(F.col("label").isin(open_)).groupBy("grp").agg(F.max(place).alias("top"))
        pull = on.join(best, "grp").where(place < F.col("top")).select("grp", "label", F.col("top.label").alias("target"), "here")
        # Where a shard is full already, what a group has there stays; counts of shards by shards go to the driver.
        flow = {(r.label, r.target): r.n for r in pull.groupBy("label", "target").agg(F.sum("here").alias("n")).collect()}
        if not flow:
            break
        asked = {t: sum(n for (_, b), n in flow.items() if b == t) for t in open_}
        quota = {(a, b): min(1.0, (flow.get((b, a), 0) + max(0, room - used.get(b, 0)) * n / asked[b]) / n) for (a, b), n in flow.items()}
        allowed = F.lit(0.0)
        for (a, b), q in quota.items():
            allowed = F.when((F.col("label") == a) & (F.col("target") == b), F.lit(q)).otherwise(allowed)
        # Small groups move as one, the members of larger ones each for itself.
        dice = F.pmod(F.xxhash64("grp", F.lit(k), F.when(F.col("here") > room // WHOLE, F.col("uid"))), F.lit(1 << 20)) / float(1 << 20)
        moved = labels.join(pull, ["grp", "label"], "left").select("uid", "grp", F.when(F.col("target").isNotNull() & (dice < allowed), F.col("target")).otherwise(F.col("label")).alias("label"))
        labels = scratch.write(moved, f"labels-{k}")
        scratch.drop(f"on-{k}")
    return labels


def _ranks(rows: DataFrame, order: list, name: str, by: list[str] | None = None) -> DataFrame:
    """`rows` with a gapless 0-based `name` within `by` (or over all). order: leading columns, then the bucket column, which
    together name a bucket and order the buckets; then columns that order a bucket. None of them may be null."""
    lead, bucket, inner = order
    by = by or []
    sizes = rows.groupBy(*by, *lead, bucket).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*by).orderBy(*lead, bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    numbered = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*by, *lead, bucket).orderBy(*inner)) - 1)
    return numbered.join(offsets, [*by, *lead, bucket]).withColumn(name, (F.col("__before") + F.col("__at")).cast("long")).drop("__before", "__at")


def shard(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is `rows`)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    sized = document_sizes(docs)
    # A document's own key: repeated rows differ by the number of their partition and place, fixed once written.
    nodes = scratch.write(sized.withColumn("uid", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()
    linked = _propagate(nodes.select("uid", "grp"), shards, total, scratch, rounds)
    # Documents without links: their place in a hash order, cut where each shard's room ends.
    alone = nodes.select("uid", "grp").join(linked.select("grp").distinct(), "grp", "left_anti")
    want = max(1, math.ceil(total / shards / BUCKET_ROWS))
    alone = _ranks(alone.withColumn("b", F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(4 * shards * want))), [[], "b", ["uid"]], "rank")
    used = {r.label: r.n for r in linked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ends, at = [], 0
    for s in range(shards):
        at += max(0, total * (s + 1) // shards - total * s // shards - used.get(s, 0))
        ends.append(at)
    fill = F.lit(shards - 1)
    for s in range(shards - 2, -1, -1):
        fill = F.when(F.col("rank") < ends[s], s).otherwise(fill)
    labels = scratch.write(linked.select("uid", "grp", "label").unionByName(alone.select("uid", "grp", fill.cast("int").alias("label"))), "labels")
    # Order: label, leading bits of the group, leading bits of the document. A bucket has some BUCKET_ROWS rows on average,
    # and a group of any size spreads over all document bits.
    doc_bits = max(4, min(20, want.bit_length() + 1))
    grp_cut, doc_cut = F.pmod(F.xxhash64("grp"), F.lit(max(16, 4 * want))), F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(1 << doc_bits))
    big = nodes.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS // 4).select("grp", F.lit(True).alias("big"))
    keyed = labels.join(big, "grp", "left").select("uid", "label", "grp", grp_cut.alias("g"), F.when(F.col("big"), doc_cut + 1).otherwise(0).alias("d"), F.when(F.col("big"), F.col("grp")).otherwise(F.unhex(F.lit(""))).alias("bg"))
    ranked = _ranks(keyed, [["label", "g", "bg"], "d", ["grp", "uid"]], "rank")
    placed = scratch.write(ranked.select("uid", F.floor(F.col("rank") * shards / F.lit(max(total, 1))).cast("int").alias("shard"), (F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(4 * want))).alias("b")), "placed")
    slots = _ranks(placed, [[], "b", ["uid"]], "slot", ["shard"])
    out = nodes.drop("grp").join(slots.select("uid", "shard", "slot"), "uid")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
