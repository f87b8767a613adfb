"""A Merkle manifest of a dataset: a tree per source, and one over the sources' roots.

Bottom-up, every level of all trees is one aggregation of the level below, and is written: runs of three consecutive
nodes become one, which keeps its children's digests. A tree ends where one node remains. Top-down, the levels are
joined again, children to parents: each child puts its siblings before the proof that its parent inherited, and the
sources' roots start from their proof in the upper tree. A step of a proof is what stands left and right of the node
in its run. Keys of all joins are (tree, place of the parent), so a source of any size is spread evenly.

Digests are lower-case hex wherever they are hashed, and 32 bytes where they are stored. The driver learns the number
of levels, nothing else.

Edge cases: null columns are hashed as `-`; a null doc_id stands first in its source; rows that share a doc_id stand
in the order of their leaves, and equal rows have equal leaves at neighbouring places; a null source is a source of its
own, the first one; a single row is leaf, subroot and root, its proof is empty (the digest of an empty text); empty
tables give no rows; texts of any length are hashed whole; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .places import placed, source_key
from .shared import Scratch

FAN_OUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Manifest:
    """levels[0]: doc_id, copy (leaf of the copy where it differs) and key, pos, n, digest of the leaves; then the nodes
    above, with `kids`. upper: the same over the sources' roots."""

    levels: list[DataFrame]
    upper: list[DataFrame]
    scratch: Scratch


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(fields: list[Column]) -> Column:
    """sha256 (32 bytes) of the fields: `-` where null, else the number of bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _tree(leaves: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """All levels above written leaves (key, pos, n, digest), each written."""
    levels = [leaves]
    widest = leaves.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        at = F.floor(F.col("pos") / FAN_OUT)
        run = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        up = levels[-1].where("n > 1").groupBy("key", at.alias("pos")).agg(F.first("n").alias("n"), run.alias("run"))
        kids = F.concat(*(F.coalesce(F.get("run", F.lit(i))["digest"], F.lit(b"")) for i in range(FAN_OUT)))
        up = up.select("key", "pos", F.floor((F.col("n") + FAN_OUT - 1) / FAN_OUT).alias("n"), kids.alias("kids"))
        up = up.withColumn("digest", F.unhex(F.sha2(hexed(F.col("kids")), 256)))
        levels.append(scratch.write(up, f"{name}-{len(levels)}"))
        widest = -(-widest // FAN_OUT)
    return levels


def build(docs: DataFrame, copy: Column | None = None) -> Manifest:
    """The manifest of `docs`. copy: what the text of a copy of the dataset is, to be verified against it."""
    scratch = Scratch(docs.sparkSession, "merkle")
    own = leaf([F.col(c) for c in FIELDS])
    other = F.lit(None).cast("binary")
    if copy is not None:
        other = F.when(~copy.eqNullSafe(F.col("text").cast("string")), leaf([*(F.col(c) for c in FIELDS[:-1]), copy]))
    rows = docs.select(F.col("doc_id"), source_key(F.col("source")).alias("key"), own.alias("digest"), other.alias("copy"))
    rows = scratch.write(rows, "rows")  # texts are read once
    leaves = scratch.write(placed(rows, ["key"], ["doc_id", "digest"], scratch, "parts"), "leaves")
    scratch.drop("rows")
    scratch.drop("parts")
    levels = _tree(leaves, scratch, "level")
    roots = levels[0].where("n = 1").select("key", "digest")
    for level in levels[1:]:
        roots = roots.unionByName(level.where("n = 1").select("key", "digest"))
    roots = scratch.write(roots.select(F.lit("all").alias("key"), F.col("key").alias("tree"), "digest"), "roots")
    first = scratch.write(placed(roots, ["key"], ["tree"], scratch, "root-parts"), "subroots")
    return Manifest(levels, _tree(first, scratch, "upper"), scratch)


def _pushed(levels: list[DataFrame], tops: DataFrame, more: list[str], scratch: Scratch, name: str) -> DataFrame:
    """The leaves with `proof` and the columns `more`. tops: key, proof, more, for the node that remains of each tree."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k]
        kept = [*own.columns, "proof", *more]
        out = own.where("n = 1").join(tops, "key").select(*kept)
        if above is not None:
            place = F.pmod(F.col("pos"), F.lit(FAN_OUT)).cast("int")
            run, size = F.col("__run"), 32 * place
            step = F.struct(F.substring(run, F.lit(1), size).alias("left"), F.substring(run, size + 33, F.lit(32 * FAN_OUT)).alias("right"))
            parents = above.select("key", F.col("pos").alias("__parent"), F.col("kids").alias("__run"), F.col("proof").alias("__proof"), *more)
            below = own.where("n > 1").withColumn("__parent", F.floor(F.col("pos") / FAN_OUT)).join(parents, ["key", "__parent"])
            out = out.unionByName(below.withColumn("proof", F.concat(F.array(step), F.col("__proof"))).select(*kept))
        above = out if k == 0 else scratch.write(out, f"{name}-{k}")
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: doc_id, key, pos, digest (its leaf), copy, proof (steps from the leaf to the root), subroot, root."""
    spark, scratch = manifest.scratch.spark, manifest.scratch
    top = manifest.upper[-1].select("key", F.array().cast("array<struct<left:binary,right:binary>>").alias("proof"), F.col("digest").alias("root"))
    subroots = _pushed(manifest.upper, top, ["root"], scratch, "upper-proof")
    tops = scratch.write(subroots.select(F.col("tree").alias("key"), "proof", F.col("digest").alias("subroot"), "root"), "tops")
    return _pushed(manifest.levels, tops, ["subroot", "root"], scratch, "proof")


def fold(digest: Column, proof: Column) -> Column:
    """The root (hex) that a leaf and its proof lead to."""
    return F.aggregate(proof, hexed(digest), lambda at, step: F.sha2(F.concat(hexed(step["left"]), at, hexed(step["right"])), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 (hex) of all siblings of a proof."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: hexed(F.concat(step["left"], step["right"]))), ""), 256)


def verified(docs: DataFrame, copy: Column) -> DataFrame:
    """Manifest and proofs of `docs`, and whether a copy whose text is `copy` still leads to the root: doc_id, leaf,
    subroot, root, proof_sha256, folded_root, verified."""
    each = proofs(build(docs, copy)).withColumn("folded_root", fold(F.coalesce("copy", "digest"), F.col("proof")))
    each = each.select("doc_id", hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root")
    return each.withColumn("verified", F.col("folded_root") == F.col("root"))
