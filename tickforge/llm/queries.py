"""The registered queries over the testing tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, infill, licenses, merge_dropout, merkle, mixing, near_dedup, quality, shards, substring_dedup, token_files, topk, toxicity
from .labelled import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(scores: DataFrame, held_out, threshold: float, *more: str) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), remainder(4) == 2
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), held_out)
    return _judged(toxicity.score(docs, model), held_out, toxicity.THRESHOLD, "offending_sentences", "worst_start", "worst_end")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


def op4_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the check values of the text that they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = merge_dropout.encode(docs, decoded="decoded")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.crc32("decoded").alias("decoded_crc32"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), remainder(5) == 0
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), held_out)
    return _judged(quality.score(docs, model), held_out, quality.THRESHOLD)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents"), 16)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; the copy that is verified has lost its line ends where crc32 of the doc_id is even."""
    copy = F.when(remainder(2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verified(_table(spark, sf_dir, "documents"), copy)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.checked(_table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scores)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""

_NOTICES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))
_GRAMS = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
_NORMAL = r"string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
_LICENSES = f"""
WITH templates(template_id, license, text) AS (VALUES {_NOTICES}),
t_words AS (SELECT template_id, license, {_NORMAL.format("text")} AS w FROM templates),
known AS (SELECT template_id, license, {_GRAMS.format("w")} AS t FROM t_words),
numbered AS (SELECT row_number() OVER () AS uid, doc_id, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT uid, doc_id, unnest(list_distinct(list_concat(
    string_split(regexp_replace(text, '([.;!?])[\t\n\f\r\x0B ]+', '\1' || chr(10), 'g'), chr(10)), list_concat(string_split(text, chr(10)), list_concat(string_split_regex(text, '\n[ \t\r]*\n'), [text]))))) AS unit
  FROM numbered),
words AS (SELECT uid, doc_id, unit, {_NORMAL.format("unit")} AS w FROM units WHERE length(unit) > 0),
grams AS (SELECT uid, doc_id, unit, {_GRAMS.format("w")} AS g FROM words WHERE len(w) >= 2),
scored AS (
  SELECT uid, doc_id, unit, template_id, license,
    CAST(2 * len(list_intersect(g, t)) AS DOUBLE) / (len(g) + len(t)) AS dice
  FROM grams JOIN known ON len(t) > 0 AND len(g) <= 1.5 * len(t) + 1 AND 1.5 * len(g) + 1 >= len(t)),
best AS (
  SELECT *, row_number() OVER (PARTITION BY uid, unit ORDER BY dice DESC, template_id) AS n FROM scored WHERE dice >= 0.8)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM best WHERE n = 1 GROUP BY doc_id, license
""".replace("\\\\p", "\\p")

_NEAR = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(v, doc_id)) AS component_id, doc_id <= coalesce(v, doc_id) AS kept
FROM sets LEFT JOIN least ON u = doc_id
"""


#: CRC-32 has no function in DuckDB: a bit at a time over the digits of doc_id.
_CRC = """list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))), lambda s, b:
  list_reduce(list_concat([xor(s, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END))"""
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in merkle.FIELDS) + ")"
_TREE = lambda name, first: f"""{name}(key, lvl, pos, n, digest) AS (
  {first} UNION ALL
  SELECT key, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY key, lvl, pos // 3),
{name}_steps AS (SELECT a.key, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.key = b.key AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL)"""  # noqa: E731
_MERKLE = f"""
WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS uid, coalesce('s' || source, '') AS key, ({_CRC}) % 2 AS bit FROM documents),
g AS (SELECT uid, doc_id, key, {_LEAF} AS leaf, CASE WHEN bit = 1 THEN replace(text, chr(10), '') ELSE text END AS text, source, lang, n_chars FROM d),
h AS (SELECT uid, doc_id, key, leaf, {_LEAF} AS claimed, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM g),
{_TREE("up", "SELECT key, 0, pos, n, leaf FROM h")},
sub AS (SELECT key, digest AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
{_TREE("top", "SELECT 'all', 0, pos, n, subroot FROM sub")},
way(uid, upper, lvl, pos, proof, folded) AS (
  SELECT uid, false, 0, pos, '', claimed FROM h UNION ALL
  SELECT w.uid, CASE WHEN s.lvl IS NULL THEN true ELSE w.upper END, CASE WHEN s.lvl IS NULL AND NOT w.upper THEN 0 ELSE w.lvl + 1 END, CASE WHEN s.lvl IS NULL AND NOT w.upper THEN sub.pos ELSE w.pos // 3 END,
    proof || coalesce(s.l || s.r, ''), CASE WHEN s.lvl IS NULL THEN folded ELSE sha256(s.l || folded || s.r) END
  FROM way w JOIN h USING (uid) JOIN sub ON sub.key = h.key
  LEFT JOIN (SELECT false AS upper, * FROM up_steps UNION ALL SELECT true, * FROM top_steps) s ON s.upper = w.upper AND s.lvl = w.lvl AND s.pos = w.pos AND s.key = CASE WHEN w.upper THEN 'all' ELSE h.key END
  WHERE s.lvl IS NOT NULL OR NOT w.upper),
ended AS (SELECT uid, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM way WHERE upper GROUP BY uid)
SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = (SELECT digest FROM top WHERE n = 1) AS verified
FROM h JOIN ended USING (uid) JOIN sub ON sub.key = h.key
"""

_NUMBER = lambda k: f"CAST('0x' || substr(hash, {8 * k + 1}, 8) AS BIGINT)"
_INFILL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash FROM documents),
c AS (SELECT *, len(units) AS n, least({_NUMBER(0)} % (len(units) + 1), {_NUMBER(1)} % (len(units) + 1)) AS lo, greatest({_NUMBER(0)} % (len(units) + 1), {_NUMBER(1)} % (len(units) + 1)) AS hi,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_NUMBER(2)} % 100 >= 100 THEN 'plain' WHEN {_NUMBER(3)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, coalesce(array_to_string(list_slice(units, 1, lo), ''), '') AS prefix, coalesce(array_to_string(list_slice(units, lo + 1, hi), ''), '') AS middle, coalesce(array_to_string(list_slice(units, hi + 1, n), ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_merkle_manifest": _MERKLE, "op12_fill_in_middle": _INFILL, "op3_exact_topk": _TOPK, "op5_minhash_near_dedup": _NEAR, "op10_license_scan": _LICENSES}
