import hashlib
import zlib

from pyspark.sql import functions as F

from tickforge.llm import merkle, queries
from tickforge.llm.labelled import remainder


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """All levels, and for each leaf its siblings (left, right) from the bottom up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 3])) for i in range(0, len(low), 3)])
    proofs = []
    for i in range(len(leaves)):
        steps, at = [], i
        for low in levels[:-1]:
            run = at // 3 * 3
            steps.append(("".join(low[run:at]), "".join(low[at + 1 : run + 3])))
            at //= 3
        proofs.append(steps)
    return levels[-1][0] if leaves else None, proofs


def brute(rows, tampered):
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((leaf_of(*row), row))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    roots, inner = {}, {}
    for s in names:
        by[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        roots[s], inner[s] = tree([x[0] for x in by[s]])
    root, outer = tree([roots[s] for s in names])
    out = []
    for s, above in zip(names, outer, strict=True):
        for (leaf, row), steps in zip(by[s], inner[s], strict=True):
            at = leaf_of(*row[:4], tampered(row))
            for left, right in [*steps, *above]:
                at = sha(left + at + right)
            out.append((row[0], leaf, roots[s], root, sha("".join(x + y for x, y in [*steps, *above])), at, at == root))
    return sorted(out, key=str)


def halves(row):
    return row[4].replace("\n", "") if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 else row[4]


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, key string, digest int")
    copy = F.when(remainder(2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.verified(docs, copy).collect()), key=str)


def test_every_edge_case_equals_a_plain_tree(spark):
    rows = [(i, f"s{i % 5 if i % 3 else 0}", "en", 3, f"line {i}\nnext") for i in range(230)]  # one source holds a third
    rows += [(300, None, None, None, None), (301, None, "é", -4, ""), (None, "s1", "en", 1, "a\n"), (None, "s1", "en", 1, "b\n"), (302, "", "en", 0, "x\r\n\n"), (303, "z" * 9, "en", 2, "é\n" * 50_000)]
    rows += [(7, "s2", "en", 3, "again\n"), (7, "s2", "en", 3, "again\n"), (9, "\U0001f40e", "en", 1, "\n"), (11, "￮", "en", 1, "\n")]
    assert run(spark, rows) == brute(rows, halves)


def test_small_trees(spark):
    for n in (0, 1, 2, 3, 4, 10):
        rows = [(i, "a", "en", 1, "t\n") for i in range(n)]
        assert run(spark, rows) == brute(rows, halves)
    rows = [(i, f"s{i}", "en", 1, "t") for i in range(7)]  # a source each
    assert run(spark, rows) == brute(rows, halves)


def test_a_changed_text_is_found_and_an_unchanged_one_is_not(spark):
    out = queries.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(out) == len(docs)
    for r in out:
        d = docs[r.doc_id]
        assert r.leaf == leaf_of(d.doc_id, d.source, d.lang, d.n_chars, d.text)
        assert r.verified == (halves((d.doc_id, 0, 0, 0, d.text)) == d.text) == (r.folded_root == r.root)
