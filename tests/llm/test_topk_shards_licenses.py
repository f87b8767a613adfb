import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import licenses, queries, shards, topk


def brute_topk(rows, is_query, k, scale=64):
    ok = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if is_query(q):
            best = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b)))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_topk_matches_brute_force_with_ties_and_bad_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(40)]) for i in range(300)]
    rows += [(300 + i, [0.25] * 40) for i in range(200)]  # one common vector
    rows += [(600, None), (601, []), (602, [float("nan")] * 40), (603, [float("inf")] + [0.0] * 39), (604, [None] + [1.0] * 39), (None, [1.0] * 40), (620, [1.0] * 7), (621, [2.0] * 7), (640, [1.0] * 3)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = topk.top_k(v, v.where("vec_id % 20 = 0"), k=20)
    assert {tuple(r) for r in got.collect()} == brute_topk(rows, lambda i: i % 20 == 0, 20)
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_pruned_search_equals_all_products():
    rng = np.random.default_rng(3)
    q, c = rng.integers(-40, 40, (64, 9)), (rng.integers(-40, 40, (64, 500)) * rng.choice([1, 1, 6], 500)).astype(np.int64)
    ids = np.arange(500) + 100
    r, j, s = topk.search(np.arange(9), q, ids, c, 5)
    full = q.T @ c
    for i in range(9):
        want = sorted(range(500), key=lambda x: (-full[i, x], x))[:5]
        assert j[r == i].tolist() == want and s[r == i].tolist() == [full[i, x] for x in want]
    big = 1 << 30
    _, _, s = topk.search(np.array([0]), np.full((4, 1), big), np.array([1]), np.full((4, 1), big - 1), 1)
    assert s.tolist() == [4 * big * (big - 1)]


def check_shards(rows, out, n):
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    text = {}
    for d, t in rows:
        text.setdefault(d, []).append((t or "").encode())
    for r in out:
        assert any(r["size"] == len(t) + 1 and r.text_crc32 == zlib.crc32(t) for t in text[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < n
    counts = Counter(r.shard for r in out)
    sizes = [counts.get(s, 0) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(n):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))


def test_shards_hold_the_law_and_keep_groups_together(spark):
    rng = random.Random(8)
    rows = [(i, f"text {rng.randrange(10**6)}") for i in range(900)]
    for g in range(40):
        rows += [(1000 + 10 * g + i, f"group {g}") for i in range(6)]
    rows += [(2000 + i, "hot") for i in range(500)]
    rows += [(3000, None), (3001, ""), (None, "x"), (3002, "same"), (3002, "same")]
    out = shards.shard(spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")), 16).collect()
    check_shards(rows, out, 16)
    where = {r.doc_id: r.shard for r in out}
    whole = sum(len({where[1000 + 10 * g + i] for i in range(6)}) == 1 for g in range(40))
    assert whole >= 25
    assert len({where[2000 + i] for i in range(500)}) <= 10


def test_few_rows_and_none(spark):
    rows = [(i, "a") for i in range(5)]
    check_shards(rows, shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect(), 16)
    assert shards.shard(spark.createDataFrame([], "doc_id long, text string"), 16).count() == 0


def brute_licenses(rows, templates, t):
    grams = lambda s: {(a, b) for w in [re.sub(r"[\W_]+", " ", s.lower()).split()] for a, b in zip(w, w[1:], strict=False)}
    known = [(i, name, grams(text)) for i, name, text in templates]
    found = {}
    for d, text in rows:
        if text is None:
            continue
        for unit in dict.fromkeys(re.sub(r"([.;!?])\s+", r"\1\n", text).split("\n") + text.split("\n") + re.split(r"\n[ \t\r]*\n", text) + [text]):
            g = grams(unit)
            near = [(2 * len(g & k) / (len(g) + len(k)), -i, name) for i, name, k in known if g and k]
            if near and max(near)[0] >= t:
                best = max(near)
                dice, n = found.get((d, best[2]), (0, 0))
                found[d, best[2]] = (max(dice, best[0]), n + 1)
    return {(*k, round(v[0], 9), v[1]) for k, v in found.items()}


def test_licenses_match_brute_force(spark):
    full = "Permission is hereby granted. Free of charge, to any person\nobtaining a copy of this software! And so on"
    templates = [(i, *x) for i, x in enumerate(licenses.TEMPLATES)] + [(50, "whole", full), (51, "none", "one"), (52, "mit", licenses.NOTICES[1][1])]
    rows = [
        (1, "Some text. Released under the MIT License. More text"), (2, "Licensed under CC BY-NC 4.0.\nother line"), (3, full), (4, "nothing here"), (5, None), (6, ""), (7, "word"), (None, "All rights reserved."),
        (8, "this work is licensed under the gnu general public license version 3"), (8, "Licensed under the Apache License version 2.0"), (9, "released released under the the MIT license license " * 3), (10, "x " * 50000),
        (12, "Copyright (c) Someone\n\n" + "\n \n".join(t.replace(", ", ",\n", 3) for _, t in licenses.PARAGRAPHS[:3]) + "\n\nand code"), (13, licenses.PARAGRAPHS[10][1].replace("program", "library")),
        (11, "All rights reserved."), (11, "All rights reserved."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    table = spark.createDataFrame(templates, "template_id long, license string, text string")
    out = licenses.license_matches(docs, table)
    assert {(r.doc_id, r.license, round(r.dice, 9), r.n_units) for r in out.collect()} == brute_licenses(rows, templates, licenses.DICE)
    assert licenses.license_matches(docs.limit(0)).count() == 0 == licenses.license_matches(docs, table.limit(0)).count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)


@pytest.mark.parametrize("name", ["op3_exact_topk", "op5_minhash_near_dedup", "op10_license_scan"])
def test_sql_is_registered(name):
    assert name in queries.oracle_sql() and name in queries.queries()
