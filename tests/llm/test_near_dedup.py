import random
import re

import pytest

from tickforge.llm.near_dedup import keep_one, near_duplicates

SF = "/root/testdata/sf0.001"


def brute(rows, k, num, den):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    comp = {d: d for d in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {(d, len(sets[d]), root(d), root(d) == d) for d in ids}


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_matches_brute_force_on_documents(spark, k, num):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {tuple(r) for r in near_duplicates(docs, k, num, 100).collect()} == brute(rows, k, num, 100)


def test_large_groups_and_chains(spark):
    """Variants of one base, each a few words off, so that many are linked only through others."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    rows = [(0, " ".join(base)), (1, " ".join(base)), (2, None), (3, ""), (4, "One two"), (5, "one  TWO"), (6, " \n\t")]
    for i in range(7, 300):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs, 3, 85, 100).collect()} == brute(rows, 3, 85, 100)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a b c d", 1), (7, "a b c d", 2), (7, "a b c d", 3), (9, "a b c d", 4)], "doc_id long, text string, kept int")
    rows = sorted(near_duplicates(docs, 3, 85, 100).collect(), key=str)
    assert {tuple(r) for r in rows} == {(None, 2, None, True), (7, 2, 7, True), (9, 2, 7, False)}
    assert sorted(r["kept"] for r in keep_one(docs).collect()) == [1, 2, 3]
    assert near_duplicates(docs.limit(0)).count() == 0
