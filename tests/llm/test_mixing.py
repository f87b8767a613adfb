import re
from collections import defaultdict

import numpy as np

from tickforge.llm import mixing, queries


def plain_targets(sizes, most=3):
    """Targets by sharing again and again what is above a source's ceiling."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in held]
        rest, w = total - sum(held.values()), sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / w for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return held | share
        held |= {s: most * sizes[s] for s in above}


def checked(rows, out, slack=0.01):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r.doc_id, r["size"], r.source) for r in out), key=str) == sorted(((d, size(t), s) for d, t, s in rows), key=str)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, t, s in rows:
        sizes[s] += size(t)
    targets = plain_targets(sizes) if sizes else {}
    copies = defaultdict(set)
    for r in out:
        taken[r.source] += r.taken
        copies[r.source].add(r.copies)
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * max(1, targets[r.source])
    for s, n in taken.items():
        assert len(copies[s]) <= 2 and abs(n - targets[s]) <= max(slack * targets[s], 20), (s, n, targets[s])
    return taken


def test_mix_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    out = queries.op13_source_mixing(spark, "/root/testdata/sf0.01").collect()
    checked(rows, out, 0.002)
    again = mixing.mix_sources(docs.repartition(13)).select(*out[0].__fields__).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))  # whatever the layout


def test_edge_cases(spark):
    rows = [(i, "w " * (1 + i % 40), "hot") for i in range(1500)] + [(i, "w " * 3, f"s{i % 4}") for i in range(300)]
    rows += [(None, "a b c", "hot"), (5, None, "none"), (6, "", "none"), (7, " x y", None), (8, "k " * 30_000, None), (8, "k " * 30_000, None), (9, "only", "\U0001f40e"), (10, "only", "￮")]
    rows += [(99, "same text here", "s1")] * 50
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    out = mixing.mix_sources(docs).collect()
    big = {None: 60_000}  # two documents of half the source each: no way to come nearer
    sizes = defaultdict(int)
    for d, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets, got = plain_targets({s: max(n, 1e-9) for s, n in sizes.items()}), defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        got[r.source] += r.taken
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3 and abs(r.target - targets[r.source]) < 1e-3
    for s, n in targets.items():
        assert abs(got[s] - n) <= big.get(s, 4), (s, got[s], n)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_blocks_of_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(i, "w " * (1 + i * 7 % 90), "ab"[i % 3 == 0]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    checked(rows, mixing.mix_sources(docs).collect(), 0.001)


def plain_flight(h, size, pi, level, landing):
    """One group, one triple at a time."""
    pi, turn = list(pi), 0
    u64 = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & u64
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & u64
        return x ^ (x >> 31)

    while True:
        live = [i for i, p in enumerate(pi) if 0 < p < 1]
        triples = min(len(live) // 3, len(live) - landing)
        if triples <= 0:
            return pi
        for k in range(triples):
            a = live[3 * k : 3 * k + 3]
            z = [size[i] for i in a]
            u = [z[1] - z[2], z[2] - z[0], z[0] - z[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
            top = max(map(abs, u))
            u = [x / top for x in u]
            up = [(1 - pi[i]) / x if x > 0 else pi[i] / -x if x < 0 else float("inf") for i, x in zip(a, u, strict=True)]
            down = [pi[i] / x if x > 0 else (1 - pi[i]) / -x if x < 0 else float("inf") for i, x in zip(a, u, strict=True)]
            rising = (mix((int(h[a[0]]) & u64) ^ mix((level << 32) + turn + 1)) >> 11) / (1 << 53) * (min(up) + min(down)) < min(down)
            way, end = (min(up), up.index(min(up))) if rising else (-min(down), down.index(min(down)))
            for j, i in enumerate(a):
                p = pi[i] + way * u[j]
                pi[i] = float((u[j] > 0) == rising) if j == end else 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p
        turn += 1


def test_flight_of_all_groups_equals_one_triple_at_a_time():
    rng = np.random.default_rng(4)
    group = np.sort(rng.integers(0, 9, 400))
    h, size, pi = rng.integers(-(1 << 62), 1 << 62, 400), rng.choice([0, 3, 3, 17, 900], 400), rng.random(400)
    pi[::17] = 0.0
    out = mixing.flight(group, h, size, pi, 2)
    for g in range(9):
        own = group == g
        assert np.allclose(out[own], plain_flight(h[own], size[own].astype(float), pi[own], 2, mixing.LANDING), atol=1e-9)
        assert abs(out[own].sum() - pi[own].sum()) < 1e-6 and abs(out[own] @ size[own] - pi[own] @ size[own]) < 1e-6
        assert ((out[own] > 0) & (out[own] < 1)).sum() <= mixing.LANDING


def test_expectations_stay(spark):
    rng = np.random.default_rng(5)
    size, pi = rng.integers(1, 50, 60), np.full(60, 0.3)
    many = np.stack([mixing.flight(np.zeros(60, int), rng.integers(-(1 << 62), 1 << 62, 60), size, pi, 0, landing=2) for _ in range(3000)])
    assert np.abs(many.mean(axis=0) - 0.3).max() < 0.05


def test_landing_takes_the_nearest_way():
    size, pi = np.array([100, 60, 41, 7, 5]), np.full(5, 0.5)
    out = mixing.land(size, pi)
    best = min(abs(np.array(w) @ size - pi @ size) + abs(sum(w) - 2.5) for w in np.ndindex(*(2,) * 5))
    assert abs(out @ size - pi @ size) + abs(out.sum() - 2.5) == best
