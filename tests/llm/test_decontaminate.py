import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tickforge.llm import decontaminate as dc


def word_list(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", "".join(c.lower() if c.isascii() else c for c in text or "").encode())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def nearest(item, w):
    """(edits, start, words) of the nearest window of w, of equal ones the first, then the shortest; cell by cell."""
    row = [(0, s, 0) for s in range(len(w) + 1)]
    for i, x in enumerate(item, 1):
        new = [(i, 0, 0)]
        for j, y in enumerate(w, 1):
            up, side, both = row[j], new[j - 1], row[j - 1]
            new.append(min((up[0] + 1, up[1], j - up[1]), (side[0] + 1, side[1], j - side[1]), (both[0] + (x != y), both[1], j - both[1])))
        row = new
    return min(row)


def brute(docs, items, rate, least=dc.MIN_WORDS):
    out = {}
    for d, t in docs:
        w = word_list(t)
        for i, it in items:
            n = word_list(it)
            near = nearest(n, w)
            if len(n) >= least and near[0] <= dc.edits(len(n), rate):
                out[d, i] = near
    return out


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh") + "".join(rng.choice("klmnoprstuäé") for _ in range(rng.randrange(1, 6)))
    vocabulary = [word() for _ in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.randrange(8, 60)))) for i in range(18)] + [(90, "too short it"), (91, None), (92, "")]
    docs = []
    for i in range(90):
        text = some(rng.randrange(0, 60))
        if i % 2 == 0:
            leak = items[rng.randrange(18)][1].split()
            for _ in range(rng.randrange(0, dc.edits(len(leak), dc.RATE) + 2)):
                p, kind = rng.randrange(len(leak)), rng.randrange(3)
                leak[p : p + (kind != 1)] = [] if kind == 2 else [word()]
            text += leak + some(rng.randrange(0, 40))
        docs.append((i, (", " if i % 3 else " ").join(text).upper() if i % 5 == 0 else " ".join(text)))
    return docs + [(500, None), (501, ""), (502, items[0][1])], items


@pytest.fixture(scope="module")
def case():
    docs, items = corpus()
    return docs, items, brute(docs, items, dc.RATE)


def test_finds_what_brute_force_finds(spark, case):
    docs, items, want = case
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.edits, r.start_word, r.n_words) for r in got} == want and len(got) == len(want) > 30


def test_clean_keeps_what_leaks_nothing(spark, case):
    docs, items, want = case
    table = spark.createDataFrame([(d, t, "x") for d, t in docs] + [(None, items[0][1], "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    gone = {d for d, _ in want}
    left = [r.doc_id for r in dc.clean(table, bench).collect()]
    assert {d for d, _ in docs} - gone <= set(left) and None in left
    assert 502 not in left
    assert dc.leaks(table.limit(0), bench).count() == 0 == dc.leaks(table, bench.limit(0)).count()


def test_nearest_windows():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([[rng.randrange(4) for _ in range(n)] for _ in range(5)] for n in (rng.randrange(1, 9), rng.randrange(9)))
        got = dc.nearest_windows(*(np.array(x, np.int64).reshape(5, -1) for x in (a, b)))
        for i in range(5):
            far = min(distance(a[i], b[i][s:e]) for s in range(len(b[i]) + 1) for e in range(s, len(b[i]) + 1))
            assert got[0][i] == far == distance(a[i], b[i][got[1][i] : got[1][i] + got[2][i]])


@pytest.mark.parametrize("n", [5, 8, 16, 40, 60])
def test_repeats_reach_the_target_on_other_copies(n):
    """Copies that the repeats were not measured with, all edits of them in one part of the item for some."""
    d = dc.edits(n, dc.RATE)
    wide, copies = dc.edited_copies(n, dc.RATE, 1000, seed=77)
    items, last = wide[:, :n], dc.repeats_for(n, dc.RATE)
    assert (dc.keys(wide, n, 0, last) == dc.keys(copies, n, 0, last)).any(axis=1).mean() >= 0.995
    for at in (0, n // 2, n - d):
        changed = items.copy()
        changed[:, at : at + d] += np.uint64(1)
        window = np.concatenate([changed, copies[:, n:]], axis=1)
        assert (dc.keys(wide, n, 0, last) == dc.keys(window, n, 0, last)).any(axis=1).mean() >= 0.97


def test_keys_are_those_of_a_plain_walk():
    rng = np.random.default_rng(3)
    for n in (3, 20, 70):
        words = rng.integers(1 << 63, size=(4, n + 5)).astype(np.uint64)
        words[1, n - 1 :] = dc._PAD
        got = dc.keys(words, n, 2, 9)
        for w, row in zip(words, got, strict=True):
            for salt, key in zip(dc.keyed(9, 41)[2:], row, strict=True):
                begin = int(dc.mix(salt)) % max(1, 2 * n - (dc.SAMPLES - 1) * dc.APART)
                at, seen = 0, []
                for j in range(begin + (dc.SAMPLES - 1) * dc.APART + 1):
                    word = w[at] if at < len(w) else dc._PAD
                    if (j - begin) % dc.APART == 0 and j >= begin:
                        seen.append(word)
                    with np.errstate(over="ignore"):
                        at += int(dc.mix(word + salt + np.uint64(j - j % 64))) >> j % 64 & 1
                with np.errstate(over="ignore"):
                    want = salt + np.uint64(n)
                    for x in seen:
                        want = dc.mix(want * np.uint64(0x9E3779B97F4A7C15) + x)
                assert key == want


def test_windows_begin_near_every_start():
    bounds = np.array([0, 7, 7, 20, 21])
    starts = np.array([0, 5, 6, 7, 9, 12, 19, 20])
    got = dc.nearest_starts(starts, bounds, 3)
    assert got.tolist() == [0, 6, 7, 10, 13, 19, 20]
    assert dc.nearest_starts(starts, bounds, 1).tolist() == starts.tolist()


def test_windows_of_a_text_that_keep_enough_pairs():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randrange(0, 12) for _ in range(4)]
        bounds = np.cumsum([0, *sizes])
        at = np.array(sorted(p for r in range(4) for p in range(bounds[r], bounds[r + 1] - 1) if rng.random() < 0.6), np.int64)
        rows = np.searchsorted(bounds, at, side="right") - 1
        need, width = rng.randrange(1, 5), rng.randrange(3, 9)
        want = [s for r in range(4) for s in range(bounds[r], bounds[r + 1]) if sum(s <= p <= s + width - 2 for p, q in zip(at, rows, strict=True) if q == r) >= need]
        assert dc.window_starts(at, rows, bounds, need, width).tolist() == want


def test_very_long_text_and_repeated_rows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    item = " ".join(word() for _ in range(30))
    long = " ".join([*(word() for _ in range(300_000)), item, *(word() for _ in range(10))])
    docs = spark.createDataFrame([(1, long), (2, item), (2, item), (2, "other text of this row")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, item)], "item_id long, text string")
    got = sorted(map(tuple, dc.leaks(docs, bench).collect()))
    assert got == [(1, 7, 300_000, 30, 0), (1, 8, 300_000, 30, 0), (2, 7, 0, 30, 0), (2, 8, 0, 30, 0)]


def test_short_items_word_for_word(spark):
    docs = spark.createDataFrame([(1, "so the End came"), (2, "the very end"), (3, "end the"), (4, "at the long last end"), (5, "at the Long, last END")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the end"), (2, "end"), (3, "the long last end")], "item_id long, text string")
    assert sorted(map(tuple, dc.leaks(docs, bench).collect())) == [(1, 1, 1, 2, 0), (4, 3, 1, 4, 0), (5, 3, 1, 4, 0)]
    assert dc.leaks(docs, bench, min_words=5).count() == 0


def test_segments_are_of_equal_length_and_one_keeps_its_share():
    rng = random.Random(4)
    for n in (1, 60, 61, 119, 120, 121, 1000, 5003):
        bounds = dc.segment_bounds(n)
        sizes = [b - a for a, b in zip(bounds, bounds[1:], strict=False)]
        assert bounds[0] == 0 and bounds[-1] == n and max(sizes) <= dc.SEGMENT and max(sizes) - min(sizes) <= 1
        for _ in range(20):  # however the edits lie
            hit = [0] * len(sizes)
            for _ in range(dc.edits(n, dc.RATE)):
                hit[min(int(abs(rng.gauss(0, 0.6)) * len(sizes)), len(sizes) - 1)] += 1
            assert any(e <= dc.edits(m, dc.RATE) for e, m in zip(hit, sizes, strict=True))


def test_long_items_with_every_edit_allowed(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate((61, 120, 300, 600, 1000, 5000))]
    items += [(9, items[0][1] + [word() for _ in range(200)])]  # begins with another item
    docs, want, within = [], set(), {}
    for i, w in items[:6]:
        for k in range(3 if len(w) < 5000 else 1):
            copy, d = list(w), dc.edits(len(w), dc.RATE)
            if k == 0:  # all in the first part
                copy[:d] = [word() for _ in range(d)]
            for _ in range(d if k else 0):
                at, kind = rng.randrange(len(copy)), rng.randrange(3)
                copy[at : at + (kind != 1)] = [] if kind == 2 else [word()]
            docs.append((100 * i + k, " ".join([word() for _ in range(30 * k)] + copy + [word() for _ in range(25)])))
            want.add((100 * i + k, i))
            within[100 * i + k, i] = (d, 30 * k)
        other = list(w)
        for at in range(0, len(w), 3):  # too far off
            other[at] = word()
        docs.append((100 * i + 90, " ".join(other)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.leaks(table, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    for r in got:
        d, at = within[r.doc_id, r.item_id]
        assert r.edits <= d and abs(r.start_word - at) <= d


def test_memory_of_long_items_is_that_of_short_ones():
    rng = np.random.default_rng(6)
    n = dc.SEGMENT
    h = rng.integers(1 << 63, size=2 * dc.KEY_ROWS * 70).astype(np.uint64)
    starts = np.arange(dc.KEY_ROWS) * 140  # windows that share no word: the worst case
    tracemalloc.start()
    dc.keys_at(h, starts, starts + 140, n, dc.window_words(n, dc.RATE), 0, dc.repeats_for(n, dc.RATE))
    walk = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    item = rng.integers(1 << 63, size=5000).astype(np.uint64)
    wide = np.concatenate([item, rng.integers(1 << 63, size=2200).astype(np.uint64)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(range(12)), pa.array([0] * 12), *(pa.ListArray.from_arrays(pa.array(np.arange(13) * len(x), pa.int32()), pa.array(np.tile(x, 12).view(np.int64))) for x in (wide, item))], names=["doc_id", "item", "at", "words", "item_words"])
    (out,) = dc._verify(dc.RATE)(iter([batch]))
    assert out.column("edits").to_pylist() == [0] * 12
    assert walk < 100e6 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_no_leak_at_the_largest_distance_is_missed(spark):
    """Copies with every edit allowed, of short and long items, keep few steps of any walk."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate((5, 9, 16, 40, 59, 120, 300))]
    docs, want = [], set()
    for i, w in items:
        for k in range(20):
            copy = list(w)
            for at in rng.sample(range(len(w)), dc.edits(len(w), dc.RATE)):
                copy[at] = word()
            docs.append((100 * i + k, " ".join([word() for _ in range(k)] + copy + [word() for _ in range(20 - k)])))
            want.add((100 * i + k, i, dc.edits(len(w), dc.RATE), k))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.leaks(table, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.edits, r.start_word) for r in got} == want


def test_dropped_and_inserted_words_cost_one_edit_each(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(4))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate((5, 9, 12, 20))] + [(8, ["a", "b"] * 6)]
    docs = []
    for i, w in items:
        d = dc.edits(len(w), dc.RATE)
        for k in range(-d - 1, d + 2):
            copy = w[:1] + w[1 - k :] if k < 0 else w[:1] + [word() for _ in range(k)] + w[1:]
            docs.append((100 * i + k + 50, " ".join([word() for _ in range(rng.randrange(4))] + copy + [word() for _ in range(rng.randrange(6))])))
    items = [(i, " ".join(w)) for i, w in items]
    want = brute(docs, items, dc.RATE)
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.edits, r.start_word, r.n_words) for r in dc.leaks(table, bench).collect()}
    assert got == want
