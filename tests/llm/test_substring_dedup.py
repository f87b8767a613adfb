import random
import re

import numpy as np
import pytest

from tickforge.llm import substring_dedup as sd


def text(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def brute_chunks(b):
    """Cuts byte by byte: by the gear hash in its usual form, or before a word where none came for long."""
    h, hashed, cuts = 0, [], []
    for i in range(1, len(b)):
        h = ((h << 1) + int(sd._GEAR[b[i - 1]])) & 0xFFFFFFFF
        low = sum(int(sd._GEAR[b[i - 1 - k]]) << k for k in range(min(i, sd.WINDOW))) & 0xFFFFFFFF
        assert (h - low) % (1 << sd.WINDOW) == 0
        if i >= sd.WINDOW and (low >> (sd.WINDOW - sd.CUT_BITS)) & (2**sd.CUT_BITS - 1) == 0:
            hashed.append(i)
            cuts.append((i, sd.WINDOW))
        elif i >= sd.WINDOW + sd.DRY and not [x for x in hashed if x > i - sd.DRY] and b[i - 1] in b" \t\n\r\x0b\x0c" and b[i] not in b" \t\n\r\x0b\x0c":
            cuts.append((i, sd.WINDOW + sd.DRY))
    return [(x, y, r) for (x, r), (y, _) in zip(cuts, cuts[1:], strict=False)]


def test_chunks_match_the_byte_loop():
    rng = random.Random(1)
    texts = ["", text(rng, 80), "a" * 1000, text(rng, 3), "x", text(rng, 400), "ab " * 200, "ha " * 5 + text(rng, 40) + " ha" * 90]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, reach = sd.chunks(data, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    for i, t in enumerate(texts):
        mine = row == i
        assert list(zip((starts[mine] - offsets[i]).tolist(), (ends[mine] - offsets[i]).tolist(), reach[mine].tolist(), strict=True)) == brute_chunks(t.encode())


def test_chunks_of_a_passage_stand_after_any_other_text():
    """What a chunk's reach promises: within a passage the same chunks come, whatever stands before and behind."""
    rng = random.Random(8)
    for core in (text(rng, 60), "ab " * 60, "a b " * 40 + text(rng, 30), "x " * 99):
        core = core.strip()
        found = []
        for _ in range(6):
            before = text(rng, rng.randrange(1, 40)) + " "
            data = np.frombuffer(f"{before}{core} {text(rng, 20)}".encode(), np.uint8)
            starts, ends, reach = sd.chunks(data, np.array([0, len(data)]))
            at = len(before.encode())
            inside = (starts - reach >= at) & (ends <= at + len(core.encode()))
            found.append(list(zip((starts[inside] - at).tolist(), (ends[inside] - at).tolist(), strict=True)))
        assert found == found[:1] * 6


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    passages = [text(rng, 51 + i) for i in range(6)]
    rows = [(i, " ".join([text(rng, rng.randrange(5, 90)), rng.choice(passages), text(rng, rng.randrange(5, 90))])) for i in range(40)]
    rows += [(100 + i, text(rng, 200)) for i in range(20)]
    rows += [(200, rows[0][1]), (201, passages[0] + "\n" + passages[0]), (202, None), (203, "")]
    return rows


def test_edge_cases(spark):
    long = "lorem ipsum dolor " * 60
    docs = spark.createDataFrame([(None, long), (1, long), (1, long), (2, None)], "doc_id long, text string")
    assert {r.doc_id for r in sd.repeated_passages(docs).collect()} == {1}
    assert sd.repeated_passages(docs.limit(0)).count() == 0
    assert sd.without_repeats(docs.limit(0)).count() == 0
    assert sd.without_repeats(docs).where("doc_id is null").first().text == long
    assert len({r.text for r in sd.without_repeats(docs).where("doc_id = 1").collect()}) == 1


def test_rows_of_one_doc_id_are_cut_each_for_itself(spark):
    rng = random.Random(4)
    passage, other = text(rng, 120), " ".join("日本語é" + text(rng, 1) for _ in range(300))
    docs = spark.createDataFrame([(1, passage, "a"), (2, "é " + passage, "b"), (2, other, "c"), (2, passage + " tail", "d")], "doc_id long, text string, text_hash string")
    out = {r.text_hash: r.text for r in sd.without_repeats(docs).collect()}
    assert out["a"] == passage and out["c"] == other
    assert out["b"].split() == ["é"] and out["d"].split() == ["tail"]


def test_a_very_long_text(spark):
    rng = random.Random(6)
    passage = text(rng, 60)
    long = " ".join([text(rng, 150_000), passage, text(rng, 1000)])
    docs = spark.createDataFrame([(1, passage), (2, long)], "doc_id long, text string")
    (span,) = sd.repeated_passages(docs).collect()
    assert (span.doc_id, span.n_words, long.encode()[span.start : span.end].decode()) == (2, 60, passage)


def brute_passages(rows, n):
    """Words of every window of n words that stands in a lesser document or earlier in its own, joined to passages."""
    split = {d: [m.span() for m in re.finditer(rb"[^ \t-\r]+", (t or "").encode())] for d, t in rows}
    seen, out = {}, []
    for d, t in sorted(rows):
        b, w, run = (t or "").encode(), split[d], None
        for i in range(len(w) - n + 1):
            first = seen.setdefault(b[w[i][0] : w[i + n - 1][1]], d)
            if first == d:
                key = b[w[i][0] : w[i + n - 1][1]]
                if seen.setdefault((d, key), i) == i:
                    continue
            if run and i <= run[1] + n:
                run = (run[0], i, min(run[2], first))
            else:
                out += [(d, w[run[0]][0], w[run[1] + n - 1][1], run[1] + n - run[0], run[2])] if run else []
                run = (i, i, first)
        out += [(d, w[run[0]][0], w[run[1] + n - 1][1], run[1] + n - run[0], run[2])] if run else []
    return sorted(out)


def test_no_passage_of_fifty_words_is_missed(spark, rows):
    rng = random.Random(5)
    plain = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))
    more = []
    for i in range(300):
        passage = plain(50 + i % 4)
        more += [(1000 + 2 * i + k, " ".join([plain(rng.randrange(1, 60)), passage, plain(rng.randrange(1, 60))])) for k in (0, 1)]
    more += [(2000, "ab " * 200), (2001, plain(49)), (2003, "\n\n" + rows[0][1] + " é"), (2004, plain(5) + " ab" * 70), (2005, "x " * 51 + plain(4)), (2006, plain(3) + " x" * 55)]
    want = brute_passages(rows + more, 50)
    assert {1001 + 2 * i for i in range(300)} <= {d for d, *_ in want}
    docs = spark.createDataFrame(rows + more, "doc_id long, text string")
    assert sorted(map(tuple, sd.repeated_passages(docs).drop("text_hash").collect())) == want
    both = docs.selectExpr("doc_id", "text", "length(text) as n_chars", "'x' as start")
    kept = sd.without_repeats(both).collect()
    cut = {r.doc_id: r.text for r in kept}
    assert len(kept) == len(rows) + len(more) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept)
    assert all(cut[d] == t for d, t in rows + more if d not in {x for x, *_ in want})
    assert all(len(cut[1001 + 2 * i].split()) <= len(more[2 * i + 1][1].split()) - 50 for i in range(300))
