import heapq
import random

import numpy as np
import pytest
import sentencepiece

from tickforge.llm import merge_dropout as md
from tickforge.llm.textarrays import U64, mix

TEXTS = ["", " a  b\n\tc  ", "x", "   ", "Hello world, this is a plain text.", "日本語 😀 ý", "\u0000  é", "a" * 300 + " b", "ab" * 400, "▁x ▁▁ a▁", "one  two   three    four", "ünd größe ciónllañ"]


def agenda(v, text, salt, dropout):
    """Plain agenda over one word after another: pop the best candidate, pass over it if its hash says so."""
    chars = [md.BLANK, *(0xFFFFFFFF if ord(c) == md.BLANK else md.BLANK if c == " " else ord(c) for c in text)] if text else []
    words = []
    for i, c in enumerate(chars):
        if i == 0 or (c == md.BLANK and chars[i - 1] != md.BLANK):
            words.append([])
        words[-1].append(c)
    out = []
    for number, w in enumerate(words):
        key = int(mix(np.array([salt + number & 2**64 - 1], U64))[0])
        parts = [(i, [c], int(v.char_ids[c]) if c < 0x110000 else -1) for i, c in enumerate(w)]
        judged, heap = {}, []

        def offer(l, r, key=key, heap=heap):
            m = int(v.merged(np.array([l[2]]), np.array([r[2]]))[0])
            if m >= 0:
                h = int(mix(mix(np.array([key + l[0] & 2**64 - 1], U64)) ^ np.array([m * 0x9E3779B97F4A7C15 & 2**64 - 1], U64))[0])
                heapq.heappush(heap, (int(v.rank[m]), l[0], h < int(dropout * 2**64), m, l[2], r[2], r[0]))

        for l, r in zip(parts, parts[1:], strict=False):
            offer(l, r)
        while heap:
            _, at, skip, m, a, b, right = heapq.heappop(heap)
            i = next((i for i, p in enumerate(parts) if p[0] == at), None)
            if skip or i is None or parts[i][2] != a or i + 1 >= len(parts) or parts[i + 1][2] != b or parts[i + 1][0] != right:
                continue
            parts[i : i + 2] = [(at, parts[i][1] + parts[i + 1][1], m)]
            if i:
                offer(parts[i - 1], parts[i])
            if i + 1 < len(parts):
                offer(parts[i], parts[i + 1])
        del judged
        for _, cs, p in parts:
            out += [p] if p >= 0 else v.byte_ids[list(chr(md.BLANK if cs[0] == 0xFFFFFFFF else cs[0]).encode())].tolist()
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    blanks = [f"a{' ' * n}b{' ' * (n + 31)}c" for n in range(2, 40)]
    return TEXTS + blanks + [" ".join("".join(rng.choice("abcdeinrstéñ") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 30))) for _ in range(60)]


def encoded(texts, dropout, salts):
    v = md.vocabulary(md.default_model())
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, b = md.encode_slice(v, data, np.cumsum([0, *(len(t.encode()) for t in texts)]), salts, dropout)
    return v, [ids[b[i] : b[i + 1]].tolist() for i in range(len(texts))]


def test_without_dropout_ids_are_the_librarys(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=md.default_model())
    _, got = encoded(texts, 0.0, np.zeros(len(texts), U64))
    assert [g for t, g in zip(texts, got, strict=True) if "▁" not in t] == [model.encode(t) for t in texts if "▁" not in t]


@pytest.mark.parametrize("dropout", [0.1, 0.3, 1.0])
def test_equals_the_agenda(texts, dropout):
    salts = np.arange(len(texts)).astype(U64) * U64(977)
    v, got = encoded(texts, dropout, salts)
    assert got == [agenda(v, t, int(s), dropout) for t, s in zip(texts, salts, strict=True)]


def test_long_and_short_words_merge_by_one_rule():
    v = md.vocabulary(md.default_model())
    for n in range(2, md.MATRIX + 1):
        sym = np.full(n, v.char_ids[md.BLANK], np.int32)
        for dropout in (0.0, 0.1, 0.3):
            salts = mix(np.arange(20, dtype=U64))
            short = md._merge_matrix(v, np.repeat(sym[:, None], 20, axis=1), salts, md._limit(dropout))
            for i in range(20):
                ids, at = md.merge_long(v, sym, int(salts[i]), dropout)
                left = np.flatnonzero(short[:, i] != -2)
                assert (left.tolist(), short[left, i].tolist()) == (at.tolist(), ids.tolist())


def test_round_trip_seeds_and_edge_cases(spark, texts):
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, "abc def", "k"), (900, None, "k"), (901, "lang " * 20000, "k"), (901, "lang " * 20000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    one = md.decode(md.encode(docs, 0.2, seed=1)).collect()
    assert [(r.doc_id, r.text, r.n_tokens) for r in one] == rows
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in one)
    assert one[-1].ids == one[-2].ids and one[0].ids == []
    assert len({tuple(one[-1].ids[i : i + 3]) for i in range(0, 600, 1)}) > 3
    other = [r.ids for r in md.encode(docs, 0.2, seed=2).collect()]
    assert other != [r.ids for r in one]
    assert [r.ids for r in md.encode(docs.repartition(5), 0.2, seed=1).orderBy("doc_id").collect()] == [r.ids for r in md.encode(docs, 0.2, seed=1).orderBy("doc_id").collect()]
    assert md.encode(docs.limit(0)).count() == 0


def test_one_pass_equals_two(spark, texts):
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (None, "abc def")], "doc_id long, text string")
    assert md.encode(docs, 0.2, decoded="decoded").collect() == md.decode(md.encode(docs, 0.2)).collect()
    assert md.encode(docs.limit(0), decoded="decoded").count() == 0
