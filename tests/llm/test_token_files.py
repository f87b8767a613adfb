import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tickforge.llm import token_files as tf

ODD = ["", "a, b.c", "don't.'s x", "É̀,.A", "  ", "a b,　c.", "<|endoftext|> x", "x,\n.y", "İstanbul, ΑΣ. ΣΑΣ,", "ǅ ß ªº ﬁ", "日本語，。", "1234 a1b", "a b\u0085c", "<|ENDOFTEXT|>", "'s'S 're.", "😀 x,."]


def texts():
    rng = random.Random(2)
    return ODD + ["".join(rng.choice("abcXYZéÉñß ,.'\n\t!?1<|>") for _ in range(rng.randrange(300))) for _ in range(150)]


def test_ids_are_the_librarys():
    import pyarrow as pa

    from tickforge.llm.textarrays import slices

    enc, lib = tf.encoder(tf.default_tokenizer()), Tokenizer.from_file(tf.default_tokenizer())
    for limit in (10, 1 << 18):
        got = []
        for _, _, data, offsets in slices(pa.array(texts()), limit):
            got += [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(data, offsets)[0]]
        assert got == [e.ids for e in lib.encode_batch(texts(), add_special_tokens=False)]


def brute(rows):
    lib, start, out = Tokenizer.from_file(tf.default_tokenizer()), 0, []
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [tf.END_ID]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(spark, tmp_path):
    rows = [(None, "first"), *((7 * i % 171, t) for i, t in enumerate(texts()))]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, start int")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    folder = f"file://{tmp_path}/t"
    manifest = tf.write_tokens(docs, folder, sequence=64, partitions=5)
    assert sorted(map(tuple, tf.read_tokens(manifest, folder).collect()), key=lambda r: r[1]) == brute(ordered)
    flat = [i for _, t in ordered for i in [*Tokenizer.from_file(tf.default_tokenizer()).encode(t or "", add_special_tokens=False).ids, tf.END_ID]]
    for r in manifest.collect():
        file = tf.TokenFile(f"{folder}/ids-{r.part:08d}.arrow")
        own = flat[r.start : r.start + r.tokens]
        n = -(-len(own) // 64)
        rebuilt = []
        for i in range(n):
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            rebuilt += ids[mask].tolist()
        assert rebuilt == own


def test_edge_cases(spark):
    same = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "word " * 100000)], "doc_id long, text string")
    assert sorted(map(tuple, tf.write_and_read(same).collect()), key=lambda r: r[1]) == brute([(1, "a b"), (1, "a b"), (2, None), (3, "word " * 100000)])
    assert tf.write_and_read(same.limit(0)).count() == 0
