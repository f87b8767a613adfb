import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import quality, queries, toxicity
from tickforge.llm.labelled import remainder

SF = "/root/testdata/sf0.1"


def auc(y, s):
    y, s = np.array(y), np.array(s)
    r = s.argsort().argsort() + 1
    n = y.sum()
    return (r[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("query", "label", "modulus", "rest"), [(queries.op2_toxicity, "toxic", 4, 2), (queries.op7_quality, "quality", 5, 0)])
def test_held_out_accuracy(spark, query, label, modulus, rest):
    out = {r.doc_id: r for r in query(spark, SF).collect()}
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % modulus == rest) for d, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.values())
    held = [(labels[d], r.score, r.predicted) for d, r in out.items() if r.held_out and d in labels]
    y, s, p = zip(*held, strict=True)
    assert auc(y, s) > 0.95
    hit = sum(a == b for a, b in zip(y, p, strict=True)) / len(y)
    assert hit > 0.95, hit


def toxic_docs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, labels = [], []
    for i in range(400):
        s = [" ".join(word() for _ in range(8)).capitalize() for _ in range(6)]
        if i % 4 == 0:
            s[rng.randrange(6)] += f" {rng.choice(['vilex', 'badword'])} " + word()
        rows.append((i, ". ".join(s) + "."))
        labels.append((i, int(i % 4 == 0)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_offending_sentences_are_located(spark):
    rows, docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels, remainder(4) == 2)
    text = dict(rows)
    for r in toxicity.score(docs, model).where("offending_sentences > 0").collect():
        part = text[r.doc_id].encode()[r.worst_start : r.worst_end].decode()
        assert ("vilex" in part or "badword" in part) and "." not in part
    kept = {r.doc_id for r in toxicity.not_toxic(docs, model).collect()}
    assert kept == {i for i in text if i % 4}


def test_noisy_or_is_the_product_over_sentences(spark):
    _, docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels, remainder(4) == 2)
    texts = ["vilex one", "a badword. b", "plain"]
    rows = [(i, t) for i, t in enumerate([*texts, ". ".join(texts)])]
    s = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert s[3] == pytest.approx(1 - (1 - s[0]) * (1 - s[1]) * (1 - s[2]))


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edge_cases(spark, module):
    label = "toxic" if module is toxicity else "quality"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "word " * 50000), (3, "x\n\n!")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    for labels in (none, spark.createDataFrame([(3, 1), (3, 0), (1, 7), (None, 1)], f"doc_id long, {label} int")):
        model = module.fit(docs, labels, remainder(4) == 9)
        out = module.score(docs, model).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert module.score(docs.limit(0), model).count() == 0


def test_additive_tables_find_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    model = quality.train(x, y)
    assert (1, 0) in model.pairs
    z = model.intercept + sum(model.tables[j][b] for j, b in enumerate(model.bins(x[:1])[0])) + sum(t[model.bins(x[:1])[0][i] * quality.BINS + model.bins(x[:1])[0][j]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
    assert model.predict(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-z)))
    fresh = rng.random((1000, 4))
    assert ((model.predict(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))).mean() > 0.9
