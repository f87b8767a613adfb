import random

import pytest

import corpus_pipeline
from tickforge.llm import decontaminate, near_dedup, substring_dedup, toxicity
from tickforge.llm.labelled import remainder


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents, toxic ones, exact and near copies, a long passage in several documents, and a benchmark leak."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(3, 9)))
    words = lambda n: " ".join(word() + ("." if i % 9 == 8 else "") for i in range(n))
    passage, item = words(70), words(40)
    rows, labels = [], []
    for i in range(200):
        text = words(rng.randrange(40, 120))
        labels.append((i, 1, 0))
        rows.append((i, text))
    for i in range(200, 300):
        rows.append((i, words(30) + f" {rng.choice(['vilex', 'nastyz'])} " + words(30)))
        labels.append((i, 1, 1))
    rows += [(300 + i, rows[i][1]) for i in range(5)] + [(310 + i, rows[10 + i][1] + " extra") for i in range(5)]
    rows += [(320 + i, f"{words(40)} {passage} {words(40)}") for i in range(4)]
    rows += [(330, f"{words(30)} {item} {words(30)}"), (340, None), (341, "")]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(d, t, "xx", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), dict(rows), passage


def test_stages_catch_what_is_planted_and_keep_the_rest(spark, planted):
    folder, text, passage = planted
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    gone = set(text) - set(out)
    assert gone == set(range(200, 300)) | set(range(300, 305)) | set(range(310, 315)) | {330}
    for d in range(200):
        assert out[d].text == text[d]
    assert sum(passage in out[d].text for d in range(320, 324)) == 1
    assert all(r.n_tokens == len(r.ids) for d, r in out.items() if d != 340)


def test_each_stage_works_on_its_predecessors_rows(spark, planted):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, bench = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        out = stage(spark, docs, folder)
        ids = {r.doc_id for r in out.collect()}
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, remainder(4) == 2)).collect()}
            assert ids == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
        if name == "near_dedup":
            assert ids == {r.doc_id for r in near_dedup.near_duplicates(docs, 5, 80, 100).where("kept").collect()}
        if name == "substring_dedup":
            assert ids == {r.doc_id for r in rows} and {r.doc_id for r in substring_dedup.repeated_passages(docs).collect()} == {321, 322, 323}
        if name == "decontamination":
            assert {r.doc_id for r in rows} - ids == {r.doc_id for r in decontaminate.leaks(docs, bench).collect()} == {330}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)


def test_edge_cases_of_the_whole_run(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(3, 9)))
    long = " ".join(word() for _ in range(30_000))
    rows = [(None, "no id here", None, "a"), (None, None, None, "b"), (1, "same row", "x", "c"), (1, "same row", "x", "c"), (2, long, "x", "d"), (3, "", None, "e"), (4, None, None, None), (5, "é 日本 \u2581 x", "x", "f")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(((d, t) for d, t, *_ in rows), key=str)
    none = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{none}/documents.parquet")
    for name in ("labels", "benchmark"):
        (none / f"{name}.parquet").symlink_to(tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0
