import hashlib
import re

import pytest

from tickforge.llm import infill, queries


def brute(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [None, "", "\n", "\n\n\n", "a", "a\nb", "a\r\nb\r\n", "<P>", "x<M>\ny", "<\nP>\n", "<P\n>S>\n<\n", ">\n<", "é\U0001f40e\n x\ny\x85z\n", "<S\n<M\n<P\n", "s\n" * 30_000, "one long line " * 20_000]


def test_arrangements_equal_plain_ones_and_come_back(spark):
    rows = [(i, t, "clash", i) for i in range(40) for t in ODD[:14]] + [(i, t, "clash", 1) for i, t in enumerate(ODD[14:])] + [(None, "a\nb\nc", "x", 1), (None, "a\nb\nc", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    out = infill.arrange(docs)
    got = [(r.doc_id, r.text, r.n, r.form, r.prefix and len(r.prefix), r.output, r.back) for r in out.withColumn("back", infill.restored(out.output, out.form)).collect()]
    want = []
    for d, t, *_ in rows:
        n, form, p, _, output = brute(d, t)
        want.append((d, t, n, form, p if p else ("" if form != "plain" else None), output, t or ""))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {x[3] for x in got} == {"plain", "spm", "psm"}


def test_digests_of_the_query(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {(d, *brute(d, t)[:4], sha(brute(d, t)[4]), sha(t or "")) for d, t in enumerate(ODD)}
    assert {tuple(r) for r in infill.checked(docs).collect()} == want
    assert infill.checked(docs.limit(0)).count() == 0


def test_shares_follow_the_rates(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a\nb\nc' as text")
    forms = {r.form: r["count"] for r in infill.arrange(docs, rate=50, spm=20).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 2000) < 200 and abs(forms["spm"] - 400) < 100
    with pytest.raises(ValueError):
        infill.arrange(docs, rate=101)


def test_no_python_in_the_plan(spark):
    plan = queries.op12_fill_in_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
