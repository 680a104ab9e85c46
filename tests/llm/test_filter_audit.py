"""The filter audit against a loop over documents and orders."""

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from tapestry.llm import filter_audit
from tapestry.llm.filter_audit import COUNTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def failures(i, text, rows):
    words = WORD.findall(text)
    tests = {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": any((t or "") == text and j < i for j, t, *_ in rows if i is not None and j is not None),
    }
    return {f for f, bad in tests.items() if bad}


def brute(rows, labels):
    """(part, order, step) -> counts and Shapley sum; ``rows``: (doc_id, text, part)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out, shapley = {}, Counter()
    docs = [(i, p or "", failures(i, t or "", rows)) for i, t, p in rows]
    for part in {p for _, p, _ in docs}:
        for order in permutations("ABCDE"):
            left = [(i, fails) for i, p, fails in docs if p == part]
            everything = left
            for step, f in enumerate(order, 1):
                removed = [(i, fails) for i, fails in left if f in fails]
                gone = [x for x in everything if not any(x is y for y in left)]
                left = [x for x in left if f not in x[1]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f in x[1] for x in gone), sum(x[1] == {f} for x in everything),
                    sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed),
                ]
                shapley[part, f] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (*[r[c] for c in COUNTS], r.shapley) for r in rows}
    assert len(got) == len(rows) and all(r["filter"] == r.filter_order[r.step - 1] for r in rows)
    return got


def test_random_corpus(spark, docs, corpus):
    labels = [(i, i % 2, int(i % 5 == 0)) for i, *_ in corpus if i % 3] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (10**9, 1, 1)]
    got = result(filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)))
    want = brute([(i, t, source) for i, t, _, source, _ in corpus], labels)
    assert got == want and len(got) == 600 * 3
    assert any(v[2] for v in got.values()) and any(v[3] for v in got.values()) and any(v[4] for v in got.values())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, None), (8, None, 1)], LABELS).withColumn("part", F.lit("extra"))
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert result(filter_audit.audit(odd, labels)) == brute(rows, [(7, 1, 0), (8, 0, 1)])
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(empty, labels).count() == 0
    assert all(v[4:6] == (0, 0) for v in result(filter_audit.audit(odd, none)).values())


def test_long_text_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(100_000))
    rows = [(1, long, "a"), (2, long, "a"), (2, long, "b"), (3, long + " $", "b"), (4, "É" * 100_000, None), (5, "", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert result(filter_audit.audit(frame, spark.createDataFrame([], LABELS))) == brute(rows, [])
