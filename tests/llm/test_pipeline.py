"""The pipeline against brute force, stage by stage, and the registered queries against their SQL."""

import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, "/root/repo")
import corpus_pipeline
from check import compare, connect
from tapestry.llm import line_rules, mixing
from tapestry.llm.common import store, table
from tapestry.llm.queries import ORACLES, QUERIES
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check as check_packing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF), "test"))
    return out


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality(stages):
    keep = {r.doc_id for r in line_rules.line_rules(stages[0]).filter("kept").collect()}
    assert rows(stages[1]) == Counter({r: n for r, n in rows(stages[0]).items() if r[0] in keep})
    assert 0 < len(keep) < stages[0].count()


def test_exact(stages):
    groups = {}
    for r in stages[1].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(min(g)[1] for g in groups.values())


def test_near(stages):
    want = brute([(r.doc_id, r.text) for r in stages[2].collect()])
    assert sorted(r.doc_id for r in stages[3].collect()) == want


def test_mixture(stages):
    taken = {r.doc_id: r.taken for r in mixing.mix(stages[3]).collect()}
    words, texts = Counter(), {r.doc_id: r.text for r in stages[3].collect()}
    for r in stages[4].collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.text == texts[r.doc_id] or WORD.findall(texts[r.doc_id])[: len(WORD.findall(r.text))] == WORD.findall(r.text)
        assert r.text == texts[r.doc_id] or r.n_chars == len(r.text)
    assert words == Counter({i: n for i, n in taken.items() if n})


def test_packed(stages):
    copies = Counter(r.doc_id for r in stages[4].collect())
    pieces = stages[5].collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == copies
    single = {r.doc_id: r.text for r in stages[4].collect() if copies[r.doc_id] == 1}
    got = [r for r in pieces if r.doc_id in single]
    assert sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values())


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == stages[5].columns and out.count() > 0


def test_odd_rows(spark, odd, empty):
    odd = odd.withColumnRenamed("n", "n_chars")
    for frame in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            df = store(stage(spark, frame, SF), "test")
            assert df.columns == frame.columns or name == "packing"
            assert df.count() >= 0
    assert corpus_pipeline.exact(spark, odd, SF).count() == 4
    assert corpus_pipeline.mixture(spark, odd.drop("n_chars"), SF).columns == odd.drop("n_chars").columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    message, _, _, ok = compare(spark, connect(SF), SF, name, QUERIES[name], ORACLES[name])
    assert ok, message


def test_stages_with_columns_named_like_theirs(spark, odd):
    from pyspark.sql import functions as F

    frame = odd.withColumnRenamed("n", "n_chars")
    for name in ("__key", "__nth", "__size", "__taken", "__part", "_row"):
        frame = frame.withColumn(name, F.lit(f"own {name}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == frame.columns, name
        assert all(r["__key"] == "own __key" and r["__part"] == "own __part" for r in out.collect())
