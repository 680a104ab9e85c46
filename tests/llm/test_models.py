"""Kneser-Ney against a plain version, the random field against enumeration, both on held-out rows."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tapestry.llm import crf, kneser_ney
from tapestry.llm.common import table


def brute_model(texts):
    """logp(gram) by the textbook recursion over Python dictionaries."""
    counts = {4: Counter(tuple(kneser_ney._ungram(int(g))) for t in texts for g in kneser_ney.grams(kneser_ney.symbols(t)))}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut, context = {}, {}
    for n, c in counts.items():
        of = Counter(c.values())
        cut[n] = kneser_ney.discounts(of[1], of[2], of[3], of[4])
        context[n] = defaultdict(list)
        for g, k in c.items():
            context[n][g[:-1]].append(k)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 64
        seen = context[n].get(g[:-1])
        if not seen:
            return p(g[1:])
        d = lambda k: cut[n][min(k, 3) - 1]
        k = counts[n].get(g, 0)
        return (max(k - d(k), 0) if k else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * p(g[1:])

    return p


def test_perplexity(spark, docs, corpus):
    rng = random.Random(1)
    labels = [(i, 1, 0) if rng.random() < 0.5 else (i, 0, 0) if rng.random() < 0.5 else (i, 1, 1) for i, *_ in corpus]
    labels += [(labels[0][0], 0, 0), (None, 1, 0), (10**6, 1, 0)]
    good = {i for i, q, t in labels if i is not None} - {i for i, q, t in labels if not q or t}
    p = brute_model([t or "" for i, t, *_ in corpus if i in good])
    got = {r.doc_id: r for r in kneser_ney.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == len(corpus)
    for i, t, *_ in corpus:
        g = kneser_ney.grams(kneser_ney.symbols(t or ""))
        assert got[i].n_symbols == len(t or "")
        if not len(g):
            assert got[i].perplexity is None and not got[i].kept
            continue
        want = math.exp(-sum(math.log(p(kneser_ney._ungram(int(x)))) for x in g) / len(g))
        assert got[i].perplexity == pytest.approx(want, rel=1e-4)


def test_probabilities_sum_to_one(spark):
    rows = [(g, 3 - g % 4) for g in range(0, 1 << 24, 40_009) if g % 4 < 3]
    contexts = [g >> 6 for g, _ in rows[:3]]
    every = spark.createDataFrame(rows + [((c << 6) | s, 0) for c in contexts for s in range(64)], "gram int, trusted long")
    summed = every.groupBy("gram").sum("trusted").toDF("gram", "trusted")
    logp = {r.gram: r.logp for r in kneser_ney.log_probabilities(summed).collect()}
    for c in contexts:
        assert sum(math.exp(logp[(c << 6) | s]) for s in range(64)) == pytest.approx(1)


def test_long_texts_are_cut_without_effect(monkeypatch):
    text = "some words that go on " * 50
    whole = [g for _, g in kneser_ney._batches([text, "", "b"])]
    monkeypatch.setattr(kneser_ney, "BATCH", 7)
    assert np.concatenate([g for _, g in kneser_ney._batches([text, "", "b"])]).tolist() == np.concatenate(whole).tolist()


def test_junk_is_rejected_and_prose_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = kneser_ney.classify(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.kept for r in rows if truth.get(r.doc_id) == 1]
    assert sum(good) >= 0.98 * len(good)


def test_classifier_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(7, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    assert kneser_ney.classify(odd, labels).count() == 6
    assert kneser_ney.classify(odd, labels.limit(0)).filter("kept").count() == 5
    assert kneser_ney.classify(empty, labels).count() == 0


def test_forward_backward():
    rng = np.random.default_rng(0)
    emission, transition, start = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([5, 2, 1])
    marginal, expected, norm = crf.forward_backward(emission, transition, start, lengths)
    total, pairs = 0.0, np.zeros((3, 3))
    for s, n in enumerate(lengths):
        weights = {}
        for path in itertools.product(range(3), repeat=int(n)):
            weights[path] = math.exp(start[path[0]] + sum(emission[s, k, y] for k, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
        z = sum(weights.values())
        total += math.log(z)
        for k in range(n):
            for y in range(3):
                assert marginal[s, k, y] == pytest.approx(sum(w for p, w in weights.items() if p[k] == y) / z)
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w / z
    assert norm == pytest.approx(total) and expected == pytest.approx(pairs)


def test_held_out_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = crf.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null and lang_pred != 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_switches_are_found(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = crf.fit(docs)
    texts = {x: next(r.text for r in docs.filter(f"lang = '{x}' and n_chars > 2000").take(1)).split()[:60] for x in ("en", "de")}
    mixed = spark.createDataFrame([(1, " ".join(texts["en"] + texts["de"]))], "doc_id long, text string").selectExpr("*", "cast(null as string) lang")
    spans = crf.identify(mixed, model=model, spans=True).first().spans
    at = lambda k: next(s.lang for s in spans if s.first <= k <= s.last)
    assert sum(at(k) == "en" for k in range(60)) > 50 and sum(at(k) == "de" for k in range(60, 120)) > 50


def test_language_odd_rows(spark, odd, empty, docs, corpus):
    assert crf.identify(odd).count() == 6
    assert crf.identify(empty).count() == 0
    got = {r.doc_id: r for r in crf.identify(docs).collect()}
    for i, t, *_ in corpus:
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1


def test_higher_order(spark, docs, corpus):
    """The order of the registered query against the recursion; what it counts grows with the text, unlike 4-grams."""
    order, pad = kneser_ney.QUERY_ORDER, lambda t, n: [0] * (n - 1) + kneser_ney.symbols(t or "").tolist()
    labels = [(i, 1, 0) for i, *_ in corpus if i % 2]
    counts = {order: Counter(tuple(s[k : k + order]) for i, t, *_ in corpus if i % 2 for s in [pad(t, order)] for k in range(len(s) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut = {n: kneser_ney.discounts(*[Counter(c.values())[k] for k in (1, 2, 3, 4)]) for n, c in counts.items()}
    follow = defaultdict(list)
    for n, c in counts.items():
        for g, k in c.items():
            follow[g[:-1], n].append(k)

    def p(g):
        n = len(g)
        if not n:
            return 1 / 64
        seen, d = follow.get((g[:-1], n)), lambda k: cut[n][min(k, 3) - 1]
        if not seen:
            return p(g[1:])
        k = counts[n].get(g, 0)
        return (max(k - d(k), 0) if k else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * p(g[1:])

    got = {r.doc_id: r for r in kneser_ney.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), order=order).collect()}
    for i, t, *_ in corpus[::7]:
        if t:
            s = pad(t, order)
            want = math.exp(-sum(math.log(p(tuple(s[k : k + order]))) for k in range(len(t))) / len(t))
            assert got[i].perplexity == pytest.approx(want, rel=1e-4)


def test_the_query_has_no_ceiling_of_n_grams(monkeypatch):
    from tapestry.llm import queries

    seen = {}
    monkeypatch.setattr(queries, "table", lambda spark, sf, name: name)
    monkeypatch.setattr(kneser_ney, "classify", lambda docs, labels, **how: seen.update(how))
    queries.op1_kneser_ney(None, "")
    assert kneser_ney.SYMBOLS ** seen.get("order", kneser_ney.ORDER) > 1 << 32


def test_frequent_n_grams_do_not_travel_as_rows(spark, monkeypatch):
    """Blocks of a few documents that have nearly the same n-grams: no row per block and n-gram, and the same result whatever is frequent."""
    rng, stored, store = random.Random(3), {}, kneser_ney.store
    rows = [(i if i % 9 else None, " ".join(rng.choice(["red", "green", "blue", "black", "white"]) for _ in range(60)) + f" {i * 7919 % 1000}", "en") for i in range(160)] + [(500, None, None), (501, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 160, 2)], "doc_id long, quality int, toxic int")

    def kept(df, label):
        stored[label] = store(df, label)
        return stored[label]

    def result():
        got = kneser_ney.classify(docs, labels, order=6).collect()
        return sorted((r.doc_id is None, r.doc_id or 0, r.n_symbols, round(r.perplexity or 0, 4), round(r.threshold, 4), r.kept) for r in got)

    monkeypatch.setattr(kneser_ney, "BLOCK_DOCS", 8)
    monkeypatch.setattr(kneser_ney, "store", kept)
    want = result()
    assert stored["grams"].filter("gram is not null").count() < stored["logp"].count()
    for name, value in (("FREQUENT", 100), ("SLICE", 7), ("SAMPLE_DOCS", 20)):
        monkeypatch.setattr(kneser_ney, name, value, raising=False)
        assert result() == want
    assert stored["grams"].filter("gram is not null").count() > stored["logp"].count()
