"""Block naming, license rules, line rules and mixing against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tapestry.llm import license_rules, line_rules, mixing, naming
from tapestry.llm.common import restrict

WHITE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("block", [16, 100, 8192])
def test_block_naming(docs, corpus, block):
    groups = defaultdict(list)
    for i, t, *_ in corpus:
        groups[WHITE.sub("", t or "")].append((-len(t or ""), i))
    got = by_id(naming.exact_groups(docs, block_bytes=block))
    assert len(got) == len(corpus)
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), i == keep)
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_block_naming_odd_rows(odd, empty):
    rows = naming.exact_groups(odd).collect()
    assert len(rows) == 6 and sum(r.kept for r in rows) == 4
    assert sorted(r.group_size for r in rows) == [1, 1, 1, 3, 3, 3]
    assert naming.exact_groups(empty).count() == 0
    stay = restrict(odd, naming.exact_groups(odd).filter("kept"), one=True)
    assert stay.columns == odd.columns and stay.count() == 4


def test_license_base(docs, corpus):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = by_id(license_rules.scan_licenses(docs))
    assert len(got) == len(corpus)
    for i, t, *_ in corpus:
        words = pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        places = [(j, label) for p, label in license_rules.PHRASES.items() for j in range(len(words)) if words[j : j + len(p.split())] == p.split()]
        r = got[i]
        starts = sorted(j for j, _ in places)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), starts[0] if starts else None, starts[-1] if starts else None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_suppression(spark):
    texts = [
        "licensed under the GNU Lesser General Public License v2.1 or later", "SPDX-License-Identifier: GPL-2.0-only", "CC BY-NC-SA 4.0", "Apache License, Version 2.0",
        "see GPL and MIT License", "occupy accby",
    ]
    got = by_id(license_rules.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[i].labels for i in range(6)] == ["gpl,lgpl-2.1-or-later", "gpl-2.0", "cc-by,cc-by-nc-sa-4.0", "apache-2.0", "gpl,mit", ""]
    assert [(s.begin, s.end) for s in got[4].spans] == [(4, 7), (12, 23)]
    assert len(license_rules.signatures()) > 200


def test_license_odd_rows(odd, empty):
    assert license_rules.scan_licenses(odd).count() == 6
    assert license_rules.scan_licenses(empty).count() == 0


def base_row(text):
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    repeat = len({j for i, g in enumerate(grams) if times[g] > 1 for j in (i, i + 1, i + 2)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat


def test_line_rules_base(docs, corpus):
    got = by_id(line_rules.line_rules(docs))
    assert len(got) == len(corpus)
    for i, t, *_ in corpus:
        want, r = base_row(t or ""), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_frequent_lines_deplete(spark):
    rows = [(i, f"Menu  home about us contact\n{'same long footer words ' * 20}\nown {i}", "h") for i in range(30)]
    rows += [(100 + i, "\n".join(f"own line {i} {j} " + " ".join(f"w{i}x{j}y{k}" for k in range(9)) for j in range(8)) + "\nmenu home about us contact", "h") for i in range(5)]
    rows += [(200 + i, " ".join(f"copy{k}" for k in range(60)), "h") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_id(line_rules.line_rules(frame))
    assert not any(got[i].kept for i in range(30)), "documents of common lines only are depleted"
    assert all(got[100 + i].kept and got[100 + i].removed_words == 5 for i in range(5)), "one common line is no reason"
    assert all(got[200 + i].kept for i in range(40)), "copies of one text are one document"
    stripped = by_id(line_rules.strip_lines(frame))
    assert stripped[3].text == "own 3" and stripped[3].removed_lines == 2
    assert stripped[203].text == rows[-1][1]


def test_line_rules_odd_rows(odd, empty):
    assert line_rules.line_rules(odd).count() == 6
    assert line_rules.line_rules(empty).count() == 0
    assert line_rules.strip_lines(empty).count() == 0


def fair_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, rest = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        over = [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]]
        if not over:
            return full | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            full[s] = 2 * sizes[s]
        rest = 1.5 * sum(sizes.values()) - sum(full.values())


def test_mixing(spark, docs, corpus):
    source_of = {i: s for i, _, _, s, _ in corpus}
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in corpus}
    totals = Counter()
    for i, n in size.items():
        totals[source_of[i]] += n
    want = fair_targets(totals)
    got = by_id(mixing.mix(docs))
    taken = Counter()
    for i, r in got.items():
        assert r.size == size[i] and r.source_size == totals[source_of[i]]
        assert r.target == pytest.approx(want[source_of[i]])
        assert 0 <= r.taken <= 2 * r.size
        taken[source_of[i]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    assert {i: r.taken for i, r in by_id(mixing.mix(docs.repartition(5))).items()} == {i: r.taken for i, r in got.items()}


def test_mixing_many_sources(spark):
    sizes = {f"s{i}": (i * 37) % 11 * 10 + (1 if i % 4 else 0) for i in range(23)}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(fair_targets(sizes))


def test_inclusion_grows_with_the_odds(spark):
    """Over many seeds, how often a document is drawn follows the probabilities that the operator gives its size."""
    rows = [(i, "w " * (1 if i % 2 else 16), "a") for i in range(40)] + [(100 + i, "w " * 400, "b") for i in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    hits = Counter()
    for seed in range(12):
        for r in mixing.mix(frame, weights=(1.0, 40.0), share=0.6, seed=seed).filter("source = 'a' and taken > 0").collect():
            hits[r.size] += 1
    frame.unpersist()
    assert hits[16] > 1.5 * hits[1]


def test_mixing_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 6 and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(empty).count() == 0
