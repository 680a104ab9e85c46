"""License detection by ordered signature rules, in DataFrame functions only.

Rules are regular expressions with a label, a rank and a keyword.  A document is only tried on the rules whose keyword it
contains.  All places of all rules are collected as intervals; one that lies inside an interval of the same or a higher
rank is suppressed, so ``gpl-2.0`` inside a full name, or a bare ``cc by`` inside a versioned one, is not reported twice.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window, functions as F

from .common import WHITE, whole

# Fixed values of the contract: phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MENTION, SHORT, NAME, ADDRESS, TAG = range(5)  # ranks of rules: a notice, an abbreviation, a name, an address, a machine-readable tag

# Families whose rules follow from their name: (label, short form, name pattern, versions, keyword).
_FAMILIES = [
    ("gpl", r"gpl", r"(?:gnu )?general public licen[sc]e", ["1.0", "2.0", "3.0"], "gnu|gpl|general public"),
    ("lgpl", r"lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", ["2.0", "2.1", "3.0"], "lgpl|general public"),
    ("agpl", r"agpl", r"(?:gnu )?affero general public licen[sc]e", ["1.0", "3.0"], "agpl|affero"),
    ("gfdl", r"gfdl", r"(?:gnu )?free documentation licen[sc]e", ["1.1", "1.2", "1.3"], "gfdl|documentation licen"),
    ("apache", r"apache", r"apache (?:software )?licen[sc]e", ["1.0", "1.1", "2.0"], "apache"),
    ("mpl", r"mpl", r"mozilla public licen[sc]e", ["1.0", "1.1", "2.0"], "mpl|mozilla"),
    ("epl", r"epl", r"eclipse public licen[sc]e", ["1.0", "2.0"], "epl|eclipse"),
    ("eupl", r"eupl", r"european union public licen[sc]e", ["1.0", "1.1", "1.2"], "eupl|european union"),
    ("cddl", r"cddl", r"common development and distribution licen[sc]e", ["1.0", "1.1"], "cddl|common development"),
    ("artistic", r"artistic", r"artistic licen[sc]e", ["1.0", "2.0"], "artistic"),
    ("afl", r"afl", r"academic free licen[sc]e", ["1.1", "2.0", "2.1", "3.0"], "afl|academic free"),
    ("osl", r"osl", r"open software licen[sc]e", ["1.0", "2.0", "2.1", "3.0"], "osl|open software"),
    ("bsl", r"bsl", r"boost software licen[sc]e", ["1.0"], "bsl|boost"),
    ("ofl", r"ofl", r"(?:sil )?open font licen[sc]e", ["1.0", "1.1"], "ofl|open font"),
    ("odbl", r"odbl", r"open (?:data commons open )?database licen[sc]e", ["1.0"], "odbl|database licen"),
    ("psf", r"psf", r"python software foundation licen[sc]e", ["2.0"], "psf|python software"),
]
_TELLING = {"gpl", "lgpl", "agpl", "gfdl", "eupl", "cddl", "odbl"}  # short forms that mean the licence without a version, too
_CC_TERMS = {
    "cc-by": "attribution", "cc-by-sa": "attribution[- ]share ?alike", "cc-by-nd": "attribution[- ]no ?deriv(?:ative)?s", "cc-by-nc": "attribution[- ]non ?commercial",
    "cc-by-nc-sa": "attribution[- ]non ?commercial[- ]share ?alike", "cc-by-nc-nd": "attribution[- ]non ?commercial[- ]no ?deriv(?:ative)?s",
}
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Licences without versions: (label, pattern, rank, keyword).
_SINGLE = [
    ("mit", r"\bmit licen[sc]e\b", NAME, "mit licen"), ("mit", r"\bpermission is hereby granted, free of charge\b", NAME, "hereby granted"),
    ("isc", r"\bisc licen[sc]e\b", NAME, "isc licen"), ("zlib", r"\bzlib licen[sc]e\b", NAME, "zlib"), ("unlicense", r"\bunlicense\b", NAME, "unlicense"),
    ("wtfpl", r"\bwtfpl\b", NAME, "wtfpl"), ("cc0", r"\bcc0(?: ?1\.0)?\b", NAME, "cc0"), ("cc0", r"\bcreativecommons\.org/publicdomain/zero\b", ADDRESS, "creativecommons"),
    ("public-domain", r"\bpublic domain\b", NAME, "public domain"), ("bsd", r"\bbsd licen[sc]e\b", NAME, "bsd"), ("bsd-2-clause", r"\b(?:2|two)[- ]clause bsd\b", NAME, "bsd"),
    ("bsd-3-clause", r"\b(?:3|three)[- ]clause bsd\b", NAME, "bsd"), ("bsd-4-clause", r"\b(?:4|four)[- ]clause bsd\b", NAME, "bsd"), ("bsd", r"\bredistribution and use in source and binary forms\b", NAME, "redistribution"),
    ("ms-pl", r"\bmicrosoft public licen[sc]e\b", NAME, "microsoft public"), ("copyright", r"(?:\bcopyright\b|©)(?: ?(?:\(c\)|©))? ?(?:19|20)\d\d", MENTION, "copyright|©"),
    ("reserved", r"\ball rights reserved\b", MENTION, "rights reserved"), ("reserved", r"\btous droits réservés\b", MENTION, "droits réservés"),
    ("reserved", r"\balle rechte vorbehalten\b", MENTION, "rechte vorbehalten"), ("reserved", r"\btodos los derechos reservados\b", MENTION, "derechos reservados"),
    ("proprietary", r"\bproprietary and confidential\b", MENTION, "proprietary"), ("no-warranty", r"\bwithout warranty of any kind\b", MENTION, "without warranty"),
    ("no-redistribution", r"\b(?:do not|may not be) redistribute\w*\b", MENTION, "redistribute"),
]


def _version(v: str) -> str:
    major, minor = v.split(".")
    return rf"{major}\.{minor}" if minor != "0" else rf"{major}(?:\.0)?"


def signatures() -> list[tuple[str, str, int, str]]:
    """All rules (label, pattern, rank, keywords joined by |), in order: families, Creative Commons, single licences."""
    out = []
    for label, short, name, versions, keys in _FAMILIES:
        out += [(label, rf"\b{name}\b", NAME, keys), (label, rf"spdx-license-identifier: ?{short}\b", TAG, "spdx")]
        if label in _TELLING:
            out.append((label, rf"\b{short}\b", SHORT, keys))
        for v in versions:
            n = _version(v)
            out += [
                (f"{label}-{v}", rf"\b{name}(?:,? (?:version|v\.?))? ?v?{n}\b", NAME, keys), (f"{label}-{v}", rf"\b{short}[- ]?v?{n}\b", SHORT, keys),
                (f"{label}-{v}-or-later", rf"\b{name}(?:,? (?:version|v\.?))? ?v?{n},? or (?:\(at your option\) )?(?:any )?later\b", NAME, keys),
                (f"{label}-{v}", rf"spdx-license-identifier: ?{short}-{v.replace('.', '[.]')}(?:-only)?(?!-or)\b", TAG, "spdx"),
                (f"{label}-{v}-or-later", rf"spdx-license-identifier: ?{short}-{v.replace('.', '[.]')}-or-later\b", TAG, "spdx"),
            ]
    for (label, term), v in product(_CC_TERMS.items(), [*_CC_VERSIONS, None]):
        tail, code = (f"-{v}", rf"[ -]?{_version(v)}\b") if v else ("", r"\b(?![ -]?(?:nc|nd|sa)\b)")
        path = label.removeprefix("cc-")
        out += [
            (label + tail, rf"\b{label.replace('-', '[- ]')}{code}", SHORT, "cc"), (label + tail, rf"\bcreative commons {term}{code}", NAME, "creative commons"),
            (label + tail, rf"\bcreativecommons\.org/licenses/{path}/{v.replace('.', '[.]') if v else ''}", ADDRESS, "creativecommons"),
        ]
    return out + _SINGLE


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[tuple[str, str, int, str]] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, ``spans``.

    Base phrases are found as runs of words; a text is cut in front of each and the words of the cuts counted.  ``spans`` are
    the detections left after suppression: label, rank, first character and end in the text in ASCII lower case with white
    space collapsed.  ``score`` is the highest rank found, from 0 (nothing) to 1 (a machine-readable tag).  A null text is
    empty; rows repeated whole are scanned one by one; other columns are ignored.
    """
    rules = signatures() if rules is None else rules
    keywords = sorted({k for r in rules for k in r[3].split("|")})
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("body"))
    t = t.withColumn("n_words", F.regexp_count("body", F.lit(WORD_ANY_CASE)).cast("long"))
    # Unicode lower case finds every ASCII keyword that ASCII lower case finds; it only decides what is looked at more closely.
    # White space is collapsed as in ``clean``, because a notice may be wrapped between the words of a keyword.
    t = t.withColumn("gate", F.lower(F.regexp_replace("body", WHITE, " "))).withColumn("found", F.expr(f"filter(array({', '.join(map(_literal, keywords))}), k -> contains(gate, k))"))
    phrased = F.expr("contains(gate, 'reserved') or contains(gate, 'license') or contains(gate, 'cc')")
    lowered = F.translate("body", upper, low)
    t = t.withColumn("plain", F.when(phrased, F.concat(F.lit("x "), F.btrim(F.regexp_replace(lowered, NOT_WORD, " ")), F.lit(" "))))
    t = t.withColumn("cuts", F.split("plain", f"(?= (?:{'|'.join(PHRASES)}) )", -1))
    spaces = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))
    some = F.size("cuts") > 1
    base = {
        "n_base": F.when(some, F.size("cuts") - 1).otherwise(0).cast("long"),
        "first_word": F.when(some, spaces(F.get("cuts", F.lit(0)))).cast("long"),
        "last_word": F.when(some, F.col("n_words") - spaces(F.element_at("cuts", -1)) + 1).cast("long"),
        "base_found": F.filter(F.array(*[F.when(some & F.contains("plain", F.lit(f" {p} ")), F.lit(x)) for p, x in PHRASES.items()]), lambda x: x.isNotNull()),
        "clean": F.when(F.size("found") > 0, F.regexp_replace(lowered, WHITE, " ")),
    }
    packed = ", ".join(f"struct({i} as rule, {_literal(p)} as pattern, array({', '.join(_literal(k) for k in keys.split('|'))}) as keys)" for i, (_, p, _, keys) in enumerate(rules))
    t = t.withColumns(base).withColumn("active", F.expr(f"if(size(found) = 0, array(), filter(array({packed}), r -> arrays_overlap(r.keys, found)))"))
    t = t.withColumn("active", F.expr("filter(active, r -> regexp_like(clean, r.pattern))"))
    keep = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_found"]
    hits = t.select(*keep, "clean", F.explode_outer("active").alias("r")).select(
        *keep, "r.rule", F.posexplode_outer(F.split(F.expr("regexp_replace(clean, r.pattern, concat(chr(1), '$0', chr(2)))"), "\x01", -1)).alias("nth", "piece")
    )
    hits = hits.select(
        *keep, "rule", "nth", (F.char_length("piece") - F.when(F.col("nth") > 0, 1).otherwise(0)).alias("length"), F.when(F.col("nth") > 0, F.instr("piece", "\x02") - 1).alias("matched")
    ).repartition("row")
    begin = F.coalesce(F.sum("length").over(Window.partitionBy("row", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    facts = F.expr("element_at(array(" + ", ".join(f"struct({_literal(label)} as label, {rank} as rank)" for label, _, rank, _ in rules) + "), rule + 1)")
    hits = hits.withColumn("begin", F.when(F.col("matched") > 0, begin)).withColumn("end", F.col("begin") + F.col("matched"))
    hits = hits.withColumn("fact", F.when(F.col("begin").isNotNull(), facts)).select(*keep, "rule", "begin", "end", "fact.label", "fact.rank")
    # Widest first at the same place, then the higher rank, then the earlier rule: an interval lies inside one before it or in none.
    seen = Window.partitionBy("row").orderBy(F.col("begin").asc_nulls_last(), F.desc("end"), F.desc("rank"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for rank in range(TAG + 1):
        reach = F.max(F.when(F.col("rank") >= rank, F.col("end"))).over(seen)
        inside = inside | ((F.col("rank") == rank) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    hits = hits.withColumn("left", F.col("begin").isNotNull() & ~inside)
    out = hits.groupBy("row").agg(
        *[F.first(c).alias(c) for c in keep[1:]], F.collect_set(F.when(F.col("left"), F.col("label"))).alias("more"),
        F.max(F.when(F.col("left"), F.col("rank") + 1)).alias("best"),
        F.collect_list(F.when(F.col("left"), F.struct("begin", "end", "label", "rank"))).alias("spans"),
    )
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base_found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_found", "more")), ",").alias("labels"),
        (F.greatest(F.coalesce("best", F.lit(0)), F.when(F.size("base_found") > 0, 1).otherwise(0)) / F.lit(float(TAG + 1))).cast("double").alias("score"), F.array_sort("spans").alias("spans"),
    )
