"""License rules: a notice that is wrapped between any two words is found like one on a single line."""

import pytest

from tapestry.llm import license_rules

NOTICES = {
    "MIT License": "mit", "public domain": "public-domain", "without warranty of any kind": "no-warranty", "permission is hereby granted, free of charge": "mit",
    "ISC License": "isc", "Microsoft Public License": "ms-pl", "Creative Commons Attribution 4.0": "cc-by-4.0", "European Union Public Licence 1.2": "eupl-1.2",
    "Lesser General Public License 2.1": "lgpl-2.1", "Free Documentation License 1.3": "gfdl-1.3", "Academic Free License 3.0": "afl-3.0",
    "tous droits réservés": "reserved", "alle Rechte vorbehalten": "reserved", "todos los derechos reservados": "reserved",
}


@pytest.mark.parametrize("space", ["\n", "\t", "  ", "\r\n", " \n "])
def test_wrapped_notices(spark, space):
    texts = [t for n in NOTICES for t in (f"see {n} here", f"see {n} here".replace(" ", space))]
    got = {r.doc_id: r for r in license_rules.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, label in enumerate(NOTICES.values()):
        flat, wrapped = got[2 * i], got[2 * i + 1]
        assert label in wrapped.labels.split(",")
        assert (wrapped.labels, wrapped.spans, wrapped.score) == (flat.labels, flat.spans, flat.score)
