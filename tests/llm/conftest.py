import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, alphabet="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Random documents with copies, near copies, shared passages, repeats, nulls, odd white space and non-ASCII words."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(0, 160)) for _ in range(60)]
    passage = prose(rng, 40)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(12)]
    near = prose(rng, 120)
    for _ in range(10):
        words = near.split()
        words[rng.randrange(len(words))] = "zzz"
        texts.append(" ".join(words))
    texts += [near, near + " ", near.replace(" ", "\n"), "\t" + near, passage, passage * 3, "ab " * 300, "x" * 500, "", None, " \n\t ", "é" * 120 + " ü", "日本語 テスト " * 40]
    texts += ["All rights reserved. CC-BY 4.0", "the GNU General Public License, version 3 or later\ncc by cc by", "Ünïcode\x0bline\x0ctext\r\nMore #1 $5 <b>", "a\nb\na\nb\n\nb", "one two"]
    rows = [(i, t, [None, "en", "de", "fr"][i % 4], [None, "s1", "s2", "s2"][i % 4], None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows, rows of one id with different texts, and extra columns whose names the operators use too."""
    text = "some words that are here twice " * 12
    rows = [(None, text, "en", None), (None, None, None, "s"), (7, text, "en", "s"), (7, text, "en", "s"), (7, "other", None, "s"), (8, text + "tail", "de", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("row", "n", "size", "kept", "name", "block", "line", "body", "bin", "words", "bucket", "kind", "fingerprint", "u"):
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit("extra"))
    return frame


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
