"""Language identification by a linear-chain conditional random field over words.

Every word has features: its beginning and end (affixes), its letter n-grams, and itself where the training lexicon has it.
Feature weights and transitions between languages are learned together by the gradient of the likelihood, on stretches of
labelled documents and on stretches put together from two languages, which teach when text switches.  Forward-backward
gives each word its probabilities; a document's language is the one with the largest expected share of its words.

Learning takes a bounded sample (``TRAIN_DOCS`` documents per language, a stretch of ``TRAIN_CHARS`` characters each, at a hashed
place); prediction reads every word of every document, inside Spark tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import whole

TRAIN_DOCS = 300
TRAIN_CHARS = 2500
LEXICON_TIMES = 3
FEATURES = 1 << 16
CHAIN = 64  # words of a chain; a longer document is a row of chains
PASSES = 4
RATE = 0.3
CACHE = 400_000
WIDTH = 32  # bytes of a word that features see
WORDS = 1 << 17  # words labelled together


def word_features(words: list[str], lexicon: frozenset[str] | set[str]) -> np.ndarray:
    """Hashed features of each word (words, slots); ``FEATURES`` fills the slots that a word leaves empty.

    Features are the first and last 1 to 4 bytes, all pairs and triples of bytes, and the word itself if the lexicon has
    it; a word without a letter only has one that says so.  Of a very long word the two ends count.
    """
    n, raw = len(words), []
    for w in words:
        x = w.lower().encode("utf-8", "surrogatepass") if w.isalpha() or any(map(str.isalpha, w)) else b""
        raw.append(x if len(x) <= WIDTH else x[: WIDTH - 12] + x[-12:])
    size = np.array([len(x) for x in raw], np.int64)
    m = np.frombuffer(b"".join([x.ljust(WIDTH, b"\0") for x in raw]), np.uint8).reshape(n, WIDTH).astype(np.uint64)
    out = np.full((n, 2 * WIDTH + 6), FEATURES, np.int32)

    def hashed(kind: int, code: np.ndarray) -> np.ndarray:
        return (((code | np.uint64(kind << 33)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int32)

    slot, rows = 0, np.arange(n)
    head, tail = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(1, 5):
        head = (head << np.uint64(8)) | m[:, k - 1]
        tail |= m[rows, np.maximum(size - k, 0)] << np.uint64(8 * (k - 1))
        out[:, slot] = np.where(size >= k, hashed(k, head), FEATURES)
        out[:, slot + 1] = np.where(size >= k, hashed(4 + k, tail), FEATURES)
        slot += 2
    pair = (m[:, :-1] << np.uint64(8)) | m[:, 1:]
    triple = (pair[:, :-1] << np.uint64(8)) | m[:, 2:]
    for kind, code in ((9, pair), (10, triple)):
        there = size[:, None] >= np.arange(code.shape[1])[None, :] + (kind - 7)
        out[:, slot : slot + code.shape[1]] = np.where(there, hashed(kind, code), FEATURES)
        slot += code.shape[1]
    out[size == 0, 0] = zlib.crc32(b"no letter") % FEATURES
    out[:, slot] = [zlib.crc32(x) % FEATURES if x and w.lower() in lexicon else FEATURES for x, w in zip(raw, words)]
    return out


def forward_backward(emission: np.ndarray, transition: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals (chains, words, labels), expected transitions (labels, labels) and the log-likelihood's normaliser.

    ``emission``: scores (chains, words, labels); words from a chain's length on are padding.
    """
    s, t, n = emission.shape
    top = emission.max(axis=2, keepdims=True)
    e = np.exp(emission - top)
    live = np.arange(t)[None, :] < lengths[:, None]
    move, begin = np.exp(transition), np.exp(start)
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.ones((s, t))
    a = e[:, 0] * begin
    for k in range(t):
        if k:
            a = np.where(live[:, k, None], (alpha[:, k - 1] @ move) * e[:, k], alpha[:, k - 1])
        z = a.sum(axis=1)
        scale[:, k] = np.where(live[:, k], z, 1.0)
        alpha[:, k] = a / z[:, None]
    expected = np.zeros((n, n))
    for k in range(t - 2, -1, -1):
        ahead = e[:, k + 1] * beta[:, k + 1] / scale[:, k + 1, None]
        beta[:, k] = np.where(live[:, k + 1, None], ahead @ move.T, 1.0)
        on = live[:, k + 1]
        expected += (alpha[on, k].T @ ahead[on]) * move
    marginal = alpha * beta
    marginal /= marginal.sum(axis=2, keepdims=True)
    return marginal * live[:, :, None], expected, float(np.log(scale).sum() + (top[:, :, 0] * live).sum())


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # (features, labels)
    transition: np.ndarray
    start: np.ndarray
    lexicon: frozenset[str]
    cache: dict[str, int] = field(default_factory=dict, repr=False)
    matrix: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "matrix": None}

    def score(self, words: list[str]) -> np.ndarray:
        """Score of each word for each label: the sum of its features' weights."""
        padded = np.concatenate([self.weights, np.zeros((1, len(self.labels)))]).astype(np.float32)
        parts = [padded[word_features(words[a : a + 4096], self.lexicon)].sum(axis=1) for a in range(0, len(words), 4096)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def emission(self, words: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE or self.matrix is None:
            self.cache, self.matrix = {}, np.zeros((0, len(self.labels)), np.float32)
        fresh = [w for w in dict.fromkeys(words) if w not in self.cache]
        if fresh:
            self.cache.update(zip(fresh, range(len(self.matrix), len(self.matrix) + len(fresh))))
            self.matrix = np.concatenate([self.matrix, self.score(fresh)])
        return self.matrix[np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))]

    def marginals(self, documents: list[list[str]]) -> Iterator[np.ndarray]:
        """Label probabilities of every word, document by document."""
        held, n = [], 0
        for words in documents:
            held.append(words)
            n += len(words)
            if n >= WORDS:
                yield from self._marginals(held)
                held, n = [], 0
        yield from self._marginals(held)

    def _marginals(self, documents: list[list[str]]) -> Iterator[np.ndarray]:
        sizes = np.array([len(d) for d in documents], np.int64)
        if not sizes.sum():
            yield from (np.zeros((0, len(self.labels))) for _ in documents)
            return
        scores = self.emission([w for d in documents for w in d])
        chains = -(-sizes // CHAIN)
        first = np.cumsum(chains) - chains
        inside = np.arange(len(scores)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row, col = np.repeat(first, sizes) + inside // CHAIN, inside % CHAIN
        padded = np.zeros((int(chains.sum()), CHAIN, len(self.labels)))
        padded[row, col] = scores
        found = forward_backward(padded, self.transition, self.start, np.bincount(row, minlength=len(padded)))[0][row, col]
        yield from np.split(found, np.cumsum(sizes)[:-1])


def train(texts: list[str], langs: list[str], passes: int = PASSES, rate: float = RATE) -> Crf:
    """Fit on labelled texts; the result depends on them and their order only."""
    labels = sorted(set(langs))
    code = {x: i for i, x in enumerate(labels)}
    documents = [t.split() for t in texts]
    times = Counter(w.lower() for d in documents for w in d)
    lexicon = frozenset(w for w, n in times.items() if n >= LEXICON_TIMES)
    stretches = [(d[a : a + CHAIN], code[x]) for d, x in zip(documents, langs) for a in range(0, len(d), CHAIN)]
    chains: list[tuple[list[str], list[int]]] = [(w, [y] * len(w)) for w, y in stretches]
    rng = np.random.default_rng(0)
    mixed = rng.permutation(len(stretches))
    for a, b in zip(mixed[::2], mixed[1::2]):  # half of one stretch, half of another
        (u, x), (v, y) = stretches[a], stretches[b]
        chains.append((u[: CHAIN // 2] + v[: CHAIN // 2], [x] * len(u[: CHAIN // 2]) + [y] * len(v[: CHAIN // 2])))
    chains = [c for c in chains if c[0]]
    n = max(len(labels), 1)
    model = Crf(labels, np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros(n), lexicon)
    words = {w: i for i, w in enumerate(dict.fromkeys(w for c, _ in chains for w in c))}
    slots = word_features(list(words), lexicon) if words else np.zeros((0, 1), np.int32)
    size = (slots < FEATURES).sum(axis=1)
    flat, begin = slots[slots < FEATURES].astype(np.int64), np.cumsum(size) - size
    sums = {"w": np.full((FEATURES, n), 1e-3), "t": np.full((n, n), 1e-3), "s": np.full(n, 1e-3)}

    def step(key: str, array: np.ndarray, gradient: np.ndarray) -> None:
        sums[key] += gradient * gradient
        array += rate * gradient / np.sqrt(sums[key])

    for _ in range(passes if chains and n > 1 else 0):
        for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 128)):
            some = [chains[i] for i in batch]
            lengths = np.array([len(c) for c, _ in some])
            ids = np.array([words[w] for c, _ in some for w in c])
            y = np.array([k for _, ks in some for k in ks])
            row, col = np.repeat(np.arange(len(some)), lengths), np.concatenate([np.arange(k) for k in lengths])
            own, back = np.unique(ids, return_inverse=True)
            spread = np.repeat(np.arange(len(own)), size[own])
            feats = flat[np.repeat(begin[own] - (np.cumsum(size[own]) - size[own]), size[own]) + np.arange(size[own].sum())]
            score = np.zeros((len(own), n))
            np.add.at(score, spread, model.weights[feats])
            padded = np.zeros((len(some), int(lengths.max()), n))
            padded[row, col] = score[back]
            marginal, expected, _ = forward_backward(padded, model.transition, model.start, lengths)
            error = np.eye(n)[y] - marginal[row, col]
            per_word = np.zeros((len(own), n))
            np.add.at(per_word, back, error)
            used, inverse = np.unique(feats, return_inverse=True)
            gradient = np.zeros((len(used), n))
            np.add.at(gradient, inverse, per_word[spread])
            sums["w"][used] += gradient * gradient
            model.weights[used] += rate * gradient / np.sqrt(sums["w"][used])
            seen = np.zeros((n, n))
            np.add.at(seen, (y[:-1][row[1:] == row[:-1]], y[1:][row[1:] == row[:-1]]), 1)
            step("t", model.transition, (seen - expected) / len(some))
            step("s", model.start, (np.bincount(y[col == 0], minlength=n) - marginal[:, 0].sum(axis=0)) / len(some))
    return model


def held_out(doc_id) -> F.Column:
    """Fixed by the contract: documents that learning must not read."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> Crf | None:
    """Learn from at most ``train_docs`` documents of each language that are not held out (None: there are none)."""
    key = F.col(id_col).cast("long")
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & key.isNotNull() & ~held_out(key))
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = usable.select(key.alias("id"), F.col(lang_col).alias("lang")).distinct().withColumn("nth", F.row_number().over(turn)).filter(F.col("nth") <= train_docs)
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.char_length("body") - TRAIN_CHARS, F.lit(1))) + 1
    texts = usable.select(key.alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("body")).join(chosen.select("id", "lang"), ["id", "lang"])
    # Repeated ids: one text each, so that the sample stays within its bound.
    cut = texts.select("id", "lang", F.substring(F.col("body"), place.cast("int"), F.lit(TRAIN_CHARS)).alias("cut")).groupBy("id", "lang").agg(F.min("cut").alias("cut"))
    rows = sorted(cut.collect(), key=lambda r: (r.lang, r.id))
    return train([r.cut for r in rows], [r.lang for r in rows]) if rows else None


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Crf | None = None, spans: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``; with ``spans`` also the runs of words of one language.

    ``score`` is the expected share of the words that are in the predicted language.  A null text, one without
    letters, and every text when there is nothing to learn from is ``und`` with score 0.  A null id is not held out.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    schema += ", spans array<struct<first: long, last: long, lang: string>>" if spans else ""

    def runs(p: np.ndarray) -> list[dict]:
        best = p.argmax(axis=1)
        cuts = np.flatnonzero(np.diff(best)) + 1
        return [{"first": int(a), "last": int(b) - 1, "lang": model.labels[best[a]]} for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(best)])] if len(best) else []

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = frame["body"].tolist()
            lettered = [any(map(str.isalpha, t)) for t in texts]
            documents = [t.split() if ok and model else [] for t, ok in zip(texts, lettered)]
            out, found = [], []
            for words, p in zip(documents, model.marginals(documents) if model else [None] * len(texts)):
                if not words:
                    out.append(("und", 0.0))
                    found.append([])
                    continue
                counts = p.sum(axis=0)
                k = int(counts.argmax())
                out.append((model.labels[k], min(1.0, float(counts[k] / counts.sum()))))
                if spans:
                    found.append(runs(p))
            result = pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"].astype(bool), "lang_pred": [x for x, _ in out], "score": [x for _, x in out]})
            yield result.assign(spans=found) if spans else result

    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("doc_id"), F.coalesce(held_out(key), F.lit(False)).alias("held_out"), whole(text_col).alias("body"))
    return rows.mapInPandas(predict, schema)
