"""Toxic spans by a linear-chain conditional random field over words.

Two states, clean (0) and toxic (1). A word's emission is a sum of weights of hashed features of the word alone: itself, its
first letters and its last letters; transitions are weights between neighbouring states, and every text begins and ends in
state 0. Training maximises the conditional likelihood of labelled words by gradients from forward-backward marginals.

Labels of words come from labels of texts: a word is labelled toxic where it stands in a toxic text and one of its
features is far more frequent in toxic texts than in clean ones. In clean texts every word is labelled clean. Toxic texts
without such a word carry no label and are left out.

A text's score is a logistic function of its marginals (expected toxic words, their density, the likeliest one), since a
word of a toxic stem may stand alone in a clean text. It is fitted on the same sample.

Scoring runs forward-backward over whole texts in blocks: the chain is linear in its potentials, so a block of words is a
2 x 2 matrix, the blocks' matrices give what enters each block, and all blocks then advance side by side.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import held_out, labelled_sample, map_texts

#: Weights of the hashed features.
BUCKETS = 1 << 18
#: Words in a block of the chain.
BLOCK = 64
#: Bound of the labelled sample: texts of each class, and characters of a text.
PER_CLASS, LONGEST = 1500, 20_000
#: A feature marks a word toxic if it stands in at least so many toxic texts of the sample, in this share of them, and is so
#: rarely in clean ones.
LEAST_TEXTS, LEAST_SHARE, PURITY = 5, 0.03, 0.8
#: Words of which a task remembers the emission.
REMEMBERED = 300_000
WORDS = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The word, its first 3 to 6 letters, its last 3."""
    return ["=" + word] + ["^" + word[:n] for n in (3, 4, 5, 6) if len(word) > n] + (["$" + word[-3:]] if len(word) > 3 else [])


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def marginals(emit: np.ndarray, trans: np.ndarray):
    """Probability of state 1 at every place of one chain, and the sums of pair marginals.

    ``emit``: log odds of state 1; -inf forces state 0, which is how texts in a row are kept apart. ``trans``: 2 x 2
    log potentials.
    """
    n = len(emit)
    width = -(-n // BLOCK)
    padded = np.full(width * BLOCK, -np.inf)
    padded[:n] = emit
    e = np.exp(np.clip(padded, -60, 60)).reshape(width, BLOCK).T.copy()
    e[np.isneginf(padded).reshape(width, BLOCK).T] = 0.0
    (a, b), (c, d) = np.exp(trans)
    # Matrix of each block, scaled at every step.
    p, q, r, s = np.ones(width), np.zeros(width), np.zeros(width), np.ones(width)
    for i in range(BLOCK):
        p, q, r, s = p * a + q * c, e[i] * (p * b + q * d), r * a + s * c, e[i] * (r * b + s * d)
        top = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / top, q / top, r / top, s / top
    into, rows = np.empty(width), list(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist()))
    f0, f1 = 1.0, 0.0
    for i, (w, x, y, z) in enumerate(rows):
        into[i] = f1 / f0
        f0, f1 = f0 * w + f1 * y, f0 * x + f1 * z
        top = f0 + f1
        f0, f1 = max(f0 / top, 1e-300), f1 / top
    back = np.empty(width)
    g0, g1 = 1.0, 1.0
    for i in range(width - 1, -1, -1):
        back[i] = g1 / g0
        w, x, y, z = rows[i]
        g0, g1 = w * g0 + x * g1, y * g0 + z * g1
        top = g0 + g1
        g0, g1 = max(g0 / top, 1e-300), g1 / top
    ahead, behind = np.empty_like(e), np.empty_like(e)
    odds = into
    for i in range(BLOCK):
        odds = np.minimum(e[i] * (b + d * odds) / (a + c * odds), 1e200)
        ahead[i] = odds
    odds = back
    for i in range(BLOCK - 1, -1, -1):
        behind[i] = odds
        w = e[i] * odds
        odds = np.minimum((c + d * w) / (a + b * w), 1e200)
    ahead, behind = ahead.T.ravel()[:n], behind.T.ravel()[:n]
    both = ahead * behind
    return both / (1 + both), ahead, behind, np.exp(np.clip(emit, -60, 60)) * ~np.isneginf(emit)


def pair_sums(ahead, behind, e, trans, weight):
    """Sums over neighbouring places of the probability of each pair of states."""
    (a, b), (c, d) = np.exp(trans)
    f, w = ahead[:-1], e[1:] * behind[1:]
    parts = np.stack([a + 0 * f, b * w, f * c, f * d * w])
    parts /= parts.sum(axis=0)
    return (parts * weight[1:]).sum(axis=1).reshape(2, 2)


def word_labels(sample):
    """``[(words, labels)]``: labels of words from labels of texts; toxic texts without a marked word are left out."""
    split = [(WORDS.findall(t.lower()), y) for t, y in sample]
    seen = (Counter(), Counter())
    for words, y in split:
        seen[y].update({f for w in set(words) for f in features(w)[:-1]})
    size = [max(1, sum(1 for _, y in split if y == k)) for k in (0, 1)]
    marks = {f for f, n in seen[1].items() if n >= max(LEAST_TEXTS, LEAST_SHARE * size[1])
             and n / size[1] >= PURITY * (n / size[1] + seen[0][f] / size[0])}
    toxic = {w for words, y in split if y for w in set(words) if not marks.isdisjoint(features(w)[:-1])}
    out = []
    for words, y in split:
        labels = np.array([y and w in toxic for w in words], np.float64)
        if words and (labels.any() or not y):
            out.append((words, labels))
    return out


def fit(sample, rounds: int = 60, rate: float = 0.3, shrink: float = 1e-4):
    """``(weights, transitions, bias)`` of a field trained on ``[(text, label)]``."""
    texts = word_labels(sample)
    vocabulary: dict[str, int] = {}
    chain, truth = [-1], [0.0]
    for words, labels in texts:
        chain += [vocabulary.setdefault(w, len(vocabulary)) for w in words] + [-1]
        truth += [*labels, 0.0]
    chain, truth = np.array(chain), np.array(truth)
    at, which = [], []
    for w, i in vocabulary.items():
        own = [bucket(f) for f in features(w)]
        at += own
        which += [i] * len(own)
    at, which = np.array(at, np.int64), np.array(which, np.int64)
    real, weights, trans, bias = chain >= 0, np.zeros(BUCKETS), np.zeros((2, 2)), -3.0
    everywhere = np.ones(len(chain))
    t0, t1 = truth[:-1], truth[1:]
    told = np.array([[((1 - t0) * (1 - t1)).sum(), ((1 - t0) * t1).sum()], [(t0 * (1 - t1)).sum(), (t0 * t1).sum()]])
    memory = [np.full(BUCKETS, 1e-8), np.full((2, 2), 1e-8), 1e-8]
    scale = max(1.0, truth.sum())
    for _ in range(rounds if vocabulary else 0):
        per_word = np.bincount(which, weights[at], len(vocabulary)) + bias
        emit = np.where(real, per_word[np.maximum(chain, 0)], -np.inf)
        p, ahead, behind, e = marginals(emit, trans)
        miss = np.bincount(chain[real], (truth - p)[real], len(vocabulary))
        steps = [np.bincount(at, miss[which], BUCKETS) / scale - shrink * weights,
                 (told - pair_sums(ahead, behind, e, trans, everywhere)) / scale, miss.sum() / scale]
        for k, g in enumerate(steps):
            memory[k] = memory[k] + g * g
        weights = weights + rate * steps[0] / np.sqrt(memory[0])
        trans = trans + rate * 0.3 * steps[1] / np.sqrt(memory[1])
        bias += rate * steps[2] / np.sqrt(memory[2])
    return weights.astype(np.float32), trans, float(bias)


def summary(p: np.ndarray) -> tuple[float, float, float]:
    """What the score of a text reads from the marginals of its words."""
    total = float(p[p >= 0.02].sum())
    return np.log1p(total), np.log1p(1000 * total / max(1, len(p))), float(p.max()) if len(p) else 0.0


def calibrate(rows: np.ndarray, truth: np.ndarray, rounds: int = 25, shrink: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the intercept."""
    x = np.column_stack([rows, np.ones(len(rows))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + shrink * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (truth - p) - shrink * w)
    return w


def learn(sample):
    """The whole model: field and calibration. A sample without one of the classes scores everything 0."""
    model = (*fit(sample), None)
    if len({y for _, y in sample}) < 2:
        return model
    tagger, rows = Tagger(model), []
    for i in range(0, len(sample), 200):
        rows += [summary(p) for p in tagger.marginals([t for t, _ in sample[i:i + 200]])]
    return (*model[:3], calibrate(np.array(rows), np.array([y for _, y in sample], np.float64)))


class Tagger:
    """A trained field and the emissions of the words met so far."""

    def __init__(self, model):
        self.weights, self.trans, self.bias, self.calibration = model
        self.known: dict[str, float] = {}

    def emissions(self, words: list[str]) -> list[float]:
        out = list(map(self.known.get, words))
        if None in out:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, found in enumerate(out):
                if found is None:
                    word = words[i]
                    found = self.known.get(word)
                    if found is None:
                        found = self.known[word] = float(sum(self.weights[bucket(f)] for f in features(word))) + self.bias
                    out[i] = found
        return out

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Probability of every word of every text to be toxic."""
        emit, bounds = [-np.inf], [0]
        for t in texts:
            emit += self.emissions(WORDS.findall(t.lower()))
            emit.append(-np.inf)
            bounds.append(len(emit) - 1)
        p = marginals(np.array(emit), self.trans)[0]
        return [p[a + 1:b] for a, b in zip(bounds, bounds[1:])]

    def score(self, texts: list[str]):
        """Score of every text and ``[(start, end)]`` of its toxic words, by offset in the text."""
        scores, spans = [], []
        for t, own in zip(texts, self.marginals(texts)):
            scores.append(0.0 if self.calibration is None or not len(own) else
                          float(1 / (1 + np.exp(-np.clip(np.dot(self.calibration, (*summary(own), 1.0)), -30, 30)))))
            hot = np.flatnonzero(own >= 0.5)
            spans.append([])
            if len(hot):
                lowered = t.lower()
                # Lower case may be longer than the text (one letter becomes two): then words are found in the text itself.
                places = [m.span() for m in WORDS.finditer(lowered if len(lowered) == len(t) else t)]
                spans[-1] = [places[h] for h in hot.tolist() if h < len(places)]
        return scores, spans


def train(docs: DataFrame, labels: DataFrame, text: str = "text"):
    """A model from a bounded sample of labelled rows that are not held out. Without toxic rows every score is near 0."""
    return learn(labelled_sample(docs, labels, "toxic", PER_CLASS, LONGEST, text))


def tagged(docs: DataFrame, model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``score``, and ``spans``: begin and end of toxic words in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: BUCKETS weights
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def work(texts, tagger):
        scores, spans = tagger.score(texts)
        return {"score": pa.array(scores, pa.float64()), "spans": pa.array([[{"begin": a, "end": b} for a, b in s] for s in spans], kind)}

    return map_texts(docs, keep, text, work, "score double, spans array<struct<begin: bigint, end: bigint>>", lambda: Tagger(shared.value))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every row of ``docs``.

    NULL, empty and wordless texts score 0. A NULL doc_id keeps its row and is not held out; repeated rows score alike;
    an empty table gives no rows; other columns are ignored.
    """
    scored = tagged(docs, train(docs, labels, text), ["doc_id"], text)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, known: DataFrame, labels: DataFrame, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns; ``known`` are the texts of the labelled rows."""
    renamed = {c: f"__kept_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(c).alias(n) for c, n in renamed.items()])
    scored = tagged(plain, train(known, labels, text), list(renamed.values()), renamed[text])
    return scored.where(F.col("score") < threshold).select(*[F.col(renamed[c]).alias(c) for c in docs.columns])
