"""Quality rules and a quality model: logistic regression over hashed word and character n-grams.

Features of a text are means over its words: hashed words, hashed character n-grams inside words, hashed pairs of words.
A word's share of the score is a constant, so a task computes it once per distinct word; pairs are looked up in one step for
a whole slice. Scores are calibrated to probabilities on texts that the weights were not fitted on, and compared with a fixed
threshold. The base rules count words, symbols, repeated lines and repeated windows of three words exactly.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import labelled_sample, map_texts

#: Hashed weights for words with their character n-grams, and for pairs of words.
BUCKETS = 1 << 18
#: Lengths of the character n-grams.
GRAMS = (2, 3, 4)
#: Bound of the labelled sample: texts of each class, and characters of a text.
PER_CLASS, LONGEST = 1500, 20_000
#: Words of which a task remembers number and score.
REMEMBERED = 150_000
#: Least probability of good quality.
THRESHOLD = 0.5
SYMBOLS = re.compile(r"[#*$%&|<>]")


def word_features(words: list[bytes]):
    """Hashed features of words: ``(bucket, index of the word, portion)``.

    A word itself counts 1, the n-grams of its letters, with borders marked, share another 1.
    """
    text = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    end = np.cumsum(size)
    whose = np.repeat(np.arange(len(words)), size)
    left = end[whose] - np.arange(len(text))  # letters from here to the word's border
    grams = sum(np.maximum(0, size - n + 1) for n in GRAMS)
    at, of, share = [np.array([zlib.crc32(w) % BUCKETS for w in words], np.int64)], [np.arange(len(words))], [np.ones(len(words))]
    for n in GRAMS:
        place = np.flatnonzero(left >= n)
        code = np.full(len(place), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + text[place + k]
        at.append(((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS)
        of.append(whose[place])
        share.append(1 / grams[of[-1]])
    return np.concatenate(at), np.concatenate(of), np.concatenate(share)


class Words:
    """Numbers words and keeps what is constant about each: hash and share of the score."""

    def __init__(self, weights=None):
        self.weights, self.number, self.most = weights, {}, REMEMBERED
        self.hash, self.share = np.empty(1024, np.uint32), np.empty(1024)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        found = list(map(number.get, words))
        if None in found:
            self.learn([w for w, known in zip(words, found) if known is None])
            found = list(map(number.__getitem__, words))
        return np.array(found, np.int64)

    def room(self) -> None:
        """Forget all words if there are too many; numbers given before are void then."""
        if len(self.number) > self.most:
            self.number.clear()

    def learn(self, words) -> None:
        """Number new words, with their hashes and shares."""
        new = list(dict.fromkeys(w for w in words if w not in self.number))
        if not new:
            return
        first = len(self.number)
        self.number.update(zip(new, range(first, first + len(new))))
        if len(self.number) > len(self.hash):
            self.hash, self.share = (np.resize(v, 2 * len(self.number)) for v in (self.hash, self.share))
        self.hash[first:len(self.number)] = [zlib.crc32(w) for w in new]
        if self.weights is not None:
            at, of, portion = word_features(new)
            self.share[first:len(self.number)] = np.bincount(of, self.weights[at] * portion, len(new))


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Hashed feature of each pair of neighbouring words."""
    mixed = hashes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + hashes[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def score(numbers: np.ndarray, words: Words, pairs: np.ndarray) -> float:
    """Raw score of a text: the mean share of its words, and of its pairs."""
    if not len(numbers):
        return 0.0
    total = words.share[numbers].mean()
    return float(total + pairs[pair_buckets(words.hash[numbers])].mean()) if len(numbers) > 1 else float(total)


def repeated_words(numbers: np.ndarray) -> int:
    """Words in windows of three words that stand in the text twice or more, the first included."""
    if len(numbers) < 4:
        return 0
    if numbers.max() < 1 << 21:
        # Three numbers below 2 ** 21 make one exact key.
        keys = (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    else:
        # Pairs are numbered anew first; two numbers below 2 ** 31 make one exact key.
        _, pairs = np.unique((numbers[:-1] << 31) | numbers[1:], return_inverse=True)
        keys = (pairs[:-1] << 31) | numbers[2:]
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[which] > 1)
    hit = np.zeros(len(numbers), bool)
    for shift in (0, 1, 2):
        hit[again + shift] = True
    return int(hit.sum())


def fit(sample, rounds: int = 80, rate: float = 0.5, shrink: float = 1e-3):
    """``(weights, pair weights, slope, intercept)`` from ``[(text, 0 or 1)]``; every fifth text only calibrates.

    A sample without one of the classes gives a model that passes every text.
    """
    if len({y for _, y in sample}) < 2:
        return np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0, 30.0
    words = Words()
    rows = [words.numbers(t.encode("utf-8", "replace").split()) for t, _ in sample]
    truth = np.array([y for _, y in sample], np.float64)
    size = np.array([max(1, len(r)) for r in rows])
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at, which, portion = word_features(list(words.number))
    pairs = np.concatenate([pair_buckets(words.hash[r]) if len(r) > 1 else np.empty(0, np.int64) for r in rows])
    pair_of = np.repeat(np.arange(len(rows)), [max(0, len(r) - 1) for r in rows])
    pair_size = np.maximum(1, size - 1)
    fitted = np.arange(len(rows)) % 5 > 0
    balance = np.where(truth == 1, 0.5 / max(1, truth[fitted].sum()), 0.5 / max(1, (1 - truth)[fitted].sum())) * fitted
    w, p, bias = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0
    memory = [np.full(BUCKETS, 1e-10), np.full(BUCKETS, 1e-10), 1e-10]

    def raw():
        share = np.bincount(which, w[at] * portion, len(words.number))
        return np.bincount(of, share[flat], len(rows)) / size + np.bincount(pair_of, p[pairs], len(rows)) / pair_size

    for _ in range(rounds):
        miss = balance * (truth - 1 / (1 + np.exp(-(raw() + bias))))
        per_word = np.bincount(flat, (miss / size)[of], len(words.number))
        steps = [np.bincount(at, per_word[which] * portion, BUCKETS) - shrink * w * 1e-3,
                 np.bincount(pairs, (miss / pair_size)[pair_of], BUCKETS) - shrink * p * 1e-3, miss.sum()]
        memory = [m + g * g for m, g in zip(memory, steps)]
        w, p, bias = (v + rate * g / np.sqrt(m) for v, g, m in zip((w, p, bias), steps, memory))
    w, p = w.astype(np.float32), p.astype(np.float32)
    x = np.column_stack([raw()[~fitted], np.ones((~fitted).sum())])
    line, y = np.zeros(2), truth[~fitted]
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        line += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - q) - 1e-3 * line)
    return w, p, float(line[0]), float(line[1])


def measure(texts: list[str], model, words: Words) -> dict:
    """Base counts and the probability of good quality for whole texts."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    counts, chance = {n: [] for n in names}, []
    _, pairs, slope, intercept = model
    encoded = [t.encode("utf-8", "replace") for t in texts]
    words.room()
    words.learn(w for data in encoded for w in data.split())
    for t, data in zip(texts, encoded):
        split = data.split()
        numbers = words.numbers(split)
        # Continuation bytes are 0x80 to 0xBF; all other bytes begin a code point.
        joined = np.frombuffer(b"".join(split), np.uint8)
        lines = [x for x in data.split(b"\n") if not x.isspace() and x] if b"\n" in data else []
        for name, n in zip(names, (len(split), int(((joined & 0xC0) != 0x80).sum()), len(SYMBOLS.findall(t)),
                                   len(lines) - len(set(lines)), repeated_words(numbers))):
            counts[name].append(n)
        chance.append(float(1 / (1 + np.exp(-np.clip(slope * score(numbers, words, pairs) + intercept, -30, 30)))))
    return {n: pa.array(c, pa.int64()) for n, c in counts.items()} | {"quality": pa.array(chance, pa.float64())}


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``quality`` for every row of ``docs``.

    NULL, empty and blank texts have no words and fail the base rules. Ids may be NULL or repeated; an empty table gives no
    rows; other columns are ignored.
    """
    model = fit(labelled_sample(docs, labels, "quality", PER_CLASS, LONGEST, text))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: twice BUCKETS weights
    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, quality double"
    rows = map_texts(docs, ["doc_id"], text, lambda texts, words: measure(texts, shared.value, words), schema, lambda: Words(shared.value[0]))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & (F.col("quality") >= threshold)).alias("kept"), "quality")
