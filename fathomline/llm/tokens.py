"""Exact token counts at every prefix of a text, by dynamic programming over its pieces and their bytes.

A byte-level BPE tokenizer cuts a text into pieces and encodes each on its own. The table of a text holds, per piece, its
end and the tokens up to there; inside a piece a second recurrence over bytes holds the count of each prefix: the last
token of a prefix is the one token that ends there and may follow the encoding of what is left of it, so
``count[k] = count[k - len(token)] + 1``. Both tables are made once; truncation and budget questions read them.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import map_texts, pieces

#: Unicode's white space, as the library has it; Python's own class also has U+001C to U+001F.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed value: the pre-tokenizer's pattern, with the library's classes written for Python's re.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^{BLANK}\w]|_)+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
#: Pieces, runs and pairs of which a worker remembers the count; beyond it the memory starts anew.
REMEMBERED = 600_000
#: Pieces worked on at once, their cells (pieces x length squared), and bytes beyond which a piece is worked on alone.
AT_ONCE, CELLS, LONG_PIECE = 4096, 4_000_000, 48
#: Slots (a power of two) in which a worker remembers which tokens may follow each other.
SLOT_BITS = 20


def byte_letters() -> dict[str, int]:
    """The byte that each letter of the vocabulary stands for: printable Latin-1 is itself, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixTables:
    """Prefix tables of many pieces side by side: the recurrence of ``PrefixBpe.piece_table``, a step for all at once.

    Tokens are found by walking a trie of the vocabulary from every place of every piece; which tokens may follow each
    other is worked out for all pairs of a step and remembered in slots that newer pairs overwrite.
    """

    def __init__(self, order: dict, halves: list, joined: dict, longest: int):
        children, token = {}, [-1]
        for word, number in order.items():
            node = 0
            for byte in word:
                node = children.setdefault(node << 8 | byte, len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = number
        self.token, self.longest = np.array(token, np.int64), longest
        self.edge, self.child = sorted_pairs(children)
        self.pair, self.made = sorted_pairs(joined)
        self.left, self.right = (np.array(h, np.int64) for h in zip(*halves))
        self.slot_key, self.slot = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, bool)

    def may_follow(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one << 32 | two
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out, new = self.slot[slot], np.flatnonzero(self.slot_key[slot] != key)
        if len(new):
            out[new] = self.judged(one[new], two[new])
            self.slot_key[slot[new]], self.slot[slot[new]] = key[new], out[new]
        return out

    def judged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, at = np.ones(len(a), bool), np.arange(len(a))
        before = np.full(len(a), 1 << 60)
        while len(at):
            key = a << 32 | b
            place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            bad = (self.pair[place] == key) & (self.made[place] < before)
            out[at[bad]] = False
            on = ~bad & ((a >= 256) | (b >= 256))
            at, a, b = at[on], a[on], b[on]
            later = a > b
            before = np.where(later, a, b + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Token count of every prefix, ``[length, word]``; beyond a word's end nothing of meaning."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n, many = int(sizes.max()), len(words)
        letters = np.zeros((many, n), np.int64)
        letters[np.arange(n) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        token = np.full((n, n + 1, many), -1, np.int32)
        for start in range(n):
            at = np.flatnonzero(sizes > start)
            node = np.zeros(len(at), np.int64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                key = node << 8 | letters[at, end - 1]
                place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
                on = (self.edge[place] == key) & (sizes[at] >= end)
                at, node = at[on], self.child[place[on]]
                if not len(at):
                    break
                token[start, end, at] = self.token[node]
        count, last = np.zeros((n + 1, many), np.int64), np.full((n + 1, many), -1, np.int64)
        for end in range(1, n + 1):
            todo = np.flatnonzero(sizes >= end)
            for start in range(max(0, end - self.longest), end):
                some = token[start, end, todo]
                at = todo[some >= 0]
                ends = token[start, end, at].astype(np.int64)
                if start and len(at):
                    fits = self.may_follow(last[start, at], ends)
                    at, ends = at[fits], ends[fits]
                if len(at):
                    count[end, at], last[end, at] = count[start, at] + 1, ends
                    todo = todo[last[end, todo] < 0]
                    if not len(todo):
                        break
        return count

    def totals(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each whole word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order, out = np.argsort(sizes, kind="stable"), np.empty(len(words), np.int64)
        at = 0
        while at < len(order):
            some = order[at:at + AT_ONCE]
            # As many as fit with the length of the longest among them.
            fit = np.flatnonzero((np.arange(len(some)) + 1) * sizes[some] * (sizes[some] + 1) <= CELLS)
            some = some[:max(1, int(fit[-1]) + 1 if len(fit) else 1)]
            made = self.counts([words[i] for i in some.tolist()])
            out[some] = made[sizes[some], np.arange(len(some))]
            at += len(some)
        return out


def sorted_pairs(table: dict) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and their values."""
    keys = np.fromiter(table.keys(), np.int64, len(table))
    order = np.argsort(keys)
    return keys[order], np.fromiter(table.values(), np.int64, len(table))[order]


class PrefixBpe:
    """Vocabulary of a byte-level BPE file of the tokenizers library, and the prefix tables of pieces and texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letter = byte_letters()
        # Tokens in the order in which merging makes them: bytes first. halves: what each was merged from (a byte: itself).
        order = {bytes([b]): b for b in range(256)}
        self.halves, self.joined = [(b, b) for b in range(256)], {}
        for m in spec["model"]["merges"]:
            one, two = (bytes(letter[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m))
            self.joined[order[one] << 32 | order[two]] = order[one + two] = len(self.halves)
            self.halves.append((order[one], order[two]))
        self.order, self.longest = order, max(map(len, order))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.path, self.library = path, None
        self.find = re.compile(PIECES).findall
        self.fits: dict[int, bool] = {}
        self.known: dict[str, int] = {}
        self.runs: dict[str, int] = {}
        self.tables = PrefixTables(self.order, self.halves, self.joined, self.longest)

    def may_follow(self, one: int, two: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes.

        They are, unless a pair across the border merges before both tokens are complete. The pairs that can meet there
        are found by undoing, step by step, whichever of the two was made later.
        """
        key = one << 32 | two
        known = self.fits.get(key)
        if known is not None:
            return known
        halves, joined, before = self.halves, self.joined, 1 << 60
        a, b, known = one, two, True
        while True:
            met = joined.get(a << 32 | b)
            if met is not None and met < before:
                known = False
                break
            if a < 256 and b < 256:
                break
            if a > b:
                before, a = a, halves[a][1]
            else:
                before, b = b + 1, halves[b][0]
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        self.fits[key] = known
        return known

    def piece_table(self, word: bytes) -> tuple[list[int], list[int]]:
        """Token count and last token (in merge order) for every prefix of a piece, the empty one included."""
        count, last, order, longest = [0], [-1], self.order.get, self.longest
        for k in range(1, len(word) + 1):
            for start in range(k - longest if k > longest else 0, k):
                token = order(word[start:k])
                if token is not None and (not start or self.may_follow(last[start], token)):
                    count.append(count[start] + 1)
                    last.append(token)
                    break
        return count, last

    def pieces(self, text: str) -> list[str]:
        """The pieces of a whole text; strings of special tokens are pieces of their own, as the library's default has it.

        The library's letters and digits are Unicode's L and N; where re's classes differ from them (letter-like numbers,
        marks), the library itself cuts the text.
        """
        if not text.isascii() and ODD(text):
            return self.library_pieces(text)
        if self.cut_special and any(s in text for s in self.special):
            return [p for part in self.cut_special.split(text) for p in ([part] if part in self.special else self.find(part))]
        return self.find(text)

    def library_pieces(self, text: str) -> list[str]:
        if self.library is None:
            import tokenizers

            self.library = tokenizers.Tokenizer.from_file(self.path)
        parts = self.cut_special.split(text) if self.cut_special else [text]
        cut, out = self.library.pre_tokenizer.pre_tokenize_str, []
        for part in parts:
            out += [part] if part in self.special else [part[a:b] for _, (a, b) in cut(part)] if part else []
        return out

    def learn(self, pieces) -> None:
        """Count the tokens of pieces not known yet: all their prefix tables in one go."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(dict.fromkeys(pieces))
        words = [p.encode("utf-8", "replace") for p in new]
        alone = [p in self.special or len(w) > LONG_PIECE for p, w in zip(new, words)]
        short = [i for i, a in enumerate(alone) if not a]
        totals = np.empty(len(new), np.int64)
        if short:
            totals[short] = self.tables.totals([words[i] for i in short])
        for i in np.flatnonzero(alone).tolist():
            totals[i] = 1 if new[i] in self.special else self.piece_table(words[i])[0][-1]
        self.known.update(zip(new, totals.tolist()))

    def of_pieces(self, pieces: list[str]) -> list[int]:
        """Tokens of every piece, from its prefix table."""
        out = list(map(self.known.get, pieces))
        if None in out:
            self.learn(pieces)
            out = list(map(self.known.__getitem__, pieces))
        return out

    def whole(self, text: str) -> bool:
        """Whether a text must be cut piece by piece: white space beside a space, a special string, letters that re sees otherwise."""
        return bool(WIDE(text) or self.cut_special and self.cut_special.search(text) or not text.isascii() and ODD(text))

    def of_runs(self, runs: list[str]) -> np.ndarray:
        """Tokens of each run with the space before it."""
        out = np.fromiter(map(self.runs.get, runs, itertools.repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(out < 0).tolist()
        if new:
            cut = [self.find(" " + runs[i]) for i in new]
            flat = np.array(self.of_pieces(list(itertools.chain.from_iterable(cut))), np.int64)
            out[new] = np.add.reduceat(flat, np.cumsum([0, *map(len, cut[:-1])]))
            if len(self.runs) + len(new) > REMEMBERED:
                self.runs.clear()
            self.runs.update(zip((runs[i] for i in new), out[new].tolist()))
        return out

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of every text of an Arrow column, run by run.

        A lone space between other characters always starts a piece, so texts are cut there, in Arrow, and each distinct run
        of the slice is looked up once. Texts where white space follows white space, or a special string may stand, are cut
        into pieces one by one.
        """
        texts = column.to_pylist()
        alone = np.fromiter(map(self.whole, texts), bool, len(texts))
        plain = column.filter(pa.array(~alone))
        out = np.zeros(len(texts), np.int64)
        if len(plain):
            cut = pc.split_pattern(plain, " ")
            runs = cut.flatten().dictionary_encode()
            edges = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
            index = runs.indices.to_numpy()
            later = np.ones(len(index), bool)
            later[edges[:-1]] = False
            # The first run of a text has no space before it.
            heads, used = runs.dictionary.take(pa.array(index[edges[:-1]])).to_pylist(), np.unique(index[later])
            per_run = np.zeros(len(runs.dictionary), np.int64)
            per_run[used] = self.of_runs(runs.dictionary.take(pa.array(used)).to_pylist())
            sums = np.concatenate([[0], np.cumsum(np.where(later, per_run[index], 0))])
            pieces = [self.find(h) for h in heads]
            counted = self.of_pieces(list(itertools.chain.from_iterable(pieces)))
            starts = np.concatenate([[0], np.cumsum(counted)])[np.cumsum([0, *map(len, pieces)])]
            out[~alone] = sums[edges[1:]] - sums[edges[:-1]] + np.diff(starts)
        for i in np.flatnonzero(alone).tolist():
            out[i] = sum(self.of_pieces(self.pieces(texts[i])))
        return out

    def count(self, text: str) -> int:
        return int(self.counts(pa.array([text], pa.string()))[0])

    def text_table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """End (code points) of every piece, and tokens up to there."""
        pieces = self.pieces(text)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return ends, np.cumsum(np.array(self.of_pieces(pieces), np.int64))

    def count_at(self, text: str, ends, totals, chars: int) -> int:
        """Exact tokens of ``text[:chars]``, from the tables alone: only the piece that the cut goes through is looked at."""
        at = bisect.bisect_left(ends, chars)
        start = int(ends[at - 1]) if at else 0
        if at < len(ends) and ONLY_BLANK(text[start:chars]) and at and ONLY_BLANK(text[int(ends[at - 2]) if at > 1 else 0:start]):
            at, start = at - 1, int(ends[at - 2]) if at > 1 else 0  # white space up to the end of a text is one piece
        elif at < len(ends) and chars == ends[at]:
            return int(totals[at])
        if start < chars and text.startswith(tuple(self.special), start) and chars < len(text):
            return self.count_at(text[:chars], *self.text_table(text[:chars]), chars)  # half a special string is plain text
        before = int(totals[at - 1]) if at else 0
        return before + sum(self.piece_table(p.encode())[0][-1] for p in self.pieces(text[start:chars]))

    def truncate(self, text: str, ends, totals, budget: int) -> int:
        """The largest number of whole pieces' characters whose tokens fit the budget."""
        at = int(np.searchsorted(totals, budget, side="right"))
        return int(ends[at - 1]) if at else 0


#: A space after other white space: the two may be one piece.
WIDE = re.compile(f"[{BLANK}] ").search
ONLY_BLANK = re.compile(f"[{BLANK}]+").fullmatch
#: Where re's classes and Unicode's L and N may part: marks, numbers that are not digits, letters outside the common scripts.
ODD = re.compile("[^\\x00-\\x7fÀ-ÖØ-öø-ʯЀ-ҁҊ-ԯ‐-‧¡-©«-±´¶-¸»¿×÷€]").search


#: Tables that a worker process has read, by path: its next tasks find them, with all they remember.
_LOADED: dict[str, PrefixBpe] = {}


def loaded(path: str) -> PrefixBpe:
    if path not in _LOADED:
        _LOADED[path] = PrefixBpe(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, whole texts.

    NULL and empty texts have no bytes and no tokens; ids may be NULL or repeated; an empty table gives no rows.
    """
    source = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def run(batches):
        bpe = loaded(tokenizer)
        for batch in batches:
            for piece in pieces(batch, "t"):
                texts = piece.column("t")
                yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                                                  "n_tokens": pa.array(bpe.counts(texts))})

    kind = dict(source.dtypes)["doc_id"]
    counted = source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_tables(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``doc_id, ends, totals``: piece ends in code points and the tokens up to each, whole texts (NULL: empty arrays)."""
    def work(texts, bpe):
        tables = [bpe.text_table(t) for t in texts]
        kind = pa.list_(pa.int64())
        return {"ends": pa.array([t[0].tolist() for t in tables], kind), "totals": pa.array([t[1].tolist() for t in tables], kind)}

    return map_texts(docs, ["doc_id"], text, work, "ends array<long>, totals array<long>", lambda: loaded(tokenizer))
