"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: runs of text between block-level tags. Each block is read as a vector: the mean of vectors of its
tag path (open tags with their class and id words), the mean of vectors of its hashed words, and a few measures of form. A
bidirectional LSTM in numpy reads the blocks of a page in order, so each is classified with the whole page before and after
it in view. All vectors and weights are trained here by gradients through time.

There are no labelled pages. Labels for training come from pages that say what their parts are: an element named as
navigation, footer, advert, comments and so on marks its blocks as not text, else an article or main element marks them as
text; other blocks carry no label. That rule is never an input, and each training page is read twice: as it is, and with all
such elements renamed to ``div`` and all class and id words gone, so that form, words and order must tell as well. Vectors
start at zero: a name or word that training never met says nothing.

Work is linear in the page. Tags are found by one scan without backtracking; a tag path is the ``OUTER`` outermost and
``INNER`` innermost open elements; pages are read together only while their padded size stays within ``CELLS`` blocks, and
longer ones alone.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import map_texts

#: Bound of the training sample: pages, characters of a page, blocks of a page (half from its start, half from its end).
PAGES, LONGEST, MOST_BLOCKS = 100, 20_000, 40
#: Hashed vectors for paths and words, their length, and hidden units in each direction.
PATHS, WORDS, WIDTH, HIDDEN = 2048, 4096, 12, 16
#: Measures of form beside the vectors: length, link share, stops, place.
FORM = 4
#: Open elements on a tag path: outermost and innermost.
OUTER, INNER = 24, 40
#: Padded blocks read at once, steps whose inputs are multiplied at once, words gathered at once.
CELLS, STEPS, GATHER = 8192, 4096, 65_536

# Names of HTML elements and of page parts.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = ("script", "style", "noscript", "template", "svg", "title", "iframe", "object", "canvas")
OTHER_PARTS = frozenset("nav header footer aside form button select textarea label menu navbar sidebar ad ads advert advertisement advertising "
                        "banner cookie cookies consent notice alert popup modal promo sponsor sponsored comment comments disqus breadcrumb "
                        "breadcrumbs pagination pager share sharing social related widget subscribe newsletter login signup search masthead "
                        "copyright legal disclaimer skip toolbar reply replies".split())
TO_THE_END = ("script", "style", "title", "iframe")
TEXT_PARTS = frozenset("article main content post entry story articlebody".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())

NEUTRAL = "div"

NAME = re.compile(r"[a-zA-Z][\w:-]*")
TAG_END = re.compile(r"[>\"']")
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in SILENT}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[a-z0-9]+")
#: Inline elements looked through for an open element that a new one of its kind closes.
LOOK_BACK = 50
#: Characters of a tag in which class and id words are looked for.
NAMED_WITHIN = 2000


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: list[str], linked: float):
        self.text, self.path, self.linked = text, path, linked


def tokens_of(page: str):
    """``(start, end, name, closes, attributes)`` of every tag, comment and silent element, in one scan.

    ``name`` is None for comments, declarations and silent elements; ``closes`` then says whether a block ends there. Quotes hide a ``>``
    unless that would leave the tag open to the page's end; from there on every tag ends at its next ``>``.
    """
    at, last, quoted, unclosed = 0, page.rfind(">"), True, set()
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, None, False, ""
            continue
        if start > last:
            return
        lead = page[start + 1:start + 2]
        if lead in ("!", "?"):
            at = page.find(">", start) + 1
            yield start, at, None, False, ""
            continue
        name = NAME.match(page, start + 1 + (lead == "/"))
        if not name:
            at = start + 1
            continue
        end, look = -1, name.end()
        while quoted:
            stop = TAG_END.search(page, look)
            if not stop:
                quoted = False
            elif stop[0] == ">":
                end = stop.start()
                break
            else:
                look = page.find(stop[0], stop.end()) + 1
                if not look:
                    quoted = False
        if end < 0:
            end = page.find(">", name.end())
        at, kind = end + 1, name[0].lower()
        if kind == "svg" and page[end - 1] == "/":  # the one silent element that may close itself
            yield start, at, None, True, ""
            continue
        if lead != "/" and kind in CLOSING and kind not in unclosed:
            close = CLOSING[kind].search(page, at)
            if close or kind in TO_THE_END:
                at = close.end() if close else len(page)
                yield start, at, None, True, ""
                continue
            unclosed.add(kind)
        yield start, at, kind, lead == "/", page[name.end():min(end, name.end() + NAMED_WITHIN)]


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page: text with references decoded and white space made single, tag path, share of link text."""
    out, stack, opened, held, linked, path = [], [], {}, [], 0, None

    def close() -> None:
        nonlocal held, linked, path
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                if path is None:
                    kept = stack if len(stack) <= OUTER + INNER else stack[:OUTER] + stack[-INNER:]
                    path = [n for _, names in kept for n in names]
                out.append(Block(text, path, min(1.0, linked / len(text))))
            held, linked = [], 0

    def leave(i: int) -> None:
        for n, _ in stack[i:]:
            opened[n] -= 1
        del stack[i:]

    at = 0
    for start, end, name, closes, inside in tokens_of(page):
        if start > at:
            held.append(page[at:start])
            linked += start - at if opened.get("a") else 0
        at = end
        if name is None:
            if closes:
                close()
            continue
        if name not in INLINE:
            close()
        if closes:
            if opened.get(name):
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                leave(i)
                path = None
        elif name not in VOID:
            if name in CLOSED_BY_SAME and opened.get(name):
                for i in range(len(stack) - 1, max(-1, len(stack) - 1 - LOOK_BACK), -1):
                    if stack[i][0] == name:
                        leave(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            found = NAMES.findall(inside) if inside else ()
            stack.append((name, [name] + ["." + w for groups in found for w in PARTS.findall("".join(groups).lower())]))
            opened[name] = opened.get(name, 0) + 1
            path = None
    if at < len(page):
        held.append(page[at:])
        linked += len(page) - at if opened.get("a") else 0
    close()
    return out


def weak_label(path: list[str]) -> float:
    """1 text, 0 not text, NaN where the page does not say."""
    names = [n.lstrip(".") for n in path]
    # A heading group inside an article is part of it; a page's header is not.
    article = names.index("article") if "article" in names else len(names)
    if any(n in OTHER_PARTS and not (n == "header" and i > article) for i, n in enumerate(names)):
        return 0.0
    return 1.0 if any(n in TEXT_PARTS for n in names) else np.nan


def masked(path: list[str]) -> list[str]:
    """The path with nothing on it that names a part of the page."""
    return [NEUTRAL if n in TEXT_PARTS or n in OTHER_PARTS else n for n in path if n[0] != "."]


class Reader:
    """Turns blocks into hashed numbers; remembers words within a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.last, self.last_path = None, []

    def bucket(self, word: str, size: int) -> int:
        return zlib.crc32(word.encode("utf-8", "replace")) % size

    def path(self, names: list[str]) -> list[int]:
        if names is not self.last:
            self.last, self.last_path = names, [self.bucket(n, PATHS) for n in names]
        return self.last_path

    def words(self, text: str) -> list[int]:
        words = text.split()
        out = list(map(self.known.get, words))
        if None in out:
            if len(self.known) > 200_000:
                self.known.clear()
            for i, found in enumerate(out):
                if found is None:
                    out[i] = self.known[words[i]] = self.bucket(words[i].lower(), WORDS)
        return out

    def arrays(self, pages: list[list[Block]]):
        """Hashed path and word numbers with the block of each, form measures, and the place of every block."""
        path, path_of, word, word_of, form, page_of, step = [], [], [], [], [], [], []
        for p, blocks in enumerate(pages):
            for t, b in enumerate(blocks):
                i = len(form)
                own = self.path(b.path)
                path += own
                path_of += [i] * len(own)
                own = self.words(b.text)
                word += own
                word_of += [i] * len(own)
                stops = b.text.count(".") + b.text.count(",")
                form.append((np.log1p(len(own)) / 4, b.linked, min(1.0, 5 * stops / max(1, len(own))), 1.0 / (1 + t)))
                page_of.append(p)
                step.append(t)
        ints = [np.array(v, np.int64) for v in (path, path_of, word, word_of, page_of, step)]
        return (*ints[:4], np.array(form).reshape(-1, FORM), *ints[4:])


def mean_vectors(table, at, of, n):
    """Mean vector of each block's numbers, and how many there are."""
    count = np.maximum(1, np.bincount(of, minlength=n))
    total = np.zeros((n, table.shape[1]))
    for i in range(0, len(at), GATHER):
        # Numbers come block by block, so the sums of a slice are runs of it.
        own, part = of[i:i + GATHER], at[i:i + GATHER]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        total[own[first]] += np.add.reduceat(table[part], first, axis=0)
    return total / count[:, None], count


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def lstm(x, real, w, u, b, keep=False):
    """One direction over ``x`` (steps, pages, inputs). Padding leaves the state as it is."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    out, memory = np.zeros((steps, pages, HIDDEN), x.dtype), []
    for t in range(steps):
        if t % STEPS == 0:
            driven = x[t:t + STEPS] @ w + b
        z = driven[t % STEPS] + h @ u
        gates = sigmoid(z[:, :3 * HIDDEN])
        i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        before_h, before_c = h, c
        on = real[t][:, None]
        c = np.where(on, f * c + i * g, c)
        squash = np.tanh(c)
        h = np.where(on, o * squash, h)
        out[t] = h
        if keep:
            memory.append((i, f, o, g, before_h, before_c, squash))
    return out, memory


def lstm_back(x, real, w, u, memory, d_out):
    """Gradients of one direction: by inputs, w, u, b."""
    d_w, d_u, d_b, d_x = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN), np.zeros_like(x)
    d_h, d_c = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before_h, before_c, squash = memory[t]
        on = real[t][:, None]
        d_h = d_h + d_out[t]
        inner = np.where(on, d_c + d_h * o * (1 - squash ** 2), 0)
        d_z = np.concatenate([inner * g * i * (1 - i), inner * before_c * f * (1 - f), np.where(on, d_h, 0) * squash * o * (1 - o),
                              inner * i * (1 - g ** 2)], axis=1)
        d_w += x[t].T @ d_z
        d_u += before_h.T @ d_z
        d_b += d_z.sum(axis=0)
        d_x[t] = d_z @ w.T
        d_h = d_z @ u.T + np.where(on, 0, d_h)
        d_c = np.where(on, inner * f, d_c)
    return d_x, d_w, d_u, d_b


def fresh(seed: int = 7) -> dict:
    draw, inputs = np.random.default_rng(seed), 2 * WIDTH + FORM
    model = {"path": np.zeros((PATHS, WIDTH)), "word": np.zeros((WORDS, WIDTH)), "out": draw.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
    for way in ("ahead", "back"):
        model |= {f"w_{way}": draw.normal(0, 0.25, (inputs, 4 * HIDDEN)), f"u_{way}": draw.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)),
                  f"b_{way}": np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]}
    return model


def forward(model, arrays, keep=False):
    """Chance of every block to be text, and what the backward pass needs."""
    path, path_of, word, word_of, form, page, step = arrays
    n = len(form)
    (a, na), (b, nb) = mean_vectors(model["path"], path, path_of, n), mean_vectors(model["word"], word, word_of, n)
    flat = np.concatenate([a, b, form], axis=1)
    x = np.zeros((int(step.max()) + 1, int(page.max()) + 1, flat.shape[1]), np.float64 if keep else np.float32)
    real = np.zeros(x.shape[:2], bool)
    x[step, page], real[step, page] = flat, True
    ahead, m_a = lstm(x, real, *(model[k + "_ahead"] for k in "wub"), keep)
    back, m_b = lstm(x[::-1], real[::-1], *(model[k + "_back"] for k in "wub"), keep)
    states = np.concatenate([ahead[step, page], back[::-1][step, page]], axis=1)
    return sigmoid(states @ model["out"] + model["bias"]), (x, real, m_a, m_b, states, na, nb)


def sample_blocks(page: str) -> list[Block]:
    blocks = blocks_of(page)
    return blocks if len(blocks) <= MOST_BLOCKS else blocks[:MOST_BLOCKS // 2] + blocks[-MOST_BLOCKS // 2:]


def even_weights(cut, truth):
    """Weights of sampled blocks: each label half in all, and within it rare innermost elements count for more."""
    kinds = np.array([zlib.crc32(masked(b.path)[-1].encode()) if b.path else 0 for c in cut for b in c] * 2)
    weight = np.zeros(len(truth))
    for label in (0, 1):
        own = np.flatnonzero(truth == label)
        _, kind, count = np.unique(kinds[own], return_inverse=True, return_counts=True)
        part = 1 / np.sqrt(count[kind])
        weight[own] = 0.5 * part / max(part.sum(), 1e-9)
    return weight


def fit(pages: list[str], rounds: int = 70, rate: float = 0.05, decay: float = 1.0):
    """A model trained on pages, or nothing where no page says what its parts are."""
    cut = [sample_blocks(p) for p in pages]
    cut = [c for c in cut if c and not np.isnan([weak_label(b.path) for b in c]).all()]
    if not cut:
        return None
    truth = np.array([weak_label(b.path) for c in cut for b in c] * 2)
    arrays = Reader().arrays(cut + [[Block(b.text, masked(b.path), b.linked) for b in c] for c in cut])
    path, path_of, word, word_of, _, page, step = arrays
    told = ~np.isnan(truth)
    weight = even_weights(cut, truth)
    model = fresh()
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    for turn in range(1, rounds + 1):
        p, (x, real, m_a, m_b, states, na, nb) = forward(model, arrays, keep=True)
        miss = weight * (p - np.where(told, truth, 0))
        d_states = miss[:, None] * model["out"]
        grads = {"out": states.T @ miss, "bias": np.array([miss.sum()])}
        d_a, d_b = np.zeros(x.shape[:2] + (HIDDEN,)), np.zeros(x.shape[:2] + (HIDDEN,))
        d_a[step, page], d_b[step, page] = d_states[:, :HIDDEN], d_states[:, HIDDEN:]
        d_x, grads["w_ahead"], grads["u_ahead"], grads["b_ahead"] = lstm_back(x, real, model["w_ahead"], model["u_ahead"], m_a, d_a)
        d_y, grads["w_back"], grads["u_back"], grads["b_back"] = lstm_back(x[::-1], real[::-1], model["w_back"], model["u_back"], m_b, d_b[::-1])
        d_flat = (d_x + d_y[::-1])[step, page]
        for key, at, of, count, part in (("path", path, path_of, na, d_flat[:, :WIDTH]), ("word", word, word_of, nb, d_flat[:, WIDTH:2 * WIDTH])):
            spread = (part / count[:, None])[of]
            grads[key] = np.stack([np.bincount(at, spread[:, j], len(model[key])) for j in range(WIDTH)], axis=1)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model[k] = model[k] - rate * (first[k] / (1 - 0.9 ** turn)) / (np.sqrt(second[k] / (1 - 0.999 ** turn)) + 1e-8)
        model["word"] *= 1 - rate * decay  # few pages, many words: what a word says has to recur
    return model


def groups(lengths: list[int]):
    """Numbers of pages to read together: of like length, at most 64, at most ``CELLS`` padded blocks or one page."""
    group = []
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lambda i: lengths[i]):
        if group and (len(group) == 64 or (len(group) + 1) * lengths[i] > CELLS):
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def chances(cut: list[list[Block]], model, reader: Reader):
    """For each page that has blocks: its number, and the chance of each block to be text."""
    for group in groups([len(c) for c in cut]):
        found, at = forward(model, reader.arrays([cut[k] for k in group]))[0] if model else None, 0
        for k in group:
            yield k, np.ones(len(cut[k])) if found is None else found[at:at + len(cut[k])]
            at += len(cut[k])


def extract(pages: list[str], model, reader: Reader) -> list[str]:
    """Main text of each page."""
    cut, out = [blocks_of(p) for p in pages], [""] * len(pages)
    for k, chance in chances(cut, model, reader):
        out[k] = " ".join([b.text for b, c in zip(cut[k], chance) if c >= 0.5])
    return out


def train(pages: DataFrame, column: str = "html"):
    """A model from a bounded sample of pages, chosen by a hash of the page."""
    chosen = pages.where(F.length(column).between(1, LONGEST)).select("page_id", F.xxhash64("page_id", F.length(column)).alias("draw"))
    few = chosen.where("page_id is not null").orderBy("draw", "page_id").limit(PAGES).collect()
    if not few:
        return None
    ids = pages.sparkSession.createDataFrame([(r["page_id"],) for r in few], pages.select("page_id").schema)
    rows = (pages.where(F.length(column).between(1, LONGEST)).join(F.broadcast(ids), "page_id").select(column)
            .orderBy(F.xxhash64("page_id"), column).limit(PAGES).collect())
    return fit([r[0] for r in rows])


def main_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``, from the whole html.

    NULL and empty pages, and pages without text, have the text ''. Where no page names its parts, all blocks are text.
    Ids may be NULL or repeated; an empty table gives no rows; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, column))  # of fixed size

    def work(texts, reader):
        found = extract(texts, shared.value, reader)
        return {"text": pa.array(found, pa.string()), "n_chars": pa.array([len(t) for t in found], pa.int64())}

    return map_texts(pages, ["page_id", "url"], column, work, "text string, n_chars long", Reader)
