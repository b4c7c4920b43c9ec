"""Main-text extraction from HTML by a recurrent block labeller.

A page is read into its leaf blocks, in order: the text between block-level
tags, with the path of elements above it.  Each block is a vector of hashed path
elements (tags, words of class and id), hashed words and a few measures.  A
bidirectional LSTM (numpy) reads the whole sequence in both directions and
labels every block as main text or not, so the context of the whole document
decides.

Training: at most ``TRAIN_PAGES`` pages (of smallest id hash, up to
``TRAIN_BYTES`` each) in which an article or main element says what is main
text, and ``VARIANTS`` re-arrangements of each with other containers, menus,
side bars, notices, adverts, forms and reader comments.  Extraction reads every
whole page.

Text rules: character references are decoded; white space inside a block
(``[\\x20\\x09-\\x0D]+``) becomes one space, the block is trimmed, empty blocks
go, and blocks are joined by one line feed.  Scripts, styles, comments, titles
and the like are no blocks; markup that a page breaks off in is dropped.  A tag of
any length ends at the first ``>`` outside its attributes' quotes; a quote that
is never closed does not count.

Defined cases: a null or empty page has the text ''; a page of plain text is one
block; unclosed and stray tags are allowed: an element whose content is no text of
the page costs none without its closer (but a script or style takes the rest, as in
a browser); very long pages are read whole; ties do not arise, each block being
labelled by its score; rows that repeat are extracted alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import hash_sample, map_texts, small_batches, span_hashes, words_of

TRAIN_PAGES = 200
TRAIN_BYTES = 100_000
VARIANTS = 6
PATH_BUCKETS, LEAF_BUCKETS, WORD_BUCKETS, MEASURES = 96, 24, 24, 8
N_FEATURES = PATH_BUCKETS + LEAF_BUCKETS + WORD_BUCKETS + MEASURES
HIDDEN = 20
CELLS = 20_000  # blocks (with padding) labelled at once

SPACE = re.compile(r"[\x20\x09-\x0D]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements whose content is no text of the page; those that can hold their like end at the matching closer.
SKIPPED = frozenset("script style noscript template textarea title svg math iframe object select head".split())
NESTED = frozenset("template svg math object select".split())
RAW = frozenset("script style textarea title".split())  # without a closer they run to the end of the page
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# A tag that closes an open one of the same group, up to the nearest container.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("ul ol dl table body div section article".split())
# A quote opens a value only after "="; it ends at its mate, however far, or counts as a plain character where it has none
# or where the mate opens a value of a later tag (so that its own was left out).  Possessive: a tag is read once.
TAG = re.compile(
    r"""</?([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:"[^">]*+"|'[^'>]*+'"""
    r"""|"(?![^"]*<[a-zA-Z][^"<>]*[\w-]\s*=\s*")[^"]*+"|'(?![^']*<[a-zA-Z][^'<>]*[\w-]\s*=\s*')[^']*+')?+)*+)(>?)"""
)
# class, id and role; the values of other attributes are passed over.
ATTRIBUTE = re.compile(
    r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|=\s*(?:\"[^\"]*\"|'[^']*')", re.IGNORECASE
)
WORD_PARTS = re.compile(r"[a-z]+")


def _element(tag: str, attributes: str) -> str:
    """An element of a path: the tag and the words of its class, id and role."""
    words = []
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        words += WORD_PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", a or b or c).lower())
    return " ".join([tag, *dict.fromkeys(words)])


def closers(page: str, tag: str) -> dict[int, int]:
    """{end of an opening tag: end of the closing tag that matches it} of all such elements of a page, in one pass."""
    found, opened = {}, []
    for m in re.finditer(rf"<(/?){tag}(?![^\s/>])", page, re.IGNORECASE):
        whole = TAG.match(page, m.start())
        if not whole or not whole[3]:
            break  # the page ends inside a tag
        if not m[1]:
            if not whole[2].endswith("/"):
                opened.append(whole.end())
        elif opened:
            if tag in NESTED:
                found[opened.pop()] = whole.end()
            else:
                found |= dict.fromkeys(opened, whole.end())
                opened.clear()
    return found


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) of every leaf block of a page, in order."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str]] = []
    pieces: list[str] = []
    linked, at, end = 0, 0, len(page)
    closed: dict[str, dict[int, int]] = {}

    def flush():
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip(" ")
            if text:
                out.append((tuple(e for t, e in stack if t not in INLINE), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop_to(names, until=frozenset()):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    while at < end:
        opening = page.find("<", at)
        if opening < 0:
            opening = end
        if opening > at:
            piece = page[at:opening]
            pieces.append(piece)
            if any(t == "a" for t, _ in stack):
                linked += len(piece.strip())
        if opening == end:
            break
        following = page[opening + 1 : opening + 2]
        if following == "!":
            if page.startswith("<!--", opening):
                close = page.find("-->", opening + 4)
                at = end if close < 0 else close + 3
            else:
                close = page.find(">", opening)
                at = end if close < 0 else close + 1
            continue
        if following == "?":
            close = page.find(">", opening)
            at = end if close < 0 else close + 1
            continue
        if not (following.isalpha() or (following == "/" and page[opening + 2 : opening + 3].isalpha())) or not following.isascii():
            pieces.append("<")  # a less-than sign
            at = opening + 1
            continue
        found = TAG.match(page, opening)
        if not found[3]:
            break  # the page ends inside a tag
        tag, attributes, at = found[1].lower(), found[2], found.end()
        if following == "/":
            if tag not in INLINE:
                flush()
                pop_to((tag,))
            else:
                pop_to((tag,), CLOSES_P)
            continue
        if tag in SKIPPED:
            if tag not in INLINE:
                flush()
            if attributes.endswith("/") and tag in ("svg", "math"):
                continue
            if tag not in closed:
                closed[tag] = closers(page, tag)
            close = closed[tag].get(at)
            if close is not None:
                at = close
            elif tag in RAW:
                # a closer that the pass over tags did not match (an opener within quotes) still ends the element
                late = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
                if late is None:
                    break
                at = late.end()
            # without a closer the others are passed over alone: what follows is the page's
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P:
                pop_to(("p",), frozenset(("button", "td", "th")))
            if tag in SIBLINGS:
                pop_to(SIBLINGS[tag], CONTAINERS if tag != "tr" else frozenset(("table",)))
        if tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, _element(tag, attributes)))
    flush()
    return out


_path_vectors: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed bag of a path's tags and words, nearer ones heavier, and its last tag by itself."""
    found = _path_vectors.get(path)
    if found is None:
        found = np.zeros(PATH_BUCKETS + LEAF_BUCKETS, np.float32)
        for depth, element in enumerate(reversed(path)):
            for k, word in enumerate(element.split(" ")):
                code = zlib.crc32(f"{'w' if k else 't'}:{word}".encode())
                found[code % PATH_BUCKETS] += (1 if code >> 20 & 1 else -1) * max(0.4, 1.0 - 0.1 * depth)
        leaf = path[-1].split(" ")[0] if path else ""
        found[PATH_BUCKETS + zlib.crc32(leaf.encode()) % LEAF_BUCKETS] = 1
        if len(_path_vectors) > 20_000:
            _path_vectors.clear()
        _path_vectors[path] = found
    return found


def features(pages: list[list[tuple[tuple[str, ...], str, int]]]) -> np.ndarray:
    """One row for each block of the pages, in order."""
    every = [b for page in pages for b in page]
    out = np.zeros((len(every), N_FEATURES), np.float32)
    if not every:
        return out
    out[:, : PATH_BUCKETS + LEAF_BUCKETS] = np.stack([_path_vector(path) for path, _, _ in every])
    w = words_of(pa.array([text.encode() for _, text, _ in every], pa.binary()))
    hashes = span_hashes(w.data, w.start, w.end, fold=True)
    cell = w.doc_of_word() * WORD_BUCKETS + (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    counts = np.bincount(cell, minlength=len(every) * WORD_BUCKETS).reshape(len(every), WORD_BUCKETS)
    n = np.maximum(w.per_doc, 1)
    at = PATH_BUCKETS + LEAF_BUCKETS
    out[:, at : at + WORD_BUCKETS] = counts / np.sqrt(n)[:, None] * 0.5
    size = np.array([len(text) for _, text, _ in every])
    at += WORD_BUCKETS
    out[:, at] = np.log1p(size) / 6
    out[:, at + 1] = np.log1p(n) / 5
    out[:, at + 2] = np.array([link for _, _, link in every]) / size
    out[:, at + 3] = [text[-1] in ".!?\"”»" for _, text, _ in every]
    out[:, at + 4] = [any(c in text for c in "©|»›") for _, text, _ in every]
    place = np.concatenate([(np.arange(len(p)) + 0.5) / len(p) for p in pages if p])
    out[:, at + 5] = place
    out[:, at + 6] = [len(path) / 10 for path, _, _ in every]
    out[:, at + 7] = size < 25
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """A forward and a backward LSTM over block vectors, and a logistic label for each block."""

    def __init__(self, n: int = N_FEATURES, hidden: int = HIDDEN, seed: int = 3):
        rnd = np.random.default_rng(seed)
        self.hidden, self.w = hidden, {}
        for d in "fb":
            self.w[d + "x"] = rnd.normal(0, n**-0.5, (n, 4 * hidden))
            self.w[d + "h"] = rnd.normal(0, hidden**-0.5, (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1.0  # forget gates start open
            self.w[d + "b"] = bias
        self.w["o"], self.w["c"] = rnd.normal(0, 0.1, 2 * hidden), np.zeros(1)

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, order) -> tuple[np.ndarray, list]:
        steps, batch, _ = x.shape
        n = self.hidden
        h, c = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype)
        out, kept = np.zeros((steps, batch, n), x.dtype), [None] * steps
        inputs = x @ self.w[d + "x"].astype(x.dtype) + self.w[d + "b"].astype(x.dtype)
        recurrent = self.w[d + "h"].astype(x.dtype)
        for t in order:
            z = inputs[t] + h @ recurrent
            gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            m = mask[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            kept[t] = (h, c, i, f, o, g, th)
            c = m * new + (1 - m) * c
            h = m * (o * th) + (1 - m) * h
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        steps = len(x)
        one, kept_one = self._pass("f", x, mask, range(steps))
        two, kept_two = self._pass("b", x, mask, range(steps - 1, -1, -1))
        both = np.concatenate((one, two), axis=2)
        return _sigmoid(both @ self.w["o"].astype(x.dtype) + self.w["c"][0]), both, kept_one, kept_two

    def _back(self, d: str, x, mask, order, kept, d_out, grads) -> None:
        n = self.hidden
        d_h, d_c = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
        d_z_all = np.zeros((len(x), x.shape[1], 4 * n))
        for t in order:
            h0, c0, i, f, o, g, th = kept[t]
            m = mask[t][:, None]
            d_h = d_h + d_out[t]
            d_new = m * (d_c + d_h * o * (1 - th**2))
            d_z = np.concatenate((d_new * g * i * (1 - i), d_new * c0 * f * (1 - f), m * d_h * th * o * (1 - o), d_new * i * (1 - g**2)), 1)
            d_z_all[t] = d_z
            grads[d + "h"] += h0.T @ d_z
            d_c = d_new * f + (1 - m) * d_c
            d_h = d_z @ self.w[d + "h"].T + (1 - m) * d_h
        flat = d_z_all.reshape(-1, 4 * n)
        grads[d + "x"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[d + "b"] += flat.sum(0)

    def gradients(self, x, mask, y) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the blocks."""
        score, both, kept_one, kept_two = self.forward(x, mask)
        d_score = (score - y) * mask / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["o"] = (both * d_score[:, :, None]).sum((0, 1))
        grads["c"] = np.array([d_score.sum()])
        d_both = d_score[:, :, None] * self.w["o"]
        n, steps = self.hidden, len(x)
        self._back("f", x, mask, range(steps - 1, -1, -1), kept_one, d_both[:, :, :n], grads)
        self._back("b", x, mask, range(steps), kept_two, d_both[:, :, n:], grads)
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 8, batch: int = 32, seed: int = 5) -> BiLstm:
        rnd = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(epochs):
            order = rnd.permutation(len(pages))
            order = order[np.argsort([len(pages[i]) // 8 for i in order], kind="stable")]
            groups = [order[i : i + batch] for i in range(0, len(order), batch)]
            for g in rnd.permutation(len(groups)):
                x, mask = padded([pages[i] for i in groups[g]])
                y = np.zeros(mask.shape)
                for k, i in enumerate(groups[g]):
                    y[: len(labels[i]), k] = labels[i]
                step += 1
                for k, grad in self.gradients(x.astype(np.float64), mask, y).items():
                    grad = np.clip(grad, -1, 1) + 1e-5 * self.w[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    rate = 0.012 * (1 - 0.8 * epoch / epochs)
                    self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of similar length go through together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and len(pages[order[stop]]) * (stop + 1 - at) <= CELLS:
                stop += 1
            some = [i for i in order[at:stop] if len(pages[i])]
            at = stop
            if some:
                x, mask = padded([pages[i] for i in some])
                score = self.forward(x, mask.astype(np.float32))[0]
                for k, i in enumerate(some):
                    out[i] = score[: len(pages[i]), k] >= 0.5
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, features) and the mask of what is there."""
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)))
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# What the training pages are re-arranged with: paths of containers and of page furniture, from common markup.
MAIN_PATHS = [
    "article", "main|article", "main", "div content", "div main content", "div post|div entry content", "section story",
    "div article body", "div page|div text", "article post|div body", "div wrapper|article", "div container|main|div article content",
    "table|tr|td content", "div", "section", "div story body",
]
FURNITURE = {
    "top": [
        "nav|ul|li", "header|nav|ul|li", "div menu|ul|li", "ul navbar|li", "div nav|a", "header|div", "div header|p", "header|p",
        "div masthead", "div top bar", "header|h2", "div breadcrumb", "nav", "div skip link", "div search|form|label", "form search|p",
    ],
    "notice": [
        "div cookie notice|p", "div notice", "div notice|p", "div banner", "div alert|p", "div gdpr consent|p", "section notice|p",
        "div newsletter|p", "div subscribe|form|p", "div popup modal|p", "aside notice|p", "p notice", "p cookie banner", "div paywall|p",
    ],
    "ad": [
        "div ad", "div ads", "div advert", "div advertisement|p", "aside promo|p", "div sponsored|p", "div promo", "section ad|p",
        "p ad", "div banner ad|p", "div ad slot|div", "figure ad|figcaption",
    ],
    "side": [
        "aside|p", "aside|ul|li", "div sidebar|ul|li", "div sidebar|p", "aside sidebar|h3", "aside related|h3", "div related|ul|li",
        "div widget|p", "section related|ul|li", "div popular|ol|li", "div share|a", "div social|ul|li", "div author bio|p", "div tags|a",
    ],
    "form": ["form|p", "form|label", "form|div", "form|button", "form|fieldset|legend", "form login|label", "form contact|p"],
    "comments": [
        "section comments|h3", "section comments|div comment|p", "div comments|ul|li|p", "ol commentlist|li|p", "div comment|p",
        "div disqus|p", "section comments|article comment|p", "div responses|div reply|p", "ul comments|li", "div user comments|blockquote|p",
        "section id comments|p", "article comment|p", "aside comments|p",
    ],
    "bottom": [
        "footer", "footer|p", "div footer|p", "footer|ul|li", "div footer|ul|li", "footer|div", "div copyright", "div site footer|p",
        "footer|nav|a", "div legal|p",
    ],
}
PHRASES = [
    "Home", "About us", "Contact", "Accept all cookies", "We use cookies on this site.", "Subscribe to our newsletter", "Advertisement",
    "Sponsored", "Leave a reply", "3 comments", "Share this", "Log in", "Search", "Related stories", "Most read", "Read more", "Next",
    "All rights reserved.", "© 2024 Example", "Privacy policy", "Terms of use", "Your e-mail address", "Submit", "Thanks for this article!",
]
CONTENT_TAGS = ["p"] * 12 + ["h2", "h3", "ul|li", "blockquote|p", "ol|li", "pre", "table|tr|td", "figure|figcaption", "div", "section|p"]
BOILERPLATE_TAGS = frozenset("nav aside footer form header".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement comment comments cookie cookies disqus footer menu nav navbar newsletter notice promo related "
    "share sidebar social sponsored subscribe widget".split()
)


def rule_labels(page) -> np.ndarray | None:
    """Labels of a page that marks its main text itself; None if it does not."""
    out, marked = [], False
    for path, _, _ in page:
        tags = {e.split(" ")[0] for e in path}
        words = {w for e in path for w in e.split(" ")[1:]}
        inside = bool(tags & {"article", "main"})
        marked |= inside
        out.append(inside and not tags & BOILERPLATE_TAGS and not words & BOILERPLATE_WORDS)
    return np.array(out, float) if marked else None


def variant(texts: list[str], headline: str, others: list[str], rnd: np.random.Generator):
    """A page made of the given main texts in another arrangement, with its labels."""
    page, labels = [], []
    root = ("html", "body")

    def path(spec: str) -> tuple[str, ...]:
        return tuple(spec.split("|"))

    def furniture(kind: str, inside: tuple[str, ...] = root, most: int = 4):
        spec = path(rnd.choice(FURNITURE[kind]))
        link = kind in ("top", "side", "bottom") and rnd.random() < 0.6
        for _ in range(rnd.integers(1, most + 1)):
            text = str(rnd.choice(PHRASES)) if rnd.random() < 0.35 else others[rnd.integers(len(others))]
            if kind in ("top", "form") or rnd.random() < 0.3:
                text = " ".join(text.split()[: rnd.integers(1, 5)]) or text
            page.append(((*inside, *spec), text, len(text) if link else 0))
            labels.append(0.0)

    main = (*root, *path(str(rnd.choice(MAIN_PATHS))))
    for kind, chance in (("top", 0.85), ("notice", 0.35), ("top", 0.4), ("ad", 0.4), ("side", 0.25), ("form", 0.2)):
        if rnd.random() < chance:
            furniture(kind, most=6 if kind == "top" else 3)
    if rnd.random() < 0.8:
        head = main if rnd.random() < 0.8 else (*main, "header")
        page.append(((*head, str(rnd.choice(["h1", "h1", "h1", "h2"]))), headline, 0))
        labels.append(1.0)
    for k, text in enumerate(texts):
        if k and rnd.random() < 0.15:
            kind = str(rnd.choice(["ad", "side", "notice", "form"]))
            furniture(kind, inside=main, most=2)
        page.append(((*main, *path(str(rnd.choice(CONTENT_TAGS)))), text, 0))
        labels.append(1.0)
    for kind, chance in (("side", 0.2), ("comments", 0.25)):
        if rnd.random() < chance:
            furniture(kind, inside=main)
    for kind, chance in (("comments", 0.4), ("side", 0.4), ("ad", 0.3), ("form", 0.3), ("notice", 0.2), ("bottom", 0.7)):
        if rnd.random() < chance:
            furniture(kind, most=5)
    return page, np.array(labels)


def train(pages: list[str], variants: int = VARIANTS, seed: int = 9) -> BiLstm:
    """A labeller learned from pages (HTML) that mark their main text and from their re-arrangements."""
    rnd = np.random.default_rng(seed)
    parsed = [blocks(p) for p in pages]
    marked = [(p, y) for p in parsed if p for y in [rule_labels(p)] if y is not None and y.any()]
    # stand-ins where there are few such pages: invented words in sentences
    while len(marked) < 40:
        made = [" ".join("".join(rnd.choice(list("aeiolnrstdm"), rnd.integers(2, 9))) for _ in range(rnd.integers(5, 60))).capitalize() + "." for _ in range(rnd.integers(1, 9))]
        body = "".join(f"<p>{t}</p>" for t in made)
        page = blocks(f"<body><nav><ul><li><a>Home</a></li></ul></nav><article><h1>{made[0][:40]}</h1>{body}</article><footer>{made[-1][:50]}</footer>")
        marked.append((page, rule_labels(page)))
    sentences = [text for page, y in marked for (_, text, _) in page]
    made_pages, made_labels = [p for p, _ in marked], [y for _, y in marked]
    for page, y in marked:
        texts = [text for (_, text, _), label in zip(page, y) if label]
        others = [" ".join(s.split()[: rnd.integers(3, 40)]) for s in (sentences[i] for i in rnd.integers(len(sentences), size=12))]
        for _ in range(variants):
            few = texts[: rnd.integers(1, len(texts) + 1)]
            new, label = variant(few[:40], few[0][:70], others, rnd)
            made_pages.append(new)
            made_labels.append(label)
    vectors = features(made_pages)
    cuts = np.cumsum([len(p) for p in made_pages])[:-1]
    return BiLstm().fit(np.split(vectors, cuts), made_labels)


def main_text(page: str, model: BiLstm) -> str:
    return _extract([page], model)[0]


def _extract(pages: list[str], model: BiLstm) -> list[str]:
    parsed = [blocks(p) for p in pages]
    vectors = np.split(features(parsed), np.cumsum([len(p) for p in parsed])[:-1])
    return [
        "\n".join(text for (_, text, _), keep in zip(page, labels) if keep)
        for page, labels in zip(parsed, model.label(vectors))
    ]


def extract(pages: DataFrame, model: BiLstm | None = None, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page; the labeller is learned from ``pages`` if none is given."""
    small_batches(pages.sparkSession)
    if model is None:
        usable = pages.filter((F.octet_length("html") <= TRAIN_BYTES) & F.col("page_id").isNotNull()).select("page_id", "html")
        ids = hash_sample(usable.select("page_id").distinct(), "page_id", train_pages).withColumnRenamed("page_id", "__page")
        sample = usable.join(F.broadcast(ids), F.col("page_id") == F.col("__page")).groupBy("page_id").agg(F.min("html").alias("html"))
        # bounded: train_pages rows of TRAIN_BYTES at most
        model = train([r["html"] for r in sorted(sample.collect(), key=lambda r: r["page_id"])])

    def read(texts):
        found = _extract([(t or b"").decode("utf-8", "replace") for t in texts.to_pylist()], model)
        return {"text": pa.array(found, pa.string()), "n_chars": np.array([len(t) for t in found], np.int64)}

    typed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_texts(typed, read, "page_id long, url string, text string, n_chars long", ["page_id", "url"], text="html")
