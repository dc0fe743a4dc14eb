"""Main text of web pages: a recurrent labeller over the blocks of a page.

A page is cut into leaf blocks: the text between tags that begin or end a block. Each block becomes a vector of its
tag path (tags, classes, ids and roles of its ancestors, hashed), its words (hashed) and a few numbers. A bidirectional
LSTM in NumPy reads the blocks of the whole page and labels each one as main text or not.

It is trained on pages that are drawn from a bounded sample: their article is placed in one of many layouts, and menus,
notices, adverts, forms, sidebars, comments and the like are put around and into it, so that the labels are known.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.textbytes import map_texts

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    # A tag whose quotes do not close ends at the next >.
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME = re.compile(r"[a-z]+|[0-9]+")
# Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object textarea select title head".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
# An open element of the key ends where one of its values begins.
CLOSES = {
    "p": frozenset(
        "p div article section nav header footer aside main ul ol dl table form h1 h2 h3 h4 h5 h6 pre blockquote hr "
        "fieldset figure address details".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}


CLOSED_BY = {tag: tuple(k for k, tags in CLOSES.items() if tag in tags) for tag in frozenset().union(*CLOSES.values())}
PATH_TOKENS = 48  # of the nearest ancestors that a block's path keeps


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int = 0  # characters inside links


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; white space is one space, and blocks without text are left out.

    Linear in the page, however deep it is: a block looks at its nearest ancestors, and open elements are counted.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, skipping, at, n = 0, 0, 0, len(page)

    def path() -> tuple[str, ...]:
        kept: list[tuple[str, ...]] = []
        size = 0
        for _, tokens in reversed(stack):
            kept.append(tokens)
            size += len(tokens)
            if size >= PATH_TOKENS:
                break
        return tuple(t for tokens in reversed(kept) for t in tokens)

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(path(), text, linked))
            parts.clear()
        linked = 0

    def pop(to: int):
        nonlocal skipping
        while len(stack) > to:
            tag = stack.pop()[0]
            opened[tag] -= 1
            skipping -= tag in SKIPPED

    while at < n:
        found = MARKUP.search(page, at)
        upto = found.start() if found else n
        if upto > at and not skipping:
            text = html.unescape(page[at:upto])
            parts.append(text)
            if opened["a"]:
                linked += len(text)
        if not found:
            break
        at = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        tag = (tag or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        elif tag == "br" and not skipping:
            parts.append(" ")
        if closing:
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        if tag in VOID or rest.endswith("/") and tag in ("svg", "math"):
            continue
        for i in range(len(stack) - 1, -1, -1) if any(opened[k] for k in CLOSED_BY.get(tag, ())) else ():
            open_tag = stack[i][0]
            if tag in CLOSES.get(open_tag, ()):
                pop(i)
                break
            if open_tag not in INLINE and open_tag not in CLOSES:
                break
        tokens = [tag]
        for name, value in ATTRIBUTE.findall(rest) if rest else ():
            words = NAME.findall(value.lower())
            tokens += [f".{w}" for w in words] or [f"@{name.lower()}"]
        stack.append((tag, tuple(tokens)))
        opened[tag] += 1
        skipping += tag in SKIPPED
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else n
    flush()
    return out


@dataclass(frozen=True)
class Labeller:
    """sample_pages: bound on the pages that the model is trained on, those whose ids hash lowest."""

    sample_pages: int = 250
    variants: int = 4
    path_slots: int = 4096
    word_slots: int = 1024
    width: int = 16
    hidden: int = 20
    epochs: int = 6
    batch: int = 32
    rate: float = 0.01
    seed: int = 5


NUMBERS = 6


@dataclass
class Page:
    """Blocks as arrays: token slots with the block of each, and numbers."""

    paths: tuple[np.ndarray, np.ndarray]
    words: tuple[np.ndarray, np.ndarray]
    numbers: np.ndarray
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _slots(found: list[list[str]], slots: int, memory: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    out, owner = [], []
    for i, tokens in enumerate(found):
        for t in tokens:
            slot = memory.get(t)
            if slot is None:
                if len(memory) > 200_000:
                    memory.clear()
                slot = memory[t] = zlib.crc32(t.encode("utf-8", "replace"))
            out.append(slot)
        owner += [i] * len(tokens)
    return np.array(out, np.int64) % slots, np.array(owner, np.int64)


_path_memory: dict[str, int] = {}
_word_memory: dict[str, int] = {}


def featured(found: list[Block], sizes: Labeller, labels: np.ndarray | None = None) -> Page:
    n = len(found)
    words = [b.text.split() for b in found]
    count = np.array([len(w) for w in words], float)
    chars = np.array([len(b.text) for b in found], float)
    ends = np.array([b.text[-1] in ".!?:;…\"'" for b in found], float)
    depth = np.array([len(b.path) for b in found], float)
    share = np.array([b.linked for b in found], float) / np.maximum(chars, 1)
    numbers = np.stack(
        [np.log1p(count) / 4, np.minimum(share, 1), ends, np.arange(n) / max(n, 1), depth / 10, np.ones(n)], axis=1
    )
    return Page(
        _slots([sorted(set(b.path)) for b in found], sizes.path_slots, _path_memory),
        _slots(words, sizes.word_slots, _word_memory),
        numbers,
        np.zeros(n) if labels is None else labels,
    )


class Network:
    """Embeddings, an LSTM in either direction, and a logistic output for each block."""

    def __init__(self, sizes: Labeller, state: dict[str, np.ndarray] | None = None):
        self.sizes = sizes
        if state is None:
            rng = np.random.default_rng(sizes.seed)
            w, h, d = sizes.width, sizes.hidden, 2 * sizes.width + NUMBERS
            state = {
                "path": rng.normal(0, 0.3, (sizes.path_slots, w)),
                "word": rng.normal(0, 0.1, (sizes.word_slots, w)),
                "out": rng.normal(0, 0.2, 2 * h + d),
                "bias": np.zeros(1),
            }
            for side in ("f", "b"):
                state[f"x{side}"] = rng.normal(0, d**-0.5, (d, 4 * h))
                state[f"h{side}"] = rng.normal(0, h**-0.5, (h, 4 * h))
                state[f"c{side}"] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
        self.state = state

    def _inputs(self, pages: list[Page]):
        """[T, B, D] inputs, and where each block stands."""
        lengths = np.array([len(p.numbers) for p in pages])
        base = np.r_[0, np.cumsum(lengths)]
        n, w = int(base[-1]), self.sizes.width
        paths = np.concatenate([p.paths[0] for p in pages]), np.concatenate([p.paths[1] + o for p, o in zip(pages, base, strict=False)])
        words = np.concatenate([p.words[0] for p in pages]), np.concatenate([p.words[1] + o for p, o in zip(pages, base, strict=False)])
        scale = 1 / np.maximum(np.bincount(words[1], minlength=n), 1)
        flat = np.zeros((n, 2 * w + NUMBERS))
        for first, (slot, owner), table in ((0, paths, self.state["path"]), (w, words, self.state["word"])):
            if len(slot):
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                flat[owner[starts], first : first + w] = np.add.reduceat(table[slot], starts, axis=0)
        flat[:, w : 2 * w] *= scale[:, None]
        flat[:, 2 * w :] = np.concatenate([p.numbers for p in pages])
        page = np.repeat(np.arange(len(pages)), lengths)
        step = np.arange(n) - base[page]
        return flat, page, step, lengths, paths, words, scale

    def _run(self, x: np.ndarray, side: str):
        h = self.sizes.hidden
        steps, batch, _ = x.shape
        a = x @ self.state[f"x{side}"] + self.state[f"c{side}"]
        hs, cs, gates = np.zeros((steps + 1, batch, h)), np.zeros((steps + 1, batch, h)), np.empty((steps, batch, 4 * h))
        for t in range(steps):
            z = a[t] + hs[t] @ self.state[f"h{side}"]
            z[:, : 3 * h] = 1 / (1 + np.exp(-np.clip(z[:, : 3 * h], -40, 40)))
            z[:, 3 * h :] = np.tanh(z[:, 3 * h :])
            cs[t + 1] = z[:, h : 2 * h] * cs[t] + z[:, :h] * z[:, 3 * h :]
            hs[t + 1] = z[:, 2 * h : 3 * h] * np.tanh(cs[t + 1])
            gates[t] = z
        return hs, cs, gates

    def forward(self, pages: list[Page]):
        flat, page, step, lengths, paths, words, scale = self._inputs(pages)
        steps = int(lengths.max())
        back = lengths[page] - 1 - step
        x = {side: np.zeros((steps, len(pages), flat.shape[1])) for side in "fb"}
        at = {"f": step, "b": back}
        outs, runs = [], {}
        for side in "fb":
            x[side][at[side], page] = flat
            runs[side] = self._run(x[side], side)
            outs.append(runs[side][0][at[side] + 1, page])
        joint = np.concatenate([*outs, flat], axis=1)
        logits = joint @ self.state["out"] + self.state["bias"][0]
        chance = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        return chance, (flat, page, at, x, runs, joint, paths, words, scale)

    def gradients(self, pages: list[Page]) -> tuple[float, dict[str, np.ndarray]]:
        chance, (flat, page, at, x, runs, joint, paths, words, scale) = self.forward(pages)
        label = np.concatenate([p.labels for p in pages])
        n, h, w = len(label), self.sizes.hidden, self.sizes.width
        loss = -np.mean(label * np.log(chance + 1e-9) + (1 - label) * np.log(1 - chance + 1e-9))
        d = (chance - label) / n
        grads = {"out": joint.T @ d, "bias": np.array([d.sum()])}
        d_joint = d[:, None] * self.state["out"]
        d_flat = d_joint[:, 2 * h :].copy()
        for k, side in enumerate("fb"):
            hs, cs, gates = runs[side]
            steps, batch = gates.shape[:2]
            d_out = np.zeros((steps, batch, h))
            d_out[at[side], page] = d_joint[:, k * h : (k + 1) * h]
            d_z = np.empty_like(gates)
            d_h, d_c = np.zeros((batch, h)), np.zeros((batch, h))
            for t in range(steps - 1, -1, -1):
                i, f, o, g = (gates[t][:, q * h : (q + 1) * h] for q in range(4))
                d_h = d_h + d_out[t]
                tc = np.tanh(cs[t + 1])
                d_c = d_c + d_h * o * (1 - tc**2)
                d_z[t] = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * cs[t] * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - g**2)], axis=1
                )
                d_h = d_z[t] @ self.state[f"h{side}"].T
                d_c = d_c * f
            rows = d_z.reshape(-1, 4 * h)
            grads[f"x{side}"] = x[side].reshape(-1, x[side].shape[2]).T @ rows
            grads[f"h{side}"] = hs[:-1].reshape(-1, h).T @ rows
            grads[f"c{side}"] = rows.sum(axis=0)
            d_flat += (d_z @ self.state[f"x{side}"].T)[at[side], page]
        for name, first, (slot, owner), size in (
            ("path", 0, paths, self.sizes.path_slots), ("word", w, words, self.sizes.word_slots),
        ):
            part = d_flat[:, first : first + w] * (scale[:, None] if name == "word" else 1)
            grads[name] = np.zeros((size, w))
            np.add.at(grads[name], slot, part[owner])
        return float(loss), grads

    def train(self, pages: list[Page]) -> None:
        rng = np.random.default_rng(self.sizes.seed + 1)
        mean = {k: np.zeros_like(v) for k, v in self.state.items()}
        square = {k: np.zeros_like(v) for k, v in self.state.items()}
        step, total = 0, self.sizes.epochs * -(-len(pages) // self.sizes.batch)
        for _ in range(self.sizes.epochs):
            order = rng.permutation(len(pages))
            for first in range(0, len(order), self.sizes.batch):
                _, grads = self.gradients([pages[i] for i in order[first : first + self.sizes.batch]])
                step += 1
                rate = self.sizes.rate * (1 - 0.9 * step / total)
                for k, g in grads.items():
                    if k in ("word", "path"):
                        g = g + 1e-5 * self.state[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.state[k] = self.state[k] - rate * (mean[k] / (1 - 0.9**step)) / (
                        np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
                    )

    def label(self, pages: list[Page]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p.numbers)), key=lambda i: len(pages[i].numbers))
        while order:
            size = max(1, min(256, 20_000 // len(pages[order[min(255, len(order) - 1)]].numbers)))
            group, order = order[:size], order[size:]
            chance, rest = self.forward([pages[i] for i in group])
            for j, i in enumerate(group):
                out[i] = chance[rest[1] == j] >= 0.5
        return out


# What surrounds an article: element, attributes. Names that pages commonly give to such parts.
AROUND = [
    ("nav", ""), ("nav", 'class="menu"'), ("div", 'class="navbar"'), ("ul", 'class="menu"'), ("ul", 'class="breadcrumbs"'),
    ("header", ""), ("header", 'class="site-header"'), ("div", 'id="header"'), ("div", 'class="top-bar"'),
    ("footer", ""), ("footer", 'class="site-footer"'), ("div", 'id="footer"'), ("div", 'class="copyright"'),
    ("aside", ""), ("aside", 'class="sidebar"'), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="widget"'),
    ("div", 'class="cookie-notice"'), ("div", 'class="cookie-banner"'), ("div", 'id="cookies"'), ("div", 'class="notice"'),
    ("div", 'class="consent"'), ("div", 'class="alert"'), ("section", 'class="banner"'), ("div", 'role="alert"'),
    ("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'), ("div", 'class="advertisement"'),
    ("aside", 'class="ad"'), ("div", 'class="sponsored"'), ("div", 'class="promo"'), ("ins", 'class="adsbygoogle"'),
    ("form", ""), ("form", 'class="search"'), ("form", 'class="newsletter"'), ("div", 'class="subscribe"'), ("div", 'class="login"'),
    ("div", 'class="comments"'), ("section", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="comment-list"'),
    ("section", 'class="comments"'), ("div", 'class="reader-comments"'), ("div", 'class="reply"'), ("section", 'class="responses"'),
    ("div", 'class="related"'), ("section", 'class="related-posts"'), ("div", 'class="recommended"'), ("div", 'class="share"'),
    ("div", 'class="social"'), ("div", 'class="popup"'), ("div", 'class="modal"'), ("div", 'role="navigation"'), ("div", 'class="pagination"'),
    ("div", 'role="complementary"'), ("div", 'role="contentinfo"'), ("div", 'class="tags"'), ("div", 'class="disclaimer"'),
]
LAYOUTS = [
    ("article", ""), ("article", ""), ("article", 'class="post"'), ("main", ""), ("div", 'class="article"'), ("div", 'class="content"'),
    ("div", 'id="content"'), ("div", 'class="post-body"'), ("div", 'class="entry-content"'), ("section", 'class="article-body"'),
    ("div", 'role="main"'),
]
INSIDE = ["p", "p", "p", "p", "p", "h2", "blockquote", "li", "pre", "td", "div", "h3", "figcaption"]


def drawn_page(texts: list[str], stock: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The blocks of a page whose article has these texts, with parts of the stock around it, and their labels."""

    def some(words: int) -> str:
        text = stock[rng.integers(len(stock))].split()
        at = int(rng.integers(max(1, len(text) - words)))
        return " ".join(text[at : at + words])

    def part() -> tuple[str, str]:
        tag, attributes = AROUND[rng.integers(len(AROUND))]
        n = int(rng.integers(1, 5))
        words = int(rng.choice([1, 2, 4, 12, 40]))
        kind = int(rng.integers(4))
        if kind == 0 or tag in ("ul", "ol"):
            inner = "".join(f'<li><a href="#">{html.escape(some(words))}</a></li>' for _ in range(n))
            inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
        elif kind == 1:
            inner = html.escape(some(words))
        elif kind == 2:
            inner = "".join(f"<p>{html.escape(some(words))}</p>" for _ in range(n))
        else:
            inner = "".join(f"<div><h3>{html.escape(some(2))}</h3><p>{html.escape(some(words))}</p></div>" for _ in range(n))
        return "part", f"<{tag} {attributes}>{inner}</{tag}>"

    tag, attributes = LAYOUTS[rng.integers(len(LAYOUTS))]
    pieces = ["<html><body>"]
    for _ in range(int(rng.integers(0, 5))):
        pieces.append(part()[1])
    wrapped = rng.random() < 0.3
    if wrapped:
        pieces.append('<div class="container">')
        pieces += [part()[1] for _ in range(int(rng.integers(0, 3)))]
    pieces.append(f"<{tag} {attributes}>")
    if rng.random() < 0.6:
        pieces.append(f"<h1>\x02{html.escape(some(6))}</h1>")
    plain = rng.random() < 0.5
    for t in texts:
        inner = "p" if plain else INSIDE[rng.integers(len(INSIDE))]
        body = f"\x02{html.escape(t)}"
        if rng.random() < 0.2:
            body = f"<b>{body}</b>"
        if rng.random() < 0.1:
            body = f'\x02<a href="#">{body[1:] if body[0] == chr(2) else body}</a>'
        outer = {"li": ("<ul>", "</ul>"), "td": ("<table><tr>", "</tr></table>")}.get(inner, ("", ""))
        pieces.append(f"{outer[0]}<{inner}>{body}</{inner}>{outer[1]}")
        if rng.random() < 0.15:
            pieces.append(part()[1])
    pieces.append(f"</{tag}>")
    if wrapped:
        pieces += [part()[1] for _ in range(int(rng.integers(0, 3)))]
        pieces.append("</div>")
    for _ in range(int(rng.integers(0, 5))):
        pieces.append(part()[1])
    found = blocks("".join(pieces) + "</body></html>")
    labels = np.array(["\x02" in b.text for b in found], float)
    for b in found:
        b.text = b.text.replace("\x02", "") or "."
    return found, labels


def trained(sample: list[str], sizes: Labeller) -> Network:
    """The labeller of pages drawn from a sample; without any text in it, from a stock of its own."""
    stock = [b.text for page in sample for b in blocks(page)] or ["one two three.", "four five six seven."]
    rng = np.random.default_rng(sizes.seed)
    drawn = []
    for _ in range(max(1, len(sample)) * sizes.variants):
        texts = [stock[i] for i in rng.integers(len(stock), size=int(rng.integers(1, 9)))]
        found, labels = drawn_page(texts, stock, rng)
        if found:
            drawn.append(featured(found, sizes, labels))
    network = Network(sizes)
    network.train(drawn)
    return network


def train(pages: DataFrame, sizes: Labeller | None = None) -> Network:
    """The labeller, trained in one task on pages drawn from at most sizes.sample_pages pages."""
    sizes = sizes or Labeller()
    sample = (
        pages.where(F.length("html") > 0)
        .select(F.xxhash64("page_id", "html").alias("_order"), "html")
        .orderBy("_order", "html")
        .limit(sizes.sample_pages)
    )
    # One row whatever the sample, so that an empty one trains as well.
    held = sample.agg(F.collect_list("html").alias("pages"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in batch.column("pages").to_pylist():
                state = pickle.dumps(trained(sorted(found), sizes).state)
                yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["state"])

    return Network(sizes, pickle.loads(held.mapInArrow(work, "state binary").first()["state"]))


def main_text(pages: DataFrame, network: Network | None = None, sizes: Labeller | None = None) -> DataFrame:
    """page_id, url and text of every page: its blocks of main text, joined by line feeds.

    A null or empty page has an empty text. Repeated rows are read each by itself. Other columns are ignored.
    """
    network = network or train(pages, sizes)
    shared = pages.sparkSession.sparkContext.broadcast((network.sizes, network.state))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.select("page_id", "url").schema)
    ready: list[Network] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Network(*shared.value))
        found = [blocks(h or "") for h in batch.column("html").to_pylist()]
        labels = ready[0].label([featured(f, ready[0].sizes) for f in found])
        texts = ["\n".join(b.text for b, keep in zip(f, l, strict=True) if keep) for f, l in zip(found, labels, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )

    return map_texts(pages.select("page_id", "url", "html"), "html", work, f"{kinds}, text string")
