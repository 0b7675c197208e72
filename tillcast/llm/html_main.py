"""Main text of web pages by a recurrent block labeller (operator 8).

A page is a sequence of text blocks; each block is a vector of hashed tag-path tokens (tags,
class, id and role names of the elements around it), hashed words and a few measures.  A
bidirectional LSTM in numpy reads the whole sequence, so each block is judged with the context
of the document, and a logistic layer says main text or not.

Training: a bounded sample of the table's pages, labelled weakly by what the markup says of
itself (article and main on one side; navigation, footers, adverts, forms, comments on the
other), each also in altered copies: containers renamed, further boilerplate put in.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import map_rows
from tillcast.llm.html_blocks import Block, blocks
from tillcast.llm.sampling import labelled_sample

PATH_CELLS = 128
WORD_CELLS = 48
MEASURES = 10
WIDTH = PATH_CELLS + WORD_CELLS + MEASURES
HIDDEN = 20
SAMPLE_PAGES = 240
SAMPLE_CHARS = 30_000
TRAIN_BLOCKS = 96
EPOCHS = 12

#: Names by which markup marks what is not the article, and what is.
SIDE_TAGS = frozenset("nav footer aside form button menu dialog header fieldset".split())
SIDE_NAMES = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar side rail "
                       "widget ad ads advert advertisement adslot sponsor sponsored promo banner cookie cookies consent "
                       "gdpr notice alert popup modal overlay newsletter subscribe signup login search form share "
                       "sharing social related recommended trending comment comments reply replies respond disqus "
                       "discussion contentinfo complementary pagination pager legal copyright toolbar".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = frozenset("article content post entry story body main text".split())
#: Phrases for the boilerplate put into altered copies.
PHRASES = {
    "cookie": ("We use cookies to improve your experience.", "Accept all", "Cookie settings"),
    "newsletter": ("Subscribe to our newsletter", "Enter your email address", "Sign up"),
    "comments": ("3 comments", "Reply", "Leave a comment", "Report"),
    "related": ("Related articles", "You may also like", "Read more"),
    "share": ("Share this", "Tweet", "Print"),
    "login": ("Log in", "Create an account", "Forgot your password?"),
    "footer": ("All rights reserved.", "Privacy policy", "Terms of use", "Contact"),
}


class _WordCells(dict):
    """Memo of word -> cell, emptied when it holds 200,000 words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        c = self[word] = _cell(word, WORD_CELLS)
        return c


WORD_MEMO = _WordCells()


def _cell(token: str, cells: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % cells


@lru_cache(maxsize=20_000)
def _path_cells(path: tuple) -> tuple:
    found = set()
    for tag, names in path:
        found.add(_cell("<" + tag, PATH_CELLS))
        found.update(_cell("." + n, PATH_CELLS) for n in names)
    if path:
        found.add(_cell("last<" + path[-1][0], PATH_CELLS))
    return tuple(sorted(found))


def vectors(page: list[Block]) -> np.ndarray:
    """(blocks, WIDTH) input of the labeller."""
    x = np.zeros((len(page), WIDTH), np.float32)
    words = [b.text.lower().split() for b in page]
    count = np.array([len(w) for w in words], np.int64)
    cells = np.fromiter(map(WORD_MEMO.__getitem__, chain.from_iterable(words)), np.int64, int(count.sum()))
    hashed = np.bincount(np.repeat(np.arange(len(page)) * WORD_CELLS, count) + cells, minlength=len(page) * WORD_CELLS)
    hashed = hashed.reshape(len(page), WORD_CELLS)
    x[:, PATH_CELLS:PATH_CELLS + WORD_CELLS] = hashed / np.maximum(np.linalg.norm(hashed, axis=1, keepdims=True), 1e-9)
    for i, b in enumerate(page):
        x[i, list(_path_cells(b.path))] = 1
        t, n = b.text, len(b.text)
        x[i, PATH_CELLS + WORD_CELLS:] = (
            math.log1p(n) / 5, math.log1p(count[i]) / 4, b.linked / n, t[-1] in ".!?…\"'", n < 25,
            (t.count(".") + t.count(",")) / count[i], t[0].isupper(), i / len(page), len(b.path) / 10, "©" in t)
    return x


@dataclass
class Labeller:
    """Weights of both directions (input, recurrent, bias) and of the output layer."""
    w: dict

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Share of main text for the blocks of each page; pages are run side by side."""
        some = [i for i, x in enumerate(pages) if len(x)]
        out = [np.zeros(0)] * len(pages)
        if some:
            n = np.array([len(pages[i]) for i in some])
            h = np.concatenate([run_direction(self.w, k, [pages[i] for i in some], n, k == "b")[0] for k in "fb"], axis=1)
            p = 1 / (1 + np.exp(-(h @ self.w["o"] + self.w["c"])))
            for i, part in zip(some, np.split(p, np.cumsum(n)[:-1])):
                out[i] = part
        return out


def _layout(n: np.ndarray, backward: bool):
    """Flat positions of step t of every page still running, longest page first."""
    order = np.argsort(-n, kind="stable")
    first = np.concatenate(([0], np.cumsum(n)[:-1]))[order]
    length = n[order]
    for t in range(int(length[0])):
        k = int(np.searchsorted(-length, -t))      # pages longer than t
        yield (first[:k] + length[:k] - 1 - t) if backward else (first[:k] + t)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def run_direction(w: dict, k: str, pages: list[np.ndarray], n: np.ndarray, backward: bool, keep: bool = False):
    """Hidden states of one direction over the blocks of all pages laid end to end."""
    x = np.concatenate(pages)
    z = x @ w[k + "x"] + w[k + "b"]
    out = np.zeros((len(x), HIDDEN), np.float32)
    h = c = np.zeros((len(pages), HIDDEN), np.float32)
    tape = []
    for at in _layout(n, backward):
        h, c = h[:len(at)], c[:len(at)]
        g = z[at] + h @ w[k + "h"]
        i, f, o = (_sigmoid(g[:, j * HIDDEN:(j + 1) * HIDDEN]) for j in range(3))
        u = np.tanh(g[:, 3 * HIDDEN:])
        new = f * c + i * u
        s = np.tanh(new)
        if keep:
            tape.append((at, h, c, i, f, o, u, s))
        h, c = o * s, new
        out[at] = h
    return out, x, tape


def gradients(w: dict, k: str, x: np.ndarray, tape: list, d_out: np.ndarray) -> dict:
    """Back-propagation through time of one direction."""
    dz = np.zeros((len(x), 4 * HIDDEN), np.float32)
    d_h = np.zeros_like(w[k + "h"])
    dh = dc = np.zeros((0, HIDDEN), np.float32)
    for at, h, c, i, f, o, u, s in reversed(tape):
        more = len(at) - len(dh)                   # pages that end at this step
        dh = np.vstack([dh, np.zeros((more, HIDDEN), np.float32)]) + d_out[at]
        dc = np.vstack([dc, np.zeros((more, HIDDEN), np.float32)]) + dh * o * (1 - s * s)
        g = np.hstack([dc * u * i * (1 - i), dc * c * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - u * u)])
        dz[at] = g
        d_h += h.T @ g
        dh, dc = g @ w[k + "h"].T, dc * f
    return {k + "x": x.T @ dz, k + "h": d_h, k + "b": dz.sum(0)}


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 3) -> Labeller:
    """Adam on the log loss of every block; ``pages``: (vectors, labels)."""
    rng = np.random.default_rng(seed)
    w: dict = {}
    for k in "fb":
        w[k + "x"] = rng.normal(0, 0.1, (WIDTH, 4 * HIDDEN)).astype(np.float32)
        w[k + "h"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w[k + "b"] = np.zeros(4 * HIDDEN, np.float32)
        w[k + "b"][HIDDEN:2 * HIDDEN] = 1
    w["o"], w["c"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)
    m, v, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    pages = [p for p in pages if len(p[0])]
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), 24):
            part = [pages[i] for i in order[at:at + 24]]
            n = np.array([len(x) for x, _ in part])
            runs = {k: run_direction(w, k, [x for x, _ in part], n, k == "b", True) for k in "fb"}
            h = np.hstack([runs["f"][0], runs["b"][0]])
            d = ((_sigmoid(h @ w["o"] + w["c"]) - np.concatenate([y for _, y in part])) / n.sum()).astype(np.float32)
            g = {"o": h.T @ d, "c": np.array([d.sum()])}
            dh = d[:, None] * w["o"]
            for j, k in enumerate("fb"):
                g |= gradients(w, k, runs[k][1], runs[k][2], dh[:, j * HIDDEN:(j + 1) * HIDDEN])
            step += 1
            scale = min(1.0, 5 / (np.sqrt(sum(float((a * a).sum()) for a in g.values())) + 1e-9))
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * scale * g[k]
                v[k] = 0.999 * v[k] + 0.001 * (scale * g[k]) ** 2
                w[k] = (w[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Labeller(w)


def weak_labels(page: list[Block]) -> np.ndarray:
    """1 where the markup calls a block part of the article, by its innermost telling element."""
    marked = any(t in MAIN_TAGS or MAIN_NAMES & set(names) for b in page for t, names in b.path)
    y = np.zeros(len(page), np.float32)
    for i, b in enumerate(page):
        side = any(t in SIDE_TAGS or (SIDE_NAMES & set(names) and t not in MAIN_TAGS and t not in ("body", "html"))
                   for t, names in b.path)
        inside = any(t in MAIN_TAGS or MAIN_NAMES & set(names) for t, names in b.path)
        y[i] = not side and (inside if marked else len(b.text) > 80 and b.linked < len(b.text) / 2)
    return y


def altered(page: str, rng) -> str:
    """A copy of a page with its containers renamed and further boilerplate put in."""
    if rng.random() < 0.6:
        name = rng.choice(("div class='content'", "div id='main-content'", "div class='post-body'", "main", "section class='story'",
                           "div class='entry-content'"))
        page = re.sub(r"<article\b[^>]*>", f"<{name}>", page)
        page = page.replace("</article>", f"</{name.split()[0]}>")
    if rng.random() < 0.4:
        page = page.replace("<nav>", "<div class='menu'>").replace("</nav>", "</div>")
    if rng.random() < 0.4:
        page = re.sub(r"<footer\b[^>]*>", "<div id='footer'>", page).replace("</footer>", "</div>")
    said = re.findall(r"<p>([^<]{20,400})", page) or ["Some words of a reader about this."]

    def any_text():
        return str(rng.choice(said))

    def bits(kind):
        return "".join(f"<{t}>{p}</{t}>" for p in PHRASES[kind] for t in [str(rng.choice(("p", "span", "div", "li", "h3")))])

    names = {"cookie": ("div id='cookie-banner'", "div class='consent notice'"), "newsletter": ("form class='newsletter'", "div class='subscribe'"),
             "comments": ("section id='comments'", "div class='comment-list'", "ol class='comments'"),
             "related": ("aside class='related'", "div class='related-posts'", "div class='sidebar'", "aside"),
             "share": ("div class='social-share'", "ul class='share'"), "login": ("form", "div class='login'"),
             "footer": ("footer class='site-footer'", "div class='legal'")}
    for kind, places in names.items():
        if rng.random() < 0.45:
            tag = str(rng.choice(places))
            body = bits(kind)
            if kind in ("comments", "related"):
                body += "".join(f"<div class='{kind}-item'><p>{any_text()}</p></div>" for _ in range(rng.integers(1, 4)))
            part = f"<{tag}>{body}</{tag.split()[0]}>"
            spots = [m.end() for m in re.finditer(r"<body[^>]*>|</nav>|</p>|</article>|</main>", page)]
            late = kind in ("comments", "related", "share", "footer")
            spot = spots[-1] if late and spots else spots[0] if spots else 0
            if spots and rng.random() < 0.4:
                spot = int(rng.choice(spots))
            page = page[:spot] + part + page[spot:]
    for _ in range(rng.integers(0, 4)):      # any marked container, with text like the article's, anywhere
        tag, name = str(rng.choice(("div", "section", "aside", "div"))), str(rng.choice(sorted(SIDE_NAMES)))
        how = str(rng.choice(("class", "id")))
        part = f"<{tag} {how}='{name}'>" + "".join(f"<p>{any_text()}</p>" for _ in range(rng.integers(1, 4))) + f"</{tag}>"
        spots = [m.end() for m in re.finditer(r"<body[^>]*>|</p>|</nav>|</article>|</main>|</footer>", page)]
        if spots:
            spot = int(rng.choice(spots)) if rng.random() < 0.7 else spots[-1]
            page = page[:spot] + part + page[spot:]
    if rng.random() < 0.3:
        page = re.sub(r"(<body[^>]*>)", lambda m: m[1] + f"<header class='site-header'><h2>{any_text()}</h2></header>", page, count=1)
    return page


def fit_labeller(pages: list[str], seed: int = 3) -> Labeller:
    """The labeller trained on the pages and two altered copies of each, every block of them: a page
    of more than TRAIN_BLOCKS blocks is that many consecutive ones at a time.  Pages without a block
    teach nothing; if there are pages but none teaches, an error is raised."""
    rng = np.random.default_rng(seed)
    data, taught = [], False
    for page in pages:
        for copy in (page, altered(page, rng), altered(page, rng)):
            seq = blocks(copy)
            taught |= copy is page and bool(seq)             # the altered copies have put-in blocks
            x, y = vectors(seq), weak_labels(seq)
            data += [(x[i:i + TRAIN_BLOCKS], y[i:i + TRAIN_BLOCKS]) for i in range(0, max(1, len(seq)), TRAIN_BLOCKS)]
    if pages and not taught:
        raise ValueError("no page of the sample has a text block to train on")
    return train(data, seed=seed)


def page_sample(pages: DataFrame, most: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``most`` whole pages, chosen by a hash of the page: fewer when they are long, so that
    there are about ``most`` * ``chars`` characters at most, but one page at least."""
    keyed = pages.where(F.length("html") > 0).select(F.col("html").alias("text"), F.lit("page").alias("kind"))
    return [r[2] for r in labelled_sample(keyed, "kind", most, chars, whole=True)]


def main_text(page: list[Block], share: np.ndarray) -> str:
    return "\n\n".join(b.text for b, p in zip(page, share) if p >= 0.5)


def extract_main_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_blocks, main_blocks of every whole page.

    Null and empty html, or a page without main text: empty text.  Null page_id and url are
    carried, repeated rows give equal results.  No rows: no rows.  Other columns are ignored."""
    shared = pages.sparkSession.sparkContext.broadcast(model)     # weights: fixed size

    def make():
        labeller = shared.value

        def fn(cols):
            seqs = [blocks(h or "") for h in cols["html"].to_pylist()]
            shares = labeller.probabilities([vectors(s) for s in seqs])
            texts = [main_text(s, p) for s, p in zip(seqs, shares)]
            return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts],
                    "n_blocks": [len(s) for s in seqs], "main_blocks": [int((p >= 0.5).sum()) for p in shares]}

        return fn

    return map_rows(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), make,
                    "page_id long, url string, text string, n_chars long, n_blocks int, main_blocks int")
