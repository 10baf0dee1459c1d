"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks.  A bidirectional LSTM in numpy reads for each block a vector of its
tag path (names, classes, ids, hashed) and of its words (hashed), with a few lengths, and labels every
block in the light of the whole page.  It is trained on a bounded sample of pages whose own markup names what
a block is, with names and extra blocks varied, so that pages that name things otherwise are read as well.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import bound_batches

#: Pages that the labeller is trained on, at most, in the order of a hash of their ids.
SAMPLE_PAGES = 500
#: Blocks of a page that it teaches with at most, half of them its first; reading is of whole pages.
TRAIN_BLOCKS = 60
PATH_DIMS, WORD_DIMS, HIDDEN = 96, 32, 16
STEPS, BATCH, RATE = 260, 24, 0.02

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose content is no text of the page.
RAW = frozenset("script style title noscript template svg math iframe object head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: An open element of these ends where one of the same, or a block, begins.
CLOSES_ITSELF = frozenset("p li dt dd option tr td th".split())

#: Names that say what a block is, in tags, classes, ids and roles.
MAIN_NAMES = frozenset("article main content post entry story body text".split())
OTHER_NAMES = frozenset(
    "nav navigation menu breadcrumb breadcrumbs header masthead footer bottom sidebar aside ad ads advert advertisement adsbygoogle banner sponsor "
    "sponsored promo cookie cookies consent notice popup modal overlay newsletter subscribe comment comments reply respond disqus form login "
    "search share social related recommended pagination pager widget legal copyright toolbar alert gdpr button select dialog".split()
)


@dataclass
class Block:
    path: tuple[str, ...]  # "tag.word.word" of each open block element, outermost first
    text: str
    linked: int  # characters inside links


def blocks_of(page: str | None) -> list[Block]:
    """The page's leaf blocks with text, in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = in_link = at = 0

    def close():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(tuple(label for _, label in stack), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def put(raw: str):
        nonlocal linked
        if raw:
            parts.append(raw)
            if in_link:
                linked += len(raw)

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            close()
            return out
        put(page[at : m.start()])
        at = m.end()
        if m.group(1) is not None:
            put(html.escape(m.group(1)))
        if m.group(3) is None:
            continue
        tag, ending = m.group(3).lower(), bool(m.group(2))
        if tag in RAW:
            if not ending and not m.group(4).rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if tag == "head":
                    body = re.compile(r"<body\b", re.I).search(page, at)
                    if end is None or body is not None and body.start() < end.start():
                        at = body.start() if body is not None else at
                        continue
                at = end.end() if end is not None else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if ending else 1
            elif tag == "br":
                parts.append(" ")
            continue
        close()
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            in_link = 0
        elif tag not in VOID:
            while stack and (stack[-1][0] in CLOSES_ITSELF and (stack[-1][0] == tag or stack[-1][0] == "p")):
                stack.pop()
            words = [w.lower() for a in _ATTR.finditer(m.group(4)) for w in _NAME.findall(a.group(2) or a.group(3) or a.group(4) or "")]
            stack.append((tag, ".".join([tag, *words])))


_WORDS: dict[str, int] = {}


def _word_dim(word: str) -> int:
    got = _WORDS.get(word)
    if got is None:
        if len(_WORDS) > 500_000:
            _WORDS.clear()
        got = _WORDS[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_DIMS
    return got


_PATHS: dict[tuple, np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    got = _PATHS.get(path)
    if got is None:
        if len(_PATHS) > 50_000:
            _PATHS.clear()
        got = np.zeros(PATH_DIMS, np.float32)
        for part in path:
            for k, name in enumerate(part.split(".")):
                # known names have a place of their own kind; a tag and a class of one name are the same word
                if name in ("html", "body") and k == 0:
                    continue
                got[zlib.crc32(name.encode("utf-8", "surrogatepass")) % PATH_DIMS] = 1.0
        _PATHS[path] = got
    return got


EXTRA = 5


def vectors(blocks: list[Block]) -> np.ndarray:
    """blocks x (path, words, lengths) inputs."""
    out = np.zeros((len(blocks), PATH_DIMS + WORD_DIMS + EXTRA), np.float32)
    for i, b in enumerate(blocks):
        out[i, :PATH_DIMS] = _path_vector(b.path)
        words = b.text.lower().split()
        dims = np.bincount([_word_dim(w) for w in words], minlength=WORD_DIMS)
        out[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = dims / max(1.0, np.sqrt((dims * dims).sum()))
        n = len(b.text)
        out[i, -EXTRA:] = (np.log1p(len(words)) / 5, b.linked / max(1, n), sum(map(b.text.count, ".!?,;")) / max(1, len(words)),
                           i / max(1, len(blocks) - 1), n > 120)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = PATH_DIMS + WORD_DIMS + EXTRA
        self.p = {}
        for way in ("f", "b"):
            self.p[f"{way}x"] = rng.normal(0, 0.3, (d, 4 * HIDDEN)).astype(np.float32)
            self.p[f"{way}h"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1.0  # forget gate
            self.p[f"{way}c"] = bias
        self.p["out"] = rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
        self.p["skip"] = np.zeros(d, np.float32)
        self.p["bias"] = np.zeros(1, np.float32)

    @staticmethod
    def _pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t = max(len(s) for s in seqs)
        x = np.zeros((len(seqs), t, seqs[0].shape[1]), np.float32)
        mask = np.zeros((len(seqs), t), np.float32)
        for i, s in enumerate(seqs):
            x[i, : len(s)], mask[i, : len(s)] = s, 1
        return x, mask

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        n, t, _ = x.shape
        gates_x = x @ self.p[f"{way}x"] + self.p[f"{way}c"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, t, HIDDEN), np.float32)
        for k in range(t) if way == "f" else range(t - 1, -1, -1):
            g = gates_x[:, k] + h @ self.p[f"{way}h"]
            i, f, o = (_sigmoid(g[:, j * HIDDEN : (j + 1) * HIDDEN]) for j in range(3))
            u = np.tanh(g[:, 3 * HIDDEN :])
            c2 = f * c + i * u
            tc = np.tanh(c2)
            m = mask[:, k : k + 1]
            if keep is not None:
                keep.append((k, i, f, o, u, c, h, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
            out[:, k] = h
        return out

    def probabilities(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        """Per block: how likely it is main text.  Pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(seqs)
        order = sorted((i for i in range(len(seqs)) if len(seqs[i])), key=lambda i: len(seqs[i]))
        while order:
            n = max(1, min(len(order), 256, 40_000 // len(seqs[order[-1]])))
            take, order = order[-n:], order[:-n]
            x, mask = self._pad([seqs[i] for i in take])
            hidden = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b")], axis=2)
            p = _sigmoid(hidden @ self.p["out"] + x @ self.p["skip"] + self.p["bias"])
            for row, i in zip(p, take, strict=True):
                out[i] = row[: len(seqs[i])]
        return out

    def gradient(self, seqs: list[np.ndarray], labels: list[np.ndarray]) -> tuple[float, dict]:
        x, mask = self._pad(seqs)
        y = np.zeros(mask.shape, np.float32)
        for i, own in enumerate(labels):
            y[i, : len(own)] = own
        kept = {"f": [], "b": []}
        hf, hb = self._run(x, mask, "f", kept["f"]), self._run(x, mask, "b", kept["b"])
        hidden = np.concatenate([hf, hb], axis=2)
        p = _sigmoid(hidden @ self.p["out"] + x @ self.p["skip"] + self.p["bias"])
        loss = -(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / mask.sum()
        dz = mask * (p - y) / mask.sum()
        g = {"out": np.einsum("nt,nth->h", dz, hidden), "skip": np.einsum("nt,ntd->d", dz, x), "bias": np.array([dz.sum()])}
        for w, way in enumerate(("f", "b")):
            dout = dz[:, :, None] * self.p["out"][w * HIDDEN : (w + 1) * HIDDEN]
            dh = np.zeros((len(seqs), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            dx = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.p[f"{way}h"])
            for k, i, f, o, u, c, h, tc, m in reversed(kept[way]):
                dh = dh + dout[:, k]
                own = m * dh
                dc2 = m * dc + own * o * (1 - tc * tc)
                dg = np.concatenate([dc2 * u * i * (1 - i), dc2 * c * f * (1 - f), own * tc * o * (1 - o), dc2 * i * (1 - u * u)], axis=1)
                dx[:, k] = dg
                gh += h.T @ dg
                dh = (1 - m) * dh + dg @ self.p[f"{way}h"].T
                dc = (1 - m) * dc + dc2 * f
            g[f"{way}x"], g[f"{way}h"], g[f"{way}c"] = np.einsum("ntd,ntg->dg", x, dx), gh, dx.sum(axis=(0, 1))
        return float(loss), g

    def train(self, make, steps: int = STEPS, batch: int = BATCH, rate: float = RATE) -> float:
        """Adam over batches from ``make(batch)``."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            loss, g = self.gradient(*make(batch))
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in g.items():
                x = x * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return loss


def named_label(path: tuple[str, ...]) -> int | None:
    """1 main text, 0 other, None where the names do not say."""
    names = {n for part in path for n in part.split(".")} - {"html"}
    body = {n for part in path if not part.startswith("body") for n in part.split(".")}
    if names & OTHER_NAMES:
        return 0
    return 1 if body & MAIN_NAMES else None


#: Ways to name the same part of a page, for training.
_MAIN = ("article", "article", "main", "div.content", "div.main.content", "div.post", "section.story", "div.entry.content", "div.article.body", "main/article", "div")
_NAV = ("nav/ul/li", "nav/ul/li", "div.menu/ul/li", "ul.navigation/li", "header/nav/ul/li", "div.nav/div", "div.breadcrumbs/ul/li")
_AD = ("div.ad", "div.ad", "div.ads", "aside.sponsored", "div.promo/p", "ins.adsbygoogle", "div.banner", "section.advert/p")
_FOOT = ("footer", "footer", "footer/p", "div.footer", "div.footer/div/p", "div.copyright")
_EXTRAS = ("header/div", "header/h1", "div.header/p", "div.masthead/h2", "aside/p", "aside/ul/li", "div.sidebar/ul/li", "div.sidebar/p", "aside/h3",
           "div.cookie.notice/p", "div.notice", "div.alert/p", "div.popup/p", "section.newsletter/p", "form/label", "form/p", "form/button", "div.search/form/label",
           "section.comments/h2", "section.comments/div.comment/p", "div.comments/div.comment", "ul.comments/li.comment/p", "div.comment/p", "div.reply/p",
           "div.related/ul/li", "div.share/ul/li", "section.related/h3")


def _varied(blocks: list[Block], labels: list[int], rng) -> tuple[list[Block], list[int]]:
    """The page under other names, with blocks of other kinds put before, between and after."""
    if rng.random() < 0.35:
        return blocks, labels
    pick = lambda xs: xs[rng.integers(len(xs))]
    main, nav, ad, foot = (pick(x) for x in (_MAIN, _NAV, _AD, _FOOT))
    out, marks = [], []

    def add(path: str, text: str, linked: int, mark: int):
        out.append(Block(("html", "body", *path.split("/")), text, linked))
        marks.append(mark)

    def extras(n):
        for _ in range(n):
            path, text = pick(_EXTRAS), pick(blocks).text
            words = text.split()[: int(rng.integers(1, 60))] if rng.random() < 0.7 else text.split()
            for _again in range(int(rng.integers(1, 4))):
                add(path, " ".join(words), len(" ".join(words)) if path.endswith("li") and rng.random() < 0.8 else 0, 0)

    extras(rng.integers(0, 3))
    for b, mark in zip(blocks, labels, strict=True):
        leaf = b.path[-1].split(".")[0] if b.path else "p"
        if mark:
            add(f"{main}/{leaf if leaf not in ('article', 'main', 'body', 'html') else 'p'}", b.text, b.linked, 1)
            if rng.random() < 0.03:
                extras(1)
        elif b.linked > 0.5 * len(b.text):
            add(nav, b.text, b.linked, 0)
        else:
            add(ad if len(out) < len(blocks) / 2 else foot, b.text, b.linked, 0)
    extras(rng.integers(0, 4))
    return out, marks


def likely_label(block: Block) -> int:
    """The label by names; where these do not say, by form: running text of a few words that is not mostly links is main text."""
    named = named_label(block.path)
    if named is not None:
        return named
    return int(len(block.text.split()) >= 5 and block.linked <= 0.5 * len(block.text))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, seed: int = 11,
        page_blocks: int = TRAIN_BLOCKS) -> Labeller:
    """Trains on a bounded sample of pages: those whose names say of every block what it is.

    If there is no such page in the sample, its blocks are labelled by ``likely_label``, and the pages' parts take the
    varied names all the same.  A page teaches with its first and last blocks, ``page_blocks`` at most.  Rows repeated or of
    one id are sampled each, ``sample_pages`` in all; without any page that has text the model stays untrained.
    """
    bound_batches(pages.sparkSession)
    sample = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(html_col).cast("string").alias("h"))
    ids = sample.select("i").orderBy(F.xxhash64("i"), "i").limit(sample_pages)
    texts = [r["h"] for r in sample.join(ids.distinct(), "i", "left_semi").orderBy(F.xxhash64("i"), "i", F.xxhash64("h")).limit(sample_pages).toLocalIterator()]
    known, guessed = [], []
    for t in texts:
        blocks = blocks_of(t)
        if len(blocks) > page_blocks:
            blocks = blocks[: page_blocks // 2] + blocks[-(page_blocks // 2) :]
        marks = [named_label(b.path) for b in blocks]
        if blocks and 1 in marks and None not in marks:
            known.append((blocks, marks))
        marks = [likely_label(b) for b in blocks]
        if 1 in marks:
            guessed.append((blocks, marks))
    model, rng = Labeller(seed), np.random.default_rng(seed)
    known = known or guessed
    if known:

        def make(batch):
            chosen = [_varied(*known[rng.integers(len(known))], rng) for _ in range(batch)]
            return [vectors(b) for b, _ in chosen], [np.array(m, np.float32) for _, m in chosen]

        model.train(make)
    return model


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars, n_blocks, n_kept``.

    White space inside a block becomes one blank; kept blocks are joined by two line feeds.  Null and empty
    pages, and pages without main text, give the empty text.  Rows repeated give equal rows.
    """
    bound_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parsed = [blocks_of(h) for h in pdf["html"]]
            chances = held.value.probabilities([vectors(b) for b in parsed])
            kept = [[b.text for b, p in zip(bs, ps, strict=True) if p >= 0.5] for bs, ps in zip(parsed, chances, strict=True)]
            texts = ["\n\n".join(k) for k in kept]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts],
                                "n_blocks": [len(b) for b in parsed], "n_kept": [len(k) for k in kept]})

    return rows.mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks int, n_kept int")
