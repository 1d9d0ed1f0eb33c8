"""Operator 8: main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags, with the path of open
elements.  A block's vector holds its hashed path elements, its hashed words and a few sizes.  A bidirectional LSTM in numpy
reads the whole sequence, so every block is labelled with the rest of the page in view; blocks labelled as content are the
page's text.  Scripts, styles, comments, the head and the markup are no blocks.

It is trained here, in one task, on a bounded sample of pages (``sample_pages``).  Blocks of those pages get their
label from the meaning of their path (fixed values below); each page is also learnt with its parts moved into other
usual wrappings and with further boilerplate put in, so that the network learns to label markup that the sample lacks.
The weights (some ten thousand numbers) are broadcast.

Defined results: null html counts as empty; a page without content has an empty text; unclosed and stray tags are
tolerated; repeated rows are extracted each; an empty table gives no rows (and trains on nothing); other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import WordHashes, text_of

# ---- fixed values -------------------------------------------------------------------------------------------------
#: Elements that don't end a block.
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong strike sub sup "
             "time tt u var wbr".split())
#: Elements without an end tag.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = set("script style head title noscript template svg textarea select iframe object".split())
#: Those of them whose content is raw text: up to the end tag, else up to the page's end.
RAW = set("script style textarea iframe".split())
#: Elements that may stand in a head; any other, or text, ends it.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that end an open element of SILENT whose end tag is missing.
BREAKS = set("body article main section nav header footer aside h1 h2 h3 h4 h5 h6 p div table ul ol dl blockquote pre form".split())
#: Path elements (tags, .classes, #ids) of boilerplate, and of content.
BOILERPLATE = set("nav header footer aside form button menu dialog .nav .navbar .menu .header .masthead .footer .sidebar .notice "
                  ".cookie .banner .alert .ad .ads .advert .sponsored .promo .comment .comments .share .related .breadcrumb "
                  "#nav #menu #header #masthead #footer #sidebar #notice #cookie #ad #comments".split())
CONTENT = set("article main .content .article .post .entry #content #main #article".split())
#: Usual wrappings of content, and of boilerplate, from the outside in.
CONTENT_WRAPS = ["article", "main", "main article", "div.content", "div#content", "div.post", "div.entry-content",
                 "section.article-body", "div#main div.article", "div.page article.post", "section", "div"]
BOILERPLATE_WRAPS = {
    "start": ["nav ul li a", "nav a", "div.menu ul li a", "ul.nav li a", "div#nav a", "header", "header h1", "header p", "div.header p",
              "div#masthead", "div.breadcrumb a", "div.cookie-notice p", "div.notice", "div.alert p", "div.banner"],
    "inside": ["aside p", "div.ad", "div.ad p", "aside.ad p", "div.advert", "div.sponsored p", "div.promo p", "form p",
               "form label", "form button", "div.share a", "nav ul li a", "div.related ul li a", "div.sidebar p"],
    "end": ["footer", "footer p", "div.footer p", "div#footer", "aside p", "div.sidebar ul li a", "div#sidebar p",
            "section.comments p", "div.comments div.comment p", "div#comments article p", "ol.comments li p",
            "section#comments article.comment p", "form label", "form p", "div.related a", "div.ad", "div.cookie-banner p"],
}
# -------------------------------------------------------------------------------------------------------------------

# attributes hold no bare "<" and are never tried again, so that tags without their end cost no second look
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^<>]*+>", re.S)
NAMED = re.compile(r"\b(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)

PATH_DIMS, WORD_DIMS, SIZES = 192, 32, 4
#: Innermost elements that a block's path keeps.
DEPTH = 64
DIMS, HIDDEN = PATH_DIMS + WORD_DIMS + SIZES, 16


def element(tag: str, attributes: str) -> tuple[str, ...]:
    """A path element: the tag, its classes and id, and the words of compound names."""
    names = []
    for kind, *values in NAMED.findall(attributes) if attributes else ():
        mark = "." if kind.lower() == "class" else "#"
        for name in "".join(values).lower().split():
            names.append(mark + name)
            names += [mark + part for part in re.split(r"[-_]+", name) if part and part != name]
    return (tag, *names)


def blocks(page: str | None) -> list[tuple[tuple, str, int]]:
    """(path, text, characters within links) of the leaf blocks in page order; white space is one space."""
    out: list = []
    path: list[tuple[str, ...]] = []
    text: list[str] = []
    linked, at, page = 0, 0, page or ""
    ended: dict[str, set[int]] = {}

    inside: list[tuple[bool, bool]] = [(False, False)]      # for each depth: within a silent element, within a link

    def push(e: tuple) -> None:
        path.append(e)
        inside.append((inside[-1][0] or e[0] in SILENT, inside[-1][1] or e[0] == "a"))

    def cut(depth: int) -> None:
        del path[depth:], inside[depth + 1:]

    def has_end(tag: str, start: int) -> bool:
        """The element that starts there has an end tag of its own."""
        if tag not in ended:
            ended[tag], opened = set(), []
            for m in re.finditer(rf"<(/?){tag}(?=[\s/>])", page, re.I):
                if not m[1]:
                    opened.append(m.start())
                elif opened:
                    ended[tag].add(opened.pop())
        return start in ended[tag]

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined and not inside[-1][0]:
            out.append((tuple(e for e in path[-DEPTH:] if e[0] not in INLINE or e[0] == "a"), joined, min(linked, len(joined))))
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            if path and path[-1][0] == "head" and raw.strip():
                cut(len(path) - 1)
            piece = entities.unescape(raw) if "&" in raw else raw
            text.append(piece)
            if inside[-1][1]:
                linked += len(piece)

    while m := TOKEN.search(page, at):
        add(page[at: m.start()])
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == tag:
                    cut(i)
                    break
                if path[i][0] in SILENT and path[i][0] != "head" and path[i][1]:
                    break                                   # a stray end tag within it
            continue
        for i, e in enumerate(path) if inside[-1][0] else ():
            if e[0] == "head" and (tag == "body" or i == len(path) - 1 and tag not in IN_HEAD) or \
                    e[0] in SILENT and tag in BREAKS and not e[1]:
                cut(i)
                break
        if tag in SILENT and tag not in RAW:
            if not m[3].endswith("/"):
                push((tag, has_end(tag, m.start())))
        elif tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            if tag not in INLINE:
                for i in range(len(path) - 1, -1, -1):      # a block ends an open paragraph
                    if path[i][0] == "p":
                        cut(i)
                        break
                    if path[i][0] not in INLINE:
                        break
            push(element(tag, m[3]))
    add(page[at:])
    flush()
    return out


class Vectors:
    """Block vectors; the parts of paths that repeat are remembered."""

    def __init__(self):
        self.paths: dict[tuple, np.ndarray] = {}
        self.hashes = WordHashes()

    def path(self, path: tuple) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            v = np.zeros(PATH_DIMS)
            for depth, e in enumerate(reversed(path)):
                for name in e:
                    for salt in ("", "last ") if depth == 0 else ("",):
                        h = self.hashes[salt + name]
                        v[h % PATH_DIMS] += 1 if h >> 60 & 1 else -1
            self.paths[path] = v
        return self.paths[path]

    def __call__(self, leaves: list) -> np.ndarray:
        out = np.zeros((len(leaves), DIMS))
        for i, (path, text, linked) in enumerate(leaves):
            out[i, :PATH_DIMS] = self.path(path)
            words = text.lower().split()
            h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words)) % np.uint64(WORD_DIMS)
            out[i, PATH_DIMS: PATH_DIMS + WORD_DIMS] = np.bincount(h.astype(np.int64), minlength=WORD_DIMS) / (len(words) + 1)
            out[i, -SIZES:] = np.log1p(len(words)) / 5, linked / len(text), (i + 1) / len(leaves), 1 / (i + 1)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors, one logistic output a block."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = weights or {
            k: v for d in ("f", "b") for k, v in ((f"x{d}", r.normal(0, 0.15, (DIMS, 4 * HIDDEN))),
                                                  (f"h{d}", r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))),
                                                  (f"c{d}", np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)))
        } | {"out": r.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states of one direction; x: pages x blocks x DIMS; keep: gets what back-propagation needs."""
        pages, length, _ = x.shape
        h = c = np.zeros((pages, HIDDEN))
        out, into = np.zeros((pages, length, HIDDEN)), x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            z = into[:, t] + h @ self.w[f"h{d}"]
            gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN: 2 * HIDDEN], gates[:, 2 * HIDDEN:]
            c_new = f * c + i * g
            th, m = np.tanh(c_new), mask[:, t, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, th, m))
            h, c = m * (o * th), m * c_new                  # padding stands after (or, backwards, before) a page's blocks
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        sides = [self._run(d, x, mask, None if keep is None else keep.setdefault(d, [])) for d in ("f", "b")]
        both = np.concatenate(sides, axis=2)
        if keep is not None:
            keep["both"] = both
        return both @ self.w["out"] + self.w["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        error = (_sigmoid(self.logits(x, mask, keep)) - y) * mask / mask.sum()
        g = {"out": np.einsum("pt,pth->h", error, keep["both"]), "bias": np.array([error.sum()])}
        d_both = error[:, :, None] * self.w["out"]
        for n, d in enumerate(("f", "b")):
            d_out = d_both[:, :, n * HIDDEN: (n + 1) * HIDDEN]
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN))
            dh = dc = np.zeros((len(x), HIDDEN))
            g_h = np.zeros_like(self.w[f"h{d}"])
            for t, h, c, i, f, o, gg, th, m in reversed(keep[d]):
                dh = (dh + d_out[:, t]) * m
                dc = dc * m + dh * o * (1 - th * th)
                dz[:, t] = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - gg * gg)], axis=1)
                g_h += h.T @ dz[:, t]
                dh, dc = dz[:, t] @ self.w[f"h{d}"].T, dc * f
            g |= {f"x{d}": np.einsum("ptd,ptk->dk", x, dz), f"h{d}": g_h, f"c{d}": dz.sum((0, 1))}
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 20, batch: int = 32, rate: float = 0.01, seed: int = 7) -> None:
        """Adam over batches of pages of like length."""
        order, rng = sorted(range(len(pages)), key=lambda i: len(pages[i][0])), np.random.default_rng(seed)
        batches = [order[i: i + batch] for i in range(0, len(order), batch)]
        m, v = ({k: np.zeros_like(w) for k, w in self.w.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            for n in rng.permutation(len(batches)):
                x, mask = padded([pages[i][0] for i in batches[n]])
                y = padded([pages[i][1][:, None] for i in batches[n]])[0][:, :, 0]
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                    self.w[k] = self.w[k] - rate * m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, pages))
    x, mask = np.zeros((len(pages), length, pages[0].shape[1])), np.zeros((len(pages), length))
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def meaning(leaves: list) -> np.ndarray:
    """1 for blocks whose path says content, 0 for the rest; without any content element all but boilerplate is content."""
    names = [{n for e in path for n in e} for path, _, _ in leaves]
    plain = np.array([not n & BOILERPLATE for n in names], float)
    inside = np.array([bool(n & CONTENT) for n in names], float)
    return plain * inside if inside.any() else plain


def _wrap(spec: str) -> tuple:
    parts = [re.match(r"([a-z0-9]+)(.*)", s) for s in spec.split()]
    return tuple(element(p[1], " ".join(f'class="{n[1:]}"' if n[0] == "." else f'id="{n[1:]}"'
                                        for n in re.findall(r"[.#][\w-]+", p[2]))) for p in parts)


def _placed(spec: str, rng: np.random.Generator) -> tuple:
    """The wrapping of a boilerplate block; at times text stands in it without a paragraph, and a link ends before its block."""
    path = _wrap(spec)
    return path[:-1] if len(path) > 1 and path[-1][0] in ("a", "p") and rng.random() < 0.6 else path


def rewrapped(leaves: list, labels: np.ndarray, other: list[str], rng: np.random.Generator) -> tuple[list, np.ndarray]:
    """The page with its content in another wrapping, and with boilerplate blocks of other pages' texts around and in it."""
    top = (("html",), ("body",)) if rng.random() < 0.8 else ()
    content = [(path, text, linked) for (path, text, linked), y in zip(leaves, labels) if y]
    wrap = _wrap(CONTENT_WRAPS[rng.integers(len(CONTENT_WRAPS))])
    out: list = []

    def boilerplate(where: str, inside: tuple = ()) -> None:
        spec = BOILERPLATE_WRAPS[where][rng.integers(len(BOILERPLATE_WRAPS[where]))]
        for _ in range(rng.integers(1, 7 if spec.endswith(" a") or "p" in spec else 2)):
            text = other[rng.integers(len(other))]
            if spec.endswith((" a", "label", "button")):
                text = " ".join(text.split()[: rng.integers(1, 5)])
            out.append(((*top, *inside, *_placed(spec, rng)), text, len(text) if spec.endswith(" a") else 0, 0.0))

    for _ in range(rng.integers(0, 4)):
        boilerplate("start")
    for n, (path, text, linked) in enumerate(content):
        if n and rng.random() < 0.08:
            boilerplate("inside", wrap if rng.random() < 0.7 else ())
        leaf = path[-1:] if path and path[-1][0] in ("p", "h1", "h2", "h3", "li", "blockquote", "pre", "td") else (("p",),)
        out.append(((*top, *wrap, *leaf), text, linked, 1.0))
    for _ in range(rng.integers(0, 4)):
        boilerplate("end")
    return [o[:3] for o in out], np.array([o[3] for o in out])


#: Short pages made of each page.
SHORT_COPIES = 6
#: Wrappings of short pages; a dot alone stands for a class without a meaning.
SHORT_WRAPS = ["", "body", "html body", "body div", "body div.", "div.", "table tr td", "body table tr td", "body section.", "body article",
               "body div. div.", "body main"]


def shortened(leaves: list, labels: np.ndarray, other: list[str], rng: np.random.Generator) -> tuple[list, np.ndarray]:
    """A page of one or two content blocks, bare or in a wrapping without a known name, at times beside one block of boilerplate."""
    content = [leaf for leaf, y in zip(leaves, labels) if y]
    if not content:
        return [], np.zeros(0)
    at = rng.integers(len(content))
    spec = re.sub(r"\.(?= |$)", lambda m: f".c{rng.integers(10 ** 6)}", SHORT_WRAPS[rng.integers(len(SHORT_WRAPS))])
    wrap = _wrap(spec) if spec else ()
    leaf = (("p",),) if rng.random() < 0.5 else ()
    out = [((*wrap, *leaf), text, linked, 1.0) for _, text, linked in content[at: at + rng.integers(1, 3)]]
    if rng.random() < 0.6:
        where = ("start", "end")[rng.integers(2)]
        spec = BOILERPLATE_WRAPS[where][rng.integers(len(BOILERPLATE_WRAPS[where]))]
        text = " ".join(other[rng.integers(len(other))].split()[: rng.integers(1, 9)])
        extra = (_placed(spec, rng), text, len(text) if spec.endswith(" a") else 0, 0.0)
        out = [extra, *out] if where == "start" else [*out, extra]
    return [o[:3] for o in out], np.array([o[3] for o in out])


def fit_labeller(pages: list[str], seed: int = 7) -> Labeller:
    """A labeller trained on the pages as they are, rewrapped, and cut to one or two blocks."""
    rng, vectors, model = np.random.default_rng(seed), Vectors(), Labeller()
    parsed = [p for p in map(blocks, pages) if p]
    labels = [meaning(p) for p in parsed]
    texts = [text[:400] for p in parsed for _, text, _ in p]    # words for made-up boilerplate only
    seen = [(vectors(p), y) for p, y in zip(parsed, labels)]
    for p, y in zip(parsed, labels):
        for made in (rewrapped, *[shortened] * SHORT_COPIES):
            moved, of = made(p, y, texts, rng)
            if moved:
                seen.append((vectors(moved), of))
    if seen:
        model.fit(seen, seed=seed)
    return model


def main_texts(model: Labeller, vectors: Vectors, pages: list[str | None]) -> list[str]:
    """The content of each page: its blocks in page order, joined by one space."""
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if parsed[i]), key=lambda i: len(parsed[i]))
    while order:
        # pages of like length together, at most 64 pages or some 20,000 blocks with padding
        size = max(1, min(64, 20_000 // len(parsed[order[-1]])))
        some, order = order[-size:], order[:-size]
        x, mask = padded([vectors(parsed[i]) for i in some])
        for i, logit in zip(some, model.logits(x, mask)):
            out[i] = " ".join(leaf[1] for leaf, z in zip(parsed[i], logit) if z >= 0)
    return out


def train(pages: DataFrame, id_col: str, html_col: str, sample_pages: int) -> Labeller:
    order = F.xxhash64(F.col(f"`{id_col}`").cast("string"))
    sample = (pages.select(text_of(html_col).alias("html"), order.alias("order")).orderBy("order", F.length("html"))
              .limit(sample_pages).select("html").repartition(1))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = fit_labeller(sorted(h for b in batches for h in b["html"]))
        yield pd.DataFrame({"name": list(model.w), "w": [w.ravel().tolist() for w in model.w.values()]})

    shapes = {k: v.shape for k, v in Labeller().w.items()}
    learnt = {r["name"]: np.array(r["w"]).reshape(shapes[r["name"]])
              for r in sample.mapInPandas(learn, "name string, w array<double>").collect()}
    return Labeller(learnt or None)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            sample_pages: int = 400) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    model = pages.sparkSession.sparkContext.broadcast(train(pages, id_col, html_col, sample_pages).w)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), text_of(html_col).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, vectors = Labeller(model.value), Vectors()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                some = batch.slice(low, 512)
                texts = main_texts(labeller, vectors, some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
    return rows.mapInArrow(read, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
