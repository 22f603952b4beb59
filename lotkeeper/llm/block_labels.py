"""Main text of pages by a recurrent block labeller.

A bidirectional LSTM, written in numpy, reads a page's leaf blocks in order, each as a vector of its tag path, its
hashed words and a few figures, and says of every block whether it belongs to the article. No labelled pages
exist, so the network learns from layouts put together from blocks of a bounded sample of pages:
an article among menus, headers, footers, sidebars, notices, adverts, forms and reader comments, under changing
elements and names, now and then without any name that gives them away. Every page of the table is read whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotkeeper.llm.html_blocks import Block, read_blocks
from lotkeeper.llm.words import sample

#: Pages whose text the training layouts are made of, by order of a hash of the id; layouts and passes over them.
SAMPLE_PAGES = 300
LAYOUTS, EPOCHS = 2_000, 8
PATHS, WORDS, FIGURES = 1024, 1024, 8
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 4, 16
BATCH = 64
SEED = 20240811

#: Containers of what surrounds an article: elements and the names pages give them.
AROUND = {
    "menu": (("nav", "ul", "div"), ("menu", "nav", "navbar", "navigation", "breadcrumb", "topnav", "tabs", "links", "toc")),
    "header": (("header", "div"), ("header", "masthead", "top", "branding", "site header", "logo", "banner top")),
    "footer": (("footer", "div"), ("footer", "bottom", "site footer", "copyright", "colophon", "legal")),
    "sidebar": (("aside", "div", "section"), ("sidebar", "side", "widget", "related", "aside", "rail", "trending", "popular", "recommended")),
    "notice": (("div", "section", "aside", "p"), ("notice", "cookie", "consent", "alert", "gdpr", "banner", "modal", "popup", "message", "warning", "disclaimer", "newsletter", "paywall")),
    "advert": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adbox", "dfp")),
    "form": (("form", "div"), ("form", "search", "login", "subscribe", "signup", "contact")),
    "comments": (("section", "div", "ol"), ("comments", "comment", "replies", "reply", "respond", "discussion", "disqus", "responses", "feedback")),
    "share": (("div", "ul"), ("share", "social", "sharing", "tags", "tools", "follow", "meta", "byline")),
}
MAIN = (("article",), ("main",), ("article", "div"), ("main", "article"), ("div",), ("section",), ("article", "section"))
MAIN_NAMES = ("content", "main", "article", "post", "entry", "story", "body", "text", "entry content", "post body", "")

_bucket: dict[str, int] = {}


def _hash(token: str, size: int) -> int:
    found = _bucket.get(token)
    if found is None:
        if len(_bucket) > 500_000:
            _bucket.clear()
        found = _bucket[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
    return found % size


def vectors(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Path buckets and their blocks, word buckets and their blocks, and the figures of every block."""
    paths, path_of, words, word_of, figures = [], [], [], [], []
    n = len(blocks)
    for i, block in enumerate(blocks):
        for token in dict.fromkeys(block.path):
            paths.append(_hash(token, PATHS))
            path_of.append(i)
        if block.path:
            paths.append(_hash("last " + block.path[-1], PATHS))
            path_of.append(i)
        found = block.text.lower().split()
        for word in found:
            words.append(_hash(word, WORDS))
            word_of.append(i)
        size = len(block.text)
        figures.append((1.0, np.log1p(len(found)) / 4, np.log1p(size) / 6, block.linked / size, i / n, min(n, 100) / 100,
                        float(block.text[-1] in ".!?…"), sum(map(block.text.count, "0123456789")) / size))
    return (np.asarray(paths, np.int64), np.asarray(path_of, np.int64), np.asarray(words, np.int64),
            np.asarray(word_of, np.int64), np.asarray(figures, float).reshape(-1, FIGURES))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings of path and words, an LSTM in each direction, and a logistic output for every block."""

    def __init__(self, rng: np.random.Generator):
        inputs = PATH_SIZE + WORD_SIZE + FIGURES
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"path": rng.normal(0, 0.3, (PATHS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORDS, WORD_SIZE)),
                  "out": draw(2 * HIDDEN + inputs, 1), "bias": np.zeros(1)}
        for side in ("f", "b"):
            self.p["w" + side], self.p["u" + side] = draw(inputs, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
            self.p["c" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def embed(self, page) -> np.ndarray:
        paths, path_of, words, word_of, figures = page
        n = len(figures)
        one, two = np.zeros((n, PATH_SIZE)), np.zeros((n, WORD_SIZE))
        np.add.at(one, path_of, self.p["path"][paths])
        np.add.at(two, word_of, self.p["word"][words])
        scale = np.sqrt(np.maximum(np.bincount(word_of, minlength=n), 1))[:, None]
        return np.concatenate([one, two / scale, figures], axis=1)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray) -> list:
        """Steps of one direction over (time, batch, input); every step keeps what learning needs."""
        w, u, c = self.p["w" + side], self.p["u" + side], self.p["c" + side]
        times = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        h, s = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        drive, steps = x @ w + c, [None] * len(x)
        for t in times:
            gates = drive[t] + h @ u
            i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            fresh = f * s + i * g
            m = mask[t][:, None]
            steps[t] = (h, s, i, f, o, g, fresh, m)
            s = m * fresh + (1 - m) * s
            h = m * (o * np.tanh(fresh)) + (1 - m) * h
            steps[t] += (h,)
        return steps

    def _learn(self, side: str, x: np.ndarray, steps: list, dh_out: np.ndarray, grads: dict) -> np.ndarray:
        w, u = self.p["w" + side], self.p["u" + side]
        dx, dh, ds = np.zeros_like(x), np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        times = range(len(x) - 1, -1, -1) if side == "f" else range(len(x))
        for t in times:
            h, s, i, f, o, g, fresh, m, _ = steps[t]
            dh = dh + dh_out[t]
            tanh = np.tanh(fresh)
            own = dh * m
            dfresh = ds * m + own * o * (1 - tanh**2)
            dgates = np.concatenate([dfresh * g * i * (1 - i), dfresh * s * f * (1 - f), own * tanh * o * (1 - o),
                                     dfresh * i * (1 - g**2)], axis=1)
            grads["w" + side] += x[t].T @ dgates
            grads["u" + side] += h.T @ dgates
            grads["c" + side] += dgates.sum(0)
            dx[t] = dgates @ w.T
            dh = dh * (1 - m) + dgates @ u.T
            ds = ds * (1 - m) + dfresh * f
        return dx

    def forward(self, pages: list) -> tuple:
        embedded = [self.embed(p) for p in pages]
        longest = max(len(e) for e in embedded)
        x, mask = np.zeros((longest, len(pages), embedded[0].shape[1])), np.zeros((longest, len(pages)))
        for k, e in enumerate(embedded):
            x[:len(e), k], mask[:len(e), k] = e, 1
        ahead, back = self._run("f", x, mask), self._run("b", x, mask)
        joined = np.concatenate([np.stack([s[-1] for s in ahead]), np.stack([s[-1] for s in back]), x], axis=2)
        return x, mask, ahead, back, joined, _sigmoid((joined @ self.p["out"])[..., 0] + self.p["bias"])

    def step(self, pages: list, labels: list) -> dict:
        x, mask, ahead, back, joined, p = self.forward(pages)
        y = np.zeros_like(p)
        for k, own in enumerate(labels):
            y[:len(own), k] = own
        d = (p - y) * mask / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"][:, 0] = np.tensordot(d, joined, axes=([0, 1], [0, 1]))
        grads["bias"][0] = d.sum()
        dj = d[..., None] * self.p["out"][:, 0]
        dx = dj[..., 2 * HIDDEN:] + self._learn("f", x, ahead, dj[..., :HIDDEN], grads) + self._learn(
            "b", x, back, dj[..., HIDDEN:2 * HIDDEN], grads)
        for k, (paths, path_of, words, word_of, figures) in enumerate(pages):
            scale = np.sqrt(np.maximum(np.bincount(word_of, minlength=len(figures)), 1))[:, None]
            np.add.at(grads["path"], paths, dx[:len(figures), k, :PATH_SIZE][path_of])
            np.add.at(grads["word"], words, (dx[:len(figures), k, PATH_SIZE:PATH_SIZE + WORD_SIZE] / scale)[word_of])
        return grads

    def fit(self, pages: list, labels: list, epochs: int, rng: np.random.Generator) -> None:
        """Adam over batches of pages of similar length."""
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        order, t = np.argsort([len(p[-1]) for p in pages], kind="stable"), 0
        batches = [order[i:i + 32] for i in range(0, len(order), 32)]
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            for b in rng.permutation(len(batches)):
                t += 1
                grads = self.step([pages[i] for i in batches[b]], [labels[i] for i in batches[b]])
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def probabilities(self, pages: list) -> list[np.ndarray]:
        """Of every block of every page; pages of similar length run together."""
        found: list = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i][-1])), key=lambda i: len(pages[i][-1]))
        at = 0
        while at < len(order):
            # a very long page runs with fewer others
            width = max(1, min(BATCH, 40_000 // len(pages[order[min(at + BATCH, len(order)) - 1]][-1])))
            part = order[at:at + width]
            p = self.forward([pages[i] for i in part])[-1]
            for k, i in enumerate(part):
                found[i] = p[:len(pages[i][-1]), k]
            at += width
        return found


def layouts(texts: list[str], n: int, rng: np.random.Generator) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Pages put together from lines of text, with the label of every block."""
    texts = texts or ["Text. More of it."]
    pick = lambda options: options[rng.integers(len(options))]

    def line(low: int, high: int) -> str:
        words = pick(texts).split()
        size = int(rng.integers(low, high + 1))
        start = int(rng.integers(max(1, len(words) - size + 1)))
        return " ".join(words[start:start + size]) or "Text"

    def named(tag: str, names: tuple[str, ...]) -> tuple[str, ...]:
        kinds = "ci" if rng.random() < 0.8 else "cir"
        found = pick(names)
        return (tag, *[f"{kinds[rng.integers(len(kinds))]}:{w}" for w in found.split()])

    def around(kind: str, outer: tuple[str, ...]) -> list[Block]:
        tags, names = AROUND[kind]
        tag = pick(tags)
        # a telling element or a telling name, or both
        path = outer + (named(tag, names) if tag in ("div", "section", "p", "ul", "ol") or rng.random() < 0.5 else (tag,))
        if kind in ("menu", "share"):
            inner = ("ul", "li") if path[-1] != "ul" and rng.random() < 0.7 else ("li",) if tag == "ul" else ()
            return [Block(t, path + inner, len(t)) for t in (line(1, 3) for _ in range(rng.integers(2, 9)))]
        if kind == "comments":
            extra = lambda: ("div", "c:comment") if rng.random() < 0.4 else ("li",) if tag == "ol" else ("p",)
            return [Block(line(4, 60), path + extra(), 0) for _ in range(rng.integers(1, 6))]
        found = []
        for _ in range(rng.integers(1, 5 if kind in ("sidebar", "footer", "form") else 3)):
            text = line(2, 30)
            inner = pick(((), ("p",), ("div",), ("ul", "li"), ("label",) if kind == "form" else ("h3",)))
            found.append(Block(text, path + inner, len(text) if rng.random() < 0.3 else 0))
        return found

    pages, labels = [], []
    for _ in range(n):
        outer = ("html", "body") + (("div", "c:wrapper") if rng.random() < 0.3 else ("div",) if rng.random() < 0.2 else ())
        tags = pick(MAIN)
        inside = outer + sum([(t, *([f"c:{w}" for w in pick(MAIN_NAMES).split()] if t in ("div", "section") or rng.random() < 0.2
                                    else [])) for t in tags], ())
        blocks: list[tuple[Block, int]] = []
        put = lambda found, label: blocks.extend((b, label) for b in found)
        for kind in ("notice", "header", "menu", "form", "advert", "sidebar"):
            if rng.random() < (0.75 if kind == "menu" else 0.4):
                put(around(kind, outer), 0)
        if rng.random() < 0.8:
            head = inside + (("header",) if rng.random() < 0.2 else ()) + ("h1",)
            put([Block(line(2, 14), head, 0)], 1)
        size = int(rng.integers(1, 6)) if rng.random() < 0.4 else int(rng.integers(4, 25))
        for _ in range(size):
            kind = rng.random()
            if kind < 0.06:
                put([Block(line(1, 8), inside + (pick(("h2", "h3", "h4")),), 0)], 1)
            elif kind < 0.12:
                put([Block(line(1, 20), inside + (pick(("ul", "ol")), "li"), 0) for _ in range(rng.integers(1, 5))], 1)
            elif kind < 0.16:
                put([Block(line(3, 40), inside + (pick(("blockquote", "pre", "td")),), 0)], 1)
            elif kind < 0.22:
                put(around(pick(("advert", "share", "sidebar", "notice", "form")), inside), 0)
            else:
                # short paragraphs are as much of the article as long ones, and may be links in part
                text = line(1, 6) if rng.random() < 0.3 else pick(texts)
                if rng.random() < 0.1:  # the same words over and over, or text that the page had before
                    text = " ".join([line(1, 2)] * int(rng.integers(2, 40))) if rng.random() < 0.5 else blocks[-1][0].text if blocks else text
                tail = () if rng.random() < 0.1 else ("p",)
                put([Block(text, inside + tail, int(len(text) * rng.random() * 0.4) if rng.random() < 0.15 else 0)], 1)
        for kind in ("share", "comments", "sidebar", "advert", "form", "menu", "footer"):
            if rng.random() < (0.75 if kind == "footer" else 0.35):
                put(around(kind, inside if kind in ("share", "comments") and rng.random() < 0.3 else outer), 0)
        pages.append([b for b, _ in blocks])
        labels.append(np.asarray([y for _, y in blocks], float))
    return pages, labels


def train(texts: list[str], count: int = LAYOUTS, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    rng = np.random.default_rng(seed)
    model = Labeller(rng)
    pages, labels = layouts(texts, count, rng)
    model.fit([vectors(p) for p in pages], labels, epochs, rng)
    return model


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", rows: int = SAMPLE_PAGES) -> Labeller:
    """Train on layouts of the lines of at most ``rows`` pages."""
    named = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where("html is not null")
    picked = sample(named, ["id"], rows).collect()
    lines = [b.text for r in sorted(picked, key=lambda r: (r["id"] is None, r["id"] or 0, r["html"])) for b in read_blocks(r["html"])]
    return train([t for t in lines if re.search(r"\w", t)])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              model: Labeller | None = None) -> DataFrame:
    """The main text of every page: id, url, text, n_chars, and blocks and chosen, how many there were and stayed.

    Blocks of the article are joined in page order by one line end, character references decoded, runs of blanks
    one space. Null and empty pages, and pages without an article, give empty text. Rows stay one to one,
    repeated and null ids too; other columns are ignored; an empty table gives none.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or learn(pages, id_col, html_col))

    def run(batches):
        labeller = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                read = [read_blocks(h.as_py()) for h in batch.column("html")]
                chosen = labeller.probabilities([vectors(b) for b in read])
                texts = ["\n".join(b.text for b, p in zip(blocks, own) if p >= 0.5) for blocks, own in zip(read, chosen)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in read], pa.int64()),
                     pa.array([int((p >= 0.5).sum()) for p in chosen], pa.int64())],
                    ["id", "url", "text", "n_chars", "blocks", "chosen"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long, blocks long, chosen long"
    ).withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
