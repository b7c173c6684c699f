"""Main text of web pages by a recurrent labeller of text blocks.

A page is read as the sequence of its leaf blocks: texts between tags that break a line. A block
has a tag-path vector (hashed tags, classes, ids and roles of all elements around it), a hashed-word
vector and a few ratios. A bidirectional LSTM in numpy reads the whole sequence and says for each
block whether it belongs to the article.

The labeller is trained on a bounded sample of the given pages. Pages that mark their article give their
own blocks. From the same texts, further pages are composed with other containers, class names and
boilerplate, whose labels are known, so that it doesn't hang on one template.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh32_intdigest

from flowvigil.llm.shared import remembering, small_batches
from flowvigil.staging import Staging

#: Elements of HTML by what they do to text.
RAW = "script style iframe".split()
#: Elements whose text is not shown, read like all others: what they hold ends where the page says so.
SILENT = frozenset("head noscript template svg object canvas audio video annotation annotation-xml".split())
#: What <head> holds; any other element, or text, closes it.
IN_HEAD = frozenset("base link meta title noscript template".split())
#: Elements that can't be in <svg> and close it, but for those in which other HTML may stand.
NOT_IN_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_IN_SVG = frozenset("foreignobject desc title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br "
    "math mfrac mi mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder "
    "munderover mmultiscripts menclose semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCKS = "p"
CLOSED_BY_ITSELF = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select",),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    # A start tag of these with an open quote: its content is no text either.
    r"|<(?P<torn>" + "|".join(RAW) + r")(?=[\s/>])(?![^<>\"']*>)[^>]*>.*?(?:</(?P=torn)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role|data-gold)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")

PATH_BUCKETS, WORD_BUCKETS = 1 << 11, 1 << 12
PATH_WIDTH, WORD_WIDTH, RATIOS, HIDDEN = 12, 8, 5, 12
#: Pages that the labeller is fitted on at most, and the largest such page in characters and blocks.
FIT_PAGES, FIT_CHARS, FIT_BLOCKS = 200, 100_000, 120
#: Composed pages for each given page, and in all at least.
COMPOSED, COMPOSED_LEAST = 3, 600
EPOCHS, BATCH = 24, 32
REMEMBERED = 200_000
#: Blocks labelled in one padded batch, about.
LABELLED = 8192


#: Parts of a compound class that tell of a state of the page, not of what an element holds.
STATES = frozenset("has no not with without is show hide hidden open closed on off enabled disabled fixed dark light".split())


@functools.lru_cache(4096)
def class_names(name: str) -> tuple[str, ...]:
    """A class by its letters; a compound one whole and, unless it tells of a state, in its parts, which are marked."""
    parts = PART.findall(name)
    if len(parts) < 2:
        return tuple(parts)
    return ("-".join(parts), *(() if STATES & set(parts) else ["~" + x for x in parts]))


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]
    linked: int
    gold: bool


def leaves(page: str) -> list[Leaf]:
    """Non-empty leaf blocks of a page in order; references decoded, white space run together."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...], bool | None]] = []
    pieces: list[str] = []
    state = {"links": 0, "linked": 0, "silent": False}

    def cut(i: int) -> None:
        """Close all elements from the i-th on."""
        del stack[i:]
        state["links"] = 0
        state["silent"] = any(x[0] in SILENT for x in stack)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                path = tuple(chain.from_iterable(x[1] for x in stack))
                gold = next((x[2] for x in reversed(stack) if x[2] is not None), False)
                out.append(Leaf(text, path, min(state["linked"], len(text)), gold))
            pieces.clear()
        state["linked"] = 0

    def close_before(tag: str) -> None:
        """Close <head> and <svg> where an element that can't be in them, or text in <head>, begins."""
        if not state["silent"]:
            return
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            cut(len(stack) - 1)
        names = [x[0] for x in stack]
        if tag == "body" and "head" in names:
            cut(names.index("head"))
        elif tag in NOT_IN_SVG and "svg" in names:
            i = len(names) - 1 - names[::-1].index("svg")
            if HTML_IN_SVG.isdisjoint(names[i:]):
                cut(i)

    def take(text: str) -> None:
        if state["silent"] and text.strip():
            close_before("")
        if text and not state["silent"]:
            pieces.append(text)
            if state["links"]:
                state["linked"] += len(text)

    at = 0
    for found in TOKEN.finditer(page):
        take(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            if found["raw"] or found["torn"]:
                flush()
            continue
        tag = tag.lower()
        if not found["end"]:
            close_before(tag)
        if tag in INLINE:
            if state["silent"]:
                continue
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                state["links"] = max(0, state["links"] + (-1 if found["end"] else 1))
            continue
        flush()
        if found["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    cut(i)
                    break
            continue
        closing, bounds = (tag, CLOSED_BY_ITSELF[tag]) if tag in CLOSED_BY_ITSELF else (CLOSED_BY_BLOCKS, ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in bounds or stack[i][0] in SILENT:
                break
            if stack[i][0] == closing:
                cut(i)
                break
        if tag in VOID or found["attributes"].endswith("/"):
            continue
        names, gold = ["<" + tag], None
        for name, *values in NAMED.findall(found["attributes"]):
            value = "".join(values).lower()
            if name.lower() == "data-gold":
                gold = value == "1"
            else:
                names += chain.from_iterable(map(class_names, value.split()))
        stack.append((tag, tuple(names), gold))
        state["silent"] = state["silent"] or tag in SILENT
    take(page[at:])
    flush()
    return out


_WORDS: dict[str, int] = {}


def _word_ids(words: list[str]) -> list[int]:
    remembering("extraction", _WORDS.clear)
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    known = _WORDS
    for w in words:
        if w not in known:
            known[w] = xxh32_intdigest(w.lower()) % WORD_BUCKETS
    return [known[w] for w in words]


@dataclass
class Encoded:
    """Bags of hashed path parts and words of every block, one after another, and the blocks' ratios."""

    paths: np.ndarray
    path_counts: np.ndarray
    words: np.ndarray
    word_counts: np.ndarray
    ratios: np.ndarray


def shared_path(page: list[Leaf]) -> int:
    """How many names all blocks' paths begin with: those of <body> and of wrappers around everything."""
    first, last = min((x.path for x in page), default=()), max((x.path for x in page), default=())
    return next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))


def encode(page: list[Leaf]) -> Encoded:
    paths, words, ratios = [], [], []
    shared = shared_path(page)
    # What all blocks share tells them apart from nothing; it has names of its own.
    around = {"page:" + x for x in page[0].path[:shared] if x[0] == "<"} if page else set()
    for i, leaf in enumerate(page):
        named = {*around, *leaf.path[shared:], "=" + leaf.path[-1] if leaf.path else "="}
        paths.append([xxh32_intdigest(x) % PATH_BUCKETS for x in sorted(named)])
        own = leaf.text.split()
        words.append(_word_ids(own))
        ratios.append(
            (
                math.log1p(len(own)) / 5,
                leaf.linked / max(1, len(leaf.text)),
                leaf.text[-1] in ".!?…",
                sum(w[0].isupper() for w in own) / len(own),
                i / len(page),
            )
        )
    count = lambda bags: np.array([len(x) for x in bags], dtype=np.int64)
    return Encoded(
        np.fromiter(chain.from_iterable(paths), dtype=np.int64),
        count(paths),
        np.fromiter(chain.from_iterable(words), dtype=np.int64),
        count(words),
        np.array(ratios, dtype=np.float32).reshape(-1, RATIOS),
    )


def _means(table: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean row of each bag; no bag is empty."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return np.add.reduceat(table[ids], starts, axis=0) / counts[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Labeller:
    """Bidirectional LSTM over the blocks of a page with one logit per block."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        width = PATH_WIDTH + WORD_WIDTH + RATIOS
        normal = lambda *shape, scale=0.3: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "path": normal(PATH_BUCKETS, PATH_WIDTH, scale=0.5),
            "word": normal(WORD_BUCKETS, WORD_WIDTH, scale=0.1),
            "out": normal(2 * HIDDEN + width, scale=0.2),
            "bias": np.zeros(1, dtype=np.float32),
        }
        for way in ("forth", "back"):
            self.p[way + "_x"] = normal(width, 4 * HIDDEN)
            self.p[way + "_h"] = normal(HIDDEN, 4 * HIDDEN)
            self.p[way + "_b"] = np.zeros(4 * HIDDEN, dtype=np.float32)
            self.p[way + "_b"][HIDDEN : 2 * HIDDEN] = 1.0

    def inputs(self, page: Encoded) -> np.ndarray:
        return np.concatenate(
            [
                _means(self.p["path"], page.paths, page.path_counts),
                _means(self.p["word"], page.words, page.word_counts),
                page.ratios,
            ],
            axis=1,
        )

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        steps, size, _ = x.shape
        projected = x @ self.p[way + "_x"] + self.p[way + "_b"]
        h, c = np.zeros((size, HIDDEN), np.float32), np.zeros((size, HIDDEN), np.float32)
        out, tape = np.zeros((steps, size, HIDDEN), np.float32), []
        for t in range(steps):
            z = projected[t] + h @ self.p[way + "_h"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            if keep:
                tape.append((h, c, i, f, o, g, squashed, m))
            c = m * new_c + (1 - m) * c
            h = m * (o * squashed) + (1 - m) * h
            out[t] = h
        return out, tape

    def _run_back(self, x: np.ndarray, way: str, tape: list, d_out: np.ndarray, grads: dict) -> np.ndarray:
        d_h, d_c = np.zeros_like(tape[0][0]), np.zeros_like(tape[0][0])
        d_z = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        for t in range(len(tape) - 1, -1, -1):
            h, c, i, f, o, g, squashed, m = tape[t]
            d_h = d_h + d_out[t]
            new_h, new_c = d_h * m, d_c * m + d_h * m * o * (1 - squashed**2)
            z = np.concatenate(
                [new_c * g * i * (1 - i), new_c * c * f * (1 - f), new_h * squashed * o * (1 - o), new_c * i * (1 - g**2)], axis=1
            )
            d_z[t] = z
            grads[way + "_h"] += h.T @ z
            d_h = d_h * (1 - m) + z @ self.p[way + "_h"].T
            d_c = d_c * (1 - m) + new_c * f
        flat = d_z.reshape(-1, 4 * HIDDEN)
        grads[way + "_x"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[way + "_b"] += flat.sum(axis=0)
        return d_z @ self.p[way + "_x"].T

    @staticmethod
    def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(len(r) for r in rows)
        x = np.zeros((longest, len(rows), rows[0].shape[1]), np.float32)
        mask = np.zeros((longest, len(rows)), np.float32)
        for j, r in enumerate(rows):
            x[: len(r), j], mask[: len(r), j] = r, 1
        return x, mask

    def logits(self, pages: list[Encoded]) -> list[np.ndarray]:
        """Logits of every block; pages without blocks give empty arrays."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i].ratios)), key=lambda i: len(pages[i].ratios))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]].ratios) <= LABELLED:
                end += 1
            rows = [self.inputs(pages[i]) for i in order[at:end]]
            x, mask = self._padded(rows)
            forth, _ = self._run(x, mask, "forth", False)
            back, _ = self._run(x[::-1], mask[::-1], "back", False)
            seen = np.concatenate([forth, back[::-1], x], axis=2) @ self.p["out"] + self.p["bias"]
            for j, i in enumerate(order[at:end]):
                out[i] = seen[: len(rows[j]), j]
            at = end
        return out

    def train(self, pages: list[Encoded], labels: list[np.ndarray], seed: int = 11) -> None:
        rng, p = np.random.default_rng(seed), self.p
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        order, step = np.argsort([len(x) for x in labels], kind="stable"), 0
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for _ in range(EPOCHS):
            for b in rng.permutation(len(batches)):
                rows = [self.inputs(pages[i]) for i in batches[b]]
                x, mask = self._padded(rows)
                y, _ = self._padded([labels[i][:, None].astype(np.float32) for i in batches[b]])
                forth, tape_f = self._run(x, mask, "forth", True)
                back, tape_b = self._run(x[::-1], mask[::-1], "back", True)
                seen = np.concatenate([forth, back[::-1], x], axis=2)
                error = (_sigmoid(seen @ p["out"] + p["bias"]) - y[:, :, 0]) * mask / mask.sum()
                grads = {k: np.zeros_like(v) for k, v in p.items()}
                grads["out"] = np.einsum("tb,tbd->d", error, seen)
                grads["bias"] = error.sum(keepdims=True).reshape(1)
                d_seen = error[:, :, None] * p["out"]
                d_x = d_seen[:, :, 2 * HIDDEN :].copy()
                d_x += self._run_back(x, "forth", tape_f, d_seen[:, :, :HIDDEN], grads)
                d_x += self._run_back(x[::-1], "back", tape_b, d_seen[::-1, :, HIDDEN : 2 * HIDDEN], grads)[::-1]
                for j, i in enumerate(batches[b]):
                    own, page = d_x[: len(rows[j]), j], pages[i]
                    for name, ids, counts, part in (
                        ("path", page.paths, page.path_counts, own[:, :PATH_WIDTH]),
                        ("word", page.words, page.word_counts, own[:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH]),
                    ):
                        np.add.at(grads[name], ids, np.repeat(part / counts[:, None], counts, axis=0))
                step += 1
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.002 * (g * g - second[k])
                    p[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.998**step)) + 1e-7)


#: Names that pages commonly give their parts; used to compose training pages.
MAIN = ["article", "main", "div class='content'", "div class='post'", "div id='main'", "section class='article-body'",
        "div class='entry-content'", "div class='story'", "div role='main'"]
BEFORE = ["nav", "header", "ul class='menu'", "div class='nav'", "div class='ad'", "div class='cookie-notice'",
          "div class='banner'", "div id='header'", "div class='notice'", "aside", "form", "div class='breadcrumb'"]
AFTER = ["footer", "aside", "div class='sidebar'", "div class='comments'", "section id='comments'", "div class='ad'",
         "div class='related'", "form class='newsletter'", "div id='footer'", "ol class='comment-list'", "div class='share'",
         "div class='advert'", "nav"]
MARKED = {"<article", "<main"}
NOT_MAIN = {
    "<nav", "<header", "<footer", "<aside", "<form", "<button", "<select", "ad", "ads", "advert", "comment", "comments",
    "sidebar", "notice", "cookie", "menu", "banner", "share", "related",
}

#: Classes that say how a page is set up; pages give them to <body> and to wrappers.
SETUP = ["has-sidebar", "no-banner", "with-comments", "no-ads", "page", "home", "single", "post-template", "menu-open", "no-cookie-notice",
         "header-fixed", "footer-dark", "share-enabled", "container", "related-on", "two-column", "layout", "nav-left", "form-page"]


def weak_labels(page: list[Leaf]) -> np.ndarray | None:
    """Labels of a page that marks its article; None if it doesn't."""
    if not any(MARKED & set(leaf.path) for leaf in page):
        return None
    shared = shared_path(page)
    return np.array([bool(MARKED & set(x.path)) and not NOT_MAIN & {n.lstrip("~") for n in x.path[shared:]} for x in page])


def composed(texts: list[str], rng: random.Random) -> str:
    """A page of these texts in some template; ``data-gold`` marks what its article is."""
    texts = [html.escape(x) for x in texts]

    def some(names: list[str], most: int) -> str:
        out = []
        for name in rng.sample(names, rng.randint(1, most)):
            tag, kind, body = name.split()[0], rng.randrange(3), []
            for _ in range(rng.randint(1, 5)):
                words = rng.choice(texts).split()
                start = rng.randrange(len(words))
                text = " ".join(words[start : start + (rng.randint(1, 4) if kind == 0 else rng.randint(3, 40))])
                if tag in ("ul", "ol") or kind == 0 and tag in ("nav", "div", "footer", "header"):
                    body.append(f"<li><a href='/'>{text}</a></li>" if kind == 0 else f"<li>{text}</li>")
                else:
                    body.append(text if kind == 2 else f"<p>{text}</p>")
            out.append(f"<{name} data-gold='0'>{''.join(body)}</{tag}>")
        return "".join(out)

    # Some blocks of an article are as short as those of a menu or footer, wherever they stand.
    texts = [" ".join(x.split()[: rng.randint(1, 4)]) if rng.random() < 0.2 else x for x in texts]
    main = rng.choice(MAIN)

    def block(text: str) -> str:
        kind = rng.random()
        if len(text) < 80 and kind < 0.3:
            return f"<h2>{text}</h2>"
        if kind < 0.7:
            return f"<p>{text}</p>"
        shape = rng.choice(ARTICLE_BLOCKS)
        words = text.split()
        half = len(words) // 2
        return shape.format(text, " ".join(words[:half]) or text, " ".join(words[half:]))

    body = "".join(map(block, texts))
    inside = some(AFTER, 3) if rng.random() < 0.5 else some([x for x in AFTER if "comment" in x], 1) if rng.random() < 0.3 else ""
    within = f"<{main} data-gold='1'>{body}{inside}</{main.split()[0]}>"

    def setup() -> str:
        return " ".join(rng.sample(SETUP, rng.randint(1, 4)))

    def wrapped(inner: str, share: float) -> str:
        if rng.random() >= share:
            return inner
        tag = "form" if rng.random() < 0.25 else rng.choice(["div", "div", "section", "table"])
        opened = f"<{tag} id='{rng.choice(['wrapper', 'aspnet', 'page', 'root'])}' class='{setup()}'>"
        return opened + (f"<tr><td>{inner}</td></tr>" if tag == "table" else inner) + f"</{tag}>"

    page = some(BEFORE, 4), wrapped(within, 0.3), some(AFTER, 4)
    # Some pages are an article and nothing else.
    page = page if rng.random() < 0.75 else ("", within, "")
    whole = wrapped(page[0] + wrapped(page[1] + page[2], 0.3), 0.3)
    if rng.random() < 0.2:
        return whole
    attributes = f" class='{setup()}'" if rng.random() < 0.5 else ""
    made = f"<title>{texts[0]}</title><body{attributes}>{whole}</body>"
    return f"<html>{made}</html>" if rng.random() < 0.5 else made


#: Blocks of an article beside paragraphs and headings: of the whole text, or of its halves.
ARTICLE_BLOCKS = ["<blockquote>{0}</blockquote>", "<blockquote><p>{0}</p></blockquote>", "<ul><li>{0}</li></ul>", "<ul><li>{1}</li><li>{2}</li></ul>",
                  "<ol><li>{1}</li><li>{2}</li></ol>", "<pre>{0}</pre>", "<pre><code>{0}</code></pre>", "<table><tr><td>{1}</td><td>{2}</td></tr></table>",
                  "<table><thead><tr><th>{1}</th></tr></thead><tbody><tr><td>{2}</td></tr></tbody></table>", "<dl><dt>{1}</dt><dd>{2}</dd></dl>",
                  "<figure><figcaption>{0}</figcaption></figure>", "<div>{0}</div>", "<section><p>{0}</p></section>", "<h3>{1}</h3><p>{2}</p>"]


def fit(pages: DataFrame, staging: Staging, html_column: str = "html", id_column: str = "page_id") -> Labeller:
    """Labeller trained on at most ``FIT_PAGES`` pages, chosen by a hash of id and page.

    Pages of more than ``FIT_CHARS`` characters or ``FIT_BLOCKS`` blocks are not trained on; they are
    labelled like all others. Without any usable page it is trained on composed filler texts.
    """
    usable = pages.where(F.length(html_column).between(1, FIT_CHARS)).select(
        F.col(html_column).cast("string").alias("html"), F.xxhash64(F.col(id_column), F.col(html_column)).alias("place")
    )
    keys = staging.table(usable.select("place").orderBy("place").limit(FIT_PAGES), "fit-pages")
    sample = sorted(r.html for r in usable.join(keys, "place", "left_semi").dropDuplicates(["place"]).collect())
    labeller, (encoded, labels) = Labeller(), training_pages(sample)
    if encoded:
        labeller.train(encoded, labels)
    return labeller


def training_pages(sample: list[str]) -> tuple[list[Encoded], list[np.ndarray]]:
    """The given pages that mark their article, and pages composed of all their texts, with labels."""
    rng, encoded, labels = random.Random(3), [], []
    filler = ["A page with some words that stand for a text.", "It has a second sentence, and then a third one."]
    each = max(COMPOSED, -(-COMPOSED_LEAST // max(1, len(sample))))
    for given in sample or ["<p>" + x for x in filler]:
        found = leaves(given)
        if not found or len(found) > FIT_BLOCKS:
            continue
        own = weak_labels(found)
        if own is not None:
            encoded.append(encode(found))
            labels.append(own)
        texts = [x.text for x, good in zip(found, own) if good] if own is not None else []
        for _ in range(each):
            made = leaves(composed(texts or filler, rng))
            encoded.append(encode(made))
            labels.append(np.array([x.gold for x in made]))
    return encoded, labels


def extract(
    pages: DataFrame, labeller: Labeller, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every row, in whole.

    The text has the article's blocks in page order, one to a line. A null or empty page, and one
    without article blocks, has an empty text. Ids and addresses are passed on, null too.
    """
    rows = small_batches(pages).select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                read = [leaves(x) for x in part.column("html").to_pylist()]
                found = labeller.logits([encode(x) for x in read])
                texts = ["\n".join(x.text for x, good in zip(page, own) if good > 0) for page, own in zip(read, found)]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, texts)), pa.int64())], schema=arrow)

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
