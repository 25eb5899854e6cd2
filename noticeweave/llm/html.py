"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks (runs of text between block-level tags), each with its tag path. A bidirectional LSTM in numpy
reads, for each block, a hashed vector of its path's tags and class names, whether it is mostly link text, a hashed vector of its words, and
how it stands among the page's blocks (how much text its containers hold, what is like it), and labels it as main text or not with
the whole page as context. It is trained here, on a bounded sample of the pages. Texts of
the sample are laid out anew with articles and what surrounds them, so the label of each block is known from where it was put: the texts
are told apart by length and links, the names of containers are drawn from lists, and in a part of the layouts they say nothing. Sampled
pages that have an article or main element are trained on too, labelled by that markup.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.llm.memory import settling
from noticeweave.llm.words import word_hashes

#: Pages that the labeller is trained on at most, those with the smallest hashes of their urls.
SAMPLE = 160
#: Layouts built from the texts of a sampled page, and how many of its long and other texts they use; the page itself is trained on whole.
LAYOUTS, MAIN, OTHER = 12, 12, 20
#: Times that a sampled page with an article of its own is trained on, beside its layouts.
MARKED = 5
#: Words that a text has at least to be laid out as part of an article, unless it is mostly link text.
LONG = 12
PATH, WORDS, HIDDEN = 384, 32, 32
EPOCHS, RATE, SEED = 24, 0.02, 7

# Elements that end a block, that have no content, and that never hold main text.
BLOCKS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = set("script style template noscript head title iframe object svg math canvas".split())
APART = set("nav header footer aside form menu dialog button select textarea option label fieldset legend".split())
# Words in class, id and role that mark boilerplate.
MARKS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead comment comments respond reply replies disqus cookie cookies consent notice notices alert popup modal newsletter subscribe signup login share sharing social related recommended widget toolbar pagination pager copyright disclaimer form search tags meta byline complementary contentinfo".split())

# Words in class, id and role of a div or section that holds an article.
BODIES = set("article post entry story main".split())
# Words that name articles in layouts, alone or two together, and containers around everything.
NAMES, TAILS = ["article", "post", "entry", "story", "main", "content", "text", "body"], ["", "", "-content", "-body", "-text", "__main", " content"]
WRAPS = ["", "", "<div class=\"content\">", "<section class=\"body\">", "<div id=\"page\">", "<main id=\"main\">", "<main>", "<div>", "<div class=\"container\"><div class=\"row\">", "<div id=\"wrapper\" class=\"site\">"]

_TOKEN = re.compile(r"[a-z]+")


_PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*|[^>]*)>""", re.S)
_UNENDED = re.compile(r"<[!?].*", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
# Start tags that end an element left open: which elements, and within what.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "body": ({"head"}, set()),
}
_P_WITHIN = {"button", "td", "th", "object", "li", "div", "article", "section"}


# Elements that a head may hold; any other ends it.
_IN_HEAD = set("title meta link base script style noscript template head html basefont bgsound".split())


class Element:
    """An open tag: its words of class, id and role, its parent, and whether it lies in an article and apart from one by the page's own marks."""

    __slots__ = ("tag", "names", "parent", "depth", "inside", "apart", "vector")

    def __init__(self, tag: str, names: tuple[str, ...], parent: "Element | None"):
        self.tag, self.names, self.parent, self.vector = tag, names, parent, None
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or tag in ("div", "section") and any(w in BODIES for w in names) or bool(parent and parent.inside)
        self.apart = tag in APART or any(w in MARKS for w in names) or bool(parent and parent.apart)


class Place:
    """Where a block stands: its element (None at the top of a page), and whether most of its text stands in links."""

    __slots__ = ("element", "linked")

    def __init__(self, element: Element | None, linked: bool):
        self.element, self.linked = element, linked


def blocks(html: str | None) -> list[tuple[Place, str]]:
    """The page's leaf blocks (place, text) in order. Tags that are open are counted, so what has no open tag to end is not looked for."""
    html = html or ""
    path: list[Element] = []
    counts: dict[str, int] = {}
    out: list[tuple[Place, str]] = []
    text: list[str] = []
    at, hidden, linked = 0, 0, 0

    def close() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append((Place(path[-1] if path else None, 2 * linked > len(joined)), joined))
        text.clear()
        linked = 0

    def cut(i: int) -> None:
        nonlocal hidden
        while len(path) > i:
            tag = path.pop().tag
            counts[tag] -= 1
            hidden -= tag in HIDDEN_TAGS

    def innermost(tags: set[str], within: set[str]) -> int:
        if any(counts.get(t) for t in tags):
            for i in range(len(path) - 1, -1, -1):
                if path[i].tag in tags:
                    return i
                if path[i].tag in within:
                    break
        return -1

    last = html.rfind(">") + 1  # no tag ends behind it, so signs that open one are not looked at twice
    while at < len(html):
        piece = _PIECE.search(html, at, last) if at < last else _UNENDED.search(html, at)
        if not piece and at < last:
            piece = _UNENDED.search(html, last)
        end = piece.start() if piece else len(html)
        if end > at:
            data = html[at:end]
            if hidden and path and path[-1].tag == "head" and not data.isspace():
                cut(len(path) - 1)
            if not hidden:
                text.append(unescape(data) if "&" in data else data)
                if counts.get("a"):
                    linked += len(data.strip())
        if not piece:
            break
        at = piece.end()
        tag = piece[2] if piece.re is _PIECE else None
        if tag is None:
            if piece[0].startswith("<!--") and not piece[0].endswith("-->"):
                break
            continue
        tag = tag.lower()
        breaks = tag in BLOCKS or tag in HIDDEN_TAGS
        if breaks and text:
            close()
        if piece[1]:
            if counts.get(tag):
                for i in range(len(path) - 1, -1, -1):
                    if path[i].tag == tag:
                        cut(i)
                        break
                    if not breaks and path[i].tag in BLOCKS:
                        break
            continue
        if counts.get("head") and tag not in _IN_HEAD and path[-1].tag == "head":
            cut(len(path) - 1)
        if breaks:
            i = innermost(*_CLOSES[tag]) if tag in _CLOSES else -1
            if i < 0 and tag not in HIDDEN_TAGS:
                i = innermost({"p"}, _P_WITHIN)
            if i >= 0:
                cut(i)
        elif tag == "br":
            text.append(" ")
        elif tag == "a" and counts.get("a"):  # links don't nest
            i = innermost({"a"}, BLOCKS)
            if i >= 0:
                cut(i)
        if tag in VOID or piece[3].endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in _RAW_END:
            raw = _RAW_END[tag].search(html, at)
            at = raw.start() if raw else len(html)
        names = tuple(w for found in _NAMES.findall(piece[3]) for w in _TOKEN.findall("".join(found).lower())) if piece[3] else ()
        path.append(Element(tag, names, path[-1] if path else None))
        counts[tag] = counts.get(tag, 0) + 1
        hidden += tag in HIDDEN_TAGS
    close()
    return out


def marked_main(place: Place) -> bool:
    """The label of a block of a page that marks its article itself."""
    return place.element is not None and place.element.inside and not place.element.apart


@lru_cache(50_000)
def _hash(word: str, size: int) -> tuple[list[int], np.ndarray]:
    """Two places of a word and their signs: words that share one place differ in the other."""
    h, k = zlib.crc32(word.encode()), zlib.crc32(word.encode(), 0x5BD1E995)
    return [h % size, k % size], np.array([1.0 if h & 0x80000000 else -1.0, 1.0 if k & 0x80000000 else -1.0], np.float32)


def _path_vector(element: Element | None) -> np.ndarray:
    """The tags and words from the root to an element, made from the nearest element above that has its vector; the element and its parent
    keep theirs, for the blocks beside and below."""
    way, above = [], element
    while above is not None and above.vector is None:
        way.append(above)
        above = above.parent
    vector = np.zeros(PATH, np.float32) if above is None else above.vector
    if way:
        vector = vector.copy()
    for own in reversed(way):
        for word in ("<" + own.tag, *("." + n for n in own.names)):
            at, signs = _hash(word, PATH - 1)
            vector[[1 + i for i in at]] = signs
        if own is element or own is element.parent:
            own.vector = vector.copy()
    return vector


def path_row(place: Place) -> np.ndarray:
    """The path's vector with the block's last three tags by their distance from it."""
    row = _path_vector(place.element).copy()
    row[0] = 1.0
    element, words = place.element, ["#link"] * place.linked
    for distance in range(3):
        if element is None:
            break
        words.append(f"{distance}<{element.tag}")
        element = element.parent
    for word in words:
        at, signs = _hash(word, PATH - 1)
        row[[1 + i for i in at]] += 0.5 * signs
    return row


#: Numbers that say how a block stands among the others of its page, whatever the tags and names.
SHAPE = 22


def shape(page: list[tuple[Place, str]], sizes: np.ndarray) -> np.ndarray:
    """For each block: how much text, how many blocks and how many links its parent, its parent's parent and the one above hold of the page;
    whether the blocks beside it have the same parents; how many containers like its own lie beside that; where it stands, and how near to the
    container with most text."""
    n, whole = len(page), max(1.0, float(sizes.sum()))
    above: list[list[Element | None]] = []
    for place, _ in page:
        chain, element = [], place.element
        for _ in range(3):
            element = element.parent if element is not None else None
            chain.append(element)
        above.append(chain)
    text: dict[tuple, float] = {}
    count: dict[tuple, int] = {}
    links: dict[tuple, float] = {}
    like: dict[tuple, set] = {}
    for (place, _), chain, size in zip(page, above, sizes.tolist()):
        for level, element in enumerate(chain):
            key = level, id(element)
            text[key] = text.get(key, 0.0) + size
            count[key] = count.get(key, 0) + 1
            links[key] = links.get(key, 0.0) + size * place.linked
        if chain[0] is not None:
            like.setdefault((id(chain[1]), chain[0].tag), set()).add(id(chain[0]))
    best = max((k for k in text if k[0] == 0), key=lambda k: text[k], default=(0, 0))
    depth = next((chain[0].depth for chain in above if chain[0] is not None and id(chain[0]) == best[1]), 0)
    rows = []
    for i, ((place, _), chain, size) in enumerate(zip(page, above, sizes.tolist())):
        keys = [(level, id(element)) for level, element in enumerate(chain)]
        row = []
        for key in keys:
            row += [math.log1p(text[key]) / 6, math.log1p(count[key]) / 3, text[key] / whole, links[key] / max(1.0, text[key])]
        for j in (i - 1, i + 1):
            for level in (0, 1):
                row.append(float(0 <= j < n and above[j][level] is chain[level]))
        row += [float(keys[0] == best), text[keys[0]] / text[best], (i + 0.5) / n, math.log1p(len(like.get((id(chain[1]), chain[0].tag), ()))) / 2 if chain[0] is not None else 0.0]
        row += [size * count[keys[0]] / max(1.0, text[keys[0]]) / 2, min(1.0, max(-1.0, ((chain[0].depth if chain[0] is not None else 0) - depth) / 4))]
        rows.append(row)
    return np.array(rows, np.float32).reshape(n, SHAPE)


def features(pages: list[list[tuple[Place, str]]]) -> list[np.ndarray]:
    """A matrix for each page: a row for each block."""
    texts = [text for page in pages for _, text in page]
    words = np.zeros((len(texts), WORDS), np.float32)
    sizes = np.zeros(len(texts), np.float32)
    for first, hashes, at in word_hashes(pa.array(texts, pa.large_string()), "alnum"):
        owner = np.repeat(np.arange(first, first + len(at) - 1), np.diff(at))
        sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
        np.add.at(words, (owner, (hashes % np.uint64(WORDS)).astype(np.int64)), sign)
        sizes[first : first + len(at) - 1] = np.diff(at)
    words /= np.sqrt(np.maximum(sizes, 1.0))[:, None]
    paths = np.array([path_row(place) for page in pages for place, _ in page], np.float32).reshape(-1, PATH)
    borders = np.cumsum([len(p) for p in pages])
    shapes = [shape(page, own) for page, own in zip(pages, np.split(sizes, borders[:-1]))]
    rows = np.concatenate((paths, 0.3 * words, np.log1p(sizes)[:, None] / 5, np.concatenate([np.zeros((0, SHAPE), np.float32), *shapes])), axis=1)
    return np.split(rows, borders[:-1]) if pages else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one output a step."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        size = PATH + WORDS + 1 + SHAPE
        draw = np.random.default_rng(SEED)
        self.w = weights or {
            **{f"{d}{k}": draw.normal(0, 1 / np.sqrt(n), (n, 4 * HIDDEN)) for d in "fb" for k, n in (("x", size), ("h", HIDDEN))},
            **{f"{d}o": np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN))) for d in "fb"},
            "out": draw.normal(0, 0.2, 2 * HIDDEN),
            "skip": np.zeros(size),
            "bias": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (pages, steps, HIDDEN) of one direction, and what the way back needs. A masked step keeps the state."""
        n, steps, _ = x.shape
        given = x @ self.w[d + "x"] + self.w[d + "o"]
        h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        states, kept = np.zeros((n, steps, HIDDEN), x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = given[:, t] + h @ self.w[d + "h"]
            i, f, o = np.split(_sigmoid(z[:, : 3 * HIDDEN]), 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(new_c)
            new_h = m * (o * tc) + (1 - m) * h
            kept.append((t, h, c, i, f, o, g, tc, m))
            h, c = new_h, new_c
            states[:, t] = h
        return states, kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        (hf, kf), (hb, kb) = self._pass(x, mask, "f"), self._pass(x, mask, "b")
        both = np.concatenate((hf, hb), axis=2)
        return _sigmoid(both @ self.w["out"] + x @ self.w["skip"] + self.w["bias"]), both, kf, kb

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, kf, kb = self.forward(x, mask)
        error = (p - y) * mask / mask.sum()
        grad = {"out": np.einsum("nt,nth->h", error, both), "skip": np.einsum("nt,ntd->d", error, x), "bias": error.sum(keepdims=True)[0]}
        for d, kept, w in (("f", kf, self.w["out"][:HIDDEN]), ("b", kb, self.w["out"][HIDDEN:])):
            dh, dc = np.zeros((len(x), HIDDEN), x.dtype), np.zeros((len(x), HIDDEN), x.dtype)
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), x.dtype)
            grad[d + "h"] = np.zeros_like(self.w[d + "h"])
            for t, h, c, i, f, o, g, tc, m in reversed(kept):
                dh = dh + error[:, t, None] * w
                do = m * dh * tc
                dcell = dc + m * dh * o * (1 - tc * tc)
                mine = m * dcell
                dz = np.concatenate((mine * g * i * (1 - i), mine * c * f * (1 - f), do * o * (1 - o), mine * i * (1 - g * g)), axis=1)
                grad[d + "h"] += h.T @ dz
                dz_all[:, t] = dz
                dc = mine * f + (1 - m) * dcell
                dh = (1 - m) * dh + dz @ self.w[d + "h"].T
            grad[d + "x"] = np.einsum("ntd,ntk->dk", x, dz_all, optimize=True)
            grad[d + "o"] = dz_all.sum(axis=(0, 1))
        return grad

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> None:
        """Adam over batches of pages of like length; the weights are the mean of those in the last third of the epochs."""
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i]), i))
        batches = [padded([pages[i] for i in order[k : k + 64]], [labels[i] for i in order[k : k + 64]]) for k in range(0, len(order), 64)]
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        draw, step, sums, summed = np.random.default_rng(SEED), 0, {k: np.zeros(v.shape) for k, v in self.w.items()}, 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - 0.8 * epoch / EPOCHS)
            for k in draw.permutation(len(batches)):
                step += 1
                for name, g in self.gradients(*batches[k]).items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.w[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                if 3 * epoch >= 2 * EPOCHS:
                    summed += 1
                    for name, w in self.w.items():
                        sums[name] += w
        self.w = {k: (v / summed).astype(np.float32) if summed else self.w[k] for k, v in sums.items()}

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):  # about as many steps in each batch, so a very long page is alone
            end = at + 1
            while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= 8192:
                end += 1
            own = order[at:end]
            x, mask, _ = padded([pages[i] for i in own], [np.zeros(len(pages[i])) for i in own])
            for i, p in zip(own, self.forward(x, mask)[0]):
                out[i] = p[: len(pages[i])] > 0.5
            at = end
        return out


def padded(pages: list[np.ndarray], labels: list[np.ndarray], kind: type = np.float32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask, y = np.zeros((len(pages), steps, PATH + WORDS + 1 + SHAPE), kind), np.zeros((len(pages), steps), kind), np.zeros((len(pages), steps), kind)
    for i, (p, own) in enumerate(zip(pages, labels)):
        x[i, : len(p)], mask[i, : len(p)], y[i, : len(p)] = p, 1, own
    return x, mask, y


#: A sign of no script in front of article texts in a layout, by which their blocks are known behind the parser.
_OWN = "\ue000"


def layout(texts: list[str], others: list[str], draw: np.random.Generator) -> tuple[list[tuple[Place, str]], np.ndarray]:
    """The blocks of a page made of an article (texts) with menus, adverts, forms, notices, teasers and readers' comments around and inside it,
    and which of the blocks belong to the article. In a third of the layouts names say nothing: there are none, or numbers, or words made up for
    the page, so that the label follows from how the page is built."""
    pick = lambda options: options[int(draw.integers(len(options)))]
    bare = lambda text: re.sub(f"[<&{_OWN}]", " ", text)
    kind = draw.random()
    marks = sorted(MARKS)
    invented = ["".join(pick("bcdfglmnprst") + pick("aeiou") for _ in range(int(draw.integers(2, 4)))) for _ in range(8)]

    def named(name: str) -> str:
        if kind < 0.1 or kind > 0.33 and draw.random() < 0.12:
            return ""
        own = f"c{int(draw.integers(1, 100))}" if kind < 0.25 else pick(invented) if kind < 0.33 else name
        return f' {pick(["class", "class", "id"])}="{own}"'

    def mark() -> str:
        form = int(draw.integers(5))
        return pick(marks) if form < 3 else f"{pick(marks)}-{pick(['box', 'list', 'area', 'wrap', 'section'])}" if form == 3 else f"{pick(['site', 'page', 'my', 'top'])}-{pick(marks)}"

    def few(low: int, high: int) -> range:
        return range(int(draw.integers(low, high)))

    def short(most: int = 8) -> str:
        return " ".join(bare(pick(texts + others)).split()[: int(draw.integers(1, most))]) or "x"

    def say(long: float) -> str:
        if draw.random() >= long:
            return bare(pick(others)) if draw.random() < 0.5 else short(16)
        words = bare(pick(texts)).split()
        return " ".join(words[: int(draw.integers(8, max(9, len(words) + 1)))])

    def link() -> str:
        return f"<a href='#'>{short(5)}</a>"

    def comments() -> str:
        tag, item, name = pick(["div", "section", "ol", "ul"]), pick(["div", "div", "li", "article"]), named(pick(["comment", "reply", "comment-body"]))
        item = "li" if tag in ("ol", "ul") else item
        who = lambda: pick(["<b>%s</b><span>%s</span>", "<b>%s</b> <i>%s</i>", "<div>%s, %s</div>", "<h4>%s</h4><small>%s</small>", "<p><strong>%s</strong> %s</p>"]) % (short(3), short(4))
        each = lambda: f"<{item}{name}>{who() if draw.random() < 0.8 else ''}{''.join(f'<p>{say(0.9)}</p>' for _ in few(1, 3))}</{item}>"
        head = f"<{(h := pick(['h2', 'h3', 'h4']))}>{short(5)}</{h}>" if draw.random() < 0.7 else ""
        return f"<{tag}{named(pick(['comments', 'comment-list', 'respond', 'replies', 'disqus comments']))}>{head}{''.join(each() for _ in few(1, 7))}</{tag}>"

    def teasers() -> str:
        inner = lambda: pick(["<h4>%s</h4><p>%s</p>", "<h3>%s</h3><p>%s</p>", "<p>%s</p><p>%s</p>", "%s<p>%s</p>"]) % (link(), say(0.6))
        name = named(pick(["related", "promo", "recommended"]))
        return f"<div{named(mark())}>" + "".join(f"<div{name}>{inner()}</div>" for _ in few(1, 5)) + "</div>"

    def notice() -> str:
        return f"<div{named(mark())}>" + "".join(f"<p>{say(0.7)}</p>" for _ in few(1, 3)) + pick(["<button>%s</button>", "<p>%s</p>", "%s"]) % pick([link(), short(3)]) + "</div>"

    def linked() -> str:
        tag, inner = pick([("ul", "li"), ("ol", "li"), ("div", "span"), ("div", "div"), ("p", "span"), ("nav", "div"), ("div", "p")])
        return f"<{tag}{named(mark())}>" + pick(["", " | ", " "]).join(f"<{inner}>{link()}</{inner}>" if draw.random() < 0.9 or tag != "p" else link() for _ in few(1, 8)) + f"</{tag}>"

    def row() -> str:
        return pick(["<p>%s</p>", "<div>%s</div>", "%s<hr>"]) % pick([" | ", " ", " - "]).join(link() for _ in few(1, 7))

    def apart() -> str:
        tag = pick(["aside", "nav", "footer", "header", "form", "menu"])
        return f"<{tag}{named(mark())}>" + "".join(pick(["<p>%s</p>", "<li>%s</li>", "<h3>%s</h3>", "<div>%s</div>", "<label>%s</label>", "<a href='#'>%s</a>"]) % say(0.4) for _ in few(1, 4)) + f"</{tag}>"

    def boxed() -> str:
        return f"<section{named(mark())}><h2>{short()}</h2><p>{say(0.4)}</p></section>" if draw.random() < 0.4 else f"<div{named(mark())}>{say(0.3)}</div>"

    def beside() -> str:
        return f"<div{named(mark())}><h3>{short(4)}</h3>" + "".join(f"<p>{say(0.5)}</p>" for _ in few(1, 4)) + (linked() if draw.random() < 0.6 else "") + "</div>"

    kinds = [comments, comments, teasers, notice, linked, linked, row, apart, boxed, boxed, beside]
    aside = lambda: pick(kinds)()
    box = lambda: f"<div{named(mark())}>{say(0.3)}</div>"
    within = [box, box, box, box, box, *kinds]
    form = draw.random()
    if form < 0.12:  # an article of many lines, short ones and repeated ones among them
        lines = [short(14) for _ in few(1, 6)]
        texts = [pick(lines) if draw.random() < 0.8 else pick(texts) for _ in few(4, 60)]
    elif form < 0.24:
        texts = texts[: int(draw.integers(1, 3))]
    body = []
    for i, text in enumerate(texts):
        text = _OWN + bare(text)
        if i == 0 or draw.random() < (0.25 if form > 0.12 else 0.03):
            own = _OWN + (bare(pick(others)) if draw.random() < 0.4 else short(12))
            body.append(f"<{(tag := 'h1' if i == 0 else pick(['h2', 'h2', 'h3', 'h4', 'blockquote', 'p', 'figcaption']))}>{own}</{tag}>")
        body.append(pick(["<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<ul><li>%s</li></ul>", "<blockquote><p>%s</p></blockquote>", "<blockquote>%s</blockquote>", "<div>%s</div>", "<pre>%s</pre>"]) % text)
        if draw.random() < (0.22 if form > 0.12 else 0.03):
            body.append(pick(within)())
    if draw.random() < 0.3:
        body.append(aside())
    article = "".join(body)
    around = lambda: "".join(aside() for _ in few(1, 5))
    built = draw.random()
    if built < 0.15:  # columns of a table
        cells = [f"<td>{around()}</td>", f"<td{named('content')}>{article}</td>", f"<td>{around()}</td>"]
        if draw.random() < 0.4:
            del cells[pick([0, 2])]
        page = f"<table>{f'<tr><td colspan=3>{pick([row, linked, boxed])()}</td></tr>' * (draw.random() < 0.6)}<tr>{''.join(cells)}</tr>{f'<tr><td colspan=3>{short(9)}</td></tr>' * (draw.random() < 0.6)}</table>"
    elif built < 0.3:  # no container at all
        ends = [row, linked, apart, comments, teasers, notice, beside]
        page = "".join(pick(ends)() for _ in few(0, 4)) + article + "<hr>" * (draw.random() < 0.4) + "".join(pick(ends)() for _ in few(0, 4))
    else:
        tag = pick(["article", "article", "main", "div", "div", "div", "div", "section"])
        name = "" if tag in ("article", "main") and draw.random() < 0.7 else named(pick(NAMES) + pick(TAILS))
        page = f"{around()}{pick(WRAPS) if kind > 0.33 else pick(['', '<div>', '<div><div>', '<main>'])}<{tag}{name}>{article}</{tag}>{around()}"
    line = pick(["<p>%s</p>", "<div>%s</div>", "<div class='b'><p>%s</p></div>"]) % short(10) if built >= 0.3 and draw.random() < 0.5 else ""
    parsed = blocks(f"<html><body>{page}{line}</body></html>")
    return [(place, text.replace(_OWN, "").strip()) for place, text in parsed], np.array([_OWN in text for _, text in parsed], float)


def train(pages: list[str]) -> Labeller:
    """Fits a labeller to layouts of the pages' texts, and to those of the pages that mark their article."""
    draw = np.random.default_rng(SEED)
    known: list[tuple[list, np.ndarray]] = []
    for page in map(blocks, pages):
        if any(place.element is not None and place.element.inside for place, _ in page):
            known += [(page, np.array([marked_main(place) for place, _ in page], float))] * MARKED
        long = [len(text.split()) >= LONG and not place.linked for place, text in page]
        texts = [text for (_, text), yes in zip(page, long) if yes][:MAIN] or [" ".join(["Text of an article."] * 5)]
        others = [text for (_, text), yes in zip(page, long) if not yes][:OTHER] or ["More"]
        known += [layout(texts, others, draw) for _ in range(LAYOUTS)]
    known = [k for k in known if k[0]] or [layout([" ".join(["Text of an article."] * 5)], ["More"], draw)]
    model = Labeller()
    model.fit(features([page for page, _ in known]), [own for _, own in known])
    return model


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row for each of pages (page_id, url, html): page_id, url, text (main blocks in page order, joined by a line feed), n_chars.

    Null and empty pages give an empty text; a page without blocks labelled main too. Rows that repeat are each extracted alike.
    Nothing is cut from blocks but surrounding white space. Long and deep pages are read whole, in time that grows with their blocks. Other
    columns are ignored, also those named text and n_chars. An empty table gives an empty result.
    """
    # The sample bounds what is labelled for training, never what is extracted; whole pages enter it.
    hashed = pages.where("html <> ''").select(F.xxhash64("html").alias("h"), "html")
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(sample).collect()]
    chosen = hashed.where(F.col("h").isin(least)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if least else []
    weights = train([r["html"] for r in chosen]).w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(weights)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                parsed = [blocks(h) for h in part.column("html").to_pylist()]
                texts = ["\n".join(t for (_, t), yes in zip(page, labels) if yes) for page, labels in zip(parsed, model.label(features(parsed)))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(settling(run), "page_id long, url string, text string, n_chars long")
