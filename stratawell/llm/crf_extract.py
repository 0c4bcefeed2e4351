"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A page becomes a sequence of blocks of text with their ancestors in the document tree. Features of
tags, class names and text give each block a score for being main text, transitions tie
neighbouring blocks, and Viterbi decoding labels the page. The weights are fitted by likelihood on
a bounded sample of pages that are labelled by their semantic markup. Each such page is used in
full, without the marks of the article, and with one tag for all blocks, so that pages that lack
the one or have others are decoded too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratawell.llm.words import slices
from stratawell.session import spread

BUCKETS = 1 << 14
NAMED = 32  # innermost elements whose names count
KINDS = (("ul", "li"), ("p",), ("ol", "li"), ("table", "tr", "td"), ("blockquote", "p"), ("figure", "figcaption"), ("dl", "dd"), ("pre",))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style noscript template iframe object svg math canvas audio video select textarea".split())
# What may stand in a head; any other start tag there ends it, and so does text of its own.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template noframes".split())
HEAD_HOLDS = frozenset("title style script noscript template noframes".split())
# An opening tag of the first kind ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table article section main div body html td th".split())
CONTAINER = frozenset({"article", "main"})
AROUND = frozenset("nav footer aside form button menu dialog".split())
# A name (class or id) tells of such a part if one of its words does and the others say nothing else:
# cookie-banner does, share-price-report does not.
AROUND_WORD = regex.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|"
    r"nav\w*|menu\w*|breadcrumbs?|sidebar\w*|widget\w*|footer|masthead|social|share|sharing|related|recommend\w*|"
    r"comments?|commentlist|disqus|replies|respond|pagination|pager|toolbar|login|search"
)
NEUTRAL_WORD = regex.compile(
    r"site|main|page|post|posts|article|articles|entry|blog|top|bottom|left|right|upper|lower|primary|secondary|global|mobile|"
    r"desktop|header|head|inner|outer|box|block|list|item|items|bar|area|section|container|wrap|wrapper|content|body|row|col|"
    r"column|group|panel|slot|unit|link|links|button|buttons|btn|icon|icons|form|signup|thread|reader|user|js|is|has|\d+"
)


@lru_cache(maxsize=100_000)
def tells_around(name: str) -> bool:
    words = [w for w in regex.split(r"[-_]+", name) if w]
    around = [bool(AROUND_WORD.fullmatch(w)) for w in words]
    return any(around) and all(x or NEUTRAL_WORD.fullmatch(w) for x, w in zip(around, words)) or name == "site-header"


AROUND_WEIGHT = -8.0  # at most


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    place: str  # innermost ancestor that says something: container, around or none
    link_share: float


class _Reader(HTMLParser):
    """Collects the leaf blocks of a page, also of one whose tags are not closed.

    What is open is counted by tag, and the elements that say something about their place have a stack
    of their own, so that deep nesting costs a block no more than flat text. Of names, those of the
    innermost ``NAMED`` elements are kept.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, str]] = []  # tag, names, place
        self.open: Counter[str] = Counter()
        self.places: list[str] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.silent = 0

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                place = self.places[-1] if self.places else "none"
                leaf = self.stack[-1][0] if self.stack else ""
                tags = (*(t for t in self.open if t != leaf), leaf) if leaf else ()
                names = tuple(n for _, n, _ in self.stack[-NAMED:] if n)
                self.blocks.append(Block(text, tags, names, place, min(1.0, self.linked / len(text))))
            self.parts, self.linked = [], 0

    def _place(self, tag: str, names: str) -> str:
        if tag in ("html", "body"):  # their names tell about the layout, not about their text
            return ""
        told = [tells_around(n) for n in names.split() if not n.startswith("role:")]
        # An article may carry one such name among others, and is one of these parts if all say so.
        if tag in AROUND or (all(told) and told if tag in CONTAINER else any(told)):
            return "around"
        if tag == "header":
            return "" if "container" in self.places else "around"
        return "container" if tag in CONTAINER or "role:main" in names else ""

    def _close(self, at: int) -> None:
        for tag, _, place in self.stack[at:]:
            self.silent -= tag in SILENT
            self.open[tag] -= 1
            if not self.open[tag]:
                del self.open[tag]
            if place:
                self.places.pop()
        del self.stack[at:]

    def _end_head(self) -> None:
        """Close a head whose end tag was left out; what is inside one of its elements leaves it open."""
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag == "head":
                self._close(at)
            if tag == "head" or tag in HEAD_HOLDS:
                return

    def handle_starttag(self, tag, attrs):
        if self.silent and tag not in IN_HEAD:
            self._end_head()
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self._flush()
            closes = ENDS.get(tag, frozenset())
            within = len(self.stack) if "p" in self.open or any(t in self.open for t in closes) else 0
            for at in range(within - 1, -1, -1):
                open_tag = self.stack[at][0]
                if open_tag == "p" or open_tag in closes:
                    self._close(at)
                    break
                if open_tag in SCOPES:
                    break
            if tag == "body":
                self._close(next((i for i, x in enumerate(self.stack) if x[0] == "head"), len(self.stack)))
        if tag in VOID:
            return
        found = dict(attrs)
        names = " ".join(x.lower() for x in (found.get("class"), found.get("id")) if x)
        if found.get("role"):
            names = f"{names} role:{found['role'].lower()}".strip()
        place = self._place(tag, names)
        self.stack.append((tag, names, place))
        self.open[tag] += 1
        if place:
            self.places.append(place)
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        if tag == "br" or tag not in INLINE:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._flush()
        if tag not in self.open:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close(at)
                return
            if tag in INLINE and self.stack[at][0] not in INLINE:
                return

    def handle_data(self, data):
        if self.silent and data.strip(" \t\n\r\f"):
            self._end_head()
        if self.silent:
            return
        self.parts.append(data)
        if "a" in self.open:
            self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    """The leaf blocks of a page in page order, white space inside them turned into one space."""
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader._flush()
    return reader.blocks


def weak_labels(blocks: list[Block]) -> list[int]:
    """1 for main text as far as semantic markup tells: inside the container, if the page has one."""
    boxed = any(b.place == "container" for b in blocks)
    if boxed:
        return [int(b.place == "container") for b in blocks]
    return [int(b.place == "none" and b.link_share < 0.5 and len(b.text) >= 40) for b in blocks]


def block_features(blocks: list[Block], masked: bool = False) -> list[list[int]]:
    """Hashed features of each block; ``masked`` hides the marks of the container."""
    out = []
    for b in blocks:
        text, n = b.text, len(b.text)
        tags = [t for t in b.tags if not (masked and t in CONTAINER)]
        place = "none" if masked and b.place == "container" else b.place
        letters = sum(map(str.isalpha, text))
        names = [
            "bias", f"place={place}", f"size={n.bit_length()}",
            f"links={int(b.link_share * 4)}", f"end={text[-1] in '.!?:;'}", f"letters={letters * 5 // n}",
            f"mark={text[0] in '©|·'}",
        ]
        names.append(f"tag={tags[-1] if tags else ''}")
        names += [f"in={t}" for t in {t for t in tags if t not in CONTAINER and t not in ("html", "body")}]
        names += [f"name={w}" for w in {w for x in b.names for w in x.split() if not (masked and w == "role:main")}]
        out.append([zlib.crc32(x.encode()) % BUCKETS for x in names])
    return out


def training_views(blocks: list[Block]) -> list[tuple[list[list[int]], list[int]]]:
    """Features and labels of a labelled page: in full, without the marks of the article, both also
    with its text in lists, tables and quotes, and with the same tag everywhere, its surroundings spread between the blocks of the article."""
    labels = weak_labels(blocks)
    # Lists, tables and quotes stand in articles too; menus must not make them a sign of the contrary.
    kinds = [replace(b, tags=(*b.tags[:-1], *KINDS[i % len(KINDS)])) if y else b for i, (b, y) in enumerate(zip(blocks, labels))]
    views = [(block_features(x, masked), labels) for x in (blocks, kinds) for masked in (False, True)]
    main = [i for i, y in enumerate(labels) if y]
    rest = [i for i, y in enumerate(labels) if not y]
    place = {i: (k + 0.5) / max(len(main), 1) for k, i in enumerate(main)} | {i: k / max(len(rest), 1) for k, i in enumerate(rest)}
    order = sorted(range(len(blocks)), key=place.__getitem__)
    alike = block_features([replace(b, tags=("p",), names=()) for b in blocks])
    views.append(([alike[i] for i in order], [labels[i] for i in order]))
    return views


@dataclass(frozen=True)
class PageModel:
    weights: np.ndarray  # per feature, in favour of main text
    change: np.ndarray  # 2 x 2, from label to label

    def decode(self, features: list[list[int]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to other text."""
        best, back = (0.0, 0.0), []
        t = self.change
        for i, found in enumerate(features):
            score = float(self.weights[found].sum())
            if i == 0:
                best = (0.0, score)
                continue
            to0 = (best[0] + t[0, 0], best[1] + t[1, 0])
            to1 = (best[0] + t[0, 1], best[1] + t[1, 1])
            back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
            best = (max(to0), max(to1) + score)
        label = int(best[1] > best[0])
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1] if features else []

    def main_text(self, html: str | None) -> str:
        blocks = blocks_of(html)
        labels = self.decode(block_features(blocks))
        return " ".join(b.text for b, y in zip(blocks, labels) if y)


def train(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 100, rate: float = 0.15, ridge: float = 2e-4) -> PageModel:
    """Weights of greatest penalised likelihood, by Adam on the full gradient.

    Pages are (features per block, labels). Without pages, the place alone decides.
    """
    weights, change = np.zeros(BUCKETS), np.zeros((2, 2))
    pages = [p for p in pages if p[1]]
    if not pages:
        for name, value in (("place=container", 4.0), ("place=around", -4.0)):
            weights[zlib.crc32(name.encode()) % BUCKETS] = value
        return PageModel(weights, change)
    n, longest = len(pages), max(len(y) for _, y in pages)
    sizes = np.array([len(y) for _, y in pages])
    row = np.concatenate([np.full(len(y), i) for i, (_, y) in enumerate(pages)])
    col = np.concatenate([np.arange(len(y)) for _, y in pages])
    per_block = [f for x, _ in pages for f in x]
    flat = np.array([k for f in per_block for k in f])
    owner = np.repeat(np.arange(len(per_block)), [len(f) for f in per_block])
    truth = np.concatenate([y for _, y in pages])
    labels = np.zeros((n, longest), np.int64)
    labels[row, col] = truth
    live = np.arange(longest)[None] < sizes[:, None]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:, :-1][live[:, 1:]], labels[:, 1:][live[:, 1:]]), 1)
    moments = [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, rounds + 1):
        score = np.zeros((n, longest, 2))
        score[row, col, 1] = np.bincount(owner, weights=weights[flat], minlength=len(per_block))
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            into = np.logaddexp.reduce(ahead[:, t - 1, :, None] + change[None], axis=1) + score[:, t]
            ahead[:, t] = np.where(live[:, t, None], into, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            out = np.logaddexp.reduce(change[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(live[:, t + 1, None], out, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        chance = np.exp(ahead + behind - total[:, None, None])[row, col, 1]
        gradient = np.bincount(flat, weights=(truth - chance)[owner], minlength=BUCKETS) / n - ridge * weights
        both = ahead[:, :-1, :, None] + change[None, None] + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
        turned = seen - (np.exp(both) * live[:, 1:, None, None]).sum(axis=(0, 1))
        for k, (value, slope) in enumerate(((weights, gradient), (change, turned / n - ridge * change))):
            moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * slope
            moments[2 * k + 1] = 0.999 * moments[2 * k + 1] + 0.001 * slope**2
            value += rate * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.999**step)) + 1e-8)
    # Surroundings of kinds that the sample lacks are told by their place alone.
    around = zlib.crc32(b"place=around") % BUCKETS
    weights[around] = min(weights[around], AROUND_WEIGHT)
    return PageModel(weights, change)


def fit(pages: DataFrame, sample: int = 200, max_blocks: int = 400) -> PageModel:
    """Fit on a sample of ``pages`` (page_id, html): about ``sample`` pages, drawn by a hash.

    ``max_blocks`` bounds the blocks of a page that is learned from; longer ones are not drawn.
    Only features and labels go to the driver.
    """
    n_pages = pages.count()
    draw = F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30)) / float(1 << 30)
    drawn = pages.where(draw < sample / max(n_pages, 1)).select("html")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            features, labels = [], []
            for html in part.column(0).to_pylist():
                blocks = blocks_of(html)
                if 0 < len(blocks) <= max_blocks:
                    for x, y in training_views(blocks):
                        features.append(x)
                        labels.append(y)
            kinds = (pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(features, kinds[0]), pa.array(labels, kinds[1])], names=["x", "y"])

    rows = drawn.mapInArrow(read, "x array<array<long>>, y array<long>").collect()
    return train(sorted(([list(f) for f in r["x"]], list(r["y"])) for r in rows))


def extract(pages: DataFrame, model: PageModel) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    A null or empty page, and one without main text, has an empty text. Character references are
    decoded; blocks are joined in page order by one space. Repeated rows are treated one by one.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", 2 << 20):
            texts = [shared.value.main_text(html) for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    return spread(pages.select("page_id", "url", "html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
