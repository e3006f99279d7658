"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks: the texts between block-level
tags, in page order. A block's features are the tags and the class, id and role
words of its ancestors, and a few of its text. The field has two labels, main
text and other, and is trained on labelled pages (``training_pages``: composed
layouts whose blocks are labelled by construction); Viterbi decodes.

Both labels' weights only matter by their difference, so an element has one
score, a block's score is the sum along its ancestors, and each element's is
looked up once per distinct tag.
"""

from __future__ import annotations

import html as references
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by how they part text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("iframe math noscript script style svg template textarea".split())
# Tags that say what they hold.
TELLING_TAGS = frozenset("article aside dialog figure footer form head header main menu nav section title".split())
# A tag on the left ends an open one on the right.
ENDS_OPEN = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "option": ("option",),
}

_OPENING = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[>\"']")
_NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tags:
    """The tags and comments of a page, in time that grows with its length however broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.ends_nowhere: set[int] = set()  # places outside quotes from which no end of a tag follows

    def _quoted_end(self, at: int) -> int:
        """Place behind the ``>`` that ends a tag, passing over quoted values; -1 if there is none."""
        passed = []
        while at not in self.ends_nowhere:
            passed.append(at)
            mark = _MARK.search(self.page, at)
            if mark and mark[0] == ">":
                return mark.end()
            closing = self.page.find(mark[0], mark.end()) if mark else -1
            if closing < 0:
                break
            at = closing + 1
        self.ends_nowhere.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(begin, end, name, ``/`` of a closing tag, attributes) from a place on; no name for what is no element."""
        found = _OPENING.search(self.page, at)
        if not found:
            return None
        begin, after = found.span()
        if found[0] == "<!--":
            end = self.page.find("-->", after)
            return begin, end + 3 if end >= 0 else len(self.page), "", "", ""
        end = self._quoted_end(after) if found[2] else -1
        if end < 0:  # a quote that never closes is no quote
            end = self.page.find(">", after) + 1
        if not end:  # no tag ends from here on; a comment can still begin
            begin = self.page.find("<!--", begin + 1)
            return None if begin < 0 else (*self.next(begin),)
        return begin, end, found[2] or "", found[1] or "", self.page[after : end - 1]


def leaf_blocks(page: str, of_element: Callable[[str, str], tuple[Any, Any]], start: Any) -> list[tuple[Any, str, str, int]]:
    """(sum over ancestors, innermost tag, text, characters in links) of every block that has text.

    ``of_element`` gives, from an element's tag and raw attributes, its summand and
    the one it adds as the closest telling ancestor (None if it tells nothing, and
    the one around it counts). Character references are decoded, white space becomes single
    spaces. Scripts, styles, comments and the like hold no text.
    """
    blocks: list[tuple[Any, str, str, int]] = []
    stack: list[tuple[str, Any, Any]] = [("", start, start)]
    is_open: Counter[str] = Counter()
    parts: list[str] = []
    linked = in_link = 0

    def close(depth: int) -> None:
        """End all elements from this depth on."""
        while len(stack) > depth:
            is_open[stack.pop()[0]] -= 1

    def flush() -> None:
        nonlocal linked
        text = "".join(parts)
        parts.clear()
        if "&" in text:
            text = references.unescape(text)
        text = " ".join(text.split())
        if text:
            tag, total, near = stack[-1]
            blocks.append((total + near, tag, text, min(linked, len(text))))
        linked = 0

    at, size, tags = 0, len(page), Tags(page)
    while at < size:
        found = tags.next(at)
        end = found[0] if found else size
        if end > at:
            parts.append(page[at:end])
            if in_link:
                linked += end - at
        if not found:
            break
        _, at, name, closing, attributes = found
        if not name:
            continue
        tag = name.lower()
        if tag in HIDDEN_TAGS:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
                at = (page.find(">", stop.end()) + 1 if stop else 0) or size
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            in_link = 0
            if closing:
                if is_open[tag] > 0:  # else no element ends, however many are open
                    close(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == tag))
            else:
                if stack[-1][0] == "p":
                    close(len(stack) - 1)
                for open_tag in ENDS_OPEN.get(tag, ()):
                    if stack[-1][0] == open_tag:
                        close(len(stack) - 1)
                if tag not in VOID_TAGS:
                    own, near = of_element(tag, attributes)
                    is_open[tag] += 1
                    stack.append((tag, stack[-1][1] + own, stack[-1][2] if near is None else near))
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
    flush()
    return blocks


def element_features(tag: str, attributes: str) -> tuple[tuple[str, ...], tuple[str, ...] | None]:
    """A telling tag and the words of class, id and role; the same once more for the closest telling ancestor."""
    names = sorted({f"named {part.lower()}" for groups in _NAMING.findall(attributes) for part in _NAME_PART.findall("".join(groups))})
    own = (f"tag {tag}", *names) if tag in TELLING_TAGS else tuple(names)
    return own, tuple(f"near {f}" for f in own) or None


def text_features(tag: str, text: str, linked: int) -> tuple[str, ...]:
    """What a block itself shows: its tag, length, share of links and how it ends."""
    words = text.count(" ") + 1
    length = "1" if words == 1 else "few" if words < 5 else "some" if words < 12 else "many" if words < 40 else "very many"
    share = linked / len(text)
    links = "no" if not share else "some" if share < 0.5 else "most"
    ends = "sentence" if text[-1] in ".!?…\"”»:" else "open"
    return (f"in {tag}", f"words {length}", f"links {links}", f"ends {ends}", f"{length} {links}", "copyright" if "©" in text else "plain")


@dataclass
class Field:
    """Weights of the conditional random field, main text minus other."""

    features: dict[str, float]
    steps: np.ndarray  # 2 x 2, from label to label
    first: float

    def scorer(self) -> Callable[[str, str], tuple[float, float | None]]:
        known: dict[tuple[str, str], tuple[float, float | None]] = {}

        def total(features: tuple[str, ...]) -> float:
            return sum(self.features.get(f, 0.0) for f in features)

        def score(tag: str, attributes: str) -> tuple[float, float | None]:
            key = (tag, attributes)
            if key not in known:
                if len(known) > 100_000:  # attributes that never recur
                    known.clear()
                own, near = element_features(tag, attributes)
                known[key] = total(own), None if near is None else total(near)
            return known[key]

        return score

    def main_blocks(self, page: str, score: Callable[[str, str], tuple[float, float | None]]) -> list[str]:
        """The texts of the most likely labelling's main blocks."""
        blocks = leaf_blocks(page, score, 0.0)
        stay_other, to_main, to_other, stay_main = (float(x) for x in self.steps.ravel())
        main, other = self.first, 0.0
        came: list[tuple[bool, bool]] = []  # whether main, and other, was reached from main
        for i, (ancestors, tag, text, linked) in enumerate(blocks):
            if i:
                to = (main + stay_main >= other + to_main, main + to_other > other + stay_other)
                main, other = max(main + stay_main, other + to_main), max(main + to_other, other + stay_other)
                came.append(to)
            main += ancestors + sum(self.features.get(f, 0.0) for f in text_features(tag, text, linked))
        chosen: list[str] = []
        is_main = main >= other
        for i in range(len(blocks) - 1, -1, -1):
            if is_main:
                chosen.append(blocks[i][2])
            if i:
                is_main = came[i - 1][0] if is_main else came[i - 1][1]
        return chosen[::-1]


def train(pages: list[tuple[str, list[bool]]], rounds: int = 80, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximum likelihood by full gradients with adaptive steps; deterministic.

    A page comes with one label per leaf block.
    """
    numbers: dict[str, int] = {}
    sequences = []
    for page, labels in pages:
        blocks = leaf_blocks(page, element_features, ())
        if len(blocks) != len(labels):
            raise ValueError("a labelled page needs one label per block")
        if blocks:
            rows = [[numbers.setdefault(f, len(numbers)) for f in (*path, *text_features(tag, text, linked))] for path, tag, text, linked in blocks]
            sequences.append((rows, np.array(labels, np.int64)))
    width = len(numbers)
    flat = np.concatenate([np.array(r) for rows, _ in sequences for r in rows])
    owner = np.repeat(np.arange(sum(len(rows) for rows, _ in sequences)), [len(r) for rows, _ in sequences for r in rows])
    edges = np.cumsum([0, *(len(rows) for rows, _ in sequences)])
    truth = np.concatenate([labels for _, labels in sequences])
    weights, square = np.zeros(width + 5), np.full(width + 5, 1e-8)
    for _ in range(rounds):
        emission = np.bincount(owner, weights=weights[flat], minlength=len(truth))
        steps, first = weights[width : width + 4].reshape(2, 2), weights[-1]
        expected, step_gradient, first_gradient = np.zeros(len(truth)), np.zeros((2, 2)), 0.0
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            scores = np.stack((np.zeros(b - a), emission[a:b]), axis=1)
            scores[0, 1] += first
            ahead = np.empty_like(scores)
            back = np.zeros_like(scores)
            ahead[0] = scores[0]
            for i in range(1, b - a):
                ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + steps[0], ahead[i - 1, 1] + steps[1])
            for i in range(b - a - 2, -1, -1):
                onward = steps + scores[i + 1] + back[i + 1]
                back[i] = np.logaddexp(onward[:, 0], onward[:, 1])
            total = np.logaddexp(*ahead[-1])
            expected[a:b] = np.exp(ahead[:, 1] + back[:, 1] - total)
            own = truth[a:b]
            if b - a > 1:
                pairs = np.exp(ahead[:-1, :, None] + steps + (scores + back)[1:, None, :] - total)
                np.add.at(step_gradient, (own[:-1], own[1:]), 1.0)
                step_gradient -= pairs.sum(axis=0)
            first_gradient += own[0] - expected[a]
        residual = truth - expected
        gradient = np.concatenate((np.bincount(flat, weights=residual[owner], minlength=width), step_gradient.ravel(), [first_gradient]))
        gradient = gradient / len(sequences) - decay * weights
        square += gradient * gradient
        weights = weights + rate * 5 * gradient / np.sqrt(square)
    return Field({f: float(weights[i]) for f, i in numbers.items()}, weights[width : width + 4].reshape(2, 2), float(weights[-1]))


# Words that page authors use, as text, for the composed layouts.
MAIN_NAMES = "content post entry story article body text main page single".split()
MENU_NAMES = "menu nav navigation navbar topbar breadcrumb breadcrumbs tabs toc links".split()
HEADER_NAMES = "header masthead top site-header branding logo".split()
FOOTER_NAMES = "footer site-footer bottom copyright legal colophon".split()
SIDE_NAMES = "sidebar side aside related recommended widget popular more rail trending".split()
AD_NAMES = "ad ads advert advertisement banner sponsor sponsored promo promoted adbox".split()
NOTICE_NAMES = "cookie cookies consent notice alert gdpr newsletter subscribe popup modal".split()
COMMENT_NAMES = "comments comment discussion replies respond commentlist disqus".split()
SHARE_NAMES = "share social sharing tags meta byline author".split()
TRAINING_PAGES = 320


def training_pages(seed: int = 11) -> list[tuple[str, list[bool]]]:
    """Composed pages with a label per block: True in the article, False anywhere else."""
    draw = random.Random(seed)
    syllables = "the ing tion an re on en er th es ou a der die ung ich le que eau ción os la de".split()

    def word() -> str:
        return "".join(draw.choices(syllables, k=draw.randint(1, 4)))

    def sentence(least: int, most: int) -> str:
        return " ".join(word() for _ in range(draw.randint(least, most))).capitalize() + draw.choice(".....!?:")

    def prose() -> str:
        text = " ".join(sentence(2, 18) for _ in range(draw.choice((1, 1, 2, 3, 5))))
        return text if draw.random() < 0.9 else text.replace(" ", draw.choice(("&amp; ", "### ", "%%% ", " | ")))

    def short() -> str:
        return " ".join(word() for _ in range(draw.randint(1, 4)))

    def named(names: list[str], always: bool = False) -> str:
        if not always and draw.random() < 0.25:
            return ""
        name = draw.choice(names)
        name = draw.choice((name, name, f"{draw.choice(('site', 'main', 'page', 'js', 'c', 'box'))}-{name}", f"{name} {word()}"))
        return f' {draw.choice(("class", "class", "id"))}="{name}"'

    def compose() -> tuple[str, list[bool]]:
        labels: list[bool] = []

        def block(tag: str, text: str, main: bool, attributes: str = "") -> str:
            labels.append(main)
            return f"<{tag}{attributes}>{text}" + (f"</{tag}>" if draw.random() < 0.9 or tag not in ("p", "li") else "")

        def link_list(tag: str, attributes: str) -> str:
            items = "".join(block("li", f'<a href="/{word()}">{short()}</a>', False) for _ in range(draw.randint(2, 7)))
            return f"<{tag}{attributes}><ul>{items}</ul></{tag}>"

        def aside_text(tag: str, attributes: str, most: int = 2) -> str:
            inner = "".join(block(draw.choice(("p", "div", "p")), prose() if draw.random() < 0.6 else short(), False) for _ in range(draw.randint(1, most)))
            return f"<{tag}{attributes}>{inner}</{tag}>"

        def bare(tag: str, attributes: str) -> str:
            return block(tag, prose() if draw.random() < 0.7 else short(), False, attributes)

        def menu() -> str:
            return link_list("nav", named(MENU_NAMES)) if draw.random() < 0.6 else link_list("div", named(MENU_NAMES, True))

        def advert() -> str:
            return draw.choice((bare, aside_text))("div" if draw.random() < 0.8 else "section", named(AD_NAMES, True))

        def notice() -> str:
            return draw.choice((bare, aside_text))(draw.choice(("div", "section", "dialog")), named(NOTICE_NAMES, True))

        def form() -> str:
            inner = block("label", short(), False) + "<input type=text>" + block("button", short(), False)
            return f"<form{named(['search', 'login', 'signup', 'form'])}>{inner}</form>"

        def sidebar() -> str:
            tag, attributes = draw.choice((("aside", named(SIDE_NAMES)), ("div", named(SIDE_NAMES, True)), ("section", named(SIDE_NAMES, True))))
            return draw.choice((link_list, aside_text))(tag, attributes)

        def header() -> str:
            inner = block(draw.choice(("div", "h1", "p")), short(), False)
            tag, attributes = draw.choice((("header", named(HEADER_NAMES)), ("div", named(HEADER_NAMES, True))))
            return f"<{tag}{attributes}>{inner}{menu() if draw.random() < 0.4 else ''}</{tag}>"

        def footer() -> str:
            text = f"&copy; {short()} &middot; {sentence(3, 12)}"
            tag, attributes = draw.choice((("footer", named(FOOTER_NAMES)), ("footer", ""), ("div", named(FOOTER_NAMES, True))))
            return block(tag, text, False, attributes) if draw.random() < 0.6 else f"<{tag}{attributes}>{block('p', text, False)}{link_list('div', '')}</{tag}>"

        def comments() -> str:
            tag, attributes = draw.choice((("section", named(COMMENT_NAMES, True)), ("div", named(COMMENT_NAMES, True))))
            inner = block("h3", short(), False) if draw.random() < 0.5 else ""
            for _ in range(draw.randint(1, 4)):
                kind = draw.choice(("div", "li", "article"))
                said = "".join(block("p", prose(), False) for _ in range(draw.randint(1, 2)))
                inner += f'<{kind} class="{draw.choice(("comment", "reply", "comment-body"))}">{said}</{kind}>'
            return f"<{tag}{attributes}>{inner}{form() if draw.random() < 0.3 else ''}</{tag}>"

        def paragraph() -> str:
            kind = draw.random()
            if kind < 0.62:
                text = prose()
                if draw.random() < 0.15:
                    text = text.replace(" ", f' <a href="/{word()}">{word()}</a> ', 1)
                return block("p", text, True)
            if kind < 0.72:
                return block("p", short().capitalize() + draw.choice((".", "")), True)
            if kind < 0.82:
                return block(draw.choice(("h2", "h3")), short().capitalize(), True)
            if kind < 0.88:
                items = "".join(block("li", sentence(3, 14), True) for _ in range(draw.randint(2, 4)))
                return f"<ul>{items}</ul>" if draw.random() < 0.6 else f"<ol>{items}</ol>"
            if kind < 0.92:
                return f"<blockquote>{block('p', prose(), True)}</blockquote>"
            if kind < 0.94:
                cells = "".join(block("td", short(), True) for _ in range(4))
                return f"<table><tr>{cells}</tr></table>"
            if kind < 0.96:
                return block("pre", short(), True)
            return block("div", prose(), True)

        def within() -> str:
            return draw.choice((advert, sidebar, form, notice, share))()

        def share() -> str:
            return link_list("div", named(SHARE_NAMES, True))

        def stub() -> str:
            return f"<article{named(MAIN_NAMES)}>{block('p', short() if draw.random() < 0.5 else sentence(2, 6), True)}</article>"

        def article() -> str:
            if draw.random() < 0.08:
                return stub()
            tag, attributes = draw.choice(
                (("article", named(MAIN_NAMES)), ("article", ""), ("article", ""), ("main", named(MAIN_NAMES)), ("div", named(MAIN_NAMES, True)), ("section", named(MAIN_NAMES, True)))
            )
            inner = ""
            if draw.random() < 0.85:
                title = block("h1", sentence(2, 9), True)
                inner += f"<header>{title}</header>" if draw.random() < 0.15 else title
            for _ in range(draw.choice((0, 1, 2, 3, 4, 6, 9, 14))):
                inner += paragraph()
                if draw.random() < 0.1:
                    inner += within()
            if draw.random() < 0.15:
                inner += comments()
            return f"<{tag}{attributes}>{inner}</{tag}>"

        top = ""
        if draw.random() < 0.9:
            top = f"<head>{block('title', short(), False)}<style>p{{}}</style><script>x(\"</p>\")</script></head>"
        parts = []
        for make, chance in ((notice, 0.2), (header, 0.5), (menu, 0.7), (advert, 0.5), (sidebar, 0.2), (form, 0.15)):
            if draw.random() < chance:
                parts.append(make())
        middle = article()
        for make, chance in ((share, 0.2), (advert, 0.25), (comments, 0.3), (sidebar, 0.3), (form, 0.15)):
            if draw.random() < chance:
                middle += make()
        wrapper = draw.random()
        body = "".join(parts)
        body += f'<div class="{draw.choice(("wrapper", "container", "row", "layout"))}">{middle}</div>' if wrapper < 0.3 else f"<main>{middle}</main>" if wrapper < 0.45 else middle
        if draw.random() < 0.85:
            body += footer()
        return f"<!DOCTYPE html><html>{top}<body>{body}</body></html>", labels

    return [compose() for _ in range(TRAINING_PAGES)]


def extracted(pages: DataFrame, labelled: list[tuple[str, list[bool]]] | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    ``text`` joins the main blocks by a line break; it is empty for a NULL or
    empty page and for one without main text. ``labelled`` replaces the composed
    training pages. Nothing is cut, whatever a page's length.
    """
    field = train(labelled if labelled is not None else training_pages())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = field.scorer()
        for batch in batches:
            texts = ["\n".join(field.main_blocks(page, score)) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
