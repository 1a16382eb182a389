"""Main text of web pages by a linear-chain conditional random field (operator 5).

A page becomes its leaf blocks: runs of text between block-level tags, each with its
ancestors. A field over the blocks in page order tells main text from the rest. Its
features are ancestor tags, words of the ancestors' classes and ids, and the
block's text (length, share of links, punctuation, signs). It is trained by
likelihood (forward-backward) on TRAINING_PAGES labelled pages, which a generator
lays out in many ways with known labels, and decoded by Viterbi.

Defined results: null and empty html, and pages without main text, have empty text.
Character references are decoded; white space in a block, line breaks included,
becomes one blank; blocks join in page order by one blank. Tags that never close
end with the page. Script, style and the like are no text. Repeated rows get equal
results. Nothing is cut, however long a page is.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

TRAINING_PAGES = 300
EPOCHS = 6
SEED = 5

_NAME = "[a-zA-Z][a-zA-Z0-9:_-]*"
_TOKEN = re.compile(
    rf"""<!--(?:.*?-->|.*\Z)|<(/?)({_NAME})((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)({_NAME})([^>]*)>|<[!?/][^>]*>""",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile("[a-z]+")
_RAW = {x: re.compile(rf"</{x}\b[^>]*>", re.I) for x in ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "select")}
#: Tags that begin and end blocks.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that an opening tag ends, if one is open within its list or table.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BOUNDS = frozenset("ul ol dl table body html article section div main aside nav header footer form".split())


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # tag, and words of class and id, from the root on
    linked: int  # characters inside links
    main: bool = False  # as labelled


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    out: list[Block] = []
    text: list[str] = []
    linked, links, marked, at = 0, 0, 0, 0

    def close() -> None:
        nonlocal text, linked
        if text:
            words = html_lib.unescape("".join(text)).split()
            if words:
                out.append(Block(" ".join(words), tuple(stack), linked, marked > 0))
        text, linked = [], 0

    def pop() -> None:
        nonlocal links, marked
        tag, names = stack.pop()
        links -= tag == "a"
        marked -= "labelledmain" in names

    while True:
        m = _TOKEN.search(html, at)
        piece = html[at : m.start() if m else len(html)]
        if piece:
            text.append(piece)
            linked += len(piece) * (links > 0)
        if not m:
            break
        at = m.end()
        ends, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if ends:
            if tag in BLOCK_TAGS:
                close()
            if any(t == tag for t, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in _RAW:
            end = _RAW[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
            if any(t == "p" for t, _ in stack) and tag != "button":
                _unwind(stack, ("p",), pop)
            if tag in _ENDS:
                _unwind(stack, _ENDS[tag], pop)
        if tag in VOID_TAGS:
            continue
        names = tuple(w for x in _NAMED.findall(attributes) for w in _PART.findall("".join(x).lower())) if "=" in attributes else ()
        stack.append((tag, names))
        links += tag == "a"
        marked += "labelledmain" in names
    close()
    return out


def _unwind(stack: list, tags: tuple[str, ...], pop) -> None:
    """Close the innermost open element of these tags, unless a container stands between."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in tags:
            while len(stack) > i:
                pop()
            return
        if stack[i][0] in _BOUNDS:
            return


def features(block: Block) -> list[str]:
    words = block.text.count(" ") + 1
    size = len(block.text)
    out = ["bias", f"own={block.path[-1][0] if block.path else ''}", f"words={min(7, int(math.log2(words)))}", f"links={int(4 * min(1, block.linked / size))}"]
    for tag, names in dict.fromkeys(block.path):
        out.append(f"in={tag}")
        out += [f"named={n}" for n in names if n != "labelledmain"]
    if block.text[-1] in ".!?\"'”…":
        out.append("sentence")
    if re.search(r"[©®|»›]", block.text):
        out.append("sign")
    if block.text.count(",") + block.text.count(".") > 2:
        out.append("prose")
    return list(dict.fromkeys(out))


@dataclass
class Field:
    """Two labels: 1 is main text. A feature's weight counts for label 1."""

    weights: dict[str, float]
    moves: list[list[float]]

    def _unary(self, rows: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in row]) for row in rows]

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best labels, by Viterbi. Equal scores go to label 0."""
        if not rows:
            return []
        (a, b), (c, d) = self.moves
        unary = self._unary(rows)
        zero, one, back = 0.0, unary[0], []
        for u in unary[1:]:
            from_zero, from_one = one + c > zero + a, one + d > zero + b
            back.append((from_zero, from_one))
            zero, one = max(zero + a, one + c), max(zero + b, one + d) + u
        label = int(one > zero)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def learn(self, rows: list[list[str]], labels: list[int], rate: float) -> None:
        """One step up the likelihood of a labelled page."""
        (a, b), (c, d) = self.moves
        unary = self._unary(rows)
        n = len(rows)
        ahead = [(0.0, unary[0])]
        for u in unary[1:]:
            z, o = ahead[-1]
            ahead.append((_add(z + a, o + c), _add(z + b, o + d) + u))
        back = [(0.0, 0.0)] * n
        for i in range(n - 2, -1, -1):
            z, o = back[i + 1]
            o += unary[i + 1]
            back[i] = (_add(a + z, b + o), _add(c + z, d + o))
        total, gradient = _add(*ahead[-1]), [[0.0, 0.0], [0.0, 0.0]]
        for i, row in enumerate(rows):
            step = rate * (labels[i] - math.exp(min(0.0, ahead[i][1] + back[i][1] - total)))
            if abs(step) > 1e-6:
                for f in row:
                    self.weights[f] = self.weights.get(f, 0.0) * (1 - 1e-4 * rate) + step
        for x in (0, 1):
            for y in (0, 1):
                held = sum((labels[i - 1], labels[i]) == (x, y) for i in range(1, n))
                expected = sum(math.exp(min(0.0, ahead[i - 1][x] + self.moves[x][y] + (unary[i] if y else 0.0) + back[i][y] - total)) for i in range(1, n))
                gradient[x][y] = held - expected
        for x in (0, 1):
            for y in (0, 1):
                self.moves[x][y] += rate * gradient[x][y] / max(1, n - 1)


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


def labelled_page(draw: random.Random) -> str:
    """A page laid out at random; elements of main text have the class word `labelledmain`, which is no feature."""
    letters = "abcdefghijklmnoprstuvwéüñß"
    word = lambda: "".join(draw.choices(letters, k=draw.randint(2, 9)))
    phrase = lambda lo, hi: " ".join(word() for _ in range(draw.randint(lo, hi)))
    sentence = lambda: phrase(4, 18).capitalize() + draw.choice(".....!?")
    prose = lambda lo, hi: " ".join(sentence() for _ in range(draw.randint(lo, hi)))
    link_list = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{phrase(1, 3)}</a></li>' for _ in range(draw.randint(3, 8))) + "</ul>"
    named = lambda *names: f' class="{draw.choice(names)}"' if draw.random() < 0.6 else f' id="{draw.choice(names)}"'
    box = lambda body, *names: f"<div{named(*names)}>{body}</div>"

    def paragraph() -> str:
        kind = draw.random()
        body = prose(1, 7) if kind < 0.75 else phrase(1, 4).capitalize() + draw.choice([".", "", ","]) if kind < 0.9 else f'{prose(1, 2)} <a href="/x">{phrase(1, 3)}</a> {prose(1, 2)}'
        if draw.random() < 0.15:
            body = f"<b>{body}" + draw.choice(["</b>", "", "<br>"])
        return f"<p>{body}" + ("</p>" if draw.random() < 0.85 else "")

    def main() -> str:
        parts = [f"<h1>{phrase(2, 12)}</h1>"] * (draw.random() < 0.85)
        for _ in range(draw.randint(1, 10)):
            x = draw.random()
            if x < 0.75:
                parts.append(paragraph())
            elif x < 0.85:
                parts.append(f"<h{draw.randint(2, 4)}>{phrase(1, 6)}</h2>")
            elif x < 0.92:
                parts.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(draw.randint(1, 5))) + "</ul>")
            elif x < 0.96:
                parts.append(f"<blockquote>{prose(1, 3)}</blockquote>")
            else:
                parts.append("<table><tr><td>" + "</td><td>".join(phrase(1, 3) for _ in range(3)) + "</td></tr></table>")
        return "".join(parts)

    def extra() -> str:
        return draw.choice([
            lambda: box(prose(1, 3), "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"),
            lambda: box(prose(1, 2) + "<button>" + word() + "</button>", "cookie", "cookies", "consent", "notice", "gdpr", "popup", "newsletter"),
            lambda: f"<aside>{f'<h3>{word()}</h3>' + draw.choice([link_list(), f'<p>{prose(1, 4)}</p>'])}</aside>",
            lambda: box(link_list(), "sidebar", "related", "widget", "menu", "breadcrumb", "share", "social", "tags", "pagination"),
            lambda: f"<form>{phrase(1, 4)}<input name=q><button>{word()}</button></form>",
            lambda: box(f"<p>{prose(1, 3)}</p>", "sidebar", "widget", "related", "notice", "disclaimer"),
        ])()

    def comments() -> str:
        one = lambda: draw.choice([f"<li{named('comment', 'reply')}><p>{prose(1, 4)}</p></li>", box(f"<p>{prose(1, 3)}</p>", "comment", "reply", "comment-body")])
        body = "".join(one() for _ in range(draw.randint(1, 4)))
        return draw.choice([f"<section{named('comments', 'discussion', 'respond')}>{body}</section>", f"<div{named('comments', 'disqus', 'comment-list', 'responses')}>{body}</div>"])

    mark = "labelledmain"
    inner = "".join(f'<div class="{mark}">{part}</div>' for part in [main()])
    if draw.random() < 0.35:
        inner += draw.choice([extra, comments])()
    shell = draw.random()
    whole = f"<article>{inner}</article>" if shell < 0.55 else f"<main>{inner}</main>" if shell < 0.7 else box(inner, "content", "post", "entry", "story", "article-body", "text", "main") if shell < 0.95 else inner
    # the mark's own element must teach nothing: real pages have it nowhere
    top = [f"<nav>{link_list()}</nav>"] * (draw.random() < 0.8) + [f"<header><a href=/>{phrase(1, 3)}</a><p>{phrase(2, 8)}</p></header>"] * (draw.random() < 0.4)
    bottom = [comments()] * (draw.random() < 0.35) + [f"<footer>&copy; {word()} {draw.choice(['', '&middot; ' + prose(1, 2), link_list()])}</footer>"] * (draw.random() < 0.85)
    middle = [whole] + [extra() for _ in range(draw.choice([0, 1, 1, 2, 3]))]
    if draw.random() < 0.6:
        middle.reverse()
    draw.shuffle(top)
    return f"<html><head><title>{phrase(2, 6)}</title></head><body>{''.join(top + middle + bottom)}</body></html>"


@cache
def trained(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Field:
    """The field learned from generated pages; the same for the same numbers."""
    draw = random.Random(seed)
    data = []
    for _ in range(pages):
        own = blocks(labelled_page(draw))
        for block in own:  # the marked element itself is taken out of the paths
            block.path = tuple(x for x in block.path if "labelledmain" not in x[1])
        data.append(([features(b) for b in own], [int(b.main) for b in own]))
    field = Field({}, [[0.0, 0.0], [0.0, 0.0]])
    for epoch in range(epochs):
        draw.shuffle(data)
        for rows, labels in data:
            if rows:
                field.learn(rows, labels, 0.3 / (1 + epoch))
    return field


def main_text(html: str | None, field: Field) -> str:
    own = blocks(html or "")
    return " ".join(b.text for b, label in zip(own, field.decode([features(b) for b in own]), strict=True) if label)


def _extract(field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = [main_text(h, field.value) for h in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], [*part.schema.names[:-1], "text"])

    return run


def extract(pages: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """A row for each row of pages: the key columns and text."""
    rows = pages.select(*keys, F.col(html_col).alias("html_"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(tidy(_extract(pages.sparkSession.sparkContext.broadcast(trained()))), f"{schema}, text string")


def extraction_report(pages: DataFrame) -> DataFrame:
    """A row for each page: page_id, url, text, n_chars."""
    return extract(pages, ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))
