"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, the text between two block-level tags, each with the elements
around it. Features of a block are those elements, the words their class, id and role are made
of, and shape of its text: length, share of links, how it ends. The field gives each block
(content or not) and each step from one to the next a weight; it is trained by gradient ascent
on the likelihood of labelled pages and decoded by Viterbi.

The labelled pages are made by a rule from the layouts below, with invented words, so that the
field learns structure and nothing about a language.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""
a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp
rt s samp small span strike strong sub sup time tt u var wbr
""".split())
HIDDEN = frozenset("""
script style noscript template svg math iframe object canvas audio video head title textarea select
datalist button
""".split())
PHRASING = INLINE | frozenset("""
script style noscript template svg math iframe object canvas audio video select datalist button
textarea input embed area source track
""".split())  # what stands within a line of text and does not end it
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
FOREIGN = frozenset(("svg", "math"))
CLOSES = {  # a start tag that ends an open element of these kinds
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table td th div section article main aside nav body".split())

# What class, id and role words tell. Words are whole: "research" is no search.
ABOUT = {
    "nav": "nav navbar topnav subnav navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar sitemap",
    "head": "header masthead topbar logo",
    "foot": "footer copyright colophon contentinfo",
    "side": "sidebar sidebars widget widgets aside complementary rail",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast banner",
    "advert": "ad ads adv adbox adslot dfp advert adverts advertisement advertising sponsor sponsors sponsored "
              "promo promos promotion promoted affiliate adsense doubleclick outbrain taboola",
    "form": "form forms newsletter newsletters subscribe subscription signup login search searchbox",
    "share": "share sharing social follow related recommended recommendations trending readmore teaser teasers",
    "comment": "comment comments commentlist reply replies discussion respond disqus reactions feedback",
    "content": "article content post story entry body main text page prose",
}
WHOLE = {"side": "side", "legal": "foot"}  # tell only as a class of their own
TELLS = {word: kind for kind, words in ABOUT.items() for word in words.split()}
SAYS_WHETHER = frozenset("with without has have no not show hide".split())  # "page-with-sidebar" is no sidebar

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_UNQUOTED = re.compile(r"=\s*[^\s\"'=]*/\Z")  # the slash is the end of a value
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _meanings(attributes: str) -> frozenset[str]:
    out = set()
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDING.search(value):
            out.add("hidden")
        elif name in ("class", "id", "role"):
            for token in _CAMEL.sub("-", value).lower().split():
                words = [w for w in _SPLIT.split(token) if w]
                out.update(TELLS[w] for before, w in zip(["", *words], words, strict=False)
                           if w in TELLS and before not in SAYS_WHETHER)
                out.update(WHOLE[w] for w in words if w in WHOLE and len(words) == 1)
    return frozenset(out)


@dataclass
class Block:
    text: str
    near: str               # the block-level element it lies in
    around: frozenset[str]  # what the elements around it tell
    linked: int             # characters inside links


def _within(around: frozenset[str], tag: str, meaning: frozenset[str]) -> frozenset[str]:
    """What is known inside an element, given what is known around it. The set has a bounded
    number of members, however deep elements nest."""
    if tag in INLINE or tag in ("html", "body"):
        return around
    if tag == "main":  # whatever surrounds it is the frame of the page
        around = frozenset(a for a in around if a == "about hidden" or a == "about content")
    elif tag == "article":  # some pages lie in a form as a whole
        around = around - {"under form", "about form"}
    own = {f"about {m}" for m in meaning}
    if tag in ("article", "main"):
        own.add("inner")
    own.add("inner header" if tag == "header" and "inner" in around else f"under {tag}")
    return around if own <= around else around | own


def _self_closed(attributes: str) -> bool:
    return attributes.endswith("/") and not _UNQUOTED.search(attributes)


def _after(page: str, tag: str, at: int, end: int) -> int:
    """Where the page goes on after the raw element whose start tag ends at `at`. Foreign
    elements nest, the others end at their first end tag. No tag ends beyond `end`."""
    if tag not in FOREIGN:
        close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, end)
        return close.end() if close else len(page)
    depth = 1
    while depth:
        less = page.find("<", at, end)
        if less < 0:
            return len(page)
        found = _TAG.match(page, less)
        at = found.end() if found else less + 1
        if found is None:
            continue
        slash, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if name and name.lower() == tag:
            depth += -1 if slash else not _self_closed(attributes)
    return at


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str, frozenset[str]]] = []  # (tag, near, around)
    open_: Counter = Counter()
    pieces: list[str] = []
    linked = hidden = links = paragraphs = 0  # the last three: open elements
    memo: dict[str, frozenset[str]] = {}

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                near, around = stack[-1][1:] if stack else ("", frozenset())
                out.append(Block(text, near, around, min(linked, len(text))))
            pieces.clear()
            linked = 0

    def pop() -> None:
        nonlocal hidden, links, paragraphs
        tag = stack.pop()[0]
        open_[tag] -= 1
        hidden -= tag in HIDDEN
        links -= tag == "a"
        paragraphs -= tag == "p"

    at, end = 0, len(page)
    last = page.rfind(">") + 1  # beyond it "<" begins no tag, only a comment
    while at < end:
        less = page.find("<", at)
        if less != at:
            if not hidden:
                text = entities.unescape(page[at:less if less >= 0 else end])
                pieces.append(text)
                linked += len(text) if links else 0
            if less < 0:
                break
            at = less
        found = _TAG.match(page, at) if at < last or page.startswith("<!--", at) else None
        if found is None:
            if not hidden:
                pieces.append("<")
            at += 1
            continue
        at = found.end()
        slash, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag not in PHRASING:
                flush()
            depth = None
            if open_[tag]:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
            if depth is not None and not (tag in PHRASING and any(s[0] not in PHRASING for s in stack[depth:])):
                while len(stack) > depth:
                    pop()
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in PHRASING:
            flush()
            while paragraphs and (stack[-1][0] in PHRASING or stack[-1][0] == "p"):
                pop()  # a block ends an open paragraph
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES[tag]:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i][0] in SCOPES:
                    break
        if tag in VOID or tag not in RAW - FOREIGN | INLINE and _self_closed(attributes):
            continue
        if tag in RAW:
            at = _after(page, tag, at, last)
            continue
        meaning = memo.get(attributes)
        if meaning is None:
            meaning = memo[attributes] = _meanings(attributes) if attributes.strip() else frozenset()
        near, around = stack[-1][1:] if stack else ("", frozenset())
        stack.append((tag, near if tag in INLINE else tag, _within(around, tag, meaning)))
        open_[tag] += 1
        hidden += tag in HIDDEN
        links += tag == "a"
        paragraphs += tag == "p"
    flush()
    return out


def features(block: Block) -> list[str]:
    near = block.near
    out = {"bias", f"in {near}", *block.around} - {"inner", "inner header"}
    if "inner header" in block.around:
        out.add("article header " + ("title" if near in ("h1", "h2") else "rest"))
    if not {"under article", "under main", "about content"} & out:
        out.add("no container")
    text, words = block.text, block.text.count(" ") + 1
    out.add(f"words {min(6, words.bit_length())}")
    share = block.linked / len(text)
    out.add("links " + ("none" if share == 0 else "few" if share < 0.5 else "most"))
    if text[-1] in ".!?…\"”»":
        out.add("ends like a sentence")
    if "©" in text[:40] or "all rights reserved" in text.lower():
        out.add("copyright")
    return sorted(out)


# The field --------------------------------------------------------------------------------


@dataclass
class Field:
    names: dict[str, int]
    weights: np.ndarray   # one per feature: how much it speaks for content
    steps: np.ndarray     # [from, to]
    start: np.ndarray

    def emissions(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), 2))
        for i, block in enumerate(page):
            out[i, 1] = sum(self.weights[self.names[f]] for f in features(block) if f in self.names)
        return out

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi."""
        if not page:
            return []
        score = self.emissions(page).tolist()
        (aa, ab), (ba, bb) = self.steps.tolist()
        a, b = self.start[0] + score[0][0], self.start[1] + score[0][1]
        back = []
        for x, y in score[1:]:
            back.append((b + ba > a + aa, b + bb > a + ab))
            a, b = max(a + aa, b + ba) + x, max(a + ab, b + bb) + y
        state = int(b > a)
        out = [state]
        for choice in reversed(back):
            state = int(choice[state])
            out.append(state)
        return [bool(s) for s in reversed(out)]


def train(pages: list[tuple[list[Block], list[bool]]], rounds: int = 150, penalty: float = 0.02) -> Field:
    """Gradient ascent on the pages' log-likelihood, all pages at once by position."""
    named = [[features(b) for b in page] for page, _ in pages]
    names = {f: i for i, f in enumerate(sorted({f for page in named for b in page for f in b}))}
    n, longest = len(pages), max(len(p) for p, _ in pages)
    x = np.zeros((n, longest, len(names)))
    y = np.zeros((n, longest), dtype=int)
    live = np.zeros((n, longest))
    for i, (page, label) in enumerate(zip(named, (lab for _, lab in pages), strict=True)):
        for j, found in enumerate(page):
            x[i, j, [names[f] for f in found]] = 1
        y[i, :len(label)], live[i, :len(label)] = label, 1
    size = len(names)
    theta, first, second = np.zeros(size + 6), np.zeros(size + 6), np.zeros(size + 6)
    onehot = np.eye(2)[y] * live[..., None]
    seen_step = np.einsum("nta,ntb->ab", onehot[:, :-1], onehot[:, 1:])
    for t in range(1, rounds + 1):
        w, steps, start = theta[:size], theta[size:size + 4].reshape(2, 2), theta[size + 4:]
        emit = np.stack([np.zeros((n, longest)), x @ w], axis=2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = start + emit[:, 0]
        for j in range(1, longest):
            new = np.logaddexp.reduce(forward[:, j - 1, :, None] + steps, axis=1) + emit[:, j]
            forward[:, j] = np.where(live[:, j, None] > 0, new, forward[:, j - 1])
        for j in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(steps + (emit[:, j + 1] + backward[:, j + 1])[:, None, :], axis=2)
            backward[:, j] = np.where(live[:, j + 1, None] > 0, new, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        pair = np.exp(forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :]
                      - total[:, None, None, None]) * live[:, 1:, None, None]
        slope = np.concatenate([
            np.einsum("nt,ntf->f", onehot[..., 1] - chance[..., 1], x),
            (seen_step - pair.sum(axis=(0, 1))).ravel(), (onehot[:, 0] - chance[:, 0]).sum(axis=0)])
        slope = slope / n - penalty / n * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta + 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Field(names, theta[:size], theta[size:size + 4].reshape(2, 2), theta[size + 4:])


# Labelled pages ---------------------------------------------------------------------------

# Layouts of pages. {c}: content, {n}: anything else.
SHELLS = (
    "<article>{c}</article>", "<main>{c}</main>", "<main><article>{c}</article></main>",
    '<div class="content">{c}</div>', '<div id="main-content"><div class="post-body">{c}</div></div>',
    '<section class="story">{c}</section>', '<div class="entry-content">{c}</div>',
    '<div class="wrap"><div class="article-text">{c}</div></div>', "<div>{c}</div>", "{c}",
    "<table><tr><td>{c}</td></tr></table>",
)
AROUND = (
    "<nav><ul>{links}</ul></nav>", '<ul class="menu">{links}</ul>', '<div class="breadcrumbs">{inline}</div>',
    "<nav>{p}</nav>", "<nav><p>{s}</p></nav>", "<header><h1>{s}</h1><nav>{inline}</nav></header>",
    '<div class="masthead"><h1>{s}</h1></div>', "<header><h1>{s}</h1><p>{p}</p></header>",
    "<header><p>{s}</p></header>", '<div id="header">{s}</div>', '<header><a href="/">{s}</a><p>{p}</p></header>',
    "<footer><p>{p}</p></footer>", "<footer>&copy; {s}. {p}</footer>", '<div class="footer">{p}</div>',
    "<aside><h3>{s}</h3><p>{p}</p></aside>", '<div class="sidebar"><p>{p}</p><ul>{links}</ul></div>',
    '<div class="ad">{p}</div>', '<div class="advert"><p>{p}</p></div>', '<div class="sponsored">{s}</div>',
    '<div id="cookie-notice"><p>{p}</p></div>', '<div class="notice">{p}</div>', '<div role="alert">{s}</div>',
    "<form><label>{s}</label><p>{p}</p></form>", '<div class="newsletter"><p>{p}</p></div>',
    '<section id="comments"><div class="comment"><p>{p}</p></div><div class="comment"><p>{p}</p></div></section>',
    '<ol class="comment-list"><li><p>{p}</p><p>{p}</p></li></ol>', '<div class="share">{inline}</div>',
    '<div class="related"><h4>{s}</h4><ul>{links}</ul></div>', '<div class="pagination">{inline}</div>',
    '<div style="display:none">{p}</div>', '<p class="copyright">© {s}</p>', "<ul>{links}</ul>",
)
WITHIN = tuple(a for a in AROUND[:-1] if "<h1>" not in a)  # what may interrupt an article
CONTENT = ("<p>{p}</p>", "<p>{p}", "<p>{p}</p><p>{s}</p>", "<h2>{s}</h2><p>{p}</p>",
           "<ul><li>{s}</li><li>{p}</li></ul>", "<blockquote>{p}</blockquote>", "<p>{s}.</p>",
           "<pre>{p}</pre>", "<figure><figcaption>{s}</figcaption></figure><p>{p}</p>", "<p><b>{p}<br>",
           "<table><tr><td>{s}</td><td>{s}</td></tr></table>", "<p>{p} <a href='#'>{s}</a> {p}</p>",
           "<h3>{s}</h3><p>{p}</p>", "<h4>{s}</h4><p>{p}</p>", "<ol><li>{p}</li><li>{s}</li></ol>",
           "<section><h2>{s}</h2><p>{p}</p></section>", "<h5>{s}</h5>", "<p>{s}</p>",
           "<div>{p}</div>", "<header><h1>{s}</h1></header><p>{p}</p>", "<dl><dt>{s}</dt><dd>{p}</dd></dl>")
_YES, _NO = "\ue000", "\ue001"  # marks of labelled text, private characters


def _fill(layout: str, mark: str, rng: random.Random) -> str:
    def words(low: int, high: int) -> str:
        return mark + " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(
            rng.randrange(1, 4))) for _ in range(rng.randrange(low, high)))

    def one(found: re.Match) -> str:
        kind = found.group(1)
        if kind == "p":
            return words(4, rng.choice([8, 30, 90])) + rng.choice([".", ".", ".", "", "!"])
        if kind == "s":
            return words(1, 6)
        items = [f'<a href="/{i}">{words(1, 4)}</a>' for i in range(rng.randrange(2, 7))]
        return " ".join(items) if kind == "inline" else "".join(f"<li>{i}</li>" for i in items)

    return re.sub(r"\{(\w+)\}", one, layout)


def labelled_page(rng: random.Random) -> tuple[list[Block], list[bool]]:
    pieces = [_fill(rng.choice(CONTENT), _YES, rng) for _ in range(rng.randrange(1, 9))]
    if rng.random() < 0.7:
        pieces.insert(0, _fill("<h1>{s}</h1>", _YES, rng))
    for _ in range(rng.choice([0, 0, 1, 2])):
        pieces.insert(rng.randrange(1, len(pieces) + 1), _fill(rng.choice(WITHIN), _NO, rng))
    page = [_fill(rng.choice(AROUND), _NO, rng) for _ in range(rng.randrange(4))]
    page.append(rng.choice(SHELLS).replace("{c}", "".join(pieces)))
    page += [_fill(rng.choice(AROUND), _NO, rng) for _ in range(rng.randrange(4))]
    found = blocks(f"<html><head><title>t</title></head><body>{''.join(page)}</body></html>")
    labels = [_YES in b.text for b in found]
    for b in found:
        b.text = b.text.replace(_YES, "").replace(_NO, "") or "x"
    return found, labels


def default_field(pages: int = 600, seed: int = 7) -> Field:
    rng = random.Random(seed)
    return train([labelled_page(rng) for _ in range(pages)])


# Over Spark -------------------------------------------------------------------------------


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, field.decode(found), strict=True) if keep)


def _extract(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, field) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per page: `page_id`, `url`, `text` (content blocks, one per line) and `n_chars`.

    Null and empty pages, and pages without content, have an empty text. Rows that repeat give
    the same text, null ids and urls are passed on, an empty table gives no rows, other columns
    are not read. Broken markup is read as far as it goes; a `br` is white space.
    """
    field = default_field() if field is None else field
    return pages.select(F.col("page_id").cast("long"), F.col("url"), F.col("html")).mapInArrow(
        _extract(field), "page_id long, url string, text string, n_chars long")
