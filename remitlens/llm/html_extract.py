"""Main text of web pages: boosted trees over DOM nodes, decoded top-down.

Trees score every element for being main text, from features of its subtree,
attributes, depth and siblings. The page is decoded as a whole: an element is
open (a frame that may hold anything), kept (its text is main text, except in
dropped parts) or dropped with everything below, so no element under a dropped
one is kept. The labelling of the highest likelihood wins.

No page is labelled. The trees learn from a bounded sample of pages whose main
element is marked up (article, main), with boilerplate of many kinds put into
copies of them and the main element's name changed in part, so that they don't
lean on one tag.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.boosting import Boosted, boost
from remitlens.llm.scratch import Shipped

#: Pages to learn from, about, and the markup of a page that trains, at most.
SAMPLE, MARKUP = 300, 200_000
#: What every page with a marked main element has in its markup.
MARK = (
    r"(?i)<(?:article|main)(?=[\s/>])|(?:class|id|role|itemprop|aria-label)\s*=\s*"
    r"(?:\"[^\">]*?(?:main|articlebody)|'[^'>]*?(?:main|articlebody)|[^\s>\"']*?(?:main|articlebody))"
)

# Fixed values of HTML: elements without content, elements whose content is
# no markup, elements that begin a block, start tags that end an open element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table html body article section div td th".split())
# Fixed word lists: attribute tokens that speak for or against main text.
FOR = set("article articlebody body content copy entry main post prose story text".split())
AGAINST = set(
    "ad ads advert advertisement banner bar breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer form gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notification pagination paywall popup promo promoted reader "
    "recommended related replies reply responses rss search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe tags "
    "teaser toolbar tracking warning widget".split()
)
PLAIN = ["p", "div", "section", "article", "main", "h", "li", "ul", "a", "b", "nav", "aside", "footer", "header", "form", "table", "figure"]
NEVER = RAW | set("head button select input nav aside footer form dialog svg object canvas audio video".split())
#: Never main text itself, but a page's body can lie inside.
WRAPPERS = {"form"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S
)
_NAMES = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: list[str]
    children: list[int] = field(default_factory=list)
    #: texts of the node itself: block, place in the page, text
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parse(page: str) -> list[Node]:
    """The elements of a page in page order; any markup is accepted."""
    nodes = [Node("#page", -1, 0, [])]
    stack, block, at = [0], 0, 0

    def text(part: str) -> None:
        if part:
            nodes[stack[-1]].texts.append((block, position, html.unescape(part)))

    position, size = 0, len(page)
    while position < size:
        m = _MARKUP.search(page, position)
        if not m:
            text(page[position:])
            break
        text(page[position : m.start()])
        position = m.end()
        close, tag = (x.lower() if x else "" for x in m.group(1, 2))
        if close:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if nodes[stack[i]].tag == close), 0)
            if depth:
                if any(nodes[i].tag in BLOCK for i in stack[depth:]):
                    block += 1
                del stack[depth:]
            continue
        if not tag:
            continue
        ended = {"p"} if tag in BLOCK else set()
        ended |= ENDS.get(tag, set())
        for i in range(len(stack) - 1, 0, -1):
            name = nodes[stack[i]].tag
            if name in ended:
                del stack[i:]
                break
            if name in SCOPES:
                break
        if tag in BLOCK:
            block += 1
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m.group(3) or ""))
        nodes.append(Node(tag, stack[-1], len(stack), [x.lower() for x in _TOKEN.findall(names)]))
        at = len(nodes) - 1
        nodes[stack[-1]].children.append(at)
        if tag == "br":
            nodes[stack[-1]].texts.append((block, position, " "))
        if tag in VOID or page[m.end() - 2 : m.end()] == "/>" and tag not in BLOCK:
            continue
        stack.append(at)
        if tag in RAW:
            end = re.compile(rf"</\s*{re.escape(tag)}", re.I).search(page, position)
            position = end.start() if end else size
    return nodes


def node_features(nodes: list[Node], masked: bool = False) -> np.ndarray:
    """A row per element. ``masked`` hides the names of main elements."""
    n = len(nodes)
    own = np.array([sum(len(t.strip()) for *_, t in x.texts) for x in nodes], float)
    marks = np.array([sum(t.count(c) for *_, t in x.texts for c in ".,;!?") for x in nodes], float)
    linked = np.array([own[i] if x.tag == "a" else 0.0 for i, x in enumerate(nodes)])
    size, text, links, punctuation, paragraphs = np.ones(n), own.copy(), linked.copy(), marks.copy(), np.array([x.tag == "p" for x in nodes], float)
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for column in (size, text, links, punctuation, paragraphs):
            column[up] += column[i]
        if nodes[i].tag == "a":
            links[up] += text[i] - own[i]
    against, for_main, under_bad, under_main = (np.zeros(n) for _ in range(4))
    whole = max(text[0], 1.0)
    wraps = [x.tag in WRAPPERS and 2 * text[i] >= whole for i, x in enumerate(nodes)]
    rows = np.zeros((n, 20 + len(PLAIN)))
    before = 0.0
    for i, x in enumerate(nodes):
        against[i] = sum(t in AGAINST and not (wraps[i] and t == x.tag) for t in x.tokens) + (x.tag in NEVER and not wraps[i])
        for_main[i] = 0.0 if masked else sum(t in FOR for t in x.tokens) + 2.0 * (x.tag in ("article", "main"))
        up = max(x.parent, 0)
        if i:
            under_bad[i] = under_bad[up] + against[up]
            under_main[i] = under_main[up] + for_main[up]
        family = nodes[up].children if i else [0]
        same = sum(nodes[c].tag == x.tag for c in family)
        tag = "h" if re.fullmatch("h[1-6]", x.tag) else x.tag
        if masked and tag in ("article", "main"):
            tag = "div"
        rows[i, :20] = (
            text[i],
            text[i] / whole,
            text[i] / size[i],
            links[i] / max(text[i], 1.0),
            punctuation[i] / max(text[i], 1.0),
            own[i] / max(text[i], 1.0),
            paragraphs[i],
            size[i],
            x.depth,
            before / whole,
            len(x.children),
            len(family),
            same / max(len(family), 1),
            against[i],
            for_main[i],
            min(under_bad[i], 3),
            min(under_main[i], 3),
            text[up] / whole,
            links[up] / max(text[up], 1.0),
            family.index(i) / max(len(family), 1),
        )
        if tag in PLAIN:
            rows[i, 20 + PLAIN.index(tag)] = 1
        before += own[i]
    return rows


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which elements are kept, in the likeliest labelling without
    contradictions (open, kept or dropped; see above)."""
    n = len(nodes)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    drop, keep, frame = no.copy(), yes.copy(), no.copy()
    for i in range(n - 1, 0, -1):
        if nodes[i].tag in NEVER:
            keep[i] = -np.inf
            if nodes[i].tag not in WRAPPERS:
                frame[i] = -np.inf
        up = nodes[i].parent
        drop[up] += drop[i]
        keep[up] += max(keep[i], drop[i])
        frame[up] += max(keep[i], drop[i], frame[i])
    state = ["frame"] * n
    for i in range(1, n):
        above = state[nodes[i].parent]
        if above == "drop" or drop[i] >= max(keep[i], frame[i] if above == "frame" else -np.inf):
            state[i] = "drop"
        elif above == "keep" or keep[i] >= frame[i]:
            state[i] = "keep"
    return [s == "keep" for s in state]


def text_of(nodes: list[Node], kept: list[bool]) -> str:
    """Kept text by block, in page order."""
    blocks: dict[int, list[tuple[int, str]]] = {}
    for i, x in enumerate(nodes):
        if kept[i]:
            for block, place, part in x.texts:
                blocks.setdefault(block, []).append((place, part))
    return "\n\n".join(t for b in sorted(blocks) if (t := _SPACE.sub(" ", "".join(p for _, p in sorted(blocks[b], key=lambda t: t[0]))).strip()))


def weak_labels(nodes: list[Node]) -> np.ndarray | None:
    """1 inside the marked-up main element and outside boilerplate; None for
    a page without such an element."""
    main = [x.tag in ("article", "main") or bool({"main", "articlebody", "maincontent"} & set(x.tokens)) for x in nodes]
    holds = list(main)
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    inside, bad = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        up = max(x.parent, 0)
        inside[i] = main[i] or (i > 0 and inside[up])
        around = {x.tag} if x.tag in WRAPPERS and holds[i] and not inside[i] else set()
        bad[i] = (i > 0 and bad[up]) or x.tag in NEVER - around or bool((AGAINST - around) & set(x.tokens))
    return (inside & ~bad).astype(float) if inside.any() else None


#: Boilerplate for training copies, as (before or inside the main element, markup).
EXTRAS = [
    ("before", '<header class="site-header"><a href="/">{0}</a><p>{1}</p></header>'),
    ("before", '<div class="cookie-notice"><p>{1}</p><a href="/x">{0}</a></div>'),
    ("before", '<aside class="sidebar"><h2>{0}</h2><ul><li><a href="/y">{1}</a></li></ul></aside>'),
    ("before", '<form action="/s"><label>{0}</label><input name="q"></form>'),
    ("before", '<div id="menu"><ul><li><a href="/z">{0}</a></li><li><a href="/w">{0}</a></li></ul></div>'),
    ("inside", '<div class="ad-slot"><p>{1}</p></div>'),
    ("inside", '<aside><p>{1}</p></aside>'),
    ("inside", '<form class="newsletter"><p>{1}</p><input></form>'),
    ("inside", '<div class="share social"><a href="/s">{0}</a></div>'),
    ("inside", '<section id="comments"><h3>{0}</h3><div class="comment"><p>{1}</p></div><div class="comment"><p>{1}</p></div></section>'),
    ("after", '<div class="comments"><div class="comment"><p>{1}</p></div><div class="comment-reply"><p>{1}</p></div></div>'),
    ("after", '<div class="related"><a href="/r">{0}</a><p>{1}</p></div>'),
    ("after", '<div class="sidebar widget"><p>{1}</p></div>'),
]


def training_copies(page: str, number: int) -> list[str]:
    """The page, and a copy with boilerplate of several kinds put in; a third
    of the copies have the body in one form."""
    words = re.sub(r"<[^>]*>", " ", page).split()[8:60] or ["text"]
    short, long = html.escape(" ".join(words[:3])), html.escape(" ".join(words[3:40]) or "text")
    copy = page
    for k in range(4):
        where, markup = EXTRAS[(number * 5 + k * 3) % len(EXTRAS)]
        extra = markup.format(short, long)
        if where == "before":
            copy = copy.replace("<article", extra + "<article", 1)
        elif where == "inside":
            copy = copy.replace("</article>", extra + "</article>", 1)
        else:
            copy = copy.replace("</article>", "</article>" + extra, 1)
    if number % 3 == 0:
        copy = re.sub(r"<body[^>]*>", r'\g<0><form id="form1">', copy, count=1, flags=re.I)
    return [page, copy]


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, features, labels) of each training copy of the pages of a
    batch that mark their main element."""
    for batch in batches:
        out = []
        for number, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for k, copy in enumerate(training_copies(page or "", abs(number))):
                nodes = parse(copy)
                labels = weak_labels(nodes)
                if labels is not None:
                    x = node_features(nodes, masked=(abs(number) // 7 + k) % 3 == 0)
                    out.append((number, x.astype(np.float32).tobytes(), labels.astype(np.float32).tobytes()))
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["n", "x", "y"])


def fit(pages: DataFrame, sample: int = SAMPLE) -> Boosted | None:
    """Trees from about ``sample`` of the pages that mark their main element,
    the ones of the smallest hash; None if no page does. Of a page no more than
    MARKUP characters train, around the first mark. The draw grows until it
    has enough marked pages or holds every page that may be one."""
    mark = F.regexp_instr("html", F.lit(MARK))
    may = pages.where(mark > 0)
    total = may.count()
    draw = F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30))
    part = F.when(F.char_length("html") <= MARKUP, F.col("html")).otherwise(F.col("html").substr(F.greatest(F.lit(1), mark - MARKUP // 2), F.lit(MARKUP)))
    share, rows = min(1.0, sample / max(total, 1)), []
    while total:
        few = may.where(draw <= F.lit(int(share * (1 << 30)))).select(draw.alias("n"), part.alias("html"))
        found = few.mapInArrow(_train_rows, "n long, x binary, y binary").orderBy("n").limit(4 * sample)
        rows = sorted(found.select("x", "y").collect(), key=lambda r: (r["x"], r["y"]))
        if len(rows) >= sample or share >= 1.0:
            break
        share = min(1.0, 8 * share)
    if not rows:
        return None
    width = 20 + len(PLAIN)
    x = np.vstack([np.frombuffer(r["x"], np.float32).reshape(-1, width) for r in rows]).astype(float)
    y = np.concatenate([np.frombuffer(r["y"], np.float32) for r in rows]).astype(float)
    return boost(x, y)


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(2)
            for a in range(0, len(pages), 128):
                trees = [parse(p or "") for p in pages.slice(a, 128).to_pylist()]
                x = np.vstack([node_features(t) for t in trees])
                odds = np.split(np.clip(model.value.log_odds(x), -12, 12), np.cumsum([len(t) for t in trees])[:-1])
                texts = [text_of(t, decode(t, o)) for t, o in zip(trees, odds, strict=True)]
                part = batch.slice(a, len(trees))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def main_texts(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks of the kept elements, white space in a block as one space, joined
    by blank lines; character references are decoded. Null or empty html, and
    pages without main text, give an empty text. If no page of the table marks
    its main element, nothing can be learned and all text outside elements
    that never hold main text is kept. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    model = fit(rows, sample) or Boosted(2.0, 1.0, [])
    kind = rows.schema["page_id"].dataType.simpleString()
    extract = _extract(Shipped(pages.sparkSession, model))
    found = rows.mapInArrow(extract, f"page_id {kind}, url {rows.schema['url'].dataType.simpleString()}, text string")
    return found.select("*", F.char_length("text").cast("long").alias("n_chars"))
