"""Main text of web pages by minimum-cut labelling.

A page is read as blocks of text. A linear classifier over tag names, class words, link share, length and
punctuation gives every block a cost of being content and one of being boilerplate: the capacities of its
edges to the two terminals. Blocks that follow each other, and blocks of one parent element, are joined by
smoothness edges. The minimum cut, by augmenting paths, labels all blocks of the page at once; blocks on the
content side, in page order, are the text. Text that no reader sees (scripts, styles, forms, comments of the
markup) never becomes a block. A page is a row and its graph is small; rows are independent.

Class words that mark boilerplate never count on html, body, main and an article that is in no other article,
nor on an element that holds most of the page's text (the text of its articles, if it has any): see ``judge_names``.

Inside a block, white space (line breaks too) becomes one space; character references are decoded.
Defined results: null or empty html gives the empty text. Broken markup is read to its end.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.tables import read, widened, without

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_GAP = re.compile(r"\s+")
#: Content of these is no text of the page.
SILENT = frozenset("script style noscript template head title form button select option textarea input iframe object svg math canvas audio video dialog".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption address nav aside header footer menu form fieldset details summary hr center".split()
)
#: An open element that a new one of its kind ends.
ENDS_SAME = frozenset("p li dt dd tr td th option".split())
#: Weights of the classifier; positive speaks for content.
TAGS = {
    "article": 4.0, "main": 2.5, "p": 1.2, "h1": 1.0, "h2": 0.8, "h3": 0.6, "blockquote": 0.6, "pre": 0.6, "td": 0.2, "li": -0.2, "section": 0.2,
    "nav": -12.0, "footer": -12.0, "aside": -12.0, "header": -9.0, "menu": -12.0,
}
GOOD = frozenset("article content main post entry story body text page".split())
BAD = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu menubar sidebar side footer foot header masthead breadcrumb "
    "breadcrumbs cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login form search share sharing social comment "
    "comments reply replies disqus respond discussion related recommended widget toolbar pagination pager tags copyright legal disclaimer skip hidden".split()
)
#: Names of what readers write: these may be most of a page and still not be its text.
REPLIES = frozenset("comment comments reply replies disqus respond discussion".split())
#: In a hyphenated name these say nothing against its other words: site-footer is a footer, no-sidebar is no sidebar.
PLAIN = GOOD | frozenset(
    "site left right top bottom upper lower inner outer primary secondary global mobile desktop sticky fixed box wrap wrapper container holder list item items "
    "link links block area section title label icon button btn group row col column panel unit slot bar web blog".split()
)
GOOD_WEIGHT, BAD_WEIGHT = 2.0, -12.0
ADJACENT, SIBLING = 0.35, 0.35


@dataclass
class Node:
    tag: str
    weight: float = 0.0
    silent: bool = False
    link: bool = False
    number: int = 0
    good: float = 0.0
    bad: bool = False
    replies: bool = False
    nested: bool = False
    story: int = 0
    size: int = 0


@dataclass
class Block:
    text: str
    parent: int
    weight: float
    linked: float
    tags: list[str] = field(default_factory=list)


def attributes_of(raw: str) -> dict[str, str]:
    """Lower-case attribute name -> value, empty if it has none. Of equal names the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), double or single or bare)
    return out


def hides(attributes: dict[str, str]) -> bool:
    """Whether an element with these attributes is not shown."""
    if "hidden" in attributes and not attributes["hidden"].strip().lower().startswith(("until", "false")):
        return True
    shown = _DISPLAY.findall(attributes.get("style", ""))
    return attributes.get("aria-hidden", "").strip().lower() == "true" or bool(shown and shown[-1].lower() == "none")


def named(names: list[str]) -> tuple[bool, bool, bool]:
    """Whether the names of an element speak for content, for boilerplate, and for readers' replies.

    A hyphenated name speaks for boilerplate if its words all do, but for plain ones, and no name of one word
    speaks for content.
    """
    parts = [w for n in names if (w := _WORD.findall(n))]
    single = {w[0] for w in parts if len(w) == 1}
    joined = [w for w in parts if len(w) > 1 and not BAD.isdisjoint(w) and all(x in BAD or x in PLAIN for x in w)]
    bad = bool(BAD & single) or bool(joined and not GOOD & single)
    replies = bad and (bool(REPLIES & single) or any(not REPLIES.isdisjoint(w) for w in joined))
    return any(x in GOOD for w in parts for x in w), bad, replies


def judge_names(blocks: list[Block], above: list[list[Node]]) -> None:
    """Add the weights of element names to the blocks below them (``above``: the open elements of each)."""
    if any(n.bad for nodes in above for n in nodes):
        told = 0
        boiler = [any(TAGS.get(n.tag, 0.0) <= -9.0 and n.weight < -1 for n in nodes) for nodes in above]
        for b, nodes, no in zip(blocks, above, boiler, strict=True):
            if not no and any(n.tag in ("article", "main") and not n.bad for n in nodes):
                told += len(b.text)
                for n in nodes:
                    n.story += len(b.text)
        page = 0
        for b, nodes, no in zip(blocks, above, boiler, strict=True):
            # With articles on the page, elements of bad names that hold none of them are not its text.
            if not no and not (told and any(n.bad and not n.story for n in nodes)):
                page += len(b.text)
                for n in nodes:
                    n.size += len(b.text)
        for n in {id(n): n for nodes in above for n in nodes if n.bad}.values():
            own = n.tag in ("html", "body", "main") or (n.tag == "article" and not n.nested)
            most = 2 * n.size > page and (2 * n.story > told if told else not n.replies)
            n.bad = not own and not most
        stories = [nodes for nodes, no in zip(above, boiler, strict=True) if not no and any(n.story and n.tag in ("article", "main") and not n.bad for n in nodes)]
        if stories and all(any(n.bad for n in nodes) for nodes in stories):
            # A list of articles, each below a bad name: no article is left outside, so these hold the text.
            for nodes in stories:
                for n in nodes:
                    n.bad = n.bad and not n.story
    for b, nodes in zip(blocks, above, strict=True):
        b.weight += sum(BAD_WEIGHT if n.bad else n.good for n in nodes)


def blocks_of(page: str) -> list[Block]:
    """Blocks of visible text in page order."""
    out: list[Block] = []
    held_by: list[list[Node]] = []
    open_: list[Node] = [Node("")]
    parts: list[str] = []
    linked, count = 0, 0

    def flush() -> None:
        nonlocal linked
        text = _GAP.sub(" ", "".join(parts)).strip()
        if text:
            holder = next((n for n in reversed(open_) if n.tag in BLOCK), open_[0])
            above = next((n for n in reversed(open_[: open_.index(holder)]) if n.tag in BLOCK), open_[0])
            out.append(Block(text, above.number, sum(n.weight for n in open_), linked / len(text), [n.tag for n in open_]))
            held_by.append(open_[:])
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not open_[-1].silent:
            text = entities.unescape(raw)
            parts.append(text)
            if open_[-1].link:
                linked += len(text.strip())

    def close(k: int) -> None:
        if any(n.tag in BLOCK for n in open_[k:]):
            flush()
        del open_[k:]

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = next((i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == tag), 0)
            if k:
                close(k)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            # A new block ends open paragraphs, and an open element of its own kind that cannot nest.
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == "p" or (open_[i].tag == tag and tag in ENDS_SAME):
                    close(i)
                    break
                if open_[i].tag in BLOCK:
                    break
            flush()
        above = open_[-1]
        attributes = attributes_of(m[3]) if m[3] else {}
        names = [n for a in ("class", "id", "role") if a in attributes for n in attributes[a].lower().split()]
        weight = TAGS.get(tag, 0.0)
        if tag == "header" and any(n.tag == "article" for n in open_):
            weight = -0.5
        good, bad, replies = named(names) if names else (False, False, False)
        count += 1
        hidden = above.silent or tag in SILENT or bool(attributes and hides(attributes))
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        nested = bad and tag == "article" and any(n.tag == "article" for n in open_)
        open_.append(Node(tag, weight, hidden, above.link or tag == "a", count, GOOD_WEIGHT if good and tag in BLOCK else 0.0, bad, replies, nested))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            open_.pop()
    add(page[at:])
    flush()
    judge_names(out, held_by)
    return out


def leaning(b: Block) -> float:
    """Positive for content: what the elements, length, punctuation and links of a block say."""
    n = len(b.text)
    ends = b.text[-1:] in ".!?\"'»”)"
    return b.weight - 0.6 + min(n, 400) / 200 + 0.4 * ends - 3.5 * b.linked


def minimum_cut(lean: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Content side of the minimum cut: source edges where lean > 0, sink edges where lean < 0."""
    n = len(lean)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for i, x in enumerate(lean):
        join(s, i, x, 0.0) if x > 0 else join(i, t, -x, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        came = [-1] * (n + 2)
        came[s] = -2
        queue = deque([s])
        while queue and came[t] == -1:
            x = queue.popleft()
            for e in out[x]:
                if room[e] > 1e-12 and came[to[e]] == -1:
                    came[to[e]] = e
                    queue.append(to[e])
        if came[t] == -1:
            return [came[i] != -1 for i in range(n)]
        path, x = [], t
        while x != s:
            path.append(came[x])
            x = to[came[x] ^ 1]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow


def main_text(page: str | None) -> str:
    blocks = blocks_of(page) if page else []
    lean = [leaning(b) for b in blocks]
    edges = [(i, i + 1, ADJACENT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if b.parent in last:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    if all(x > 0 for x in lean) or not any(x > 0 for x in lean):
        keep = [x > 0 for x in lean]  # nothing to cut
    else:
        keep = minimum_cut(lean, edges)
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points), which replace columns of the same name."""
    pages = without(pages, ["text", "n_chars"])
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h) for h in part.column(part.schema.get_field_index(html)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.mapInArrow(run, widened(pages, "text string, n_chars long"))


def op3_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
