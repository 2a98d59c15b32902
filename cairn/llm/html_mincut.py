"""Main text of web pages by minimum-cut labelling.

A page's text blocks are the nodes of a small graph.  A linear classifier over a block's features
(the elements around it and their class and id words, link share, length, punctuation) gives the
cost of calling it content and the cost of calling it boilerplate, which become the capacities to
the two terminals.  Blocks next to each other and blocks under one parent element are joined by
smoothness edges whose capacity is the price of labelling them differently.  A maximum flow
separates the terminals at least total cost; blocks left on the content side are the main text.

Scripts, styles, comments and other raw elements never become blocks.  A page is handled whole in
one task, pages are independent, and a batch holds a few megabytes of them.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm import storage
from cairn.llm.arrow_text import chunks

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("head noscript template svg canvas audio video annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br "
    "embed object param source track math semantics maction menclose merror "
    "mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover none mprescripts".split())
FURNITURE = frozenset("nav footer aside button select option dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
BODY = frozenset(("article", "main"))
# Words of class, id and role attributes that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices pagination popup privacy promo promoted related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "tagcloud toolbar widget complementary contentinfo".split())
# Furniture words that are also subjects of articles, and the words beside which they are furniture:
# places, shapes and parts of a page, what it offers.
SUBJECTS = frozenset(
    "ad ads banner copyright disclaimer header menu notice notices privacy promo related search share "
    "sharing social toolbar widget".split())
PLACES = frozenset(
    "area article articles back bar block body border bottom box button buttons card cards center "
    "close col column component container content count desktop entry field fixed form global grid "
    "group heading icon icons image img inline inner input item items label large left link links list "
    "logo main me media mobile module more news on open outer page panel photo policy post posts primary "
    "products reading region results right row secondary section set site slot small space sticky "
    "stories story tab tag tags text this title tools top topics unit us wrap wrapper you zone".split())
BODY_WORDS = frozenset("article content main post story entry".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*?)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|([^<]+|<)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
# Words after these in a name tell what the element has or lacks, not what it is.
MODIFIERS = frozenset("has have with without no not hide".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


@dataclass
class Weights:
    """Costs of the classifier and prices of the smoothness edges."""
    furniture: float = 12.0     # an element or a class word around the block names furniture
    body: float = 4.0           # the block is inside an article or main element
    outside: float = 4.0        # the page has such an element and the block is outside
    link: float = 3.0           # times the share of characters in links
    word: float = 0.1           # per word, up to ``words``
    words: int = 30
    sentence: float = 0.5       # ends as a sentence does
    prior: float = 1.0          # against a block that shows nothing else
    paragraph: float = 1.0      # stands in an element for running text
    neighbour: float = 0.6      # smoothness: next to each other on the page
    heading: float = 1.5        # smoothness: a heading and what follows it, besides
    border: float = 0.25        # share of an edge between furniture and what is none
    sibling: float = 0.6        # smoothness: next child with text of the same parent


@dataclass
class Block:
    parent: int
    body: bool
    furniture: bool
    why: set = field(default_factory=set)   # elements around it that a class word calls furniture
    parts: list = field(default_factory=list)
    heading: bool = False
    paragraph: bool = False
    soft: set = field(default_factory=set)  # those of ``why`` whose words are also subjects
    linked: int = 0
    text: str = ""


def _names(attributes: str) -> set[str]:
    """The words of the class, id and role attributes, without what stands after a modifier."""
    out: set[str] = set()
    for a, b, c in _NAMES.findall(attributes):
        for name in (a or b or c).lower().split():
            for word in _WORD.findall(name):
                if word in MODIFIERS:
                    break
                out.add(word)
    return out


def _furniture_words(names: set[str], in_body: bool) -> set[str]:
    """The words of ``names`` that call an element furniture.  Inside an article a word that may be
    its subject does only alone or beside words of PLACES: ``related-posts`` is furniture,
    ``related-work`` is not."""
    found = names & FURNITURE_WORDS
    if in_body and found <= SUBJECTS and names - found - PLACES:
        return set()
    return found


def _wrappers(blocks: list[Block], around: set[int], any_body: bool) -> set[int]:
    """Elements whose class words, or whose being a form, do not count: they hold the main part of
    the page.

    Those are elements around an article or main (``around``) with half of the text in such
    elements, elements inside one named by subjects alone with half of it or, on a page without any,
    elements with three quarters of its text."""
    held: dict[int, int] = {}
    total, soft = 0, set()
    for b in blocks:
        if not b.furniture and (b.body or not any_body):
            total += len(b.text)
            soft |= b.soft
            for e in b.why:
                held[e] = held.get(e, 0) + len(b.text)
    if any_body:
        return {e for e, n in held.items() if (e in around or e in soft) and 2 * n >= total}
    return {e for e, n in held.items() if 4 * n >= 3 * total}


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; unclosed elements end with the element around them."""
    out: list[Block] = []
    # Open elements: (name, number, in body, in furniture, hidden, in link, elements around it that
    # a class word calls furniture)
    stack = [("", 0, False, False, False, False, ())]
    subjects: set[int] = set()
    around, any_body = set(), False
    number, block, at, size = 0, None, 0, len(page)

    def close_to(i):
        nonlocal block
        if any(e[0] not in INLINE and not e[4] for e in stack[i:]):
            block = None
        del stack[i:]

    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        run = m[4]
        if run is not None:
            top = stack[-1]
            if top[4]:
                continue
            if block is None:
                if not run.strip():
                    continue
                home = next(e for e in reversed(stack) if e[0] not in INLINE)
                parent = stack[stack.index(home) - 1][1] if len(stack) > 1 else 0
                block = Block(parent, home[2], home[3], set(home[6]), heading=home[0] in HEADINGS,
                              paragraph=home[0] in PARAGRAPHS)
                out.append(block)
            run = html_lib.unescape(run) if "&" in run else run
            block.parts.append(run)
            block.furniture |= top[3]
            block.why.update(top[6])
            if top[5]:
                block.linked += len(run.strip())
            continue
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close_to(i)
                    break
            else:
                if name not in INLINE and not stack[-1][4]:
                    block = None
            continue
        if name in VOID:
            if name == "br" and block is not None and not stack[-1][4]:
                block.parts.append(" ")
            elif name not in INLINE and not stack[-1][4]:
                block = None
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = size if end is None else page.find(">", end.end()) + 1 or size
            continue
        if name not in INLINE and name not in HIDDEN and not stack[-1][4]:
            block = None
            for i in range(len(stack) - 1, 0, -1):  # an open p ends here; li ends li, and so on
                if stack[i][0] == "p" or (stack[i][0] == name and name in ("li", "dt", "dd", "tr",
                                                                           "td", "th", "option")):
                    close_to(i)
                    break
                if stack[i][0] not in INLINE:
                    break
        top = stack[-1]
        body, furniture, hidden, link, why = top[2:]
        names = _names(m[3]) if m[3] and "=" in m[3] else set()
        if name in BODY or (name not in INLINE and names & BODY_WORDS and name != "body"
                            and not names & FURNITURE_WORDS):
            body = True
        if name in FURNITURE or (name == "header" and not body):
            furniture = True
        elif (name == "form" or _furniture_words(names, top[2])) and name not in (
                "html", "body") and not (top[2] and name in ("header", "h1", "h2")):
            why += (number + 1,)
            if name in BODY:
                around.add(number + 1)
            elif name != "form" and names & FURNITURE_WORDS <= SUBJECTS:
                subjects.add(number + 1)
        elif name in BODY:
            around.update(why)
        any_body |= name in BODY
        hidden = hidden or name in HIDDEN
        number += 1
        stack.append((name, number, body, furniture, hidden, link or name == "a", why))
    kept = []
    for b in out:
        b.text = " ".join("".join(b.parts).split())
        b.soft = b.why & subjects
        if b.text:
            kept.append(b)
    if any(b.why for b in kept):
        wrappers = _wrappers(kept, around, any_body)
        for b in kept:
            b.furniture |= not b.why <= wrappers
    return kept


def max_flow_side(n: int, source: list[float], sink: list[float],
                  edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which of ``n`` nodes stay with the source in a minimum cut.  ``edges`` go both ways.

    Dinic's algorithm: breadth-first levels, then augmenting paths along them.  Flow straight
    through a node is taken off first."""
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def join(u, v, a, b):
        head[u].append(len(to))
        to.append(v)
        cap.append(a)
        head[v].append(len(to))
        to.append(u)
        cap.append(b)

    s, t = n, n + 1
    for i in range(n):
        through = min(source[i], sink[i])
        if source[i] > through:
            join(s, i, source[i] - through, 0.0)
        elif sink[i] > through:
            join(i, t, sink[i] - through, 0.0)
    for u, v, c in edges:
        join(u, v, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for u in queue:
            for e in head[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                path, u = [], s
                continue
            while nxt[u] < len(head[u]):
                e = head[u][nxt[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            else:
                if u == s:
                    break
                u = to[path.pop() ^ 1]
                nxt[u] += 1
                continue
            path.append(e)
            u = to[e]


_SENTENCE_END = tuple(".!?:;…。！？\"'”»)")


def label(blocks: list[Block], w: Weights = Weights()) -> list[bool]:
    """True for the blocks of the main text."""
    n = len(blocks)
    any_body = any(b.body and not b.furniture for b in blocks)
    content, plain = [], []
    for b in blocks:
        length = len(b.text.split(None, w.words))
        good = w.word * min(length, w.words)
        bad = w.prior + w.link * min(1.0, b.linked / len(b.text))
        if b.text.endswith(_SENTENCE_END):
            good += w.sentence
        if b.paragraph:
            good += w.paragraph
        if b.body:
            good += w.body
        elif any_body:
            bad += w.outside
        if b.furniture:
            bad += w.furniture
        content.append(good)
        plain.append(bad)
    edges, last = [], {}
    for i, b in enumerate(blocks):
        def joined(j, price):
            share = 1.0 if blocks[j].furniture == b.furniture else w.border
            edges.append((j, i, price * share))

        if i:
            joined(i - 1, w.neighbour + w.heading * blocks[i - 1].heading)
        if b.parent in last:
            joined(last[b.parent], w.sibling)
        last[b.parent] = i
    return max_flow_side(n, content, plain, edges)


def main_text(page: str | None, w: Weights = Weights()) -> str:
    """The content blocks of a page joined by blank lines; empty for a null or blank page."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, label(blocks, w)) if keep)


def extract_pages(pages: DataFrame, w: Weights = Weights()) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: the main text and its code points.

    Inside a block white space becomes one space; blocks keep page order and are joined by two
    line feeds.  A null html counts as empty and gives an empty text; rows that repeat an id each
    come back; other columns are ignored."""
    def run(batches):
        for rows, _, _ in chunks(batches, "html"):
            texts = [main_text(p, w) for p in rows.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return storage.arrow(
        pages.select("page_id", "url", "html"), run,
        "page_id bigint, url string, text string, n_chars bigint")
