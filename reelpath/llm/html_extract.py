"""Main text of web pages: minimum-cut labelling of blocks.

A page is cut into blocks, the texts between block-level tags.  Every block has
a cost for either label, the sum of two bounded parts of like size.  The first
is the log-odds of a naive Bayes classifier over its form (tag, words, share of
link text, punctuation), within ``CLIP``.  The second is what its containers
say, within ``LOWEST`` and ``IN_CONTENT``: ``article`` and ``main`` speak for
content, navigation, footers, forms, adverts, notices, comments and the like
against it.  A name counts by what it names: ``comment-list`` is a list of
comments, ``has-sidebar`` and ``promo-layout`` only mention something and weigh
little.  A ``main`` starts anew whatever stands around it, an ``article`` what
forms and mentions around it say.

The classifier is trained here, on blocks with clear containers, over a
sample of at most ``TRAIN_PAGES`` pages (chosen by hash); where nothing can be
learned, ``PRIOR`` stands in.  The costs are terminal capacities of a graph over
the page's blocks; neighbours in page order and neighbours under one parent are
joined by edges that are the stronger the closer they stand in the DOM.  The
minimum cut labels the page, so a short or untypical block goes with its
surroundings.  Blocks whose own cost outweighs all their edges keep their label
in every minimum cut; they are settled first, and the maximum flow runs over the
rest only.

The text is the content blocks in page order, character references decoded,
white space inside a block as one space, joined by a line feed.

Defined cases: null and empty html, and pages without a content block, give the
empty text; html that ends inside a tag, comment or script ends there;
unclosed and crossed tags are closed the way browsers close paragraphs and list
items; rows that repeat a page_id each get a row; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter, deque
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.session import checkpoint_root

TRAIN_PAGES = 20_000
#: what containers add to a block's cost
IN_CONTENT, HINT = 3.0, 0.7
BY_TAG, BY_NAME, BY_FORM, BY_MENTION, LOWEST = -4.8, -4.8, -4.5, -1.0, -5.0
#: containers at least so clear give the classifier its labels
CLEAR = 2.5
#: the bound of a block's own log-odds, and the strength of edges
CLIP = 2.5
ADJACENT, SIBLING = 0.8, 0.6
#: log-odds that stand in where nothing can be learned
PRIOR = {"words 1": -1.5, "words 2": -1.0, "words 3": -0.4, "words 4": 0.3, "words 5": 0.9, "words 6": 1.2, "words 7": 1.4,
         "words 8": 1.4, "links 0": 0.3, "links 2": -0.7, "links 3": -1.5, "links 4": -2.0, "stops 0": -0.7, "stops 1": 0.5,
         "stops 2": 0.7, "stops 3": 0.7, "tag h1": 1.0, "tag h2": 0.7, "tag h3": 0.7, "tag li": -0.3}

TAG = re.compile(r"<!--(?s:.*?)(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: elements that start and end a block
BLOCK = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol "
                  "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
#: elements whose text is none of the page's text
RAW = frozenset("script style textarea title iframe noembed noframes xmp template svg object audio video canvas".split())
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
#: of these, elements that a slash ends (the others read on as raw text)
SELF_CLOSING = RAW - {"script", "style", "textarea", "title", "xmp"}
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button select option optgroup noscript fieldset legend "
                             "head header search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                              "toolbar".split())
#: words of class and id that name what is not the article
BOILERPLATE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                              "cookies consent gdpr notice notices popup modal overlay menu nav navbar navigation breadcrumb "
                              "breadcrumbs sidebar footer masthead comment comments reply replies disqus share sharing social "
                              "related recommended newsletter subscribe subscription signup login widget widgets pagination "
                              "pager toolbar copyright disclaimer alert toc".split())
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
#: words that say nothing about what a name names, and words that only mention it
FRAME_WORDS = frozenset("container wrapper wrap box block section area slot list item items inner outer left right top bottom bar "
                        "panel unit holder region group row col column widget primary secondary".split())
MENTION_WORDS = frozenset("has with no without is not hide show enable enabled disable disabled".split())
#: an opening tag closes the nearest open one of these, up to the given scope
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
VOID_BLOCK = frozenset(("hr",))


class Block:
    """A block's text, the share of it inside links, its tag, the ids of its
    open elements from the root down, what they say (a cost) and the hint."""
    __slots__ = ("text", "links", "tag", "path", "says", "hint")

    def __init__(self, text, links, tag, path, says, hint):
        self.text, self.links, self.tag, self.path, self.says, self.hint = text, links, tag, path, says, hint


def names(value: str) -> tuple[bool, bool, bool]:
    """(names boilerplate, only mentions it, hints at content) of a class or id."""
    named = mentioned = hinted = False
    for token in value.split():
        words = [w.lower() for w in HINT_WORD.findall(token)]
        found = [w for w in words if w in BOILERPLATE_WORDS]
        if not found:
            hinted = hinted or any(w in CONTENT_WORDS for w in words)
            continue
        while len(words) > 1 and words[-1] in FRAME_WORDS:
            words.pop()
        if words[-1] in BOILERPLATE_WORDS and not any(w in MENTION_WORDS for w in words):
            named = True
        else:
            mentioned = True
    return named, mentioned, hinted


def judge(tag: str, attributes: str, above: tuple[float, bool]) -> tuple[tuple[float, bool], int]:
    """((cost, whether a tag or name against content is in it), hint) inside an
    element, from its tag, its attributes and what stands above it."""
    cost, firm = above
    named = mentioned = hidden = False
    hint, role = 0, ""
    if attributes.strip():
        for m in ATTRIBUTE.finditer(attributes):
            if m[5]:
                hidden = True
                continue
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id") and tag not in ("body", "html"):
                x, y, z = names(value)
                named, mentioned, hint = named or x, mentioned or y, max(hint, int(z))
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop" and value == "articleBody":
                role = role or "article"
            elif (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                hidden = True
    main = tag == "main" or role == "main"
    content = main or tag == "article" or role == "article"
    if main or (content and not firm):
        cost, firm = IN_CONTENT, False
    elif content:
        cost += HINT
    if tag in BOILERPLATE_TAGS and tag != "form" and not (tag == "header" and cost > 0) or role in BOILERPLATE_ROLES - {"form"}:
        cost, firm = min(cost, 0.0) + BY_TAG, True
    elif tag == "form" or role == "form":
        cost = min(cost, 0.0) + BY_FORM
    if named or hidden:
        cost, firm = min(cost, 0.0) + BY_NAME, True
    elif mentioned and not content:
        cost += BY_MENTION
    return (max(LOWEST, cost), firm), hint


def page_blocks(source: str) -> list[Block]:
    """The blocks of a page, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, tuple[float, bool], int]] = []       # tag, id, (cost, firm), hint
    parts: list[str] = []
    links = in_link = next_id = pos = 0
    end = len(source)

    def flush():
        nonlocal links
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = htmllib.unescape(text)
            text = " ".join(text.split())
            if text:
                tag, _, says, hint = stack[-1] if stack else ("", 0, (0.0, False), 0)
                out.append(Block(text, links / max(1, len(text)), tag, tuple(s[1] for s in stack), says[0], hint))
            parts.clear()
        links = 0

    search = TAG.search
    while pos < end:
        m = search(source, pos)
        stop = m.start() if m else end
        if stop > pos:
            piece = source[pos:stop]
            parts.append(piece)
            if in_link:
                links += len(piece)
        if not m:
            break
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), m[1] or m[4]
        if tag in RAW and not closing:
            if not (tag in SELF_CLOSING and m[0].endswith("/>")):
                close = RAW_END[tag].search(source, pos)
                pos = close.end() if close else end
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag in BLOCK:
            flush()
            in_link = 0
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                continue
            if tag in IMPLIED:
                ends, scope = IMPLIED[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        del stack[k:]
                        break
                    if stack[k][0] in scope:
                        break
            elif stack and stack[-1][0] == "p":
                stack.pop()
            if tag in VOID_BLOCK:
                continue
            above = stack[-1] if stack else ("", 0, (0.0, False), 0)
            says, hint = judge(tag, m[3] or m[6] or "", above[2])
            next_id += 1
            stack.append((tag, next_id, says, max(hint, above[3])))
    flush()
    return out


def form(b: Block) -> tuple[str, ...]:
    """The classifier's features of a block."""
    words = b.text.count(" ") + 1
    return (f"tag {b.tag}", f"words {min(8, words.bit_length())}", f"links {min(4, int(b.links * 4.999))}",
            f"stops {min(3, sum(map(b.text.count, '.!?')))}", f"commas {min(3, b.text.count(','))}",
            f"ends {b.text[-1] in '.!?'}")


def count_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: Counter = Counter()
    for b in batches:
        for source in b.column("html").to_pylist():
            for x in page_blocks(source or ""):
                if abs(x.says) >= CLEAR:
                    label = 1 if x.says > 0 else -1
                    n.update((f, label) for f in form(x))
                    n[("", label)] += 1
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.int32()), pa.array(list(n.values()), pa.int64())],
            names=["form", "says", "n"])


def learn(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Log-odds by feature; fewer than a hundred features exist.  Without blocks
    of both labels, ``PRIOR``."""
    total = pages.count()
    share = min(1.0, train_pages / max(1, total))
    sample = pages.select("html", F.xxhash64("page_id", "url").alias("h")) \
        .where(F.pmod("h", F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    rows = sample.select("html").mapInArrow(count_forms, "form string, says int, n long") \
        .groupBy("form", "says").agg(F.sum("n").alias("n")).collect()
    n = {(r.form, r.says): r.n for r in rows}
    good, bad = n.get(("", 1), 0), n.get(("", -1), 0)
    if not good or not bad:
        return PRIOR
    forms = {f for f, _ in n if f}
    return {f: math.log((n.get((f, 1), 0) + 1) / (good + 2)) - math.log((n.get((f, -1), 0) + 1) / (bad + 2)) for f in forms}


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order and under one parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            p, q = blocks[i - 1].path, b.path
            common = 0
            for x, y in zip(p, q):
                if x != y:
                    break
                common += 1
            out.append((i - 1, i, ADJACENT / (1 + 0.5 * max(0, len(p) + len(q) - 2 * common - 2))))
        parent = b.path[:-1]
        if parent in last and last[parent] != i - 1:
            out.append((last[parent], i, SIBLING))
        last[parent] = i
    return out


def minimum_cut(odds: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost.  ``odds`` > 0 is the cost of
    leaving a block out, < 0 of keeping it; a link costs its weight when its
    ends differ."""
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:                       # settle what no cut can turn
        i = todo.popleft()
        if label[i] is None and abs(odds[i]) > sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                odds[j] += w if label[i] else -w
                del near[j][i]
                if label[j] is None:
                    todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        inside = flow_side(rest, odds, near)
        for i in rest:
            label[i] = i in inside
    return [bool(x) for x in label]


def flow_side(rest: list[int], odds: list[float], near: list[dict[int, float]]) -> set[int]:
    """The source side of a minimum cut over ``rest`` (breadth-first augmenting)."""
    s, t = -1, -2
    cap: dict[int, dict[int, float]] = {s: {}, t: {}}
    for i in rest:
        cap[i] = dict(near[i])
        if odds[i] > 0:
            cap[s][i] = odds[i]
            cap[i][s] = 0.0
        elif odds[i] < 0:
            cap[i][t] = -odds[i]
            cap[t][i] = 0.0
    while True:
        before = {s: s}
        line = deque([s])
        while line and t not in before:
            u = line.popleft()
            for v, c in cap[u].items():
                if c > 1e-12 and v not in before:
                    before[v] = u
                    line.append(v)
        if t not in before:
            return set(before) - {s}
        push, v = math.inf, t
        while v != s:
            push = min(push, cap[before[v]][v])
            v = before[v]
        v = t
        while v != s:
            u = before[v]
            cap[u][v] -= push
            cap[v][u] = cap[v].get(u, 0.0) + push
            v = u


def main_blocks(source: str, odds_of: dict[str, float]) -> list[str]:
    """The content blocks' texts of a page."""
    blocks = page_blocks(source)
    if not blocks:
        return []
    odds = []
    for b in blocks:
        own = sum(odds_of.get(f, 0.0) for f in form(b))
        odds.append(max(-CLIP, min(CLIP, own)) + b.says + HINT * b.hint)
    keep = minimum_cut(odds, edges(blocks))
    return [b.text for b, k in zip(blocks, keep) if k]


def extractor(odds_of: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n".join(main_blocks(s or "", odds_of)) for s in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    checkpoint_root(pages.sparkSession)
    kind = dict(pages.dtypes)["page_id"]
    odds_of = learn(pages, train_pages)
    return pages.select("page_id", "url", "html").mapInArrow(
        extractor(odds_of), f"page_id {kind}, url string, text string, n_chars long")
