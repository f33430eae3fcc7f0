"""Main text of HTML pages by minimum-cut labelling.

A page becomes a row of text blocks. Each block has two costs: of being content and of being boilerplate, from a
logistic classifier on its text (trained on blocks whose element names tell their role) and from the names around
it. The costs are the capacities to the two terminals; neighbouring blocks and blocks of one container are tied by
smoothness edges. The minimum cut, by maximum flow, gives the cheapest labelling.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import map_texts, pieces, ship

#: Element names by their role in HTML.
RAW = "script style noscript textarea title iframe".split()
#: Not shown, or labels of controls and drawings; what lies between their tags is no text if they are closed.
SKIPPED = set("template select option datalist button svg".split())
FOREIGN = {"svg", "math"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th
    thead tr ul""".split())
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "search"}
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
CONTENT_NAMES = set("article content story entry post main body text".split())
BOILERPLATE_NAMES = set("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr
    notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login comment comments disqus reply replies
    respond responses sidebar side rail widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs menu
    menus nav navbar navigation footer header masthead topbar toolbar copyright pagination pager skip search form outbrain taboola
    complementary contentinfo disclaimer legal privacy warning""".split())
#: Those that may stand beside a content name (a content column with a sidebar, an article's header).
MIXED_NAMES = set("side sidebar rail header menu menus form search skip notice notices widget widgets banner social".split())

#: First words of a name that tells a topic or what else there is on the page, and last words of one that tells a state.
TOPICS, STATES = set("category cat tag topic has with without no".split()), set("open closed enabled disabled".split())

#: Comments and declarations, or a tag; a quote begins a value only behind an equals sign.
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?|[^>=])*+)>""", re.S | re.I)
#: What has no end takes the rest of the page.
ENDLESS = re.compile(r"<!.*\Z|<\?.*\Z", re.S)
RAW_ENDS = {name: re.compile(f"</{name}\\s*>", re.I) for name in RAW}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")

#: Pages that the classifier is fitted on, about; chosen by the hash of their key. And their blocks, at most.
SAMPLE_PAGES = 600
SAMPLE_BLOCKS = 30_000
FEATURES = 6
#: Where the ridge pulls the weights: length and sentences speak for content, links and a copyright sign against it.
GENERAL = np.array([-3.0, 5.0, -4.0, 0.5, 1.0, -3.0])
RIDGE = 0.02
#: Costs in nats: elements and names around a block, and the smoothness between neighbours and within a container.
#: The classifier (3 at most) and the smoothness of a block (2.4 at most) together outweigh a name, but no element.
BOILERPLATE_COST, NAME_COST, CONTENT_COST, NEIGHBOUR, CONTAINER = 9.0, 4.0, 4.0, 0.4, 0.8
#: The cost of a name on a page that would be empty with the other one: less than the classifier gives to a sentence or two.
WEAK_NAME_COST = 1.5


class Block:
    __slots__ = ("text", "links", "container", "tag", "hint")

    def __init__(self, text, links, container, tag, hint):
        self.text, self.links, self.container, self.tag, self.hint = text, links, container, tag, hint


def hint_of(tag: str, rest: str, parent: int) -> int:
    """Role told by names: -2 boilerplate by an element, -1 by a class, id or role, 1 content, 0 nothing.

    Boilerplate holds for everything inside, but <main> overrules a name around it and <article> evens it out.
    Where some names of an element tell of content and others of boilerplate, <article> and <main> stay content, and
    for any other element the text decides.
    """
    if parent == -2 or tag in BOILERPLATE_TAGS or (tag == "header" and parent <= 0):
        return -2
    if parent < 0 and tag not in CONTENT_TAGS:
        return parent
    hint = 1 if tag == "main" or (tag == "article" and parent >= 0) else 0 if tag == "article" else parent
    if not rest or tag in ("body", "html"):  # names there tell of the layout
        return hint
    names = [PART.findall(w) for m in NAMES.finditer(rest) for w in (m[1] or m[2] or m[3] or "").lower().split()]
    wanted = any(CONTENT_NAMES.intersection(n) and not BOILERPLATE_NAMES.intersection(n) for n in names)
    if wanted or tag in CONTENT_TAGS:
        names = [n for n in names if not n or (n[0] not in TOPICS and n[-1] not in STATES)]
    words = {w for n in names for w in n}
    unwanted = words & BOILERPLATE_NAMES
    if hint > 0:  # an article's own header holds its title
        unwanted = unwanted - {"header"}
    if not unwanted:
        return 1 if words & CONTENT_NAMES and parent >= 0 else hint
    if tag == "main" or (tag == "article" and wanted and parent >= 0):
        return hint
    if unwanted <= MIXED_NAMES and (tag in CONTENT_TAGS or words & CONTENT_NAMES):
        return hint
    if parent >= 0 and (wanted or (tag == "article" and not parent)):
        return min(hint, 0)
    return -1


def has_end(token: str) -> bool:
    """Whether a comment, a CDATA section or a declaration ends with what ends it."""
    if token.startswith("<!--"):
        return len(token) >= 7 and token.endswith(("-->", "--!>"))
    if token[:9].upper() == "<![CDATA[":
        return token.endswith("]]>")
    return token.endswith(">")


def tags_of(page: str) -> list[tuple[int, int, str, str, str]]:
    """Start, end, name in lower case, "/" of a closing tag, and attributes of each tag; comments have no name.

    A raw element is one entry without a name, up to its closing tag or the end of the page, and so is an element to
    be skipped from its opening tag to the closing one that belongs to it; without one, it is an ordinary tag.
    """
    tags, at, foreign = [], 0, 0
    opened: dict[str, list[int]] = {}
    last = page.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    while m := TOKEN.search(page, at, last):
        if m["name"] is None and m.end() == last and not has_end(m.group()):
            break  # cut off by the end of the search, not by its own end
        at, name, close, rest = m.end(), (m["name"] or "").lower(), m["close"], m["rest"]
        empty = bool(name) and rest.endswith("/")
        if name in RAW_ENDS and not close and not (foreign and empty):
            end = RAW_ENDS[name].search(page, at)
            at, name = end.end() if end else len(page), ""
        elif name in FOREIGN and not (empty and not close):
            foreign = max(0, foreign - 1) if close else foreign + 1
        start = m.start()
        if name in SKIPPED and close and opened.get(name):
            first = opened[name].pop()
            start = tags[first][0]
            del tags[first:]
            for places in opened.values():  # what was opened inside is gone
                while places and places[-1] >= first:
                    places.pop()
            name = ""
        elif name in SKIPPED and not close and not (empty and (foreign or name in FOREIGN)):
            opened.setdefault(name, []).append(len(tags))
        tags.append((start, at, name, close, rest))
    if m := ENDLESS.search(page, at):
        tags.append((m.start(), len(page), "", "", ""))
    return tags


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. White space inside a block is one space; character references are decoded."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # element name, hint, number of the container
    inside: Counter[str] = Counter()  # open elements by name
    number, links, text, linked = 0, 0, [], 0

    def flush():
        nonlocal text, linked
        if text:
            value = " ".join(html.unescape("".join(text)).split())
            if value:
                tag, hint, container = stack[-1]
                out.append(Block(value, min(1.0, linked / len(value)), container, tag, hint))
        text, linked = [], 0

    at = 0
    for start, end, name, close, rest in tags_of(page):
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if links:
                linked += len(piece)
        at = end
        if not name:
            continue
        if name not in BLOCKS:
            if name == "a":
                links = 0 if close else 1
            elif name == "br":
                text.append(" ")
            continue
        flush()
        if close:
            if inside[name]:
                while stack[-1][0] != name:
                    inside[stack.pop()[0]] -= 1
                inside[stack.pop()[0]] -= 1
            if name in CONTENT_TAGS or name in BOILERPLATE_TAGS:
                links = 0
        else:
            while stack[-1][0] in CLOSED_BY and name in CLOSED_BY[stack[-1][0]]:
                inside[stack.pop()[0]] -= 1
            if name in VOID:
                continue
            number += 1
            inside[name] += 1
            stack.append((name, hint_of(name, rest, stack[-1][1]), number if name not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "tr", "td", "th") else stack[-1][2]))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """What a block's text alone tells: its length, links, end of a sentence, punctuation, a copyright sign."""
    out = np.empty((len(blocks), FEATURES), np.float64)
    for i, b in enumerate(blocks):
        t = b.text
        out[i] = (1.0, math.log1p(len(t)) / 6, b.links, t[-1] in ".!?:…\"'", min(t.count(",") + t.count(". "), 10) / 10, "©" in t)
    return out


def max_flow_labels(excess: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True for the nodes on the source side of the minimum cut.

    A positive excess is a node's capacity from the source, a negative one its capacity to the sink; edges hold
    their capacity in both directions. Shortest augmenting paths by levels.
    """
    n = len(excess)
    supply, demand = np.maximum(excess, 0).tolist(), np.maximum(-excess, 0).tolist()
    if not any(supply) or not any(demand):
        return np.array([s > 0 for s in supply]) if any(supply) else np.zeros(n, bool)
    to, room, near = [], [], [[] for _ in range(n)]
    for a, b, c in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += [b, a]
        room += [c, c]
    while True:
        level = [0 if s > 1e-12 else -1 for s in supply]
        queue = deque(i for i in range(n) if level[i] == 0)
        while queue:
            i = queue.popleft()
            for e in near[i]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not any(level[i] >= 0 and demand[i] > 1e-12 for i in range(n)):
            return np.array(level) >= 0
        place = [0] * n
        for source in range(n):
            while supply[source] > 1e-12 and level[source] == 0:
                path, i = [], source
                while demand[i] <= 1e-12:
                    while place[i] < len(near[i]):
                        e = near[i][place[i]]
                        if room[e] > 1e-12 and level[to[e]] == level[i] + 1:
                            break
                        place[i] += 1
                    if place[i] == len(near[i]):  # a dead end: step back
                        if not path:
                            break
                        e = path.pop()
                        i = to[e ^ 1]
                        place[i] += 1
                    else:
                        path.append(e)
                        i = to[e]
                else:
                    flow = min([supply[source], demand[i], *(room[e] for e in path)])
                    supply[source] -= flow
                    demand[i] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    continue
                break


def label(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """True for content. Where names leave a page without any, they weigh less, so that text alone can outweigh them."""
    if not blocks:
        return np.zeros(0, bool)
    hints = np.array([b.hint for b in blocks])
    evidence = np.clip(features(blocks) @ weights, -3, 3)
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEIGHBOUR))
        if b.container in last:
            edges.append((last[b.container], i, CONTAINER))
        last[b.container] = i
    for cost in (NAME_COST, WEAK_NAME_COST):
        found = max_flow_labels(evidence + np.choose(hints + 2, [-BOILERPLATE_COST, -cost, 0, CONTENT_COST]), edges)
        if found.any():
            break
    return found


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, label(blocks, weights).tolist(), strict=True) if keep)


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge towards the general weights; these without both labels."""
    w = GENERAL.copy()
    if len(set(y.tolist())) < 2:
        return w
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (p - y)) / len(y) + RIDGE * (w - GENERAL)
        curve = (x * (balance * p * (1 - p))[:, None]).T @ x / len(y) + RIDGE * np.eye(FEATURES)
        w -= np.linalg.solve(curve, gradient)
    return w


def fit(df: DataFrame, page: str = "html", key: str = "page_id", pages: int = SAMPLE_PAGES, blocks: int = SAMPLE_BLOCKS) -> np.ndarray:
    """Weights from blocks whose element names tell their role, of about `pages` pages; at most `blocks` blocks."""
    ship(df.sparkSession)
    rows = df.select(F.xxhash64(df[key]).alias("h"), df[page].alias("page"))
    every = max(1, rows.count() // pages)

    def run(batches):
        for batch in (piece for batch in batches for piece in pieces(batch, [1])):
            for h, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = blocks_of(value or "")
                if not found:
                    continue
                made = [(h, i, int(b.hint > 0), f.tolist()) for i, (b, f) in enumerate(zip(found, features(found), strict=True)) if b.hint]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate((
                    pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())))], ["h", "i", "y", "x"])

    known = rows.where(F.pmod("h", F.lit(every)) == 0).mapInArrow(run, "h bigint, i int, y int, x array<double>")
    got = known.orderBy("h", "i", "y", "x").limit(blocks).collect()
    return train(np.array([r.x for r in got]).reshape(-1, FEATURES), np.array([r.y for r in got], float))


def extract(df: DataFrame, weights: np.ndarray, page: str = "html", keep: list[str] | None = None) -> DataFrame:
    """`keep`, text and n_chars (code points) of every page, from the whole page. Narrow.

    Blocks of content in page order, joined by an empty line. A null or empty page, or one without content, has an
    empty text; malformed markup is read as far as it goes; a null key passes through; repeated rows give repeated
    rows; an empty table gives an empty table; other columns of the input are not read.
    """

    def start():
        def block(pages):
            texts = [main_text(p.decode(), weights) for p in pages]
            return [texts, [len(t) for t in texts]]

        return block

    return map_texts(df, [page], ["page_id", "url"] if keep is None else keep, [("text", "string"), ("n_chars", "bigint")], start)


def op7_html(spark, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))
