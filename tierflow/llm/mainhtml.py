"""Main text of web pages by tag-path ratios (operator 11).

A page is read into blocks of text, each with the path of block-level elements
from the root to it. Blocks with equal tag paths are laid together: characters
and punctuation marks per block of the path are its text and punctuation
ratios. Both are smoothed over neighbouring blocks in page order, fused with
the share of the path's text that is not links, and paths under the standard
deviation of the page's scores are left out. The blocks of the remaining paths
choose the content element: the deepest that holds most of their score (the
article element around it, if there is one). The content nodes are the blocks in it;
where menus or notices lie inside that element, only those of paths over the threshold,
with the headings and the short blocks between them.

Elements that are no article text by their nature (menus, forms, scripts, page
headers and footers, asides) and elements whose class, id or role says so
(adverts, sidebars, notices, reader comments, sharing) count as paths of score
0 and are never selected. A class does not exclude the element that holds the article.

Pages are independent, so this is one pass without a shuffle; memory in a task
follows the blocks of a batch and the longest page. Scanning is linear in the
length of a page.

Null or empty html gives an empty text, as does a page without content. A page
without punctuation or with ties in scores is treated as any other: equal scores
stay or go together. Comments, CDATA and declarations are left out, missing end
tags implied, unknown end tags ignored. Rows that repeat an id are separate
results; null ids and urls are kept. An empty table gives an empty result. Other
columns are not read, so they may have any name.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, table

#: Gaussian weights of a block and its neighbours in page order.
KERNEL = tuple(math.exp(-(d * d) / 2) for d in (-2, -1, 0, 1, 2))
#: Share of the selected score that the content element has to hold.
MOST_OF_SCORE = 0.6
#: A path whose text is links to this share is a menu.
LINKED = 0.6
#: Weight of paths through an element that is meant for the article.
MEANT = 8.0

# Fixed values of HTML: elements by their kind.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img picture source track map area slot".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"),
          "tfoot": ("tr", "td", "th", "thead", "tbody"), "option": ("option",), "optgroup": ("option", "optgroup"), "body": ("head",)}
#: An element inside these does not close one outside them.
WALLS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",),
         "p": ("td", "th", "button", "object", "table", "html")}
PARTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p li ul ol dl dt dd blockquote pre td th tr tbody thead table figure figcaption".split())
CELLS = frozenset("table caption thead tbody tfoot tr td th html body".split())
IN_HEAD = frozenset("title meta link script style base noscript template bgsound".split())
DEEPEST = 500
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

NEVER = frozenset("head title script style noscript template nav footer aside form fieldset button select option optgroup datalist textarea input iframe object embed applet canvas svg audio video dialog menu search noframes noembed".split())
ARTICLE = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split())
#: Words of a class or id that say what an element is not: whole words, and beginnings of words.
NOT_TEXT = re.compile(
    r"(?:ads?|adv|dfp|nav|menus?|menubar|rail|side|secondary|aside|foot|bottom|toc|logo|brand|branding|tagline|gdpr|modal|popup|popover|overlay|skip|share|sharing|sharebar|shares|social|tags|login|signin|signup|widgets?|pager|"
    r"alerts?|legal|hidden|header|masthead|topbar|search|searchbox|form|reply|replies|respond|responses?|reactions?|feedback|disqus|promos?|warnings?|outbrain|taboola|trending|popular|cta|paywall|imprint|credits)$"
    r"|(?:advert|adsense|adslot|adbox|adunit|adblock|sponsor|promot|banner|sidebar|sidenav|breadcrumb|navbar|navigat|navlist|navmenu|topnav|footer|footnav|bottombar|comment|discussion|cookie|consent|notice|notification|"
    r"newsletter|subscri|related|recommend|readmore|morelinks|pagination|toolbar|copyright|disclaimer|dropdown|teaser|headerbar|pageheader|siteheader|sitenav|privacy|announce|sronly|screenreader|visuallyhidden)")
SAYS_ARTICLE = re.compile(r"(?:article|articlebody|entry|post|story|content|maincontent|main|body|text|prose|postbody|entrycontent|postcontent)$")
HEADER = re.compile("(?:header|heading|masthead)$")
#: What an article element itself may be in the words above: something beside the article.
BESIDE = re.compile(r"(?:ads?|adv|reply|replies|respond|promos?)$|(?:advert|sponsor|promot|comment|discussion|related|recommend|teaser|sidebar)")
#: Classes that speak of the layout around an element, not of the element.
AROUND = re.compile(r"(?:has|with|no|without|is|js|show|hide)[-_]", re.I)
MARK = re.compile("[.,;:!?\u2026\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f\u060c\u061f\u0964]")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]+)))?""")
END_OF_TAG = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
NAME = re.compile(r"[A-Za-z][^\s/>\x00]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """A block-level element: its place in the tree and what its label says."""

    __slots__ = ("name", "parent", "depth", "path", "out", "meant", "words", "holds", "score")

    def __init__(self, name, parent, path, out, meant, words):
        self.name, self.parent, self.path, self.out, self.meant, self.words = name, parent, path, out, meant, words
        self.depth = parent.depth + 1 if parent else 0
        self.holds, self.score = False, 0.0  # an article element inside; score of the selected blocks inside


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node, text, linked):
        self.node, self.text, self.linked = node, text, linked


def raw_end(name: str) -> re.Pattern:
    return RAW_ENDS.setdefault(name, re.compile(rf"</{name}(?=[\s/>])", re.I))


RAW_ENDS: dict[str, re.Pattern] = {}
DIGITS = re.compile(r"\d{2,}")


class Page:
    """Blocks of a page in page order; ``read`` runs through the markup once."""

    def __init__(self, html: str):
        self.paths: dict[tuple, int] = {}
        self.root = Node("", None, 0, False, False, ())
        self.nodes, self.blocks = [], []
        self.at, self.open = self.root, Counter()
        self.pieces, self.links, self.linked = [], 0, 0
        self.read(html)

    def text(self, chunk: str) -> None:
        if "&" in chunk:
            chunk = entities.unescape(chunk)
        if self.at.name == "head" and not chunk.isspace():
            self.pop(("head",))
        self.pieces.append(chunk)
        if self.links:
            self.linked += len(chunk)

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(self.at, text, min(self.linked, len(text))))
            self.pieces, self.linked = [], 0

    def push(self, name: str, attributes: str) -> None:
        values = {}
        if attributes:
            for key, *value in ATTRIBUTE.findall(attributes):
                values.setdefault(key.lower(), value[0] or value[1] or value[2])
        label = f"{values.get('class', '')} {values.get('id', '')}" if values else ""
        words = tuple(w for w in label.split() if not AROUND.match(w))
        out = name in NEVER or (name == "header" and not (self.open["article"] or self.open["main"])) or "hidden" in values \
            or values.get("aria-hidden", "").lower() == "true" or values.get("role", "").lower() in ROLES or bool(HIDDEN.search(values.get("style", "")))
        meant = name in ARTICLE or values.get("role", "").lower() in ("main", "article") or values.get("itemprop", "").lower() == "articlebody"
        key = (self.at.path, name, DIGITS.sub("", " ".join(words)))
        node = Node(name, self.at, self.paths.setdefault(key, len(self.paths) + 1), out, meant, words)
        self.nodes.append(node)
        self.at = node
        self.open[name] += 1

    def pop(self, names, walls=()) -> None:
        """Close the nearest open element of these names, unless one of ``walls`` is nearer."""
        if not any(self.open[n] for n in names):
            return
        if walls:
            node = self.at
            while node.name not in names:
                if node.name in walls or node.parent is None:
                    return
                node = node.parent
        while True:
            name, self.at = self.at.name, self.at.parent
            self.open[name] -= 1
            if name in names:
                return

    def start(self, name: str, attributes: str) -> None:
        if self.at.name == "head" and name not in IN_HEAD:
            self.pop(("head",))
        if name in INLINE:
            if name == "a":
                self.links = 1
            return
        self.end_block()
        if name in ENDS_PARAGRAPH and self.open["p"]:
            self.pop(("p",), WALLS["p"])
        if name in CLOSES:
            for _ in range(3):
                before = self.at
                self.pop(CLOSES[name], WALLS.get(name, ()))
                if self.at is before:
                    break
        # Beyond this depth elements are laid flat, as browsers do; their text stays.
        if name not in VOID and self.at.depth < DEEPEST:
            self.push(name, attributes)

    def end(self, name: str) -> None:
        if name in INLINE:
            if name == "a":
                self.links = 0
            return
        self.end_block()
        if name not in VOID:
            self.pop((name,), () if name in CELLS else ("td", "th"))
        self.links = 0

    def read(self, html: str) -> None:
        i, n, quoted = 0, len(html), True
        while i < n:
            lt = html.find("<", i)
            if lt < 0 or lt == n - 1:
                self.text(html[i:])
                break
            if lt > i:
                self.text(html[i:lt])
            c = html[lt + 1]
            if c == "!" or c == "?" or (c == "/" and not html[lt + 2:lt + 3].isalpha()):
                if html.startswith("<!--", lt):
                    stop, width = html.find("-->", lt + 2 if html.startswith("<!-->", lt) else lt + 4), 3
                elif html.startswith("<![CDATA[", lt):
                    stop, width = html.find("]]>", lt), 3
                else:
                    stop, width = html.find(">", lt), 1
                i = n if stop < 0 else stop + width
                continue
            m = NAME.match(html, lt + 2 if c == "/" else lt + 1)
            if not m or not m[0][0].isascii():
                self.text("<")
                i = lt + 1
                continue
            stop = END_OF_TAG.match(html, m.end()) if quoted else None
            if stop:
                end = stop.end()
            else:
                # A quote that nothing ends: from here on a tag ends at the next '>'.
                quoted, end = False, html.find(">", m.end()) + 1
                if not end:
                    break
            name = m[0].lower()
            i = end
            if c == "/":
                self.end(name)
                continue
            attributes = html[m.end():end - 1]
            self.start(name, attributes)
            if name in RAW:
                close = raw_end(name).search(html, end)
                i = close.start() if close else n
        self.end_block()


def says(words: tuple, pattern: re.Pattern) -> bool:
    """Whether a word of a class or id begins as the pattern says; camel case and hyphens part words."""
    return any(pattern.match(part.lower()) for word in words for part in (*WORD.findall(word), re.sub(r"[^a-zA-Z]", "", word)) if part)


def marked(page: Page) -> None:
    """Decide for every element whether it can hold article text, and whether it is meant to."""
    meant = [n for n in page.nodes if n.meant and not n.out]
    own = [n for n in meant if not says(n.words, BESIDE)]
    for n in own or meant:
        up = n
        while up is not None and not up.holds:
            up.holds = True
            up = up.parent
    for n in page.nodes:
        if n.out:
            continue
        if n.parent.out:
            n.out = True
        elif n.name in ("html", "body") or n.holds:
            pass
        elif n.meant:
            n.out = bool(own) and says(n.words, BESIDE)
        elif n.words and says(n.words, NOT_TEXT):
            # The header of an article belongs to it.
            header = n.name == "header" or says(n.words, HEADER)
            n.out = not (header and (inside_article(n) or says(n.words, SAYS_ARTICLE)) and not says(n.words, BESIDE))


def inside_article(node: Node) -> bool:
    up = node.parent
    while up is not None:
        if up.name in ARTICLE:
            return True
        up = up.parent
    return False


def scores(blocks: list[Block]) -> tuple[dict[int, float], float]:
    """Fused score of each tag path and the threshold of the page."""
    totals: dict[int, list] = {}
    for b in blocks:
        t = totals.setdefault(b.node.path, [0, 0, 0, 0])
        t[0] += 1
        t[1] += len(b.text)
        t[2] += len(MARK.findall(b.text))
        t[3] += b.linked
    weight = {}
    for b in blocks:
        if b.node.path not in weight:
            up, value = b.node, 1.0
            while up is not None and value == 1.0:
                if up.meant or says(up.words, SAYS_ARTICLE):
                    value = MEANT
                up = up.parent
            weight[b.node.path] = 0.0 if b.node.out else value
    ratio = {p: (chars / n, (1 + marks) / n) for p, (n, chars, marks, _) in totals.items()}
    line = [ratio[b.node.path] for b in blocks]
    smooth: dict[int, list] = {}
    for i, b in enumerate(blocks):
        near = [(w, line[j]) for w, j in zip(KERNEL, range(i - 2, i + 3)) if 0 <= j < len(line)]
        all_w = sum(w for w, _ in near)
        s = smooth.setdefault(b.node.path, [0.0, 0.0])
        s[0] += sum(w * r[0] for w, r in near) / all_w
        s[1] += sum(w * r[1] for w, r in near) / all_w
    fused = {}
    for p, (n, chars, _, linked) in totals.items():
        text, marks = smooth[p][0] / n, smooth[p][1] / n
        # Half of a path's own ratio, half of its neighbourhood's, so that a long block does not lift what stands beside it.
        text, marks = math.sqrt(text * ratio[p][0]), math.sqrt(marks * ratio[p][1])
        fused[p] = text * marks * (1 - linked / chars) * weight[p]
    values = [fused[b.node.path] for b in blocks]
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    return fused, min(deviation, max(values) / 2)


def inside_of(node: Node | None, element: Node) -> bool:
    while node is not None and node is not element:
        node = node.parent
    return node is element


def content_element(blocks: list[Block], fused: dict[int, float], least: float) -> Node | None:
    """The deepest element that holds most of the selected score, or the article around it."""
    chosen = [b for b in blocks if fused[b.node.path] > 0 and fused[b.node.path] >= least]
    if not chosen:
        return None
    total = 0.0
    for b in chosen:
        score = len(b.text) * fused[b.node.path]
        total += score
        up = b.node
        while up is not None:
            up.score += score
            up = up.parent
    best = None
    for b in chosen:
        up = b.node
        while up.score < MOST_OF_SCORE * total:
            up = up.parent
        if best is None or up.depth > best.depth:
            best = up
    # A single block or list chooses what it stands in.
    while best.name in PARTS and best.parent is not None:
        if best.name in ("td", "th") and any(b.node is not best and inside_of(b.node, best) for b in chosen):
            break  # a cell that holds blocks of its own is a column of the page, not of a table
        best = best.parent
    around = []
    up = best
    while up is not None:
        if up.meant and not up.out:
            around.append(up)
        up = up.parent
    return next((n for n in around if n.name in ARTICLE), around[0] if around else best)


def main_text(html: str | None) -> str:
    """The article text of a page, blocks joined by one space."""
    page = Page(html or "")
    if not page.blocks:
        return ""
    marked(page)
    fused, least = scores(page.blocks)
    element = content_element(page.blocks, fused, least)
    if element is None:
        return ""
    inner: dict[int, bool] = {}

    def inside(node):
        way = []
        while node is not None and id(node) not in inner:
            if node is element:
                inner[id(node)] = True
                break
            way.append(node)
            node = node.parent
        value = inner[id(node)] if node is not None else False
        for n in way:
            inner[id(n)] = value
        return value

    linked: dict[int, list] = {}
    for b in page.blocks:
        t = linked.setdefault(b.node.path, [0, 0])
        t[0] += len(b.text)
        t[1] += b.linked
    over = {p for p, v in fused.items() if v > 0 and v >= least}
    menus = set() if element.meant else {p for p, (chars, links) in linked.items() if links >= LINKED * chars}
    mixed = not (element.meant or says(element.words, SAYS_ARTICLE)) and any(b.node.out and inside(b.node) for b in page.blocks)
    own = [i for i, b in enumerate(page.blocks) if not b.node.out and inside(b.node) and b.node.path not in menus]
    if mixed:
        picked = [i for i in own if page.blocks[i].node.path in over]
        own = [i for i in own if picked and (picked[0] <= i <= picked[-1] or (i < picked[0] and page.blocks[i].node.name in HEADINGS))]
    # The title of the page, if it stands before the content element.
    if own and not any(page.blocks[i].node.name == "h1" for i in own):
        own = [i for i in range(own[0]) if page.blocks[i].node.name == "h1" and not page.blocks[i].node.out][-1:] + own
    return " ".join(page.blocks[i].text for i in own)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 200):
                part = batch.slice(at, 200)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return arrow_map(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
