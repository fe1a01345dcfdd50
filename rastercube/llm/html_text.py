"""Main text of web pages by container paths that the pages of a host agree on."""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import checked, settle

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes svg".split())
BLOCK = frozenset(
    "head address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul xmp".split())
# The open elements whose end tag may be left out, and the start tags that end them.
_ROWS = {"tr", "tbody", "thead", "tfoot"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
             "td": {"td", "th"} | _ROWS, "th": {"td", "th"} | _ROWS, "tr": _ROWS}
HEAD = frozenset("meta link base title style script noscript template".split())
SCOPES = frozenset("table ul ol dl select html body article section main div".split())
# Never part of the main text, whatever a host's pages agree on.
DROP_TAGS = RAW | frozenset("nav aside footer form button select input dialog menu head object audio video canvas annotation "
                             "annotation-xml".split())
DROP_WORDS = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs sidebar sidebars aside footer masthead banner ad "
    "ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login search searchbox share sharing social related "
    "recommended recommendations trending popular pagination pager comment comments commentlist respond reply replies "
    "disqus toolbar widget widgets skip copyright legal tags taglist topbar toc".split())
# Words of a name that only say where or how a part stands: with one of DROP_WORDS they are that word's name.
PLACE_WORDS = frozenset(
    "area bar block body bottom box button buttons center col column container content cta feed first form frame group head header "
    "heading holder icon icons image images inner item items last layout left link links list lists module outer panel "
    "placeholder post posts primary right row secondary section site slot stories the title top unit wrap wrapper zone".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form "
                       "toolbar".split())
GOOD_WORDS = frozenset("article content entry main post story body text hentry".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">]|['\"](?=[^>]*>))*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
# Where the drawing of an svg ends: its end tag, or a tag that cannot stand in one.
SVG_END = re.compile(r"</svg(?=[\s/>])[^>]*>?|(?=</?(?:p|div|h[1-6]|ul|ol|dl|li|table|section|article|main|body|html|blockquote|"
                     r"pre|header|footer|nav|aside)[\s/>])", re.I)
# A link with more text in blocks is no link list's entry, but wraps a part of the page.
LINK_TEXT = 200
# Elements nested deeper become siblings there, as in browsers; no text is lost.
MAX_LEVEL = 512


class Node:
    __slots__ = ("tag", "attrs", "parent", "level", "items", "path", "good", "kind", "spared", "wraps")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.level = parent.level + 1 if parent else 0
        self.items: list = []
        self.path = self.good = self.kind = self.wraps = None
        self.spared = False


def parse(page: str) -> Node:
    """A tolerant tree of the page: unclosed, stray and misnested tags never lose text; wrappers are told from boilerplate."""
    root = _tree(page)
    _spare(root)
    return root


def _tree(page: str) -> Node:
    root = node = Node("html", {}, None)
    depth, at, n = {}, 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt != at:
            node.items.append(page[at:] if lt < 0 else page[at:lt])
        if lt < 0:
            break
        found = TOKEN.match(page, lt)
        if found is None:
            node.items.append("<")
            at = lt + 1
            continue
        at = found.end()
        if found[1]:
            node = _close(node, found[1].lower(), depth)
        elif found[2]:
            tag = found[2].lower()
            attrs = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(found[3])}
            if tag in ("html", "body"):
                node.attrs.update(attrs) if node.tag == tag else None
                if tag == "html" or depth.get("body"):
                    continue
            if depth.get("head") and tag not in HEAD:
                node = _close(node, "head", depth)
            if tag in BLOCK and depth.get("p"):
                node = _close(node, "p", depth)
            for open_tag, closers in CLOSED_BY.items():
                if tag in closers and depth.get(open_tag):
                    up = node
                    while up.tag != open_tag and up.tag not in SCOPES and up.parent:
                        up = up.parent
                    if up.tag == open_tag:
                        node = _close(node, open_tag, depth)
            if node.level >= MAX_LEVEL:
                depth[node.tag] -= 1
                node = node.parent
            child = Node(tag, attrs, node)
            node.items.append(child)
            if tag == "svg" and not found[3].rstrip().endswith("/"):
                end = SVG_END.search(page, at)
                if end and not end[0] and "<foreignobject" in page[at: end.end()].lower():
                    end = re.compile(r"</svg(?=[\s/>])[^>]*>?", re.I).search(page, at) or end
                at = end.end() if end else n
            elif tag == "xmp":
                end = re.compile(r"</xmp(?=[\s/>])[^>]*>?", re.I).search(page, at)
                child.items.append(page[at: end.start() if end else n].replace("&", "&amp;"))
                at = end.end() if end else n
            elif tag in RAW and not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            elif tag not in VOID and not (found[3].rstrip().endswith("/") and tag not in BLOCK):
                node = child
                depth[tag] = depth.get(tag, 0) + 1
    return root


def _close(node: Node, tag: str, depth: dict) -> Node:
    """The node that is current after ``</tag>``; without an open ``tag`` nothing closes."""
    if not depth.get(tag):
        return node
    # an end of an inline element does not reach out of the block that it stands in
    up = node
    while up.tag != tag:
        if tag not in BLOCK and up.tag in BLOCK:
            return node
        up = up.parent
    while node is not up:
        depth[node.tag] -= 1
        node = node.parent
    depth[tag] -= 1
    return up.parent


def _split(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]


def _names(node: Node) -> list[list[str]]:
    """The words of each class name and of the id."""
    return [_split(n) for n in [*node.attrs.get("class", "").split(), node.attrs.get("id", "")]]


def _words(node: Node) -> set[str]:
    return {w for name in _names(node) for w in name}


def _named(node: Node, words: frozenset) -> bool:
    """Whether a name of ``node`` is one of ``words``: as its last word, or with nothing but words of place beside it.

    So ``cookie-notice`` and ``ad-box`` are, ``ad-free`` and ``social-history``
    are not; those count only for a part that is mostly links.
    """
    weak = False
    for name in _names(node):
        if words.intersection(name):
            if name[-1] in words or all(w in words or w in PLACE_WORDS for w in name):
                return True
            weak = True
    return weak and _mostly_links(node)


def _mostly_links(node: Node) -> bool:
    text = linked = 0
    stack = [(x, False) for x in node.items]
    while stack:
        x, link = stack.pop()
        if isinstance(x, str):
            text += len(x.strip())
            linked += len(x.strip()) if link else 0
        elif x.tag not in RAW:
            stack.extend((y, link or x.tag == "a") for y in x.items)
    return 2 * linked > text


def is_link(node: Node) -> bool:
    """Whether an element is a link, other than one around a part of the page (more than ``LINK_TEXT`` in blocks)."""
    if node.tag != "a":
        return False
    if node.wraps is None:
        stack, held = [(x, False) for x in node.items], 0
        while stack and held <= LINK_TEXT:
            x, block = stack.pop()
            if isinstance(x, str):
                held += len(x.strip()) if block else 0
            elif x.tag not in RAW:
                stack.extend((y, block or x.tag in BLOCK) for y in x.items)
        node.wraps = held > LINK_TEXT
    return not node.wraps


# What an element is: sure boilerplate, readers' comments, boilerplate by its name only, or text.
SURE, COMMENTS, NAMED, TEXT = range(4)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())


def kind_of(node: Node) -> int:
    """What an element is by its tag, role, or the words of its class and id."""
    if node.kind is None:
        node.kind = _kind(node)
    return node.kind


def _kind(node: Node) -> int:
    if (node.tag in DROP_TAGS and node.tag != "form") or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true":
        return SURE
    if "display:none" in node.attrs.get("style", "").replace(" ", "").lower():
        return SURE
    role = node.attrs.get("role", "").lower()
    if role in DROP_ROLES and role != "form":
        return SURE
    words = _words(node)
    if node.tag in ("html", "body", "main", "article"):
        return COMMENTS if words & {"comment", "comments", "reply", "respond"} and node.tag == "article" else TEXT
    if words & COMMENT_WORDS and _named(node, COMMENT_WORDS):
        return COMMENTS
    if node.tag == "header":
        # a header within the article holds its heading; any other is the site's
        up = node.parent
        while up and up.tag not in ("article", "main"):
            up = up.parent
        return NAMED if up is None or _named(node, DROP_WORDS) else TEXT
    return NAMED if node.tag == "form" or role == "form" or words & DROP_WORDS and _named(node, DROP_WORDS) else TEXT


def boilerplate(node: Node) -> bool:
    """Whether an element is not article text: by :func:`kind_of`, unless the page has its text in there (:func:`_spare`)."""
    return kind_of(node) != TEXT and not node.spared


def _spare(root: Node) -> None:
    """Mark the elements that are boilerplate by name, but wrap the page's text.

    Those are spared that hold four times the text (not links) of the rest, or
    the page's only h1 or main and at least as much, or an h1 within the article
    or main; the text within what is
    surely boilerplate or comments does not count.  If nothing is left without
    the named ones, all of them are spared; then the comments.
    """
    # (node, text, headings) in page order of their ends; a node's sums are there when it ends
    sums: dict[Node, list[int]] = {}
    named, stack = [], [(root, False)]
    while stack:
        node, ended = stack.pop()
        if not ended:
            sums[node] = [0, int(node.tag in ("h1", "main"))]
            if node is not root and kind_of(node) == NAMED:
                named.append(node)
            stack.append((node, True))
            for x in node.items:
                if isinstance(x, str):
                    sums[node][0] += len(x.strip())
                elif not is_link(x) and kind_of(x) not in (SURE, COMMENTS):
                    stack.append((x, False))
        elif node is not root:
            for i in (0, 1):
                sums[node.parent][i] += sums[node][i]
    text, heads = sums[root]
    for node in named:
        inside, has = sums[node]
        outside = text - inside
        node.spared = inside > 0 and (inside >= 4 * outside or (has > 0 and has == heads and inside >= outside))
        if has and not node.spared:  # the heading of an article, whatever its frame is called
            up = node.parent
            while up and up.tag not in ("article", "main"):
                up = up.parent
            node.spared = up is not None
    for kind in (NAMED, COMMENTS):
        if text_blocks(root):
            return
        stack = [root]
        while stack:
            for x in stack.pop().items:
                if isinstance(x, Node) and kind_of(x) >= kind:
                    x.spared = x.spared or kind_of(x) in (NAMED, COMMENTS)
                    stack.append(x)


def text_blocks(node: Node) -> list[str]:
    """The texts of the blocks below ``node``, without boilerplate, in page order, white space made one space."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(entities.unescape(x) if "&" in x else x)
        elif x is not node and boilerplate(x):
            if x.tag in BLOCK or x.tag in ("iframe", "hr"):
                flush()
        elif x.tag in ("br", "hr", "wbr"):
            run.append("" if x.tag == "wbr" else " ")
            if x.tag == "hr":
                flush()
        elif x.tag in BLOCK:
            flush()
            stack.append(None)
            stack.extend(reversed(x.items))
        else:
            stack.extend(reversed(x.items))
    flush()
    return out


def path_of(node: Node) -> str:
    """The tag-class path from the root, generalised: digits in class names become 0, classes are sorted."""
    if node.path is None:
        names = sorted({re.sub(r"\d+", "0", c) for c in node.attrs.get("class", "").split()})
        own = ".".join([node.tag, *names])
        node.path = sys.intern(f"{path_of(node.parent)}>{own}" if node.parent else own)  # siblings share it
    return node.path


def likely(node: Node) -> bool:
    """Whether a container's tag or names say that it holds the main text."""
    if node.good is None:
        node.good = node.tag in ("article", "main") or bool(_words(node) & GOOD_WORDS)
    return node.good


# The host's text of a page is taken if it is at least so small a part of the page's own.
FAIR = 4
CONTAINERS = frozenset("article main section div td body html center blockquote".split())


def container_scores(root: Node) -> dict[str, float]:
    """Score of every container path of a page: its paragraphs' text, less links; deeper containers hold less to dilute it.

    A text block counts for its nearest container in full and for each one
    above it by a factor less, so the container that holds the paragraphs
    directly, or several parts of them, comes out first.
    """
    scores: dict[str, float] = {}

    def visit(top: Node) -> None:
        stack = [top]
        while stack:
            node = stack.pop()
            own, linked = 0, 0
            inline = [x for x in node.items]
            while inline:
                x = inline.pop()
                if isinstance(x, str):
                    own += len(x.strip())
                elif is_link(x):
                    linked += sum(len(y.strip()) for y in x.items if isinstance(y, str))
                elif x.tag not in BLOCK and not boilerplate(x):
                    inline.extend(x.items)
                elif not boilerplate(x):
                    stack.append(x)
            if own - linked > 0:
                share, up = float(own - linked), node
                while up is not None:
                    if up.tag in CONTAINERS:
                        scores[path_of(up)] = scores.get(path_of(up), 0.0) + share * (2.0 if likely(up) else 1.0)
                        share *= 0.9
                    up = up.parent

    visit(root)
    return scores


WORD = re.compile(r"[^\W\d_]{2}")


def _adds(node: Node, child: Node, path: str) -> bool:
    """Whether ``node`` holds words outside ``child`` and ``path`` that are neither links nor boilerplate."""
    stack = [x for x in node.items if x is not child]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if WORD.search(entities.unescape(x)):
                return True
        elif not is_link(x) and not boilerplate(x) and path_of(x) != path:
            stack.extend(x.items)
    return False


def core_path(scores: dict[str, float]) -> str | None:
    """The best container's path."""
    return min(scores, key=lambda p: (-scores[p], p)) if scores else None


def best_path(root: Node, scores: dict[str, float] | None = None) -> str | None:
    """The path of a page's main text: the best container, or what holds it together with more text.

    From the best container it climbs to the outermost element that adds words
    to it, but not out of the nearest article or main.
    """
    path = core_path(container_scores(root) if scores is None else scores)
    if path is None:
        return None
    stack, node = [root], None
    while stack and node is None:
        x = stack.pop()
        if path_of(x) == path:
            node = x
        else:
            stack.extend(y for y in reversed(x.items) if isinstance(y, Node) and not boilerplate(y))
    while node is not None and node.parent and node.tag not in ("article", "main"):
        if _adds(node.parent, node, path):
            path = path_of(node.parent)
        node = node.parent
    return path


def extract(root: Node, paths: list[str]) -> str:
    """The text of the containers at the first of ``paths`` that hold any."""
    for path in paths:
        tops, stack = [], [root]
        while stack:
            node = stack.pop()
            if path_of(node) == path:
                tops.append(node)
                continue
            # what the path runs through is no boilerplate on this host
            stack.extend(x for x in reversed(node.items) if isinstance(x, Node) and (
                not boilerplate(x) or kind_of(x) == NAMED and f"{path}>".startswith(f"{path_of(x)}>")))
        if blocks := [b for top in tops for b in text_blocks(top)]:
            return "\n\n".join(blocks)
    return ""


def host_of(url):
    """The host of a URL column in lower case, without user, port and a leading ``www.``; empty if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def main_text(pages: DataFrame, votes: int = 5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars (code points).

    Pass one parses each page and votes: its main path (:func:`best_path`) for
    its host; it also counts on how many pages a container path holds text and
    on how many it is the best.  Rows of (host, path, counts) are combined
    before the shuffle, so a host with a third of all pages is a few rows from
    each task.  The paths of a host are ranked by votes, ties by path; up to
    ``votes`` ranks are kept, and its side paths: on a tenth of its pages or
    more, but the best on less than half of those.  Pass two parses each page
    again and takes its host's first path that holds text on that page if that
    is at least a ``FAIR``-th of the page's own main text, or if the page's best
    container is a side path; else the page's own main text, so a page of a
    rarer layout keeps its text.

    Null html and pages without text give an empty text; pages
    without a host have no vote in common; repeated rows count each and come back each; an empty
    table gives none; other columns are left out.  Elements below
    ``MAX_LEVEL`` levels are read as siblings at that level.
    """
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list[int]] = {}
            for host, page in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                root = parse(page or "")
                scores = container_scores(root)
                if not scores:
                    continue
                for p in scores:
                    found.setdefault((host, p), [0, 0, 0])[2] += 1
                found[host, core_path(scores)][1] += 1
                found.setdefault((host, best_path(root, scores)), [0, 0, 0])[0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in found], pa.string()) for i in (0, 1)]
                + [pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3)],
                names=["host", "path", "votes", "best", "held"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, paths, side in zip(_texts(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                root = parse(page or "")
                scores = container_scores(root)
                agreed, own = extract(root, paths or []), best_path(root, scores)
                if not paths or paths[0] != own or not agreed:
                    mine = extract(root, [own])
                    if not agreed or len(agreed) * FAIR < len(mine) and core_path(scores) not in side:
                        agreed = mine
                texts.append(agreed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col).cast("string")).alias("host"))
    counted = rows.where("host != ''").select("host", "html").mapInArrow(
        vote, "host string, path string, votes long, best long, held long").groupBy("host", "path").agg(
        *[F.sum(c).alias(c) for c in ("votes", "best", "held")])
    counted = settle(counted)
    # Spark limits the ranks of a host in each task before they meet
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    top = counted.where("votes > 0").withColumn("rank", rank).where(F.col("rank") <= votes)
    pages_of = counted.groupBy("host").agg(F.sum("votes").alias("pages"))
    side = counted.where("best * 2 < held").join(pages_of, "host").where("held * 10 >= pages")
    chosen = top.select("host", "rank", "path").unionByName(side.select("host", F.lit(None).cast("int").alias("rank"), "path"))
    ranked = F.col("rank").isNotNull()
    chosen = settle(chosen.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(ranked, F.struct("rank", "path")))).alias("p"),
        F.collect_list(F.when(~ranked, F.col("path"))).alias("side")).select("host", F.col("p.path").alias("paths"), "side"))
    named = rows.join(checked(chosen), "host", "left")
    return named.select("page_id", "url", "html", "paths", "side").mapInArrow(
        take, "page_id long, url string, text string, n_chars long")


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (x.as_py() for x in column)
