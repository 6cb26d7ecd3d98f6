"""Main text of web pages by consensus of their host.

1. Every page is parsed and each of its containers scored: the share of the
   page's text that it holds (a first-level heading counts ten times), times the
   square of the part of its text that is neither link text nor boilerplate,
   plus a little per level of depth, so a wrapper gives way to what it wraps. A
   container's path is the tags and generalised classes (digits folded) from
   the root down.
2. Every page votes for its best path. In Spark the host's pages that voted
   for a path, and those that have it but with another text than their best
   container's, are counted per host and path (map-side combined, so a host with
   a third of all pages is no hot group).
3. Every page chooses among the paths that it has and that its host's other pages
   voted for, and its own best: by the part of those pages that voted for the path,
   and the page's own share for it. So a page follows its template's pages, also
   on a host with several templates, however rare the template.
4. Extracted are the containers at the chosen path; the paragraphs, headings and
   lists that stand beside them, directly in a container around them; and,
   where they lie in an article, the rest of that article. Beside the
   containers, blocks of mere links and other containers are left out.

Scale: votes and choices are joins of narrow rows, one per page and container,
keyed by host and path. A page is told another path than its own best one only if
its choice differs; a bitmap of fixed size tells most other pages, so only html of
such pages is shuffled, keyed by a hash of host and html. Parsing takes linear time
and memory, also in markup nested without end: nodes know their parent, long paths
are kept as digests, sizes add up from the leaves. Memory is one batch of pages.

Blocks are the texts between block-level tags, in page order; white space in a
block becomes one space (``<br>`` counts as white space). Left out, wherever
they are: navigation, forms, scripts, styles, asides, footers, hidden elements
and elements whose class, id or role names a menu, sidebar, notice, advert,
comment section or the like; headers outside an article.

Cases: null or empty html and pages without text give an empty text; broken
markup is read as browsers do (unclosed and stray tags, cut references);
repeated rows are extracted separately; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as _entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches, flag_likely
from fieldcraft.session import materialize

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s>/]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s>/]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))|([^\s=/>\"']+)", re.S)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section
summary table tbody tfoot thead tr ul""".split())
CONTAINERS = frozenset("#page article main section div td body blockquote center".split())
HEADING, DEPTH = 10, 0.02
#: power of the page's own share; characters after which a path is kept as a digest
OWN, LONG_PATH = 0.25, 1024
DROPPED = frozenset("""nav aside footer form script style noscript template iframe button select textarea input
svg canvas object audio video head menu dialog search title""".split())
BAD_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert alertdialog form menu
menubar toolbar""".split())
BAD_WORDS = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer foot cookie cookies
consent gdpr notice notification alert popup modal overlay ad ads adv advert adverts advertisement advertising
sponsor sponsored promo promotion banner newsletter subscribe subscription signup login share sharing social
related recommended comment comments commentlist disqus reply replies respond pagination pager widget toolbar
skip""".split())
HEAD_WORDS = frozenset("header masthead topbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: a start tag that closes an open one of these
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th"}}
SCOPE = frozenset("html body table td th ul ol dl div section article main aside nav form".split())


class Node:
    """An element: its path and depth, what it lies in, and the sizes of the text
    under it. ``art``, ``box``: the nearest article and the nearest container."""

    __slots__ = ("tag", "path", "depth", "parent", "dropped", "link", "article", "title", "art", "box", "head", "para",
                 "text", "bad", "core")

    def __init__(self, tag, step, parent, dropped, link):
        self.tag, self.parent, self.dropped, self.link = tag, parent, dropped, link
        self.path = _join(parent.path, step) if parent else step
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or parent is not None and parent.article
        self.title = tag == "h1" or parent is not None and parent.title
        self.head = tag in HEADINGS or parent is not None and parent.head
        self.para = tag == "p" or parent is not None and parent.para
        self.art = self if tag == "article" else parent.art if parent else None
        # a quotation is a block, not a container of its own
        self.box = self if tag in CONTAINERS and tag != "blockquote" else parent.box if parent else None
        self.text = self.bad = 0
        self.core = None


def _join(path: str, step: str) -> str:
    """A path one level down; long ones as a digest, equal for equal paths."""
    out = f"{path}/{step}"
    return out if len(out) <= LONG_PATH else "~" + hashlib.blake2b(out.encode("utf-8", "replace"), digest_size=16).hexdigest()


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, _entities.unescape(next((g for g in (m[2], m[3], m[4]) if g is not None), "")))
    return out


def _boilerplate(tag: str, at: dict[str, str], article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not article):
        return True
    if not at:
        return False
    if "hidden" in at or at.get("aria-hidden", "").lower() == "true" or at.get("role", "").lower() in BAD_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I):
        return True
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{at.get('class', '')} {at.get('id', '')}").lower()))
    # an article's own container may be called a page's or an advert's body; the page itself never goes
    return tag not in ("html", "body", "article", "main") and bool(
        words & BAD_WORDS or (not article and words & HEAD_WORDS))


def _step(tag: str, at: dict[str, str]) -> str:
    names = sorted({re.sub(r"\d+", "#", c) for c in at.get("class", "").lower().split()})
    return ".".join([tag, *names])


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """The page's elements, parents first, and its pieces in page order: (node,
    text) for each piece of text, (node, None) where a block ends; boilerplate is
    marked on the node."""
    root = Node("#page", "#page", None, False, False)
    nodes, pieces, stack = [root], [], [root]
    # where elements of each tag are open, and those that end a search for one
    open_at: dict[str, list[int]] = {}
    scopes: list[int] = []
    pos, n, last = 0, len(page), page.rfind(">")

    def pop_to(k):
        for at in range(len(stack) - 1, k - 1, -1):
            node = stack.pop()
            open_at[node.tag].pop()
            if node.tag in SCOPE:
                scopes.pop()
            if node.tag in BLOCK or node.tag in ("td", "th"):
                pieces.append((node.parent, None))

    while pos < n:
        lt = page.find("<", pos)
        if lt > last >= 0 or last < 0 <= lt:
            # no tag ends after this; only a comment may begin
            mark = page.find("<!--", lt)
            pieces.append((stack[-1], page[pos:mark if mark >= 0 else n]))
            break
        m = _TAG.match(page, lt) if lt >= 0 else None
        if m is None:
            end = n if lt < 0 else lt + 1
            pieces.append((stack[-1], page[pos:end]))
            pos = end
            continue
        if lt > pos:
            pieces.append((stack[-1], page[pos:lt]))
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if open_at.get(tag):
                pop_to(open_at[tag][-1])
            continue
        if tag == "br":
            pieces.append((stack[-1], " "))
            continue
        raw = m[3] or m[6] or ""
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            pos = close.end() if close else n
            continue
        closing = CLOSES.get(tag, ())
        if tag in BLOCK and tag not in ("html", "body"):
            closing = {*closing, "p"}
        if closing:
            k = max((open_at[t][-1] for t in closing if open_at.get(t)), default=0)
            if k and k >= (scopes[-1] if scopes else 0):
                pop_to(k)
        top = stack[-1]
        at = attributes(raw) if raw.strip(" /\n") else {}
        if tag in BLOCK or tag in ("td", "th"):
            pieces.append((top, None if tag in BLOCK else " "))
        if tag in VOID or raw.endswith("/") and tag not in BLOCK and tag != "a":
            continue
        node = Node(tag, _step(tag, at), top, top.dropped or _boilerplate(tag, at, top.article), top.link or tag == "a")
        nodes.append(node)
        open_at.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            scopes.append(len(stack))
        stack.append(node)
    return nodes, pieces


#: of a path on a page: score, size of its good text, depth
Score = tuple[float, int, int]


def container_scores(nodes: list[Node], pieces: list[tuple[Node, str | None]]) -> dict[str, Score]:
    """Path -> best score of the page's containers that hold text, with the size of
    that text and the path's depth. Once per parsed page."""
    total = 0
    for node, text in pieces:
        k = len("".join(text.split())) if text else 0
        k *= HEADING if node.title else 1
        if node.dropped or node.link:
            node.bad += k
        else:
            node.text += k
            total += k
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.bad += node.bad
    out: dict[str, Score] = {}
    for node in nodes:
        if node.text and node.tag in CONTAINERS and not node.dropped:
            s = node.text / total * (node.text / (node.text + node.bad)) ** 2 + DEPTH * node.depth
            out[node.path] = max(out.get(node.path, (0.0, 0, node.depth)), (s, node.text, node.depth))
    return out


def best(scores: dict[str, Score]) -> str:
    """The winning path: highest score, then the deeper, then the first by text."""
    return min(scores, key=lambda p: (-round(scores[p][0], 9), -scores[p][2], p)) if scores else ""


def ballot(scores: dict[str, Score]) -> dict[str, bool]:
    """Path -> did the page vote for it? Without the paths that hold the same
    text as the best one and only lie higher or lower: they speak neither for
    nor against."""
    top = best(scores)
    return {p: p == top for p, (_, k, _) in scores.items() if p == top or k != scores[top][1]}


def own_share(score: Score) -> float:
    """The page's own share for a path."""
    return max(score[0] - DEPTH * score[2], 0.0)


def _beside(node: Node, words: int, links: int, around: set, articles: set) -> bool:
    """Does a block outside the chosen containers belong to their article?"""
    inside = node.art is not None and id(node.art) in articles
    if not inside and id(node.box) not in around:
        return False
    if node.head:
        return inside or words > 0
    return words > 0 if node.para else words > links


def extract(page: str | None, path: str | None = None) -> str:
    """Blocks of the page's main text: at ``path``, or at its own best one if the
    page has no container with text there."""
    nodes, pieces = parse(page or "")
    scores = container_scores(nodes, pieces)
    at = path if path in scores else best(scores)
    if not at:
        return ""
    # texts of a block, each with its element
    blocks, piece = [], []
    for node, text in pieces:
        if text is None:
            blocks.append(piece)
            piece = []
        elif not node.dropped:
            piece.append((node, text))
    blocks.append(piece)
    for node in nodes:
        node.core = node if node.path == at else node.parent.core if node.parent else None
    cores = {id(n.core): n.core for piece in blocks for n, t in piece if n.core is not None and t.strip()}
    around, articles = set(), {id(n.art) for n in cores.values() if n.art is not None}
    for node in cores.values():
        while (node := node.parent) is not None and id(node) not in around:
            around.add(id(node))
    out = []
    for piece in blocks:
        mine = [t for n, t in piece if n.core is not None]
        rest = [(n, t) for n, t in piece if t.strip() and n.core is None]
        if rest:
            sizes = [(n.link, len("".join(t.split()))) for n, t in rest if any(map(str.isalnum, _entities.unescape(t)))]
            links = sum(k for link, k in sizes if link)
            words = sum(k for link, k in sizes if not link)
            if _beside(rest[0][0], words, links, around, articles):
                mine = [t for _, t in piece]
        out.append("".join(mine))
    return "\n\n".join(b for b in (" ".join(_entities.unescape(b).split()) for b in out) if b)


def host_of(url):
    """Lower-case host of a url column; null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(h) > 0, h)


BALLOTS = "k1 long, k2 long, host string, path string, share double, depth int, own boolean, vote int"


def ballots(rows: DataFrame) -> DataFrame:
    """``rows(host, html)`` with a host -> one row per page and container path: the
    keys of host and html, the page's own share for the path, its depth, whether it is
    the page's own best, and its vote (1 for, 0 against, null neither)."""
    def run(batches):
        import pyarrow as pa
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.bool_(), pa.int32()]
        names = [f.split()[0] for f in BALLOTS.split(", ")]
        for batch in batches:
            out = []
            for k1, k2, host, page in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "host")], batch.column("html")):
                scores = container_scores(*parse(page.as_py() or ""))
                cast, top = ballot(scores), best(scores)
                out += [(k1, k2, host, p, own_share(s), s[2], p == top, int(cast[p]) if p in cast else None)
                        for p, s in scores.items()]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return rows.filter("host IS NOT NULL").select("k1", "k2", "host", "html").mapInArrow(run, BALLOTS)


def choices(cast: DataFrame) -> DataFrame:
    """``k1, k2, path`` of the pages whose choice is not their own best path. A page's
    own ballot is replaced by its share."""
    votes = (cast.groupBy("host", "path").agg(F.sum("vote").alias("won"), F.count("vote").alias("asked"))
             .filter("won > 0"))
    mine = F.coalesce("vote", F.lit(0))
    asked = F.col("asked") - F.col("vote").isNotNull().cast("int")
    value = F.round((F.col("won") - mine + F.col("share")) / (asked + 1) * F.pow("share", F.lit(OWN)), 9)
    rank = F.struct((-value).alias("v"), (-F.col("depth")).alias("d"), "path", (~F.col("own")).alias("other"))
    return (cast.join(votes, ["host", "path"]).groupBy("k1", "k2").agg(F.min(rank).alias("won"))
            .filter("won.other").select("k1", "k2", F.col("won.path").alias("path")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    bound_batches(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html")).withColumn("host", host_of(F.col("url")))
    rows = (rows.withColumn("k1", F.xxhash64("host", "html"))
            .withColumn("k2", F.xxhash64(F.lit(7), "html", "host")))
    other = materialize(choices(materialize(ballots(rows), "ballots")), "choices")
    flagged = flag_likely(rows, F.col("k1"), other.select("k1"))
    near = (flagged.filter("__likely").join(other, ["k1", "k2"], "left").select("page_id", "url", "html", "path"))
    sure = flagged.filter("NOT __likely").select("page_id", "url", "html", F.lit(None).cast("string").alias("path"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [extract(h.as_py(), p.as_py()) for h, p in zip(part.column(2), part.column(3))]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                       pa.array([len(t) for t in texts], pa.int64())],
                                      ["page_id", "url", "text", "n_chars"])

    return sure.unionByName(near).mapInArrow(run, "page_id long, url string, text string, n_chars long")
