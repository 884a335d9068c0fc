"""HTML extraction by consensus host paths.

Every page scores its containers and votes for the generalised tag-class path of the best;
Spark sums the votes per host; pages are then read again along their host's winning paths.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import staged

PATHS_PER_HOST = 5
BROADCAST_BYTES = 8 << 20
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img br picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROPPED = frozenset(
    "nav footer aside form button select dialog menu noscript iframe object template svg math canvas"
    " audio video head fieldset".split()
)
# Words of class, id or role that name what is not the article.
BOILERPLATE = frozenset(
    "nav navbar navigation menu submenu sidebar aside ad ads adv advert adverts advertisement"
    " advertisements advertising adsense banner banners sponsor sponsored sponsors promo promos promotion"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social breadcrumb breadcrumbs footer foot"
    " masthead comment comments commentlist disqus respond replies related recommended recommendations"
    " widget widgets toolbar pagination pager search hidden copyright complementary contentinfo".split()
)
# Of these, the ones that also name wrappers of whole pages; so does an element form.
LAYOUT = frozenset(
    "sidebar aside header widget widgets modal overlay search login share sharing social toolbar".split()
)
# Class names that begin so tell what a wrapper has or lacks, not what it is.
ABOUT = re.compile(r"(?:has|have|had|no|not|with|without)[-_]", re.I)
ARTICLE = frozenset("article post entry story content main maincontent bodytext articlebody text".split())
# A start tag of the key closes an open element of these, up to the nearest of the second set.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


# Why an element is left out of the article: for good, or unless the page's text is in it.
KEPT, SOFT, HARD = 0, 1, 2
HEADING = re.compile("h[1-6]")
# Parts of a text; what they hold counts for the container they stand in.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption".split())


class Node:
    """An element: ``key`` stands for its path, ``weight`` is the text in it that may be article."""

    __slots__ = ("tag", "parent", "step", "key", "own", "header", "heading", "named", "bonus", "score", "weight", "dropped", "home")

    def __init__(self, tag: str, parent, step: str, own: int = KEPT, header: bool = False, bonus: float = 1.0):
        self.tag, self.parent, self.step, self.own, self.header, self.bonus = tag, parent, step, own, header, bonus
        self.key = hash((parent.key if parent else 0, step))
        self.heading = header and bool(HEADING.fullmatch(tag))
        self.named = tag in ("article", "main") or bool(parent and parent.named)
        self.home = parent.home if parent and tag in PARTS else self
        self.score = self.weight = 0.0
        self.dropped = False

    @property
    def path(self) -> str:
        steps, at = [], self
        while at.parent is not None:
            steps.append(at.step)
            at = at.parent
        return ">".join(reversed(steps))


def _key(path: str) -> int:
    """What ``Node.key`` is along a path."""
    key = hash((0, ROOT))
    for step in path.split(">") if path else ():
        key = hash((key, step))
    return key


ROOT = "#root"


def _names(attributes: str) -> tuple[list[str], set[str], bool]:
    """Classes, the words of class, id and role, and whether the element is hidden."""
    classes: list[str] = []
    words: set[str] = set()
    hidden = False
    if not attributes.strip(" /\n\t"):
        return classes, words, hidden
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            if name == "class":
                classes = value.split()
            for token in value.split():
                if not ABOUT.match(token):
                    words.update(w.lower() for w in WORD.findall(token))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return classes, words, hidden


def _step(tag: str, classes: list[str]) -> str:
    """One generalised step of a path: the tag and its classes, digits made alike."""
    plain = sorted({re.sub(r"\d+", "#", c).replace(">", "") for c in classes})
    return ".".join([tag, *plain])


def _reason(tag: str, words: set[str], hidden: bool) -> int:
    if hidden:
        return HARD
    if tag in ("html", "body", "main"):
        return KEPT
    odd = words & BOILERPLATE
    if (tag in DROPPED and tag != "form") or not odd <= LAYOUT:
        return HARD
    return SOFT if odd or tag == "form" else KEPT


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Containers in page order, and the text blocks with the container each stands in.

    Open elements are found by tag, and a node holds its own step of the path only, so time
    and memory grow with the page, however deep it is nested or badly closed.
    """
    root = Node(ROOT, None, ROOT)
    nodes, stack = [root], [root]
    open_at: dict[str, list[int]] = {}  # tag to its places on the stack
    blocks: list[tuple[Node, str, float]] = []
    parts: list[str] = []
    linked = in_link = 0
    mute: list | None = None  # a hidden inline element: tag, open ones of it, depth of the stack

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                blocks.append((stack[-1], text, max(0.0, len(text) - 2.0 * linked)))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and mute is None:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text)

    def close_to(index: int) -> None:
        nonlocal mute
        flush()
        for n in stack[index:]:
            open_at[n.tag].pop()
        del stack[index:]
        if mute is not None and mute[2] > index:
            mute = None

    def last(tags) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        attributes = m[3] or m[6] or ""
        if tag in INLINE:
            if mute is not None:
                if tag == mute[0]:
                    mute[1] += -1 if closing else 1
                    if mute[1] == 0:
                        mute = None
            elif not closing and tag not in VOID and ("hidden" in attributes or "display" in attributes):
                if _names(attributes)[2]:
                    mute = [tag, 1, len(stack)]
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            continue
        in_link = 0
        if closing:
            k = last([tag])
            if k:
                close_to(k)
            else:
                flush()
            continue
        flush()
        if stack[-1].tag == "p":
            close_to(len(stack) - 1)
        if tag in ENDS:
            same, bounds = ENDS[tag]
            k = last(same)
            if k > last(bounds):
                close_to(k)
        if tag in VOID:
            continue
        classes, words, hidden = _names(attributes)
        parent = stack[-1]
        own, header = _reason(tag, words, hidden), parent.header
        if tag not in ("html", "body", "main") and (tag == "header" or "header" in words):
            # A header of the page goes; that of an article keeps its headings.
            if parent.named:
                header = True
            else:
                own = max(own, HARD if tag == "header" else SOFT)
        bonus = 1.5 if tag in ("article", "main") else 1.2 if words & ARTICLE else 1.0
        node = Node(tag, parent, _step(tag, classes), own, header, bonus)
        nodes.append(node)
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(node)
    flush()
    _drop(nodes, blocks)
    for node, _, gain in blocks:
        if not node.dropped:
            # The container has the text in full, those above ever less.
            share, at_ = 1.0, node.home
            while at_ is not None and share > 0.05:
                at_.score += gain * share
                share *= 0.5
                at_ = at_.parent
    return nodes, [(node, text) for node, text, _ in blocks]


def _drop(nodes: list[Node], blocks: list[tuple[Node, str, float]]) -> None:
    """Says of every node whether it is left out.

    An element that is only named like boilerplate stays where most of the text that may be
    article is in it, and no article or main element outside of it has a fifth of that text.
    """
    hard: set[int] = set()
    soft: dict[int, Node] = {}  # the outermost soft element around a node
    for n in nodes:
        above = n.parent
        if n.own == HARD or (above is not None and id(above) in hard):
            hard.add(id(n))
        around = soft.get(id(above)) if above is not None else None
        if around is None and n.own == SOFT:
            around = n
        if around is not None:
            soft[id(n)] = around
    total = clear = 0.0
    for node, _, gain in blocks:
        if id(node) not in hard:
            node.weight += gain
            total += gain
            if node.named and id(node) not in soft:
                clear += gain
    for n in reversed(nodes):
        if n.parent is not None and id(n) not in hard:
            n.parent.weight += n.weight
    rescue = total > 0 and clear < 0.2 * total
    gone: set[int] = set()  # not even headings stay below these
    for n in nodes:
        above = n.parent
        if above is None:
            continue
        out = n.own == HARD or (n.own == SOFT and not (rescue and 2 * n.weight > total))
        lost = id(above) in gone
        n.dropped = above.dropped or out
        if n.header:
            n.dropped = n.heading is False or n.own == HARD or lost
        if lost or (n.dropped and not n.header) or (n.own == HARD and n.tag != "header"):
            gone.add(id(n))


def best_container(nodes: list[Node]) -> Node | None:
    """The container of the highest score, or the article around it."""
    best = max((n for n in nodes if not n.dropped), key=lambda n: n.score * max(n.bonus, 1e-9), default=None)
    if best is None or best.score <= 0:
        return None
    at = best
    while at is not None:
        if at.tag in ("article", "main"):
            return at
        at = at.parent
    return best


def vote(page: str) -> tuple[str, float] | None:
    nodes, _ = parse(page)
    best = best_container(nodes)
    return (best.path, min(best.score, 2000.0)) if best is not None else None


def extract(page: str, paths: list[str]) -> tuple[str, str]:
    """The text along the first of the host's paths that holds any, and that path.

    Without one, that of the page's own best container.
    """
    nodes, blocks = parse(page)

    def under(wanted) -> str:
        known: dict[int, bool] = {}

        def inside(n) -> bool:
            chain = []
            while n is not None and id(n) not in known:
                if wanted(n):
                    known[id(n)] = True
                    break
                chain.append(n)
                n = n.parent
            answer = known[id(n)] if n is not None else False
            for c in chain:
                known[id(c)] = answer
            return answer

        return "\n".join(text for n, text in blocks if not n.dropped and inside(n))

    for path in paths:
        key = _key(path)
        text = under(lambda n: n.key == key and not n.dropped)
        if text:
            return text, path
    best = best_container(nodes)
    return (under(lambda n: n is best), best.path) if best is not None else ("", "")


def host_of(url: str):
    """The host of an address, lower-cased; empty without one."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, paths``: each host's paths with most votes, best first."""

    def run(batches):
        for b in batches:
            votes: Counter = Counter()
            for host, page in zip(b.column(0).to_pylist(), b.column(1)):
                got = vote(page.as_py())
                if got:
                    votes[host, got[0]] += got[1]
            hosts, paths = zip(*votes) if votes else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(list(votes.values()), pa.float64())],
                ["host", "path", "votes"],
            )

    rows = pages.select(host_of("url").alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    votes = rows.mapInArrow(run, "host string, path string, votes double").groupBy("host", "path").agg(
        F.round(F.sum("votes"), 3).alias("votes")
    )
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    best = votes.withColumn("rank", rank).filter(F.col("rank") <= PATHS_PER_HOST)
    listed = best.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("ranked"))
    return listed.select("host", F.col("ranked.path").alias("paths"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, path`` for every row of ``pages``.

    The winners are sent to every task while they are small, and joined beyond
    ``BROADCAST_BYTES``.  A null page has the empty text; a null or odd address belongs to
    the empty host; repeated rows and null ids keep their rows; further columns are ignored.
    Pages are read whole; one that is long, deep or never closed takes time and memory in
    proportion.
    """
    winners = staged(host_paths(pages), "host-paths")
    size = winners.agg(F.sum(F.length("host") + F.length(F.array_join("paths", ",")) + 64)).first()[0] or 0

    def run(batches):
        for b in batches:
            text, path = [], []
            for page, paths in zip(b.column(2), b.column(3).to_pylist()):
                t, p = extract(page.as_py(), paths or [])
                text.append(t)
                path.append(p)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(text, pa.string()),
                    pa.array([len(t) for t in text], pa.int64()),
                    pa.array(path, pa.string()),
                ],
                ["page_id", "url", "text", "n_chars", "path"],
            )

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    joined = rows.join(F.broadcast(winners) if size <= BROADCAST_BYTES else winners, "host", "left")
    return joined.select("page_id", "url", "html", "paths").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, path string"
    )
