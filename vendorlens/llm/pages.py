"""HTML extraction with consensus paths of hosts.

A first pass scores the containers of each page by their own text less what is linked,
and votes for the best one's generalised path (tags with their classes, digits folded).
Spark sums the votes per host and path; a host's winning paths are those with at least
``share`` of its votes, its losing ones those that stand on as many pages without winning. A second pass extracts each
page again at the first winning path that holds ``NEARLY`` all of what its own best container has. If none does, the page
has its text elsewhere: its own best container counts, unless that is a losing path of the host
(a box that is long for once), which leaves the first winning path that the page has.

Blocks are runs of text between block-level tags. Boilerplate is left out: navigation,
asides, headers and footers of the page, forms, scripts, styles, embedded media, and
elements whose class, id or role names a menu, sidebar, notice, advert or reader comment. Some of these words also
name parts of an article (a paper's discussion, related work, a warning in the text, an aside): such an element goes
only where at least half of it is linked (``TOPICS`` anywhere, asides and ``REMARKS`` within an article).
If nothing else is left on a page, its articles count even inside such an element. A class
that has such a word as a part of it only (``site-footer``) leaves the element out of the containers around
it, but not of those inside it or of itself, so the best container is never lost by it.

A block counts for every container around it. The best container is the smallest one with
``NEARLY`` all of the unlinked text of the fullest one; lists, tables' parts and quotes are
parts of it, not the whole. One marked as article or main is preferred if it has half.

Defined results: a null or empty page gives the empty text; a page without a url belongs to
no host and is extracted by itself; repeated rows vote and come out as often as given.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import as_sql_type, stored, text_blocks, texts

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
MATH = "math menclose mfenced mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics"
INLINE = frozenset(MATH.split()) | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Containers that may be a page's whole article.
WHOLE = frozenset("article body center div main section table td".split())
#: The part of the fullest container's unlinked text that the best one has at least.
NEARLY = 0.9
CONTAINERS = frozenset("article body blockquote center div main section table tbody td tr ul ol dl".split())
#: An open element of the second set ends where one of the first begins.
ENDS = [(frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main nav ol p pre section table ul li dd dt td th tr tbody thead tfoot".split()), frozenset({"p"})),
        (frozenset({"li"}), frozenset({"li"})), (frozenset({"dd", "dt"}), frozenset({"dd", "dt"})),
        (frozenset({"td", "th"}), frozenset({"td", "th"})), (frozenset({"tr"}), frozenset({"td", "th", "tr"})),
        (frozenset({"tbody", "thead", "tfoot"}), frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"})),
        (frozenset({"option", "optgroup"}), frozenset({"option"})), (frozenset({"body"}), frozenset({"head"}))]
# Fixed value: browsers don't nest elements deeper; what is below belongs to the innermost container.
DEPTH = 512
#: Where looking for an element to end stops.
SCOPE = frozenset("article aside body div html main nav section table td th ul ol dl form blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("annotation annotation-xml aside button dialog embed footer form iframe menu nav noscript option select "
                    "svg template audio video".split()) | RAW
BOILERPLATE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies dialog discussion disqus disclaimer footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion reader reactions "
    "recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar topbar widget widgets".split())
#: Listed words that may name a part of an article as well.
TOPICS = frozenset("discussion reactions reader recommended related".split())
REMARKS = TOPICS | frozenset("alert disclaimer notice notices notification".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form navigation search toolbar".split())

ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Words before another that tell what a page has or shows, not what the element is.
STATES = frozenset("has have with without no not is show hide".split())
READERS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())


class Block:
    """A run of text: the paths of the containers around it, what it is and how much is linked."""

    __slots__ = ("text", "paths", "skip", "article", "linked", "inside", "doubt")

    def __init__(self, text, paths, skip, article, linked, inside=0, doubt=0):
        self.text, self.paths, self.skip, self.article, self.linked = text, paths, skip, article, linked
        self.inside = inside  # the first of its containers that it counts for
        self.doubt = doubt  # the element around it that goes if it is mostly linked, 0 if none


def tag_end(page: str, at: int, missing: set[str]) -> int:
    """The place of the > that ends the tag at ``at``, outside quotes; -1 if there's none.

    ``missing`` remembers quotes of which no further one comes, so a page is read once.
    """
    i = at
    while True:
        end = page.find(">", i)
        if end < 0:
            return -1
        quote = min((q for q in "\"'" if q not in missing and 0 <= page.find(q, i, end)),
                    key=lambda q: page.find(q, i, end), default="")
        if not quote:
            return end
        close = page.find(quote, page.find(quote, i, end) + 1)
        if close < 0:
            missing.add(quote)
            return end
        i = close + 1


def is_doubtful(tag: str, attributes: dict[str, str], article: bool) -> bool:
    """Whether what names an element boilerplate may also name a part of an article."""
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or tag in SKIPPED and not (tag == "aside" and article):
        return False
    listed = {w.lower() for w in WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")} & BOILERPLATE
    return listed <= (REMARKS if article else TOPICS)


def is_boilerplate(tag: str, attributes: dict[str, str]) -> bool | None:
    """Whether an element is boilerplate; None if only a part of a class or id says so."""
    if tag in SKIPPED or attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True
    part = False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in WORD.findall(name)]
        listed = [w in BOILERPLATE for w in words]
        if not any(listed) or words[0] in STATES:
            continue
        if all(listed) or words[0] in READERS:
            return True
        part = True
    return None if part else False


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, from tags as they come; tags needn't be closed."""
    out: list[Block] = []
    stack = [("", "", False, False, (), 0, 0)]  # tag, path, skip, in an article, container paths, first that counts, doubt
    doubts = 0
    run: list[str] = []
    linked = 0
    missing: set[str] = set()

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            _, _, skip, article, paths, inside, doubt = stack[-1]
            out.append(Block(text, paths, skip, article, min(linked, len(text)), inside, doubt))
        run.clear()
        linked = 0

    def add(text):
        nonlocal linked
        if text:
            run.append(text)
            if any(e[0] == "a" for e in stack[-4:]):
                linked += len(text)

    def close_to(depth):
        if any(e[0] not in INLINE for e in stack[depth:]):
            flush()
        del stack[depth:]

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        nxt = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if nxt in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        name = TAG_NAME.match(page, lt + 1 + closing)
        if not name:
            if closing:  # a bogus comment
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = lt + 1
            continue
        end = tag_end(page, name.end(), missing)
        at = n if end < 0 else end + 1
        tag = name.group().lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break  # a formatting end tag doesn't end blocks
            continue
        for begins, ends in ENDS:
            if tag in begins:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in ends:
                        close_to(depth)
                    elif stack[depth][0] in SCOPE:
                        break
        if tag in ("br", "hr"):
            add(" ")
        if tag not in INLINE:
            flush()
        if tag in VOID or page[end - 1:end] == "/" and tag in ("svg", "path"):
            continue
        attributes = {}
        if end > name.end():
            attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(page, name.end(), end)}
        _, path, skip, article, paths, inside, doubt = stack[-1]
        if tag not in INLINE:
            classes = sorted(set(re.sub(r"\d+", "#", attributes.get("class", "").lower()).split()))
            article = article or tag in ("article", "main")
            container = tag in CONTAINERS and len(stack) < DEPTH
            if len(stack) < DEPTH:
                path = f"{path}>{'.'.join([tag, *classes])}"
            if container:
                paths = (*paths, path)
            if tag == "header":
                skip = skip or not article
            elif tag not in ("html", "body"):
                named = is_boilerplate(tag, attributes)
                if named is not False and is_doubtful(tag, attributes, article):
                    named = False
                    if not doubt:
                        doubts += 1
                        doubt = doubts
                skip = skip or bool(named)
                if named is None:  # counts for itself, if it is a container, and those inside
                    inside = len(paths) - container
            if article and tag in HEADINGS and not skip:
                skip = False
        elif "hidden" in attributes:
            skip = True
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(page, at)
            at = close.start() if close else n
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        if tag in INLINE and skip != stack[-1][2]:
            flush()
        stack.append((tag, path, skip, article, paths, inside, doubt))
    flush()
    return out


def usable(blocks: list[Block]) -> list[Block]:
    """The blocks outside boilerplate; if there are none, those of articles."""
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    for b in blocks:
        size[b.doubt] = size.get(b.doubt, 0) + len(b.text)
        linked[b.doubt] = linked.get(b.doubt, 0) + b.linked
    blocks = [b for b in blocks if not b.doubt or 2 * linked[b.doubt] < size[b.doubt]]
    return [b for b in blocks if not b.skip] or [b for b in blocks if b.article]


def last_tag(path: str) -> str:
    return path.rpartition(">")[2].split(".")[0]


def best_path(blocks: list[Block]) -> tuple[str, float]:
    """The smallest container with nearly all text that isn't linked, and its score."""
    own: dict[tuple, float] = {}
    for b in blocks:
        at = (b.paths, b.inside)
        own[at] = own.get(at, 0.0) + len(b.text) - 2 * b.linked + 20 * b.text.count(",")
    score: dict[str, float] = {}
    depth: dict[str, int] = {}
    for (paths, inside), x in own.items():
        for i, p in enumerate(dict.fromkeys(paths[inside:])):
            if last_tag(p) in WHOLE:
                score[p] = score.get(p, 0.0) + x
                depth[p] = max(depth.get(p, 0), inside + i)
    if not score:
        return "", sum(own.values())
    path = top = max(sorted(score), key=lambda p: (score[p], depth[p]))
    most = score[top]
    loose = sum(x for (paths, inside), x in own.items() if not inside and not any(p in score for p in paths))
    if most < NEARLY * (most + max(loose, 0.0)):  # much of the text is in no container
        return "", most + loose
    for p in sorted(score):
        if p.startswith(f"{top}>") and score[p] >= NEARLY * most and depth[p] > depth[path]:
            path = p
    marked = [p for p in score if last_tag(p) in ("article", "main")]
    around = [p for p in marked if path == p or path.startswith(f"{p}>")]
    around = around or [p for p in marked if p.startswith(f"{path}>") and 2 * score[p] >= most]
    if around:  # the outermost article around or in the text, if it is marked as such
        path = min(around, key=lambda p: (len(p), p))
    return path, most


def within(blocks: list[Block], path: str) -> list[Block]:
    return [b for b in blocks if path in b.paths[b.inside:]]


def unlinked(blocks: list[Block]) -> int:
    return sum(len(b.text) - b.linked for b in blocks)


def extract(page: str, winners: list[str], losers=()) -> tuple[str, str]:
    """The text of a page and the path that gave it."""
    blocks = usable(blocks_of(page))
    own = best_path(blocks)[0]
    mine = within(blocks, own)
    most = unlinked(mine)
    tried = [(path, found) for path in winners if (found := within(blocks, path))]
    for path, found in tried:
        if unlinked(found) >= NEARLY * most:
            return "\n\n".join([b.text for b in found]), path
    if tried and own in losers:
        return "\n\n".join([b.text for b in tried[0][1]]), tried[0][0]
    if mine:
        return "\n\n".join([b.text for b in mine]), own
    return "\n\n".join([b.text for b in blocks if not b.inside] or [b.text for b in blocks]), ""


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def votes(pages: DataFrame) -> DataFrame:
    """For each host and path, of a block of pages: ``host``, ``path``, its votes ``n``, their ``score`` and the pages
    that have it, ``seen``."""

    def run(batches):
        for block in text_blocks(batches, "html"):
            cast: dict[tuple, list] = {}
            for host, page in zip(block.column("host").to_pylist(), texts(block, "html")):
                blocks = usable(blocks_of(page))
                path, score = best_path(blocks)
                for p in {p for b in blocks for p in b.paths[b.inside:]}:
                    cast.setdefault((host, p), [0, 0.0, 0])[2] += 1
                if path and score > 0:
                    vote = cast.setdefault((host, path), [0, 0.0, 0])
                    vote[0] += 1
                    vote[1] += math.log1p(score)
            keys = list(cast)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string()),
                 *[pa.array([cast[k][i] for k in keys], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.int64()))]],
                names=["host", "path", "n", "score", "seen"])

    return pages.where(F.col("host").isNotNull()).select("host", "html").mapInArrow(
        run, "host string, path string, n long, score double, seen long")


def winning_paths(cast: DataFrame, share: float) -> DataFrame:
    """The paths with at least ``share`` of a host's votes, most voted first, and those on as many pages without: ``host``,
    ``winners``, ``losers``, ``votes``."""
    paths = stored(cast.groupBy("host", "path").agg(F.sum("n").alias("n"), F.round(F.sum("score"), 6).alias("score"),
                                                    F.sum("seen").alias("seen")), "votes")
    total = paths.groupBy("host").agg(F.sum("n").alias("votes"))
    # of either kind at most 1 / share times as many a host as a page has containers
    known = paths.join(total, "host").where(F.greatest("n", "seen") >= share * F.col("votes"))
    won = F.col("n") >= share * F.col("votes")
    ranked = F.sort_array(F.collect_list(F.when(won, F.struct("n", "score", "path"))), asc=False)
    return (known.groupBy("host", "votes").agg(F.transform(ranked, lambda x: x["path"]).alias("winners"),
                                               F.collect_list(F.when(~won, F.col("path"))).alias("losers"))
            .where(F.size("winners") > 0))


#: Hosts with at least this part of all votes (so at most as many) are joined by broadcast.
HOT_HOSTS = 1000


def with_winners(rows: DataFrame, won: DataFrame) -> DataFrame:
    """``rows`` with their host's ``winners`` and ``losers``. Pages of the large hosts aren't shuffled, so none is hot."""
    won = stored(won, "winners")
    every = won.agg(F.sum("votes").alias("n")).first()["n"] or 0
    large = won.where(F.col("votes") * HOT_HOSTS >= every).select("host", "winners", "losers")
    rows = rows.join(F.broadcast(large), "host", "left")
    rest = F.col("winners").isNull() & F.col("host").isNotNull()
    small = won.where(F.col("votes") * HOT_HOSTS < every).select("host", "winners", "losers")
    return rows.where(~rest).unionByName(rows.where(rest).drop("winners", "losers").join(small, "host", "left"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", share: float = 0.2) -> DataFrame:
    """The main text of every page row: ``key``, ``url``, ``text``, ``path`` (where it was found)."""
    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), host_of(pages[url]).alias("host"), pages[page].alias("html"))
    rows = with_winners(rows, winning_paths(votes(rows), share))

    def run(batches):
        for block in text_blocks(batches, "html"):
            got = [extract(p, w or [], frozenset(x or ())) for p, w, x in
                   zip(texts(block, "html"), block.column("winners").to_pylist(), block.column("losers").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), block.column("url"), pa.array([t for t, _ in got], pa.string()),
                 pa.array([p for _, p in got], pa.string())], names=["key", "url", "text", "path"])

    out = rows.select("key", "url", "html", "winners", "losers").mapInArrow(
        run, f"key {as_sql_type(pages, key)}, url string, text string, path string")
    return out.withColumnsRenamed({"key": key, "url": url})
