"""Main text of web pages by wrapper induction.

Every page becomes a tree of its block elements; siblings with equal labels (tag and class) are one
node, as they are entries of one list. The different layouts of a host are aligned by simple tree
matching and merged into the host's wrapper: a tree whose nodes know on how many pages they were
found and how much of their text was links. Each page is then aligned with its host's wrapper, which
puts every run of its text into a slot. A text that holds its slot on many of the host's different
pages is template, as is a slot outside of the page's main part that mostly holds links; varying slots
are content. In the page's main part a text must be on more of them; what an article element holds is
template only if its name tells so too, as articles of a host share passages. Elements that say themselves that they are a menu,
header, footer, sidebar, notice, advert, form or comments are template too, as such slots also vary;
a name that only has such a word among others counts as evidence beside the wrapper's. A page that
marks its main part or article has no content outside of it.

Layouts and their sums are counted before wrappers are merged, in two steps by host, and texts are
counted by host and slot with partial sums, so a host with a third of all pages is no large group. A
wrapper's size depends on a site's layouts, not on its pages; a host's list of constant texts holds a
few a slot. Copies of a page count once: a text must be on THREE different pages to be constant.

Cases: null and empty html give an empty text; a null url counts as host ''; repeated pages get equal
results; unclosed, stray and nested tags are mended as browsers do in the common cases, to any depth;
pages of any length are read whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .common import join_by_host, materialize

#: Elements that begin a block, that have no end, and whose content isn't shown.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html iframe legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template canvas audio video".split())
#: What an opening tag closes, if it is the innermost open block.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
PARAGRAPH = {"p"}
TEMPLATE_TAGS = frozenset("nav aside footer form button select dialog menu iframe fieldset option".split())
TEMPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id that name what isn't the article, and words that say nothing beside them.
TEMPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adbox adslot banner banners bottombar breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus disclaimer dropdown foot footer gdpr hidden login masthead menu menus menubar modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup popups promo promoted promotion replies reply rightbar sidebar sidebars sidenav signup sponsor sponsored sponsors subscribe subscription toolbar topbar".split()
)
#: Words that name such parts and parts of articles alike: evidence beside the wrapper's, whatever else the name holds.
HINTS = frozenset("flash follow overlay print related recommended respond responses search share sharing skip social tags teaser tracking widget widgets".split())
PLAIN_WORDS = frozenset("a area article bar block blog bottom box buttons cell center col column container content entry form global group header inner item left links list main message page panel post primary right root row secondary section site slot story text top unit user wrap wrapper".split())
#: Words that make a name one about other elements.
ABOUT = frozenset("with without has have no not".split())
#: Share of a slot's pages on which a constant text is found, outside of the main part, inside, and in an element with a telling name; different pages that it takes.
CONSTANT, INSIDE, NAMED, THREE = 0.5, 0.8, 0.2, 3
#: In an article: different pages that a constant text takes, and the share of them with neighbours of its own. What lies between unlike texts on almost all pages is no passage that articles share, and near copies of an article share neighbours too.
FIVE, APART = 5, 0.5
#: Share of links in a slot that makes a menu, and in an element with a telling name.
LINKS, NAMED_LINKS = 0.6, 0.3
#: Layouts held in a partition before they are passed on; aligned layouts and wrappers remembered.
HELD, REMEMBERED = 20_000, 5_000

ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
MARKUP = re.compile(rf"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{ATTRIBUTE})*+)>""", re.S)
NAMED_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+""")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: What an element says of itself. WEAK: it has a telling word in its name, beside others.
TEMPLATE, WEAK, HEADER, MAIN, ARTICLE = 1, 2, 4, 8, 16
SEEN: dict[tuple[str, str], tuple[str, int]] = {}


def described(tag: str, attributes: str) -> tuple[str, int]:
    """A block's label and what it says of itself."""
    key = tag, attributes
    if key in SEEN:
        return SEEN[key]
    found: dict[str, str] = {}
    for k, v in NAMED_ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        found.setdefault(k.lower(), v[1:-1] if v[:1] in ("'", '"') else v)
    names = [[w.lower() for w in PARTS.findall(name)] for k in ("class", "id") for name in found.get(k, "").split()]
    words = [w for name in names for w in name]
    role, says = found.get("role", "").lower(), 0
    if tag in TEMPLATE_TAGS or role in TEMPLATE_ROLES or "hidden" in found or found.get("aria-hidden") == "true":
        says = TEMPLATE
    elif tag not in ("body", "html"):  # the whole page is no part of itself
        for name in names:
            telling = TEMPLATE_WORDS.intersection(name)
            # A name such as with-sidebar tells of another element.
            if (telling or HINTS.intersection(name)) and not ABOUT.intersection(name):
                says |= TEMPLATE if telling and telling | PLAIN_WORDS | HINTS >= set(name) else WEAK
            elif "header" in name and PLAIN_WORDS >= set(name):
                says |= HEADER
    if tag == "header":
        says |= HEADER
    if tag == "article" or role == "article" or found.get("itemprop") == "articleBody":
        says |= ARTICLE
    elif tag == "main" or role == "main":
        says |= MAIN
    out = tag + "." + "-".join(w for w in words if not w.isdigit()), says
    if len(SEEN) < 50_000:
        SEEN[key] = out
    return out


class Node:
    """Sibling blocks of one label. at: its number in a page's or wrapper's tree."""

    __slots__ = ("label", "kids", "at", "pages", "chars", "links")

    def __init__(self, label: str, at: int = 0):
        self.label, self.kids, self.at, self.pages, self.chars, self.links = label, [], at, 1, 0, 0


def parse(text: str) -> tuple[Node, list[tuple[str, Node, int]], tuple]:
    """A page's tree; its text runs in page order, with references decoded and white space as one space, their nodes and what they lie in; its layout."""
    root = Node("root")
    #: Open blocks: tags, nodes, what they lie in; and how many there are of each tag.
    tags, nodes, says, open_ = ["root"], [root], [0], Counter()
    kid: dict[tuple[int, str], Node] = {}
    runs: list[tuple[str, Node, int]] = []
    piece: list[str] = []
    links = linked = 0
    at, end = 0, len(text)

    def flush() -> None:
        nonlocal piece, linked
        run = " ".join(entities.unescape("".join(piece)).split()) if piece else ""
        if run:
            node = nodes[-1]
            node.chars += len(run)
            node.links += min(linked, len(run))
            runs.append((run, node, says[-1]))
        piece, linked = [], 0

    def shut() -> str:
        nodes.pop()
        says.pop()
        open_[tags[-1]] -= 1
        return tags.pop()

    while at < end:
        found = MARKUP.search(text, at)
        if found is None:
            piece.append(text[at:])
            break
        if found.start() > at:
            piece.append(text[at : found.start()])
            if links:
                linked += found.start() - at
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
                at = end if close is None else close.end()
        elif tag in ("br", "hr"):
            piece.append(" ")
            if tag == "hr":
                flush()
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCKS:
            flush()
            if closing:
                if open_[tag]:
                    while shut() != tag:
                        pass
                continue
            closes = CLOSES.get(tag, PARAGRAPH)
            while tags[-1] in closes:
                shut()
            label, own = described(tag, attributes)
            within = says[-1]
            if own & HEADER and not (within | own) & (MAIN | ARTICLE):
                own |= TEMPLATE
            node = kid.get((nodes[-1].at, label))
            if node is None:
                node = kid[nodes[-1].at, label] = Node(label, len(kid) + 1)
                nodes[-1].kids.append(node)
            tags.append(tag)
            nodes.append(node)
            says.append(within | own & ~HEADER)
            open_[tag] += 1
    flush()
    return root, runs, tuple(kid)


def heaviest(pairs: list[tuple[int, int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """Of pairs (i, j, weight) those that rise in both numbers and weigh most, and their weight."""
    if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:], strict=False)):
        return sum(w for *_, w in pairs), [(i, j) for i, j, _ in pairs]
    pairs = sorted(pairs, key=lambda p: (p[0], -p[1]))
    # The best chain that ends at each j or before, in a tree of prefixes.
    size = max(j for _, j, _ in pairs) + 2
    tree: list[tuple[int, int]] = [(0, -1)] * (size + 1)
    before = []
    best = (0, -1)
    for k, (_, j, w) in enumerate(pairs):
        top, x = (0, -1), j
        while x:
            top = max(top, tree[x])
            x &= x - 1
        before.append(top[1])
        own = (top[0] + w, k)
        best, x = max(best, own), j + 1
        while x <= size:
            tree[x] = max(tree[x], own)
            x += x & -x
    chain, k = [], best[1]
    while k >= 0:
        chain.append(pairs[k][:2])
        k = before[k]
    return best[0], chain[::-1]


def align(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node, list[tuple[int, int]]]]]:
    """Simple tree matching of trees with equal roots: the most nodes that an order-preserving map keeps, and the matched nodes with their matched kids."""
    pairs, below = [(a, b)], []
    for x, y in pairs:  # grows
        where: dict[str, list[int]] = {}
        for j, kid in enumerate(y.kids if x.kids else ()):
            where.setdefault(kid.label, []).append(j)
        mine = []
        for i, kid in enumerate(x.kids if where else ()):
            for j in where.get(kid.label, ()):
                mine.append((i, j, len(pairs)))
                pairs.append((kid, y.kids[j]))
        below.append(mine)
    weight, chosen = [1] * len(pairs), [[]] * len(pairs)
    for k in range(len(pairs) - 1, -1, -1):
        if below[k]:
            more, chosen[k] = heaviest([(i, j, weight[n]) for i, j, n in below[k]])
            weight[k] += more
    out, open_ = [], [0]
    for k in open_:  # grows
        out.append((*pairs[k], chosen[k]))
        kept = set(chosen[k])
        open_ += [n for i, j, n in below[k] if (i, j) in kept]
    return weight[0], out


def matched(a: Node, b: Node) -> int:
    return align(a, b)[0] if a.label == b.label else 0


def merge(into: Node, other: Node) -> Node:
    """Aligns other with into and adds it; what doesn't match becomes an optional node in its place."""
    for a, b, pairs in align(into, other)[1]:
        a.pages, a.chars, a.links = a.pages + b.pages, a.chars + b.chars, a.links + b.links
        if len(pairs) == len(b.kids):
            continue
        kids, i, j = [], 0, 0
        for x, y in [*pairs, (len(a.kids), len(b.kids))]:
            kids += a.kids[i:x] + b.kids[j:y] + a.kids[x : x + 1]
            i, j = x + 1, y + 1
        a.kids = kids
    return into


def tree_of(layout: tuple, pages: int, chars: list[int], links: list[int]) -> Node:
    """The tree of pages of one layout, with sums over them."""
    nodes = [Node("root")] + [Node(label, i + 1) for i, (_, label) in enumerate(layout)]
    for (parent, _), node in zip(layout, nodes[1:], strict=True):
        nodes[parent].kids.append(node)
    for node in nodes:
        node.pages, node.chars, node.links = pages, chars[node.at], links[node.at]
    return nodes[0]


def merged(trees: list[Node]) -> Node:
    whole = trees[0]
    for tree in trees[1:]:
        merge(whole, tree)
    return whole


def dump(root: Node) -> bytes:
    """A tree as flat lists: of every node label, parent, pages, chars, links."""
    rows, open_ = [], [(root, -1)]
    for k, (node, parent) in enumerate(open_):  # grows
        rows.append((node.label, parent, node.pages, node.chars, node.links))
        open_ += [(kid, k) for kid in node.kids]
    return zlib.compress(pickle.dumps(rows), 1)


def undump(blob: bytes) -> Node:
    nodes: list[Node] = []
    for k, (label, parent, pages, chars, links) in enumerate(pickle.loads(zlib.decompress(blob))):
        node = Node(label, k)
        node.pages, node.chars, node.links = pages, chars, links
        nodes.append(node)
        if parent >= 0:
            nodes[parent].kids.append(node)
    return nodes[0]


def slots(page: Node, wrapper: Node, n: int) -> tuple[list[int], list[float]]:
    """Of each of a page's n nodes the slot in the wrapper, -1 if it has none, and the slot's share of links."""
    at, share = [-1] * n, [0.0] * n
    for a, b, _ in align(page, wrapper)[1]:
        at[a.at], share[a.at] = b.at, b.links / max(1, b.chars)
    return at, share


def main_text(text: str | None) -> str:
    """The text of a page that is alone on its host: only what its elements say of themselves."""
    runs = [(run, says) for run, _, says in parse(text)[1] if not says & TEMPLATE] if text else []
    marked = any(says & (MAIN | ARTICLE) for _, says in runs)
    return "\n".join(run for run, says in runs if says & (MAIN | ARTICLE) or not marked)


#: The host of a url, for Python and for Spark.
HOST = r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host of pages (host, html)."""

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, tuple], list] = {}

        def out() -> pa.RecordBatch:
            by_host: dict[str, list] = {}
            for (host, layout), sums in held.items():
                by_host.setdefault(host, []).append((layout, sums))
            rows = [(host, dump(merged([tree_of(layout, *sums) for layout, sums in sorted(own)]))) for host, own in by_host.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.binary())], names=["host", "wrapper"])

        for batch in batches:
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if text:
                    root, runs, layout = parse(text)
                    nodes = {node.at: node for _, node, _ in runs}
                    sums = held.setdefault((host, layout), [0, [0] * (len(layout) + 1), [0] * (len(layout) + 1)])
                    sums[0] += 1
                    for k, node in nodes.items():
                        sums[1][k] += node.chars
                        sums[2][k] += node.links
                    if len(held) >= HELD:
                        yield out()
        if held:
            yield out()

    def union(group: pa.Table) -> pa.Table:
        blobs = sorted(group.column("wrapper").to_pylist())
        return pa.table({"host": group.column("host")[:1], "wrapper": pa.array([dump(merged(list(map(undump, blobs))))], pa.binary())})

    parts = pages.select("host", "html").mapInArrow(induce, "host string, wrapper binary").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(32)))
    some = parts.groupBy("host", "salt").applyInArrow(union, "host string, wrapper binary")
    return some.groupBy("host").applyInArrow(union, "host string, wrapper binary")


def aligned(pages: DataFrame, known: DataFrame) -> DataFrame:
    """page_id, url, host and runs of every page: slot, says (what it lies in), links (the slot's share) and text."""
    joined = join_by_host(pages, known, F.length("wrapper")).select("page_id", "url", "host", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[bytes, Node] = {}
        placed: dict[tuple, tuple] = {}
        for batch in batches:
            begins, columns = [0], [[], [], [], []]
            for text, blob in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if text:
                    root, runs, layout = parse(text)
                    if blob is not None and (blob, layout) not in placed:
                        if blob not in trees:
                            if len(trees) > REMEMBERED:
                                trees.clear()
                            trees[blob] = undump(blob)
                        if len(placed) > REMEMBERED:
                            placed.clear()
                        placed[blob, layout] = slots(root, trees[blob], len(layout) + 1)
                    at, share = placed[blob, layout] if blob is not None else ([-1] * (len(layout) + 1), [0.0] * (len(layout) + 1))
                    for found, node, says in runs:
                        if not says & TEMPLATE:
                            for column, value in zip(columns, (at[node.at], says & ~TEMPLATE, share[node.at], found), strict=True):
                                column.append(value)
                begins.append(len(columns[0]))
            types = (pa.int32(), pa.int32(), pa.float64(), pa.string())
            parts = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["slot", "says", "links", "text"])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), parts)], names=["page_id", "url", "host", "runs"])

    parts = StructType([StructField(name, kind) for name, kind in (("slot", IntegerType()), ("says", IntegerType()), ("links", DoubleType()), ("text", StringType()))])
    return joined.mapInArrow(run, joined.select("page_id", "url", "host").schema.add("runs", ArrayType(parts)))


def constants(runs: DataFrame) -> DataFrame:
    """(host, constant): of each host the texts (slot, hash, share, apart) that are on THREE different pages and a share NAMED of the slot's pages, by exact counts.

    apart: whether the texts before it and those after it both vary from page to page.
    """
    beside = lambda i: F.coalesce(F.xxhash64(F.get("runs", i)["text"]), F.lit(0))
    pair = F.transform("runs", lambda x, i: F.struct(x["slot"].alias("slot"), F.xxhash64(x["text"]).alias("hash"), beside(i - 1).alias("before"), beside(i + 1).alias("after")))
    # Each text of a slot once a page: sorted, the others of its kind follow it.
    placed = runs.select("host", "runs", F.array_sort(pair).alias("placed"))
    before = lambda i, c: F.get(F.col("placed"), i - 1)[c]
    first = F.filter("placed", lambda x, i: (i == 0) | (x["slot"] != before(i, "slot")) | (x["hash"] != before(i, "hash")))
    there = F.array_distinct(F.transform("runs", lambda x: F.struct(x["slot"].alias("slot"), F.lit(None).cast("long").alias("hash"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("after"))))
    # Pages that say the same are one page.
    digest = F.xxhash64("runs.slot", "runs.text")
    different = placed.select("host", digest.alias("digest"), F.concat(first, there).alias("pairs")).dropDuplicates(["host", "digest"])
    counts = different.select("host", F.inline("pairs")).groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), F.least(F.approx_count_distinct("before"), F.approx_count_distinct("after")).alias("ways"))
    counts = materialize(counts.filter(F.col("hash").isNull() | (F.col("n") >= THREE)), "page-texts")
    of_slot = counts.filter("hash is null").select("host", "slot", F.col("n").alias("pages"))
    share = counts.filter("hash is not null").join(of_slot, ["host", "slot"]).withColumn("share", F.col("n") / F.col("pages")).filter(F.col("share") >= NAMED)
    apart = (F.col("n") >= FIVE) & (F.col("ways") >= APART * F.col("n"))
    return share.groupBy("host").agg(F.collect_list(F.struct("slot", "hash", "share", apart.alias("apart"))).alias("constant"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html", F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))
    runs = materialize(aligned(pages, materialize(wrappers(pages), "wrappers")), "page-runs")
    joined = join_by_host(runs, materialize(constants(runs), "constant-texts"), F.size("constant") * 16)

    def known(x):
        return F.get(F.filter(F.col("constant"), lambda c: (c["slot"] == x["slot"]) & (c["hash"] == F.xxhash64(x["text"]))), F.lit(0))

    def share(x):
        return F.coalesce(known(x)["share"], F.lit(0.0))

    def says(x, *what):
        return x["says"].bitwiseAND(sum(what)) > 0

    def template(x):
        never = F.lit(2.0)
        least = F.when(says(x, WEAK), NAMED).when(says(x, ARTICLE), F.when(F.coalesce(known(x)["apart"], F.lit(False)), INSIDE).otherwise(never)).when(says(x, MAIN), INSIDE).otherwise(CONSTANT)
        menu = F.when(says(x, WEAK), NAMED_LINKS).when(says(x, MAIN, ARTICLE), never).otherwise(LINKS)
        return (x["links"] > menu) | (share(x) >= least)

    marked = F.exists("runs", lambda x: says(x, MAIN, ARTICLE))
    kept = F.filter("runs", lambda x: (says(x, MAIN, ARTICLE) | ~F.col("marked")) & ~template(x))
    text = F.array_join(F.transform("kept", lambda x: x["text"]), "\n")
    return joined.withColumn("marked", marked).withColumn("kept", kept).select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
