"""HTML main-text extraction with site style trees.

Every page is parsed into element nodes, named by their path of tags and
classes.  The pages of a host are merged: an element node of the site style
tree is a path, its style nodes are the different child sequences seen below
it, and its contents are the different texts.  A node's importance is the
larger of its presentation entropy (how varied the child sequences are) and its
content entropy (how varied the texts are), each relative to the pages it
occurs on: a menu that looks and reads the same on every page has importance 0.
In branches below ``IMPORTANCE`` that at least ``MIN_PAGES`` different pages of
the host hold, the contents that repeat from page to page are removed; what only
one page says stays.  Pages with equal text are one page, whatever their markup,
comments and scripts, and a content that makes up ``MOSTLY`` or more of the text
of its pages is an article with near copies, not furniture.

The tree holds every element that a page shows, menus and adverts included.
Element names and class, id and role words that name page furniture (fixed
lists below) are a prior beside it: on given sites a menu, advert or footer is
drawn anew for each page, so its importance is as high as an article's.  A named
branch goes, however long its text, unless it is around the page's main content,
such as a wrapper called "has-sidebar": around the first article or main element
with text, or, on a page without one, around the first h1 and some paragraph
(without one either, around ``MOSTLY`` or more of the page's text).  Names further down
still count.  The page alone decides this, not how many pages its host has.
Where article or main elements hold ``MOSTLY`` or more of what is left of a page,
its text is taken from there.

Text: character references decoded, white space inside a block one space, blocks
in page order joined by one space.

Pages of one host never meet in a task: nodes are counted per (host, path,
variant), the entropies are sums over those counts, and pages read back only
the list of removed contents of their host.

Defined cases: null or empty html gives empty text; a null or unusable url is
the host "" ; repeated rows are extracted each and count once in the tree; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load

IMPORTANCE = 0.2
MIN_PAGES = 8        # different pages of a host that hold the node
MOSTLY = 0.5         # share of a page's text
MAX_DEPTH = 200      # deeper elements belong to their ancestor at this depth

# HTML element names by behaviour.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
UNSEEN = set("head script style noscript template iframe".split())
NAMED_TAGS = set("svg math canvas object form button select textarea input label nav aside footer dialog menu audio video map".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody "
            "td tfoot th thead tr ul".split())
MAIN = {"article", "main"}
# Class, id and role words that name page furniture.
FURNITURE = set("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
                "navigation menu breadcrumb breadcrumbs sidebar side aside rail footer foot masthead topbar toolbar cookie cookies "
                "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
                "share sharing social related recommended recommendations recommend trending popular widget widgets comment "
                "comments commentlist reply replies respond disqus discussion pagination pager copyright legal disclaimer skip "
                "search complementary contentinfo dialog hidden".split())
HEADERS = {"header", "head"}     # furniture unless inside an article
# Elements whose start ends an open paragraph or list item, and so on.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "thead": {"table"}, "option": {"select"}}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S | re.X)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "path", "parent", "children", "drop", "named", "main", "depth")

    def __init__(self, tag, path, parent, drop, named, main, depth):
        self.tag, self.path, self.parent, self.drop, self.depth = tag, path, parent, drop, depth
        self.named, self.main = named, main  # named: itself, not by what it is in
        self.children = []


def names_of(attributes: str) -> set[str]:
    out = set()
    for kind, *values in NAMED.findall(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values))
        out.update(WORDS.findall(value.lower()))
    return out


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Elements of a page and its text pieces (block element, text) in order."""
    root = Node("#root", "", None, False, False, False, 0)
    nodes, pieces, at = [root], [], 0
    here, block, text = root, root, []

    def close_block():
        nonlocal text
        piece = " ".join("".join(text).split())
        if piece:
            pieces.append((here_block, piece))
        text = []

    here_block = root
    size = len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at and not here.drop:
            text.append(html_lib.unescape(page[at:lt]))
        if lt >= size:
            break
        m = TOKEN.match(page, lt)
        if m is None:  # a bare "<"
            if not here.drop:
                text.append("<")
            at = lt + 1
            continue
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if m[0].startswith("<![CDATA[") and not here.drop:
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if closing:
            up = here
            while up is not root and up.tag != tag:
                up = up.parent
            if up is root:
                continue
            if any(x.tag in BLOCK or x.named for x in _between(here, up)):
                close_block()
                here_block = up.parent
            here = up.parent
            continue
        if tag in BLOCK or tag == "br":
            if tag != "br":
                close_block()
                up = here
                if tag in BLOCK:  # an open paragraph ends here
                    while up is not root and up.tag not in BLOCK:
                        up = up.parent
                    if up.tag == "p":
                        here = up.parent
            elif not here.drop:
                text.append(" ")
        if tag in ENDS:
            up = here
            while up is not root and up.tag not in SCOPE[tag]:
                if up.tag in ENDS[tag]:
                    here = up.parent
                up = up.parent
        if tag in VOID:
            continue
        names = names_of(attributes) if attributes else set()
        inside = here.main
        drop = here.drop or tag in UNSEEN or bool(HIDDEN.search(attributes))
        named = tag in NAMED_TAGS or bool(names & FURNITURE and tag not in ("html", "body", "main")) \
            or (not inside and (tag == "header" or bool(names & HEADERS)))
        if named and tag not in BLOCK:  # its text is a piece of its own
            close_block()
        path = here.path + "/" + tag + ("." + ".".join(sorted(names)) if names else "") if here.depth < MAX_DEPTH else here.path
        node = Node(tag, path, here, drop, named, inside or (not drop and (tag in MAIN or "main" in names and tag == "div")), here.depth + 1)
        here.children.append(tag)
        nodes.append(node)
        if tag in RAW or tag == "plaintext":
            end = re.compile(rf"</{tag}\b", re.I).search(page, at) if tag != "plaintext" else None
            at = end.start() if end else size
            here = node
            continue
        here = node
        if tag in BLOCK or named:
            here_block = node
    close_block()
    return nodes, pieces


def _between(low: Node, high: Node):
    while low is not high:
        yield low
        low = low.parent
    yield high


def host_of(url) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def path_hash(path: str) -> int:
    import xxhash
    h = xxhash.xxh64_intdigest(path)
    return h - (1 << 64) if h >= 1 << 63 else h


def around_main(pieces: list[tuple[Node, str]], chains: list[list[Node]], size: dict, total: int) -> set[str]:
    """Paths of the named branches around a page's main content."""
    def holders(tags):
        """The ancestors of the first text of an element of these tags, that element included."""
        for chain in chains:
            at = [k for k, n in enumerate(chain) if n.tag in tags or tags is MAIN and n.main and not n.parent.main]
            if at and not any(n.named and n.tag not in tags for n in chain[:at[-1]]):
                return chain[at[-1]:]
        return None

    main = holders(MAIN)
    if main is not None:
        return {n.path for n in main if n.named}
    first = holders({"h1"})
    prose = {n.path for (leaf, _), c in zip(pieces, chains) if leaf.tag == "p" for n in c}
    if first is not None:   # a wrapper holds paragraphs beside the heading, a page head does not
        return {n.path for n in first if n.named and (n.tag not in NAMED_TAGS and n.path in prose or size[n.path] >= MOSTLY * total)}
    return {n.path for c in chains for n in c if n.named and size[n.path] >= MOSTLY * total}


def prior_choice(pieces: list[tuple[Node, str]], named: list[set[str]]) -> list[str]:
    """The texts that names and main elements alone would take from a page;
    ``named``: the furniture above each."""
    free = [(n, t) for (n, t), above in zip(pieces, named) if not above]
    main = [(n, t) for n, t in free if n.main]
    if sum(len(t) for _, t in main) >= MOSTLY * sum(len(t) for _, t in free):
        free = main
    return [t for _, t in free or pieces]


def parsed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page (hash of the texts that names alone would take), texts,
    above (content hashes of the nodes over each text), furniture (whether a
    named branch that is not around the main content is among them), main, nodes:
    path, style and content hashes of the page's elements with text, and their
    share of its text.  A content hash is one of path and text."""

    def run(batches):
        signed = lambda b: path_hash(b)
        for b in batches:
            cols = {k: [] for k in ("host", "page", "texts", "above", "furniture", "main", "path", "style", "content", "share")}
            for u, h in zip(b.column("url").to_pylist(), b.column("html")):
                nodes, pieces = parse(h.as_py() or "")
                texts, chains, below = [t for _, t in pieces], [], {}
                for n, t in pieces:
                    chain, up = [], n
                    while up.parent is not None:
                        if not chain or up.path != chain[-1].path:
                            below.setdefault(up.path, []).append(t)
                        chain.append(up)
                        up = up.parent
                    chains.append(chain)
                style = {}
                for n in nodes:
                    if n.path in below:
                        style.setdefault(n.path, []).append(" ".join(n.children))
                keys = list(below)
                hashes = {k: signed(k) for k in keys}
                content = {k: signed("\n".join([k, *below[k]])) for k in keys}
                size = {k: sum(map(len, below[k])) for k in keys}
                total = max(1, sum(map(len, texts)))
                around = around_main(pieces, chains, size, total)
                named = [{n.path for n in c if n.named} - around for c in chains]
                cols["host"].append(host_of(u))
                cols["page"].append(signed("\n".join(prior_choice(pieces, named))))
                cols["texts"].append(texts)
                cols["above"].append([list(dict.fromkeys(content[n.path] for n in c)) for c in chains])
                cols["furniture"].append([bool(x) for x in named])
                cols["main"].append([n.main for n, _ in pieces])
                cols["path"].append([hashes[k] for k in keys])
                cols["style"].append([signed("|".join(style[k])) for k in keys])
                cols["content"].append([content[k] for k in keys])
                cols["share"].append([size[k] / total for k in keys])
            longs = pa.list_(pa.int64())
            types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(longs), pa.list_(pa.bool_()), pa.list_(pa.bool_()),
                     longs, longs, longs, pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url")] + [pa.array(v, t) for v, t in zip(cols.values(), types)],
                names=["page_id", "url"] + list(cols))

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, host string, page long, texts array<string>, above array<array<bigint>>, "
             "furniture array<boolean>, main array<boolean>, path array<bigint>, style array<bigint>, content array<bigint>, "
             "share array<double>")


def tree_nodes(parsed: DataFrame) -> DataFrame:
    """host, path, style, content, share: the nodes of the different pages."""
    node = ["path", "style", "content", "share"]
    once = parsed.groupBy("host", "page").agg(F.min(F.struct(*node)).alias("p"))  # the same one on every run
    return once.select("host", F.explode(F.arrays_zip(*[F.col(f"p.{c}") for c in node])).alias("n")).select("host", *[f"n.{c}" for c in node])


def importance(parsed: DataFrame) -> DataFrame:
    """host, path, pages, share, presentation, content, importance of every node
    of the site style trees.  Entropies are in units of log(pages), so 1 means
    that every page differs and 0 that all are the same."""
    kinds = tree_nodes(parsed).select("host", "path", "share", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("style").alias("variant")),
        F.struct(F.lit(1).alias("kind"), F.col("content").alias("variant")))).alias("v"))
    counts = kinds.groupBy("host", "path", "v.kind", "v.variant").agg(
        F.count("*").alias("c"), F.sum("share").alias("share"))
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("share"))).alias("share"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log("c"))).alias("s"),
        F.sum(F.when(F.col("kind") == 1, F.col("c") * F.log("c"))).alias("t"))
    m = F.col("pages")
    entropy = lambda x: F.when(m > 1, F.lit(1.0) - F.col(x) / (m * F.log(m))).otherwise(F.lit(1.0))
    return (sums.withColumn("share", F.col("share") / m).withColumn("presentation", entropy("s")).withColumn("content", entropy("t"))
            .withColumn("importance", F.greatest("presentation", "content")).drop("s", "t"))


def repeated_contents(parsed: DataFrame, low: DataFrame) -> DataFrame:
    """host, path, content: the contents of the ``low`` nodes (host, path) that
    more than one page has and that are not most of those pages."""
    counts = (tree_nodes(parsed).join(low.select("host", "path"), ["host", "path"], "left_semi")
              .groupBy("host", "path", "content").agg(F.count("*").alias("c"), F.avg("share").alias("share")))
    return counts.where((F.col("c") > 1) & (F.col("share") < MOSTLY)).select("host", "path", "content")


def main_text(pages: DataFrame, least: float = IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, host, text, removed (texts left out)."""
    parsed = cut(parsed_pages(pages), "pages-parsed")
    tree = importance(parsed)
    low = cut(tree.where((F.col("importance") < least) & (F.col("pages") >= min_pages)).select("host", "path"), "pages-nodes")
    per_host = cut(repeated_contents(parsed, low).groupBy(F.col("host").alias("h")).agg(F.collect_list("content").alias("low")),
                   "pages-low")
    joined = parsed.join(per_host, F.col("host") == F.col("h"), "left")
    low_ = F.coalesce("low", F.array().cast("array<bigint>"))
    zipped = F.arrays_zip("texts", "above", "furniture", "main")
    kept = F.filter(zipped, lambda z: ~F.arrays_overlap(z["above"], low_) & ~z["furniture"])
    joined = joined.select("page_id", "url", "host", F.size("texts").alias("n"), kept.alias("kept"))
    chars = lambda a: F.aggregate(a, F.lit(0), lambda x, z: x + F.length(z["texts"]))
    main = F.filter("kept", lambda z: z["main"])
    kept = F.when(chars(main) >= MOSTLY * chars(F.col("kept")), main).otherwise(F.col("kept"))
    return joined.withColumn("kept", kept).select(
        "page_id", "url", "host", F.array_join(F.transform("kept", lambda z: z["texts"]), " ").alias("text"),
        (F.col("n") - F.size("kept")).alias("removed"))


def op6_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(load(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "removed")
