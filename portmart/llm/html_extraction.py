"""Main text of web pages by wrapper induction.

The pages of a host come from one template.  Each is parsed to a tree and
aligned with a seed page of its host by simple tree matching (the largest
order-preserving mapping of equal tags, level by level).  Text that stands
unchanged at an aligned place of nearly all pages of the host is template;
what varies is content.  A page counts once however many rows repeat it, and
the near copies of the seed count as one page with it, so no text is template
because copies repeat it.  Of the content, the article is kept: parts that the
page's own markup names as menu, header, footer, sidebar, notice, advert,
form or reader comments go, with everything inside them.

The statistics are counts per host and seed node, summed inside each task
first, so a host with one third of all pages costs no more than others.

Defined results: null, empty or text-free html gives the empty text; a page
without article or main element is read from its body; repeated rows are
treated alike; null URLs form a host of their own; if taking the template
away would leave nothing, the text is kept; an empty table gives an empty
result; columns other than id, URL and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.llm.common import materialize, text_of

MIN_PAGES = 5
CONSTANT_SHARE = 0.9
# A page that shares more than this part of its or the seed's runs of three
# words is a near copy of the seed.  The text of a page without article or
# main element holds template text too, so it must share more.
NEAR_COPY_ARTICLE = 0.5
NEAR_COPY_PAGE = 0.75
BROADCAST_BYTES = 32 * 1024 * 1024

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set(
    "script style noscript template head title nav footer aside form button select textarea input label "
    "iframe object svg math canvas audio video dialog menu".split()
)
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
# A start tag that ends an open element of the second set (up to the nearest barrier).
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
BARRIER = set("ul ol dl table article section div main body html td th".split())
# Class tokens and ids, matched whole: "article-header" or "no-comments" name no such part.
PLACE = r"(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global|mobile)[_-])?"
NAMED_DROP = re.compile(
    rf"ads?|adverts?|advertis\w+|adsense|ad[_-](?:slot|unit|container|wrapper|banner)|sponsor(?:s|ed)?|promos?|promotions?|"
    rf"{PLACE}(?:banner|side-?bar|nav|navbar|navigation|menu|footer)|breadcrumbs?|pagination|pager|"
    r"comments?|comments?[_-](?:list|area|section|form)|replies|respond|disqus(?:_thread)?|"
    r"cookies?|cookies?[_-](?:banner|notice|consent|bar|popup)|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
    r"newsletter|newsletter[_-](?:signup|form)|subscribe|signup|login|search|search[_-](?:form|box)|"
    r"share|sharing|share[_-](?:buttons|bar|links)|social|social[_-](?:links|media|icons|share)|"
    r"related|related[_-](?:posts|articles|links)|recommend(?:ed|ations?)|widget|toolbar|skip-link|legal|copyright"
)
# They name the site's header only outside an article, as the header element does.
NAMED_HEADER = re.compile(r"masthead|header|(?:site|page)-?header")
# Elements that no name withdraws; an article inside an article is judged by its names.
KEPT = set("html body article main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
# A name with its whole value.
ATTR = re.compile(r"([^\s/=][^\s/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']\S*)))?")


class Node:
    """An element, or a text (tag ``#``) with its decoded characters."""

    __slots__ = ("tag", "names", "role", "hidden", "text", "children", "shape", "at")

    def __init__(self, tag: str, text: str = "") -> None:
        self.tag, self.text = tag, text
        self.names = self.role = ""
        self.hidden = False
        self.children: list[Node] = []
        self.shape = self.at = 0


def parse(page: str) -> Node:
    """The page's tree: end tags may be missing or stray."""
    root = Node("#root")
    stack, at = [root], 0
    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        if (text := m["text"]) is not None:
            stack[-1].children.append(Node("#", html.unescape(text)))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        closes = ENDS.get(tag, ())
        if tag in BLOCK:
            closes = {*closes, "p"}
        for k in range(len(stack) - 1, 0, -1) if closes else ():
            if stack[k].tag in closes:
                del stack[k:]
                break
            if stack[k].tag in BARRIER:
                break
        node = Node(tag)
        for name, *values in ATTR.findall(m["attrs"]):
            name = name.lower()
            if name == "hidden":
                node.hidden = True
            elif name in ("class", "id", "role"):
                value = html.unescape(next((v for v in values if v), "")).lower()
                if name == "role":
                    node.role = value.strip()
                else:
                    node.names += " " + value
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            stack.append(node)
        elif tag not in VOID and not m["attrs"].endswith("/"):
            stack.append(node)
    return root


def dropped(node: Node, in_article: bool) -> bool:
    """Named as something else than the article by its own markup."""
    if node.tag in DROPPED or node.hidden or node.role in DROPPED_ROLES:
        return True
    if node.tag == "header":
        return not in_article
    if node.tag in KEPT and not (in_article and node.tag == "article"):
        return False
    names = node.names.split()
    if not in_article and any(map(NAMED_HEADER.fullmatch, names)):
        return True
    return any(map(NAMED_DROP.fullmatch, names))


def regions(root: Node) -> list[Node]:
    """The page's articles; else its main element; else all of it."""
    articles: list[Node] = []
    mains: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag == "#" or dropped(node, False):
            continue
        if node.tag == "article":
            articles.append(node)
            continue
        if node.tag == "main" or node.role == "main":
            mains.append(node)
        stack.extend(reversed(node.children))
    return articles or mains[:1] or [root]


def blocks(root: Node, template: set[int]) -> list[str]:
    """The text blocks of the article in page order, without the template's
    text nodes (given by identity)."""
    out: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        if inline:
            line = " ".join("".join(inline).split())
            inline.clear()
            if line:
                out.append(line)

    for region in regions(root):
        # Entering a node pushes its end, so the walk needs no recursion.
        stack: list[Node | None] = [region]
        while stack:
            node = stack.pop()
            if node is None:
                flush()
            elif node.tag == "#":
                if id(node) not in template:
                    inline.append(node.text)
            elif node is not region and dropped(node, region.tag == "article"):
                if node.tag in BLOCK:
                    flush()
            elif node.tag == "br":
                inline.append(" ")
            else:
                if node.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(node.children))
        flush()
    return out


class Matcher:
    """Simple tree matching.  The score depends on the trees' shapes alone,
    so shapes are numbered and their alignments remembered.  No walk recurses,
    as pages may be nested to any depth."""

    def __init__(self) -> None:
        self.shapes: dict[tuple, int] = {}
        self.content: list[tuple[str, tuple[int, ...]]] = []
        self.sizes: list[int] = []
        self.aligned: dict[tuple[int, int], tuple[int, tuple[tuple[int, int], ...]]] = {}

    def number(self, root: Node) -> None:
        """Give every node of the tree its place and the number of its shape."""
        order, stack = [], [root]
        while stack:
            node = stack.pop()
            node.at = len(order)
            order.append(node)
            stack.extend(reversed(node.children))
        for node in reversed(order):
            key = (node.tag, tuple(c.shape for c in node.children))
            found = self.shapes.get(key)
            if found is None:
                found = self.shapes[key] = len(self.content)
                self.content.append(key)
                self.sizes.append(1 + sum(self.sizes[c] for c in key[1]))
            node.shape = found

    def known(self, a: int, b: int) -> tuple[int, tuple[tuple[int, int], ...]] | None:
        """The alignment of two shapes, if no table is needed any more."""
        if a == b:
            return self.sizes[a], tuple((i, i) for i in range(len(self.content[a][1])))
        if self.content[a][0] != self.content[b][0]:
            return 0, ()
        return self.aligned.get((a, b))

    def gain(self, a: int, b: int) -> int:
        """Nodes mapped between two shapes that are known."""
        if a == b:
            return self.sizes[a]
        return 0 if self.content[a][0] != self.content[b][0] else self.aligned[a, b][0]

    def match(self, a: int, b: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """Nodes mapped between two shapes, and which children pair."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self.known(x, y) is not None:
                stack.pop()
                continue
            xs, ys = self.content[x][1], self.content[y][1]
            head, tail = self._ends(xs, ys)
            below = {
                (c, d)
                for c in set(xs[head : len(xs) - tail])
                for d in set(ys[head : len(ys) - tail])
                if c != d and self.content[c][0] == self.content[d][0] and (c, d) not in self.aligned
            }
            if below:
                stack.extend(below)
            else:
                self.aligned[x, y] = self._children(xs, ys)
        return self.known(a, b)

    @staticmethod
    def _ends(xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[int, int]:
        """How many equal shapes stand at both starts and at both ends."""
        head = 0
        while head < min(len(xs), len(ys)) and xs[head] == ys[head]:
            head += 1
        tail = 0
        while tail < min(len(xs), len(ys)) - head and xs[-1 - tail] == ys[-1 - tail]:
            tail += 1
        return head, tail

    def _children(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[int, tuple[tuple[int, int], ...]]:
        # Equal shapes at both ends pair without a table; all others are known.
        head, tail = self._ends(xs, ys)
        pairs = [(i, i) for i in range(head)]
        pairs += [(len(xs) - k, len(ys) - k) for k in range(tail, 0, -1)]
        score = 1 + sum(self.sizes[xs[i]] for i, _ in pairs)
        mid_x, mid_y = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        best = [[0] * (len(mid_y) + 1)]
        for x in mid_x:
            above, row = best[-1], [0]
            for j, y in enumerate(mid_y):
                gain = self.gain(x, y)
                row.append(max(row[j], above[j + 1], above[j] + gain if gain else 0))
            best.append(row)
        i, j = len(mid_x), len(mid_y)
        while i and j:
            gain = self.gain(mid_x[i - 1], mid_y[j - 1])
            if gain and best[i][j] == best[i - 1][j - 1] + gain:
                i, j = i - 1, j - 1
                pairs.append((head + i, head + j))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return score + best[-1][-1], tuple(pairs)

    def texts(self, seed: Node, page: Node) -> Iterator[tuple[int, Node, Node]]:
        """The aligned texts: place of the text in the seed, and both."""
        stack = [(seed, page)]
        while stack:
            a, b = stack.pop()
            if a.tag == "#":
                yield a.at, a, b
            elif a.shape == b.shape:
                stack.extend(zip(a.children, b.children, strict=True))
            else:
                stack.extend((a.children[i], b.children[j]) for i, j in self.match(a.shape, b.shape)[1])


def same_text(a: Node, b: Node) -> bool:
    return a.text.split() == b.text.split() != []


def word_runs(tree: Node) -> set[tuple[str, ...]]:
    """The runs of three words of the page's text; fewer words are one run."""
    ws = " ".join(blocks(tree, set())).split()
    return set(zip(ws, ws[1:], ws[2:])) or ({tuple(ws)} if ws else set())


class Hosts:
    """The seeds parsed so far in this task."""

    def __init__(self) -> None:
        self.matcher = Matcher()
        self.seeds: dict[str, Node] = {}
        self.runs: dict[str, set[tuple[str, ...]]] = {}

    def seed(self, host: str, page: str) -> Node:
        if host not in self.seeds:
            self.seeds[host] = parse(page)
            self.matcher.number(self.seeds[host])
        return self.seeds[host]

    def near_copy(self, host: str, tree: Node) -> bool:
        """Whether the page is a near copy of its host's seed."""
        if host not in self.runs:
            self.runs[host] = word_runs(self.seeds[host])
        of_seed, of_page = self.runs[host], word_runs(tree)
        marked = any(r.tag != "#root" for t in (self.seeds[host], tree) for r in regions(t))
        part = NEAR_COPY_ARTICLE if marked else NEAR_COPY_PAGE
        return len(of_seed & of_page) > part * min(len(of_seed), len(of_page))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_of(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def with_seed(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """The pages beside their host's seed row, broadcast if small enough."""
    size = seeds.agg(F.sum(F.octet_length("seed") + F.octet_length("host") + 64)).first()[0] or 0
    side = seeds.withColumnRenamed("host", "seed_host")
    side = F.broadcast(side) if size <= BROADCAST_BYTES else side
    return pages.join(side, pages["host"] == F.col("seed_host")).drop("seed_host")


def choose_seeds(pages: DataFrame) -> DataFrame:
    """``host, seed``: of each host the page with the least hash of its
    content, a draw that does not depend on where the rows lie."""
    at = F.struct(F.xxhash64("page"), F.length("page"), F.col("page"))
    return pages.groupBy("host").agg(F.min_by("page", at).alias("seed"))


def with_copies(pages: DataFrame) -> DataFrame:
    """The pages beside ``copies``, how many rows of the host hold the same
    page.  Only hashes are shuffled, unless the repeated ones are many."""
    key = [F.xxhash64("page").alias("c_hash"), F.length("page").alias("c_length")]
    counted = pages.select(F.col("host").alias("c_host"), *key).groupBy("c_host", "c_hash", "c_length").count()
    repeated = materialize(counted.where("count > 1"), "page-copies")
    size = repeated.agg(F.sum(F.octet_length("c_host") + 64)).first()[0] or 0
    side = F.broadcast(repeated) if size <= BROADCAST_BYTES else repeated
    same = (
        (pages["host"] == F.col("c_host"))
        & (F.xxhash64(pages["page"]) == F.col("c_hash"))
        & (F.length(pages["page"]) == F.col("c_length"))
    )
    return pages.join(side, same, "left").select(pages["*"], F.coalesce("count", F.lit(1)).alias("copies"))


def induce(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, place, equal, pages``: for each text node of a seed, how many
    pages have the same text there, and how many the host has.  Equal pages
    count once, the seed and its near copies together as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = Hosts()
        # By number of copies too: each of a page's copies adds the same, so dividing by it is exact.
        sums: dict[tuple[str, int | None, int], int] = defaultdict(int)
        for batch in batches:
            for host, page, seed, copies in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                root = hosts.seed(host, seed)
                if page == seed:
                    for place, a, _ in hosts.matcher.texts(root, root):
                        if a.text.strip():
                            sums[host, place, copies] += 1
                    sums[host, None, copies] += 1
                    continue
                tree = parse(page)
                hosts.matcher.number(tree)
                equal = [place for place, a, b in hosts.matcher.texts(root, tree) if same_text(a, b)]
                if equal and hosts.near_copy(host, tree):
                    continue
                for place in equal:
                    sums[host, place, copies] += 1
                sums[host, None, copies] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _, _ in sums], pa.string()),
                pa.array([p for _, p, _ in sums], pa.int64()),
                pa.array([c for _, _, c in sums], pa.int64()),
                pa.array(list(sums.values()), pa.int64()),
            ],
            ["host", "place", "copies", "n"],
        )

    rows = with_seed(with_copies(pages), seeds).select("host", "page", "seed", "copies")
    counted = rows.mapInArrow(run, "host string, place long, copies long, n long")
    counted = counted.groupBy("host", "place", "copies").agg(F.sum("n").alias("n"))
    counted = counted.groupBy("host", "place").agg(F.sum(F.expr("n div copies")).alias("n"))
    counted = materialize(counted, "equal-texts")
    totals = counted.where("place is null").select(F.col("host").alias("n_host"), F.col("n").alias("pages"))
    equal = counted.where("place is not null").join(totals, F.col("host") == F.col("n_host"))
    return equal.select("host", "place", F.col("n").alias("equal"), "pages")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, constant_share: float = CONSTANT_SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    p = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), text_of("html").alias("page"))
    seeds = materialize(choose_seeds(p), "seeds")
    nodes = induce(p.select("host", "page"), seeds)
    constant = nodes.where((F.col("pages") >= min_pages) & (F.col("equal") >= constant_share * F.col("pages")))
    # The text nodes of one seed page at most.
    template = constant.groupBy("host").agg(F.collect_list("place").alias("places")).withColumnRenamed("host", "t_host")
    wrappers = seeds.join(template, seeds["host"] == template["t_host"], "left").select("host", "seed", "places")
    wrappers = materialize(wrappers, "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = Hosts()
        for batch in batches:
            out = []
            for host, page, seed, places in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                tree = parse(page)
                found = blocks(tree, set())
                if places and found:
                    hosts.matcher.number(tree)
                    known = set(places)
                    fixed = {
                        id(b)
                        for place, a, b in hosts.matcher.texts(hosts.seed(host, seed), tree)
                        if place in known and same_text(a, b)
                    }
                    found = blocks(tree, fixed) or found
                out.append("\n\n".join(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(out, pa.string()),
                    pa.array([len(t) for t in out], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = with_seed(p, wrappers).select("page_id", "url", "host", "page", "seed", "places")
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
