"""Main text of web pages by wrapper induction.

The block elements of a page form a tree. Runs of like siblings (paragraphs, items, rows) are one node of it. Trees of
pages of one host are aligned by simple tree matching, a few at a time and then the results of that, until one template
is left for each host; its nodes count the pages that have them, the texts that prevail in them, and how much text
varies from page to page, within links and without. From that the wrapper follows: texts that prevail are template; of
what varies, the part of the tree that holds most of the text is content, and small or linked parts beside it aren't. A
page is then aligned with its host's wrapper. Names of elements and classes decide only where that can't tell (adverts,
reader comments and forms vary like content), and on hosts with fewer than MIN_PAGES different pages.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Pages, or templates of such, that are aligned in one group.
GROUP = 32
#: Different pages of a host from which it has a wrapper, and in how many at least a text prevails.
MIN_PAGES = 3
#: Share of the pages with a node on which a text prevails, so that it is template: beside the content, and within.
CONSTANT, CONSTANT_IN_CONTENT = 0.5, 0.9
#: Share of a part's varying text from which a child of it holds the content, and below which a sibling of that is none.
MAIN, MINOR = 0.6, 0.1
#: Share of a node's text within links from which it is a menu or the like.
LINKED = 0.6
#: Elements below this depth belong to the one at it; nodes that a template keeps, those of the most pages.
DEPTH, NODES = 120, 4096
#: Tasks over which the pages of one host are dealt where they meet its wrapper.
SALT = 16

# Names of HTML elements, and words in class and id names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FORMS = set("head form dialog select button label fieldset object svg audio video canvas map".split())
BESIDES = set("nav header footer aside menu".split())
REPEATED = set("p li tr td th dt dd option h1 h2 h3 h4 h5 h6 blockquote pre figure".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
ARTICLE = {"article", "main"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banners?|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|side-?bars?|footers?|headers?|masthead|notices?|cookies?|consent|comment\w*|respond|repl(?:y|ies)"
    r"|disqus|shar(?:e|ing)|social|related|recommend\w*|newsletter|subscri\w*|popup|modal|widgets?|login|search|paginat\w*|pager|skip|toolbar|alerts?|disclaimer|legal|copyright|gdpr|overlay|toc)(?=$|[-_\s])",
    re.IGNORECASE,
)
#: Of these, those of what the texts of pages can't tell from content; and names of what an element is beside or without.
ARTICLE_NAMES = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|comment\w*|repl(?:y|ies)|related|recommend\w*)(?=$|[-_\s])", re.IGNORECASE)
BESIDE = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|is)[-_]\S*", re.IGNORECASE)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|([^<]++|<)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def _named(tag: str, names: str, role: str, inside: bool) -> int:
    """What names tell of an element: 2 if it is no content whatever varies in it, 1 if it is none most often, else 0."""
    if tag in FORMS:
        return 2
    found = None
    if names and tag not in ("html", "body", "main"):
        bare = BESIDE.sub("", names)
        if ARTICLE_NAMES.search(bare):
            return 2
        found = tag != "article" and NAMES.search(bare)
    if found and inside and "header" in found[0].lower():
        found = None
    return int(bool(found) or role in ROLES or tag in BESIDES and not (tag == "header" and inside))


class Page:
    """A page's blocks in order, as (text, outside, within an article), and its tree.

    A node of the tree is [label, named, places of its own blocks, characters in links, children].
    """

    def __init__(self, source: str | None) -> None:
        self.blocks: list[tuple[str, bool, bool]] = []
        self.root: list = ["", 0, [], 0, []]
        self.has_article = False
        # of open elements: tag, outside, within an article, node
        self.stack: list[tuple[str, bool, bool, list]] = [("", False, False, self.root)]
        self.held: list[str] = []
        self.in_link, self.linked = False, 0
        self._read(source or "")

    def _flush(self) -> None:
        if self.held:
            text = " ".join(html.unescape("".join(self.held)).split())
            self.held = []
            _, outside, inside, node = self.stack[-1]
            if text:
                node[2].append(len(self.blocks))
                node[3] += min(self.linked, len(text))
                self.blocks.append((text, outside, inside))
            self.linked = 0

    def _open(self, tag: str, attributes: str) -> None:
        named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
        names = f"{named.get('class', '')} {named.get('id', '')}".strip()
        article = tag in ARTICLE or named.get("role") == "main" or named.get("itemprop") == "articleBody"
        _, outside, inside, parent = self.stack[-1]
        hidden = bool(attributes) and (re.search(r"\bhidden\b", attributes) is not None and "hidden" not in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", ""))
        told = 2 if hidden else _named(tag, names, named.get("role", ""), inside)
        outside = outside or told > 0
        inside = inside or (article and not outside)
        self.has_article |= inside
        if len(self.stack) < DEPTH:
            label = re.sub(r"\d+", "0", f"{tag}.{names.split()[0]}") if names else tag
            node = [f"{label}!" if article else label, told, [], 0, []]
            parent[4].append(node)
        else:
            node = parent
        self.stack.append((tag, outside, inside, node))

    def _close(self, tags: set[str], barrier: set[str]) -> None:
        """Closes the innermost open element of `tags` and what is open in it, unless one of `barrier` is in between."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                del self.stack[k:]
                return
            if self.stack[k][0] in barrier:
                return

    def _read(self, source: str) -> None:
        at, n, match = 0, len(source), _TOKEN.match
        while at < n:
            found = match(source, at)
            at = found.end()
            text = found[7]
            if text is not None:
                self.held.append(text)
                if self.in_link:
                    self.linked += len(text)
                continue
            tag = found[2] or found[5]
            if tag is None:
                if found[0].startswith("<![CDATA["):
                    self.held.append(html.escape(found[0][9:].removesuffix("]]>")))
                continue
            tag, attributes = tag.lower(), found[3] if found[2] else found[6]
            if found[1] or found[4]:
                if tag in INLINE:
                    self.in_link &= tag != "a"
                    if any(x[0] == tag for x in self.stack[-2:]):
                        self._flush()
                        self._close({tag}, set())
                    continue
                self._flush()
                if tag in ("ul", "ol", "dl", "table", "tr", "select") or tag not in ("p", "li"):
                    self._close({tag}, set())
                else:
                    self._close({tag}, {"ul", "ol", "table", "article", "div", "section"} if tag == "p" else {"ul", "ol"})
            elif tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else n
            elif tag in INLINE:
                self.in_link |= tag == "a"
                # An inline element only matters if it is hidden or an advert or the like.
                if attributes and ("class" in attributes or "hidden" in attributes or "id" in attributes) and not attributes.rstrip().endswith("/"):
                    named = dict((k.lower(), a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes))
                    if _named(tag, f"{named.get('class', '')} {named.get('id', '')}".strip(), "", self.stack[-1][2]) or re.search(r"\shidden\b", attributes):
                        self._flush()
                        self._open(tag, attributes)
            elif tag == "br" or tag in VOID:
                if tag in ("br", "hr"):
                    self.held.append(" ")
            else:
                self._flush()
                if tag in CLOSES:
                    self._close(*CLOSES[tag])
                self._close({"p", "h1", "h2", "h3", "h4", "h5", "h6"}, {"div", "article", "section", "table", "td", "li", "body", "blockquote", "button", "object"})
                self._open(tag, attributes)
        self._flush()

    def vote(self) -> int:
        """What tells the page from others of its host: the least hash of its content blocks, so near copies have one."""
        return min((_key(text) for text, outside, inside in self.blocks if not outside and (inside or not self.has_article)), default=0)

    def by_names(self) -> str:
        """The content as names alone tell it."""
        return " ".join(text for text, outside, inside in self.blocks if not outside and (inside or not self.has_article))

    def by_wrapper(self, wrapper: list) -> str:
        """The content as the host's wrapper tells it; by names, if most of the page has no place in the wrapper."""
        kept, known, size = [], {}, 0
        todo = [(folded(self.root), wrapper, wrapper[1], 0)]
        while todo:
            node, other, good, told = todo.pop()
            told = max(told, node[1])
            if other is not None:
                # What the wrapper has a place for goes by the wrapper, but for what names alone can tell.
                good, constant = other[1] and told < 2, set(other[2])
                size += sum(len(self.blocks[i][0]) for i in node[2])
            else:
                good, constant = good and told == 0, ()
            if good:
                kept += [i for i in node[2] if not constant or _key(self.blocks[i][0]) not in constant]
            pairs = dict(aligned(node[4], other[-1], known)[1]) if other is not None and node[4] and other[-1] else {}
            for i, child in enumerate(node[4]):
                match = other[-1][pairs[i]] if i in pairs else None
                todo.append((child, match, match[1] if match is not None else good, told))
        if 2 * size < sum(len(text) for text, outside, _ in self.blocks if not outside):
            return self.by_names()
        return " ".join(self.blocks[i][0] for i in sorted(kept))


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 11  # below 2 ** 53, so that JSON readers agree on it


def folded(node: list) -> list:
    """The tree with each run of like siblings as one node that holds what they hold."""
    children: list[list] = []
    for child in map(folded, node[4]):
        before = children[-1] if children else None
        tag, _, name = child[0].partition(".")
        if before is not None and before[0] == child[0] and before[1] == child[1] and (name or tag in REPEATED):
            join_pages(before, child)
        else:
            children.append(child)
    return [node[0], node[1], list(node[2]), node[3], children]


def join_pages(a: list, b: list) -> None:
    """Adds what b holds to a, by the alignment of their children."""
    a[2] += b[2]
    a[3] += b[3]
    if not a[4] or not b[4]:
        a[4] = a[4] or b[4]
        return
    children, i, j = [], 0, 0
    for x, y in [*aligned(a[4], b[4], {})[1], (len(a[4]), len(b[4]))]:
        children += a[4][i:x] + b[4][j:y]
        if x < len(a[4]):
            join_pages(a[4][x], b[4][y])
            children.append(a[4][x])
        i, j = x + 1, y + 1
    a[4] = children


# A template's node: [label, pages that have it, sums of what names tell (1, 2), characters, of these in links,
# {key of a text: [pages that have it here, its length]}, children].


def template(page: Page) -> list:
    def one(node: list) -> list:
        texts = [page.blocks[i][0] for i in node[2]]
        return [node[0], 1, int(node[1] > 0), int(node[1] > 1), sum(map(len, texts)), node[3], {str(_key(x)): [1, len(x)] for x in texts}, [one(x) for x in node[4]]]

    return one(folded(page.root))


def matching(a: list, b: list, known: dict[tuple[int, int], int]) -> int:
    """Simple tree matching: the most nodes that two trees with equal labels at their roots can share in order."""
    if a[0] != b[0]:
        return 0
    if not a[-1] or not b[-1]:
        return 1
    key = (id(a), id(b))
    if key not in known:
        known[key] = 1 + aligned(a[-1], b[-1], known)[0]
    return known[key]


def aligned(xs: list[list], ys: list[list], known: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The weight of the best alignment of two lists of children, and the pairs in it."""
    lo, hx, hy, pairs, tail = 0, len(xs), len(ys), [], []
    # Equal leaves at either end are in some best alignment.
    while lo < hx and lo < hy and xs[lo][0] == ys[lo][0] and not (xs[lo][-1] and ys[lo][-1]):
        pairs.append((lo, lo))
        lo += 1
    while hx > lo and hy > lo and xs[hx - 1][0] == ys[hy - 1][0] and not (xs[hx - 1][-1] and ys[hy - 1][-1]):
        hx, hy = hx - 1, hy - 1
        tail.append((hx, hy))
    total = len(pairs) + len(tail)
    n, m = hx - lo, hy - lo
    if n and m:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            row, below, x = best[i], best[i + 1], xs[lo + i]
            for j in range(m - 1, -1, -1):
                y = ys[lo + j]
                most = below[j] if below[j] > row[j + 1] else row[j + 1]
                if x[0] == y[0]:
                    both = below[j + 1] + matching(x, y, known)
                    most = both if both > most else most
                row[j] = most
        total += best[0][0]
        i = j = 0
        while i < n and j < m:
            x, y = xs[lo + i], ys[lo + j]
            if x[0] == y[0] and best[i][j] == best[i + 1][j + 1] + matching(x, y, known):
                pairs.append((lo + i, lo + j))
                i, j = i + 1, j + 1
            elif best[i][j] == best[i + 1][j]:
                i += 1
            else:
                j += 1
    return total, pairs + tail[::-1]


def merge(a: list, b: list, known: dict[tuple[int, int], int]) -> None:
    """Adds the tree b to the template a: aligned nodes count together, others of b go in between."""
    for k in range(1, 6):
        a[k] += b[k]
    texts = a[6]
    for key, (n, size) in b[6].items():
        held = texts.get(key)
        if held is None:
            texts[key] = [n, size]
        else:
            held[0] += n
    if not a[7] or not b[7]:
        a[7] = a[7] or b[7]
        return
    children, i, j = [], 0, 0
    for x, y in [*aligned(a[7], b[7], known)[1], (len(a[7]), len(b[7]))]:
        children += a[7][i:x] + b[7][j:y]
        if x < len(a[7]):
            merge(a[7][x], b[7][y], known)
            children.append(a[7][x])
        i, j = x + 1, y + 1
    a[7] = children


def _nodes(node: list) -> Iterator[list]:
    todo = [node]
    while todo:
        now = todo.pop()
        yield now
        todo += now[7]


def trimmed(root: list) -> list:
    """The template of bounded size: of a node's texts those that a tenth of its pages have, and the NODES commonest nodes.

    Pages are dealt by chance, so a text that prevails on half of them is on a tenth of each group's.
    """
    nodes = list(_nodes(root))
    for node in nodes:
        if node[1] >= 5:
            least = max(2, node[1] / 10)
            node[6] = {k: v for k, v in node[6].items() if v[0] >= least}
    if len(nodes) > NODES:
        least = sorted((x[1] for x in nodes), reverse=True)[NODES]
        for node in nodes:
            node[7] = [x for x in node[7] if x[1] > least]
    return root


def wrapper(root: list) -> list:
    """The wrapper of a template: nodes [label, whether what varies in it is content, keys of template texts, children]."""
    prose: dict[int, tuple[float, float]] = {}  # of subtrees: characters that vary and aren't in links, and all of them

    def sums(node: list) -> tuple[float, float]:
        constant = sum(n * size for n, size in node[6].values() if n >= MIN_PAGES and n >= CONSTANT * node[1])
        linked = min(1.0, node[5] / node[4]) if node[4] else 0.0
        varying, everything = max(0, node[4] - constant) * (1 - linked), float(node[4])
        for child in node[7]:
            x, y = sums(child)
            varying, everything = varying + x, everything + y
        prose[id(node)] = varying, everything
        return prose[id(node)]

    def linked(node: list) -> float:
        return sum(x[5] for x in _nodes(node)) / max(1.0, prose[id(node)][1])

    def holds(node: list, tags: set[str]) -> bool:
        return any(x[0].partition(".")[0].rstrip("!") in tags for x in _nodes(node))

    def made(node: list, good: bool, inside: bool) -> list:
        inside = inside or node[0].endswith("!")
        share = CONSTANT_IN_CONTENT if inside else CONSTANT
        texts = sorted(int(k) for k, (n, _) in node[6].items() if n >= MIN_PAGES and n >= share * node[1])
        whole = prose[id(node)][0]
        shares = [prose[id(x)][0] / whole if whole else 0.0 for x in node[7]]
        main = max(range(len(shares)), key=shares.__getitem__, default=-1)
        if main >= 0 and (shares[main] < MAIN or not node[7][main][7] or 2 * node[7][main][3] >= node[7][main][1]):
            main = -1
        children = []
        for k, child in enumerate(node[7]):
            tag = child[0].partition(".")[0].rstrip("!")
            fine = good
            if 2 * child[3] >= child[1]:
                fine = False  # adverts, reader comments, forms: only names tell
            elif k != main and shares[k] < MAIN:
                beside = main >= 0 and tag not in LEAVES
                if beside and not inside and (shares[k] < MINOR or node[7][main][0].endswith("!")):
                    fine = False
                elif linked(child) >= LINKED and tag not in LEAVES:
                    fine = False
                elif 2 * child[2] >= child[1]:
                    fine = False  # what could be either way goes by names
            children.append(made(child, fine, inside))
        return [node[0], int(good), texts, children]

    sums(root)
    return made(root, True, False)


def host_of(url_col: str):  # noqa: ANN201 - a column
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def host_wrappers(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """host, wrapper (JSON): of each host with MIN_PAGES different pages or more.

    Copies and near copies of a page on a host have one vote. So a page that occurs often doesn't become its template.
    """
    rows = pages.select(host_of(url_col).alias("host"), F.xxhash64(id_col, url_col).alias("spread"), html_col).filter("host <> ''")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, votes = [], []
            for source in batch.column(2):
                page = Page(source.as_py())
                found.append(json.dumps(template(page), separators=(",", ":")))
                votes.append(page.vote())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(votes, pa.int64()), pa.array(found, pa.string())], names=["host", "spread", "vote", "tree"])

    voting = written(rows.mapInArrow(trees, "host string, spread long, vote long, tree string"), "trees")
    # Each vote has one tree: that of the smallest number among its pages.
    least = voting.groupBy("host", "vote").agg(F.min(F.struct("spread", F.xxhash64("tree").alias("hash"))).alias("one"))
    sizes = least.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_PAGES).select("host", F.ceil(F.col("n") / GROUP).alias("groups"))
    sizes = written(sizes, "sizes")
    most = sizes.agg(F.coalesce(F.max("groups"), F.lit(0))).first()[0]
    chosen = least.join(sizes, "host").select("host", "vote", F.col("one.spread").alias("spread"), F.col("one.hash").alias("hash"), "groups")
    trees_of = voting.withColumn("hash", F.xxhash64("tree")).join(chosen, ["host", "vote", "spread", "hash"]).dropDuplicates(["host", "vote"])
    now = trees_of.select("host", F.pmod("spread", "groups").alias("part"), F.col("spread").alias("place"), "tree")
    now = now.repartition("host", "part")  # else all groups of a host would stay in the task that joined it

    def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ordered = sorted(zip(table.column("place").to_pylist(), table.column("tree").to_pylist(), strict=True))
        first, *others = (json.loads(tree) for _, tree in ordered)
        for other in others:
            merge(first, other, {})
        return pa.table({"host": [key[0].as_py()], "part": pa.array([key[1].as_py() // GROUP], pa.int64()), "place": pa.array([key[1].as_py()], pa.int64()), "tree": [json.dumps(trimmed(first), separators=(",", ":"))]})

    while True:
        now = now.groupBy("host", "part").applyInArrow(merged, "host string, part long, place long, tree string")
        if most <= 1:
            break
        most = -(-most // GROUP)

    def induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(wrapper(json.loads(x)), separators=(",", ":")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["host", "wrapper"])

    return now.select("host", "tree").mapInArrow(induced, "host string, wrapper string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page.

    Returns one row for each row of `pages`: the id, url, text (empty if none) and n_chars (its code points). Null html
    is empty. A null url, or one without a host, has no wrapper; such pages are told by element names alone, and so are
    the pages of hosts with fewer than three different ones. Copies of a page count once for the wrapper, and each row
    gets its text; other columns are ignored. Elements nested deeper than DEPTH count as parts of the one at that depth.
    """
    found = written(host_wrappers(pages, id_col, url_col, html_col), "wrappers")
    salted = found.select("host", "wrapper", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64(id_col, url_col), F.lit(SALT)).cast("int")
    rows = pages.select(id_col, url_col, html_col, host_of(url_col).alias("host_of_page"), salt.alias("salt_of_page"))
    joined = rows.join(salted, (F.col("host_of_page") == F.col("host")) & (F.col("salt_of_page") == F.col("salt")), "left").select(id_col, url_col, html_col, "wrapper")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for source, told in zip(batch.column(2), batch.column(3), strict=True):
                page, told = Page(source.as_py()), told.as_py()
                if told is not None and told not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[told] = json.loads(told)
                texts.append(page.by_names() if told is None else page.by_wrapper(known[told]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kinds = {name: pages.schema[name].dataType.simpleString() for name in (id_col, url_col)}
    return joined.mapInArrow(extract, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
