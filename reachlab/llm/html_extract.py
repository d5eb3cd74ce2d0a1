"""Main text of web pages by wrapper induction.

All pages of a host are read. Those whose regions bear the same labels are a layout; its different pages count in how many of them each
text stands in one place, and what most hold is a candidate. The trees of candidates are then aligned with those of the pages they
are taken from by simple tree matching, and candidates that most pages hold in aligned places are the template. A page's text is
what stands in its article, or else in its largest content region, less what elements and their names mark as page
furniture, less the template of its host and layout.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Collection, Generator, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import lookup_join, ship, staged

ship(__name__)

#: Different pages that must hold a text in one place for it to be a layout's, and their share of all the layout's different pages.
ENOUGH, SHARE = 6, 0.8
#: If more of a layout's text than this is held by most of its pages, the pages are copies of each other and there is no template.
COPIES = 0.4

# Fixed by HTML: elements without an end, elements that hold raw text, block elements, and what an opening tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul br option select caption legend".split()
)
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body main aside nav header footer form blockquote".split())
#: Page furniture by element and by words in class, id and role.
FURNITURE = frozenset("head nav header footer aside form button select input label dialog menu script style textarea title noscript template iframe svg canvas object noembed noframes search".split())
NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related share sharing sidebar social sponsor sponsored subscribe tags toolbar widget contentinfo complementary dialog alert search respond reactions recommended".split()
)
CONTENT_NAMES = frozenset("content main article post entry story body text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("children", "hidden", "label", "names", "parent", "tag")

    def __init__(self, tag: str, names: str, hidden: bool, parent: Node | None):
        self.tag, self.names, self.hidden, self.parent = tag, frozenset(_WORD.findall(names.lower())), hidden, parent
        self.label = f"{tag}.{names}" if names else tag
        self.children: list[Node | str] = []


def parse(text: str) -> Node:
    """A tree of Nodes and texts, character references decoded. Any input gives a tree."""
    root = node = Node("#", "", False, None)
    at, end = 0, len(text)
    while at < end:
        m = _TOKEN.search(text, at)
        if m is None:
            node.children.append(entities.unescape(text[at:]))
            break
        if m.start() > at:
            node.children.append(entities.unescape(text[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up.parent is not None and up.tag != tag:
                up = up.parent
            if up.parent is not None:
                node = up.parent
            elif tag == "p":
                node.children.append(Node("p", "", False, node))
            continue
        attrs = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTR.finditer(m[3])} if m[3] else {}
        if tag in BLOCK and tag != "br":  # a block ends an open paragraph
            up = node
            while up.parent is not None and up.tag != "p" and (up.tag not in BLOCK):
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in ENDS:
            up = node
            while up.parent is not None and up.tag not in ENDS[tag] and up.tag not in SCOPE:
                up = up.parent
            if up.tag in ENDS[tag]:
                node = up.parent
                while tag == "tr" and node.tag in ENDS["tr"]:
                    node = node.parent
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()
        names = " ".join(x for x in (attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", "")) if x)
        child = Node(tag, names, hidden, node)
        node.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(text, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            node = child
    return root


def furniture(n: Node) -> bool:
    return n.tag in FURNITURE or n.hidden or (n.tag not in ("html", "body", "article", "main") and bool(n.names & NAMES))


def events(root: Node) -> Iterator[tuple[int, str]]:
    """In page order, without furniture: (1, label) of a block that opens, (0, text) of what stands in one, (-1, "") of its end; white space is one space, empty texts go."""
    open_: list[str] = []

    def flush() -> Iterator[tuple[int, str]]:
        if open_ and (text := _SPACE.sub(" ", "".join(open_)).strip()):
            yield 0, text
        open_.clear()

    stack: list[tuple[Node, Iterator]] = [(root, iter(root.children))]
    while stack:
        node, rest = stack[-1]
        for child in rest:
            if isinstance(child, str):
                open_.append(child)
            elif child.tag == "br":
                open_.append("\n")
            elif child.tag not in VOID and not furniture(child):
                if child.tag in BLOCK:
                    yield from flush()
                    yield 1, child.label
                stack.append((child, iter(child.children)))
                break
            elif child.tag in BLOCK:
                yield from flush()
        else:
            stack.pop()
            if node.tag in BLOCK or not stack:
                yield from flush()
            if node.tag in BLOCK and stack:
                yield -1, ""


def _walk(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))


def _outside(n: Node) -> bool:
    while n is not None:
        if furniture(n):
            return True
        n = n.parent
    return False


def regions(root: Node) -> list[Node]:
    """Where the main text stands: articles; or main; or a region named as content; or else the whole page."""
    nodes = list(_walk(root))
    for test in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "main" in n.names and n.tag not in ("html", "body"), lambda n: n.tag in ("div", "section", "td") and n.names & CONTENT_NAMES):
        found = [n for n in nodes if test(n) and not _outside(n)]
        inside = {id(n) for n in found}

        def nested(n: Node, inside: set[int] = inside) -> bool:
            n = n.parent
            while n is not None:
                if id(n) in inside:
                    return True
                n = n.parent
            return False

        if found := [n for n in found if not nested(n)]:
            return found
    return [root]


def digest(*parts: str) -> int:
    """64 bits, signed as a long."""
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


def main_blocks(text: str) -> list[str]:
    return [t for r in regions(parse(text)) for what, t in events(r) if not what]


def read(text: str, host: str) -> tuple[int, list[tuple[int, str, int]]]:
    """The page's layout, and the events of its regions, each text with its key: the same in one place (path of labels) of one layout of a host."""
    found = regions(parse(text))
    layout = digest(host, *sorted({r.label for r in found}))
    out: list[tuple[int, str, int]] = []
    for r in found:
        path = [r.label]
        out.append((1, r.label, 0))
        for what, t in events(r):
            if what > 0:
                path.append(t)
            elif what < 0:
                path.pop()
            out.append((what, t, 0 if what else digest(str(layout), ">".join(path), t)))
        out.append((-1, "", 0))
    return layout, out


def prune(page: list[tuple[int, str, int]], wanted: Collection[int]) -> str:
    """The page's tree of wanted texts alone, as tokens: +label, =key and - for an end; "" if it has none."""
    out: list[str] = []
    for what, t, k in page:
        if what > 0:
            out.append(f"+{digest(t)}")
        elif what == 0:
            if k in wanted:
                out.append(f"={k}")
        elif out[-1][0] == "+":
            out.pop()
        else:
            out.append("-")
    return " ".join(out)


def grow(tokens: str) -> tuple:
    """(label, children) of prune()'s tokens."""
    root: tuple = ("#", [])
    stack = [root]
    for t in tokens.split():
        if t == "-":
            stack.pop()
        else:
            stack[-1][1].append((t, []))
            if t[0] == "+":
                stack.append(stack[-1][1][-1])
    return root


def tree_match(a: tuple, b: tuple) -> tuple[int, list[tuple[tuple, tuple]]]:
    """Simple tree matching: the most nodes that roots, labels and the order of children let match, and those pairs. Trees may be of any depth."""
    stack, value = [_matching(a, b)], None
    while True:
        try:
            inner = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
            if not stack:
                return value
        else:
            stack.append(_matching(*inner))
            value = None


def _matching(a: tuple, b: tuple) -> Generator[tuple[tuple, tuple], tuple | None, tuple[int, list]]:
    """tree_match() of two nodes, which asks for that of their children."""
    if a[0] != b[0]:
        return 0, []
    m, n = len(a[1]), len(b[1])
    best = [[0] * (n + 1) for _ in range(m + 1)]
    inner: dict[tuple[int, int], tuple[int, list]] = {}
    for i in range(m):
        for j in range(n):
            x, y = a[1][i], b[1][j]
            if x[0] != y[0]:
                w = (0, [])
            elif not x[1] or not y[1]:
                w = (1, [(x, y)])
            else:
                w = yield x, y
            inner[i, j] = w
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[0])
    pairs, i, j = [], m, n
    while i and j:
        w = inner[i - 1, j - 1]
        if w[0] and best[i][j] == best[i - 1][j - 1] + w[0]:
            pairs += w[1]
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[m][n], [(a, b), *pairs]


def agreed(a: tuple, b: tuple) -> set[int]:
    """Keys of the texts that two of grow()'s trees hold in aligned places."""
    return {int(x[0][1:]) for x, _ in tree_match(a, b)[1] if x[0][0] == "="}


def _page_keys(page: list[tuple[int, str, int]]) -> tuple[int, int, dict[int, int]]:
    """Mark of all the page's texts (equal ones are copies), their length in all, and the length of each key's."""
    texts = [(k, t) for what, t, k in page if not what]
    return digest(*[str(k) for k, _ in texts]), sum(len(t) for _, t in texts), {k: len(t) for k, t in texts}


def induce(pages: list[str], host: str = "") -> list[int]:
    """The template of one host: keys of texts that most of the different pages of a layout hold in aligned places. As templates(), for pages at hand."""
    layouts: dict[int, dict[int, tuple]] = defaultdict(dict)
    for p in pages:
        layout, page = read(p, host)
        mark, size, keys = _page_keys(page)
        if keys:
            layouts[layout][mark] = (page, size, keys)  # a copy teaches nothing
    out: list[int] = []
    for seen in layouts.values():
        need = max(float(ENOUGH), SHARE * len(seen))
        held = Counter(k for _, _, keys in seen.values() for k in keys)
        sizes = {k: n for _, _, keys in seen.values() for k, n in keys.items()}
        held = Counter({k: c for k, c in held.items() if c >= need})
        if not held or sum(c * sizes[k] for k, c in held.items()) > COPIES * sum(size for _, size, _ in seen.values()):
            continue
        first = {k: min(mark for mark, (_, _, keys) in seen.items() if k in keys) for k in held}
        trees = {mark: grow(prune(page, held)) for mark, (page, _, _) in seen.items()}
        same = Counter(k for f in set(first.values()) for t in trees.values() for k in agreed(trees[f], t) if first[k] == f)
        out += [k for k, c in same.items() if c >= need]
    return sorted(out)


def extract(text: str | None, template: Collection[int] = (), host: str = "") -> str:
    if not text:
        return ""
    if not template:
        return " ".join(main_blocks(text))
    return " ".join(t for what, t, k in read(text, host)[1] if not what and k not in template)


def templates(pages: DataFrame, host_col: str = "__host", html_col: str = "__html") -> DataFrame:
    """__host, __template (array of keys) of hosts that have one, from all their pages. Only keys and trees of candidates move, no page."""
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(host_col).alias("__host"), F.col(html_col).alias("__html"))

    def keys_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 500):
                out = []
                for host, text in zip(batch["__host"].iloc[i : i + 500], batch["__html"].iloc[i : i + 500], strict=True):
                    layout, page = read(text, host)
                    mark, size, keys = _page_keys(page)
                    if keys:
                        out.append((host, layout, mark, size, list(keys), list(keys.values())))
                yield pd.DataFrame(out, columns=["__host", "layout", "mark", "size", "keys", "sizes"])

    seen = rows.mapInPandas(keys_of, "__host string, layout long, mark long, size long, keys array<long>, sizes array<long>")
    seen = staged(seen.dropDuplicates(["layout", "mark"]), "pages-seen")  # a copy teaches nothing
    layouts = seen.groupBy("layout").agg(F.min("__host").alias("__host"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("all")).filter(F.col("n") >= ENOUGH)
    need = F.greatest(F.lit(float(ENOUGH)), F.lit(SHARE) * F.col("n"))
    held = seen.select("layout", "mark", F.explode(F.arrays_zip("keys", "sizes")).alias("k"))
    held = held.groupBy("layout", F.col("k.keys").alias("key")).agg(F.count(F.lit(1)).alias("c"), F.max("k.sizes").alias("size"), F.min("mark").alias("first"))
    held = staged(held.filter(F.col("c") >= ENOUGH).join(layouts, "layout").filter(F.col("c") >= need), "pages-held")
    proper = held.groupBy("layout").agg(F.sum(F.col("c") * F.col("size")).alias("same"), F.max("all").alias("all")).filter(F.col("same") <= COPIES * F.col("all"))
    held = held.join(proper.select("layout"), "layout", "left_semi")
    wanted = staged(held.groupBy("__host").agg(F.collect_set("key").alias("wanted")), "pages-wanted")
    if wanted.isEmpty():
        return wanted.withColumnRenamed("wanted", "__template")

    def trees_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, sets = [], {}
            for host, text, keys in zip(batch["__host"], batch["__html"], batch["wanted"], strict=True):
                if host not in sets:
                    sets[host] = frozenset(keys)
                layout, page = read(text, host)
                if tree := prune(page, sets[host]):
                    out.append((layout, _page_keys(page)[0], tree))
            yield pd.DataFrame(out, columns=["layout", "mark", "tree"])

    trees = lookup_join(rows, wanted, ["__host"], "inner", F.xxhash64("__html")).mapInPandas(trees_of, "layout long, mark long, tree string")
    trees = staged(trees.dropDuplicates(["layout", "mark"]), "pages-trees")
    # each candidate is looked for as it stands in the first page, by mark, that holds it; as most pages do, these are few
    firsts = held.groupBy("layout", F.col("first").alias("mark")).agg(F.collect_set("key").alias("own")).join(trees, ["layout", "mark"])
    firsts = staged(firsts.groupBy("layout").agg(F.collect_list("tree").alias("firsts"), F.collect_list("own").alias("owns")), "pages-firsts")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for layout, tree, pages, firsts, owns in zip(batch["layout"], batch["tree"], batch["pages"], batch["firsts"], batch["owns"], strict=True):
                own = grow(tree)
                out += [(layout, k, pages) for f, keys in zip(firsts, owns, strict=True) for k in agreed(grow(f), own) & set(keys)]
            yield pd.DataFrame(out, columns=["layout", "key", "pages"])

    shapes = trees.groupBy("layout", "tree").agg(F.count(F.lit(1)).alias("pages"))  # pages with the same candidates align alike
    same = lookup_join(shapes, firsts, ["layout"], "inner", F.xxhash64("tree")).mapInPandas(align, "layout long, key long, pages long").groupBy("layout", "key").agg(F.sum("pages").alias("aligned"))
    return same.join(held, ["layout", "key"]).filter(F.col("aligned") >= need).groupBy("__host").agg(F.collect_set("key").alias("__template"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars. Null or empty html, and pages without main text, give "".

    Pages without a host in their url have no template. Repeated rows give equal results; an empty table gives none.
    """
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(url_col).alias("__url"), F.coalesce(host, F.lit("")).alias("__host"), F.col(html_col).alias("__html"))
    known = staged(templates(own.filter("__host <> ''")), "templates")  # counted, then joined
    joined = lookup_join(own, known, ["__host"], "left", F.col("__id")).select("__id", "__url", "__host", "__html", "__template")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[str, frozenset[int]] = {}
            for i in range(0, len(batch), 500):
                part = batch.iloc[i : i + 500]
                for host, t in zip(part["__host"], part["__template"], strict=True):
                    if host not in sets:
                        sets[host] = frozenset() if t is None else frozenset(t)
                texts = [extract(h, sets[host], host) for h, host in zip(part["__html"], part["__host"], strict=True)]
                yield pd.DataFrame({"__id": part["__id"], "__url": part["__url"], "text": texts, "n_chars": [len(t) for t in texts]})

    out = joined.mapInPandas(run, "__id long, __url string, text string, n_chars long")
    return out.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), "text", "n_chars")
