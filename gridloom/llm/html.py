"""HTML extraction: subtrees that recur across a host's pages are its template; what the article holds stays."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, spread_join, stored, table

#: A subtree is template if it stands on so many pages of different content of its host and on such a share of them.
TEMPLATE_PAGES = 5
TEMPLATE_SHARE = 0.3

# Fixed values of HTML: elements without content, elements whose content is no markup, elements that begin a block (all
# others, known or not, stand within a line), and elements that end an open one of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
ALONE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What is no article: elements that go with all they hold and end no block, elements that begin one, roles.
LEFT_OUT = frozenset("script style noscript template iframe svg canvas object audio video math datalist select button textarea title xmp noembed noframes".split())
NO_ARTICLE = frozenset("head nav footer aside dialog menu".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Words that name what is no article: for sure, if it holds no more than half of the text, and within a line.
SURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion cookie cookies consent gdpr "
    "comment comments disqus reply replies related recommended".split()
)
DOUBTFUL_WORDS = frozenset(
    "banner notice notices notification sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar header share sharing "
    "social subscribe subscription newsletter signup login popup modal overlay widget toolbar pagination pager hidden copyright skip".split()
)
INLINE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle sponsored promo share sharing skip".split())
# Of these, those by which an article or main element is none.
NOT_THE_ARTICLE = frozenset("comment comments disqus reply replies related recommended sponsored promo promotion ad ads advert".split())
# Words behind the one that says what a thing is: an ad-box is an ad, a header-link no header, a social-policy not social.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box button buttons cell column container content cta desktop form global group holder icons inner item items "
    "left links list main mobile outer panel post posts articles primary region right row secondary section slot this to top trail unit "
    "wrap wrapper".split()
)

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Node:
    """An element that can hold blocks; ``items`` are its nodes and the texts of its blocks, in page order."""

    __slots__ = ("tag", "label", "up", "items", "out", "main", "digest", "size")

    def __init__(self, tag: str, label: str, up: Node | None, out: int, main: bool):
        self.tag, self.label, self.up, self.out, self.main = tag, label, up, out, main
        self.items: list[Node | str] = []
        self.digest = self.size = 0


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text else {}


def named(label: str) -> set[str]:
    """What the names of a class or id call the element: of each name its last word that is no plain one."""
    found = set()
    for name in label.split():
        words = [x.lower() for x in NAME_PART.findall(name) if len(x) > 1 and not x.isdigit()]
        while len(words) > 1 and words[-1] in PLAIN_WORDS:
            words.pop()
        found.update(words[-1:])
    return found


def judged(tag: str, attrs: dict[str, str]) -> tuple[str, int, bool]:
    """(label, whether it is no article, whether it is a main part) of an element. No article: 2 for sure, 1 unless it
    holds most of the text, 0 not. Within a line words only tell adverts, share buttons and skip links."""
    role = attrs.get("role", "").lower()
    label = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip()
    words = named(label) if label else set()
    main = tag in ("article", "main") or role in ("main", "article") or "articlebody" in attrs.get("itemprop", "").lower()
    hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I)
    )
    if tag in NO_ARTICLE or role in NO_ARTICLE_ROLES or hidden:
        return label, 2, main
    if tag not in BLOCKS:
        return label, 2 if words & INLINE_WORDS else 0, main
    if main:
        return label, 2 if words & NOT_THE_ARTICLE else 0, main
    if tag in ("html", "body"):
        return label, 0, main
    if tag == "form":  # some sites put a whole page into one
        return label, 2 if words & SURE_WORDS else 1, main
    return label, 2 if words & SURE_WORDS else 1 if words & DOUBTFUL_WORDS else 0, main


def ends_of(text: str, tag: str) -> dict[int, int]:
    """Where each element ``tag`` that begins somewhere ends; one that is never closed has no entry."""
    ends: dict[int, int] = {}
    opened: list[int] = []
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", text, re.I):
        if m[1]:
            if opened:
                ends[opened.pop()] = m.end()
        elif not (tag in ("svg", "math") and m[0].endswith("/>")):
            opened.append(m.start())
    return ends


def parse(text: str) -> Node:
    """The page's tree of elements and blocks.

    As browsers do: a block ends an open paragraph, list and table parts end their like, an end tag without a start is
    passed over, one with a start ends all that is open above it. What stands within a line ends no block: of it only
    what is no article matters. Scripts, buttons, drawings and the like go with what they hold, and the line goes on.
    """
    root = Node("#page", "", None, 0, False)
    at, here, run, skip_inline = 0, root, [], []
    ends: dict[str, dict[int, int]] = {}
    above: Counter[str] = Counter()  # open elements by tag, so that no end tag looks for a start that is not there

    def flush() -> None:
        if run:
            block = " ".join("".join(run).split())
            run.clear()
            if block:
                here.items.append(block)

    def close_to(node: Node) -> None:
        nonlocal here
        flush()
        while here is not node:
            above[here.tag] -= 1
            here = here.up
        above[node.tag] -= 1
        here = node.up

    for m in MARKUP.finditer(text):
        if m.start() < at:
            continue
        if m.start() > at and not skip_inline:
            piece = text[at : m.start()]
            run.append(references.unescape(piece) if "&" in piece else piece)
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if tag in LEFT_OUT:
            if m[1]:
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(text, at)
                at = end.end() if end else len(text)
                continue
            if tag not in ends:
                ends[tag] = ends_of(text, tag)
            at = max(at, ends[tag].get(m.start(), at))
            continue
        if m[1]:
            if tag not in BLOCKS:
                if skip_inline and skip_inline[-1] == tag:
                    skip_inline.pop()
                continue
            skip_inline.clear()
            if above[tag]:
                node = here
                while node.tag != tag:
                    node = node.up
                close_to(node)
            else:
                flush()
            continue
        if tag not in BLOCKS:
            if tag in VOID:
                run.append(" " if tag == "br" else "")
            elif skip_inline:
                skip_inline += [tag] * (skip_inline[-1] == tag)
            elif m[3] and judged(tag, attributes(m[3]))[1]:
                skip_inline.append(tag)
            continue
        skip_inline.clear()
        flush()
        if here.tag == "p" or here.tag in HEADINGS and tag in HEADINGS:
            close_to(here)
        for like in ALONE.get(tag, ()):
            if not above[like]:
                continue
            node = here
            while node.up is not None and node.tag != like and node.tag not in ("ul", "ol", "dl", "table", "menu", "article", "main"):
                node = node.up
            if node.tag == like:
                close_to(node)
        if tag in VOID:
            continue
        label, out, main = judged(tag, attributes(m[3]))
        node = Node(tag, label, here, max(out, 1) if tag == "header" else out, main)
        here.items.append(node)
        here = node
        above[tag] += 1
    if at < len(text) and not skip_inline:
        run.append(references.unescape(text[at:]))
    flush()
    return root


def nodes(node: Node) -> Iterator[Node]:
    """All nodes, those below before those above; without recursion, as pages may nest deeply."""
    order, todo = [], [node]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [y for y in x.items if isinstance(y, Node)]
    return reversed(order)


def hashed(root: Node) -> int:
    """Put its hash on every subtree (element, label and all below); returns the hash of the page's text outside what is
    surely no article, by which copies of a page are known as one content."""
    for x in nodes(root):
        h = xxhash.xxh64(f"{x.tag}\0{x.label}")
        x.size = 0
        for y in x.items:
            if isinstance(y, Node):
                h.update(y.digest.to_bytes(8, "little"))
                x.size += y.size
            else:
                h.update(b"\1")
                x.size += len(y)
                h.update(y.encode("utf-8", "surrogatepass"))
        x.digest = h.intdigest()
    whole = xxhash.xxh64()
    todo: list[Node | str] = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            whole.update(x.encode("utf-8", "surrogatepass") + b"\n")
        elif x.out < 2:
            todo += reversed(x.items)
    return whole.intdigest()


def is_article(x: Node) -> bool:
    return x.tag == "article" or x.main and x.tag != "main" and "main" not in x.label.lower()


def goes(x: Node, template: set[int], half: float, whole: bool, in_article: bool) -> bool:
    """Whether ``x`` is template or no article. What only has a layout's name stays if it holds most of the text, and an
    article's own header if it has a heading. Blocks within an article are no template."""
    headed = x.tag == "header" and not whole and any(isinstance(y, Node) and y.tag in HEADINGS for y in x.items)
    return x.out == 2 or x.out == 1 and x.size <= half and not headed or x.digest in template and not (in_article and x.tag in LEAVES)


def main_parts(root: Node, template: set[int] = frozenset()) -> list[Node]:
    """The outermost main parts and articles that are not within a part that is no article, and the page's headings of
    the first order before them, if they hold most of the text that is left without template and without what is no
    article; else the page. Main parts that are template themselves count only if there are no others."""
    for skipped in (template, frozenset()) if template else (template,):
        found, headings, todo = [], [], [(root, False)]
        while todo:
            x, doubtful = todo.pop()
            if x.out == 2:
                continue
            if x.main and x.digest not in skipped:
                found.append(x)
            elif x.tag == "h1" and not found and not doubtful and x.digest not in template:
                headings.append(x)
            else:
                todo += [(y, doubtful or y.out > 0) for y in reversed(x.items) if isinstance(y, Node)]
        if found:
            inside, all_left = text_left(root, found, template)
            return headings + found if 2 * inside > all_left or inside == all_left else [root]
    return [root]


def text_left(root: Node, parts: list[Node], template: set[int]) -> tuple[int, int]:
    """How much text is left in ``parts``, and in all, without template and without what is no article."""
    own, half = {id(x) for x in parts}, root.size / 2
    inside = everywhere = 0
    todo: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
    while todo:
        x, within, in_article = todo.pop()
        if isinstance(x, str):
            everywhere += len(x)
            inside += len(x) if within else 0
            continue
        if id(x) in own:
            within = True
            in_article = is_article(x) or not has_article(x)
        elif within and not in_article and x.out < 2 and is_article(x):
            in_article = True
        elif x.up is not None and goes(x, template, half, not within, in_article):
            continue
        todo += [(y, within, in_article) for y in x.items]
    return inside, everywhere


def has_article(part: Node) -> bool:
    todo = [y for y in part.items if isinstance(y, Node)]
    while todo:
        x = todo.pop()
        if x.out < 2:
            if is_article(x):
                return True
            todo += [y for y in x.items if isinstance(y, Node)]
    return False


def candidates(root: Node, parts: list[Node]) -> list[int]:
    """Hashes of the subtrees that may be template: inside an article its containers, elsewhere blocks too."""
    whole = parts == [root]
    found, todo = [], [(root, whole)]
    article = {id(x) for x in parts}
    while todo:
        x, in_article = todo.pop()
        own = in_article or id(x) in article
        if x.up is not None and x.tag not in ("html", "body", "head") and id(x) not in article and (whole or not own or x.tag not in LEAVES):
            found.append(x.digest)
        todo += [(y, own) for y in x.items if isinstance(y, Node)]
    return found


def article_text(parts: list[Node], template: set[int], whole: bool) -> str:
    """The blocks of ``parts`` in page order without template and without what is no article."""
    out: list[str] = []
    half = sum(x.size for x in parts) / 2
    own = {id(x) for x in parts}
    todo: list[tuple[Node | str, bool]] = [(x, False) for x in reversed(parts)]
    while todo:
        x, in_article = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if id(x) in own:
            in_article = not whole and (is_article(x) or not has_article(x))
        elif not whole and not in_article and x.out < 2 and is_article(x):
            in_article = True
        elif goes(x, template, half, whole, in_article):
            continue
        todo += [(y, in_article) for y in reversed(x.items)]
    return "\n".join(out)


def host_templates(pages: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """(host, template): the hashes of subtrees that stand on many pages of a host. One row a host.

    Pages of the same text (outside what is surely no article) count as one, so an article that a host serves a thousand
    times is no template. All subtrees are counted; whether a page's blocks within an article are kept is said when
    its template is known.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, ["html"]):
                hosts, contents, found = [], [], []
                for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                    root = parse(text or "")
                    content = hashed(root)
                    own = {x - (1 << 64) if x >= 1 << 63 else x for x in candidates(root, [root])} | {0}  # 0 counts contents
                    hosts += [host] * len(own)
                    contents += [content - (1 << 64) if content >= 1 << 63 else content] * len(own)
                    found += own
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(found, pa.int64())], ["host", "content", "subtree"])

    seen = pages.select("host", "html").mapInArrow(emit, "host string, content long, subtree long")
    counts = seen.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    counts = stored(counts.where((F.col("n") >= least_pages) | (F.col("subtree") == 0)), "html-counts")
    contents = counts.where("subtree = 0").select("host", F.col("n").alias("contents"))
    # The share goes first, so that a host's list has at most (subtrees of a page) / least_share hashes, however many pages
    # it has. What is counted on a host before that grows with its pages, so it is dealt by subtree over many tasks.
    counted = counts.where(f"subtree <> 0 and n >= {int(least_pages)}")
    often = spread_join(counted, contents, "host", by="subtree").where(F.col("n") >= F.col("contents") * least_share)
    return often.groupBy("host").agg(F.collect_list("subtree").alias("template")).withColumnRenamed("host", "of")


def extract_articles(
    pages: DataFrame, least_pages: int = TEMPLATE_PAGES, least_share: float = TEMPLATE_SHARE
) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Pass one hashes every page's element subtrees and counts, per host, on how many pages of different content each
    stands; pass two parses again and leaves out a host's recurring subtrees, then what elements, roles or names mark
    as no article. Paragraphs inside an article stay though other pages repeat them. Articles and main parts narrow the
    page only if they hold most of what is then left. Copies of a page that differ in a block which nothing marks as no
    article are different pages. A null or empty page gives an
    empty text; a null or odd url is a host of its own (""); repeated rows give repeated rows; other columns are not
    read. Blocks are joined by a line feed, white space in a block is one space.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))
    by_host = pages.select("page_id", "url", "html", host.alias("host"))
    templates = stored(host_templates(by_host, least_pages, least_share), "html-templates")
    # The table has a row a host and is small or not: Catalyst broadcasts it by its real size or sorts and splits.
    with_template = by_host.join(templates, by_host["host"] == templates["of"], "left").select("page_id", "url", "html", "template")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, ["html"]):
                texts = []
                for text, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True):
                    root = parse(text or "")
                    hashed(root)
                    known = {x % (1 << 64) for x in template or ()}
                    parts = main_parts(root, known)
                    texts.append(article_text(parts, known, parts == [root]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return with_template.mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(table(spark, sf_dir, "pages"))
