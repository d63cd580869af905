"""Main texts of web pages: template subtrees counted per site, and what is left of the article.

A page is parsed into a tree of blocks. Every block subtree is hashed (tag, text, children), and Spark
counts, per host, on how many different pages each hash occurs. A subtree on many of them is the
site's template and is deleted, together with parts that say what they are: menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments. If a page marks its article or main
part, only that is taken; inside it a paragraph, heading or quotation is never seen as template, as
articles quote each other. A part that says what it is only goes if it holds no article, or if the
page has an article elsewhere.

Many pages are a share of the host's, and three at least, so a layout that only some sections of a
host have counts as well. A subtree on a small share, or of a small host, might also be what copies of
one page have in common: such subtrees only go from pages of which at least half of the text is left.

Texts: character references are decoded, white space inside a block becomes one space, blocks are
joined by an empty line in page order. Pages with the same content count once.

Defined results: null is an empty page; a page without text gives an empty one; a page without host
shares the host ''; whole pages are parsed, however long; repeated rows are extracted one by one, also
those without id; no pages give no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.store import stored
from clicktally.llm.words import slices

#: A subtree is template if it is on so many different pages of its host, and on this share of them.
LEAST_PAGES = 10
LEAST_SHARE = 0.3
#: Or on so many and this share, if at least half of a page's text is left without all of these.
FEW_PAGES = 3
FEW_SHARE = 0.05
#: Pages of one host that meet its templates in one task.
HOST_PAGES = 5_000

_SKIPPED = frozenset("script style noscript template title iframe object svg canvas math select button textarea".split())
_BOILERPLATE = frozenset("nav header footer aside form menu dialog".split()) | _SKIPPED
_BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt li td th".split())
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
#: A class or id that says what its block is, as a whole: places may come before and parts after it.
_MARKED = re.compile(
    r"(?:(?:site|page|main|global|top|bottom|left|right|post|article|entry|blog|wp|js|primary|secondary|sticky|mobile)[-_]?)*"
    r"(?:ads?|adverts?|advertisements?|advertising|adbox|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav(?:igation|bar|s)?|menus?|breadcrumbs?|"
    r"sidebars?|footers?|headers?|cookies?|consent|notices?|popups?|modals?|newsletters?|subscribe|subscription|signup|login|"
    r"shar(?:e|es|ing)|social|related|recommend(?:ed|ations?)|comments?|disqus|respond|replies|reply|pagination|pager|toolbars?|widgets?)"
    r"(?:[-_]?(?:bar|box|wrap|wrapper|container|inner|outer|area|section|block|list|items?|links?|buttons?|btns?|icons?|form|menu|nav|panel|"
    r"widgets?|posts?|articles?|stories|content|consent|notice|banner|slot|unit|overlay|dialog|thread|reply|top|bottom|left|right|main|id|[0-9]+))*",
    re.IGNORECASE,
)
#: A new block of the key ends an open one of the values.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)>|<[!?/][^>]*>""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
#: Elements whose content is no markup.
_RAW = {tag: re.compile(f"</{tag}[^>]*>", re.IGNORECASE) for tag in ("script", "style", "textarea", "title", "iframe")}


@dataclass
class Node:
    tag: str
    boilerplate: bool
    main: bool
    items: list[str | Node] = field(default_factory=list)  # texts and blocks in page order
    mark: int = 0


class _Page:
    """The blocks of a page; elements that are no blocks leave only their text."""

    def __init__(self, html: str) -> None:
        self.root = Node("html", False, False)
        self.open = [self.root]
        self.text: list[str] = []
        self.skipping: list[str] = []
        at = 0
        while (tag := _TAG.search(html, at)) is not None:
            self._data(html[at : tag.start()])
            at = tag.end()
            if (name := tag[2]) is None:  # a comment or a declaration
                continue
            name = name.lower()
            if tag[1]:
                self._end(name)
                continue
            self._start(name, tag[3])
            if name in _RAW:
                end = _RAW[name].search(html, at)
                self.skipping and self.skipping.pop()
                at = end.end() if end else len(html)
        self._data(html[at:])
        self._flush()

    def _data(self, text: str) -> None:
        if text and not self.skipping:
            self.text.append(text)

    def _flush(self) -> None:
        if self.text:
            text = " ".join(unescape("".join(self.text)).split())
            self.text.clear()
            if text:
                self.open[-1].items.append(text)

    def _close(self, place: int) -> None:
        self._flush()
        del self.open[place:]

    def _start(self, tag: str, attributes: str) -> None:
        if self.skipping and tag in _MAIN:  # what was left open before ends here
            self.skipping.clear()
        if self.skipping:
            if tag == self.skipping[-1] or tag in _RAW:
                self.skipping.append(tag)
            return
        if tag in _SKIPPED:
            self.skipping.append(tag)
            return
        if tag == "br":
            self.text.append(" ")
        if tag not in _BLOCKS:
            return
        self._flush()
        ends = _ENDS.get(tag, ())
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place].tag
            if name == "p" or name in ends:
                self._close(place)
                break
            if name not in _PARAGRAPHS:
                break
        if tag == "hr":
            return
        given = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
        said = f"{given.get('class', '')} {given.get('id', '')}".split()
        role = given.get("role", "").lower()
        main = tag in _MAIN or role in ("main", "article")
        boilerplate = tag in _BOILERPLATE or role in _ROLES or "hidden" in given or given.get("aria-hidden") == "true"
        if said and not main and tag != "body" and any(_MARKED.fullmatch(word) for word in said):
            boilerplate = True
        node = Node(tag, boilerplate, main)
        self.open[-1].items.append(node)
        self.open.append(node)

    def _end(self, tag: str) -> None:
        if self.skipping:
            if tag == self.skipping[-1]:
                self.skipping.pop()
            return
        if tag not in _BLOCKS:
            return
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag == tag:
                self._close(place)
                return
            if self.open[place].main and tag in _PARAGRAPHS:
                return


def _hash(node: Node) -> None:
    """Marks of a subtree, from the leaves up, without recursion."""
    todo, order = [node], []
    while todo:
        order.append(top := todo.pop())
        todo += (x for x in top.items if isinstance(x, Node))
    for one in reversed(order):
        said = "\0".join([one.tag, *(str(x.mark) if isinstance(x, Node) else x for x in one.items)])
        digest = hashlib.blake2b(said.encode("utf-8", "replace"), digest_size=8).digest()
        one.mark = int.from_bytes(digest, "big", signed=True)


def _spare(root: Node) -> None:
    """If all articles of a page lie in blocks that say they are something else, these are not."""
    todo: list[tuple[Node, list[Node]]] = [(root, [])]
    spared: list[list[Node]] = []
    while todo:
        node, above = todo.pop()
        above = [*above, node] if node.boilerplate else above
        if node.main:
            if not above:
                return
            spared.append(above)
            continue
        todo += ((x, above) for x in node.items if isinstance(x, Node))
    for above in spared:
        for node in above:
            node.boilerplate = False


def parse(html: str) -> Node:
    root = _Page(html).root
    _spare(root)
    _hash(root)
    return root


def _walk(root: Node) -> Iterator[tuple[Node | str, bool]]:
    """Blocks that are no boilerplate and their texts, in page order, with whether the main part holds them."""
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        item, inside = todo.pop()
        if isinstance(item, Node):
            if item.boilerplate:
                continue
            yield item, inside
            todo += ((x, inside or item.main) for x in reversed(item.items))
        else:
            yield item, inside


def _candidates(root: Node) -> set[int]:
    """Marks of the subtrees that may be template."""
    return {
        x.mark
        for x, inside in _walk(root)
        if isinstance(x, Node) and x is not root and not x.main and x.tag not in ("html", "body") and not (inside and x.tag in _PARAGRAPHS)
    }


def _blocks(root: Node, template: frozenset[int] | set[int]) -> list[str]:
    """The blocks of the main part (of the whole page, if none is marked) that are no template."""
    every, marked = [], []
    has_main = False
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        item, inside = todo.pop()
        if isinstance(item, str):
            (marked if inside else every).append(item)
            continue
        if item.boilerplate or (item.mark in template and not item.main and not (inside and item.tag in _PARAGRAPHS)):
            continue
        has_main |= item.main
        todo += ((x, inside or item.main) for x in reversed(item.items))
    return marked if has_main else every


def main_text(root: Node, template: frozenset[int] | set[int], likely: frozenset[int] | set[int] = frozenset()) -> str:
    """The main part without its template, and without what is ``likely`` one if half of the text is left."""
    blocks = _blocks(root, template)
    if likely:
        rest = _blocks(root, template | likely)
        if 2 * sum(map(len, rest)) >= sum(map(len, blocks)):
            blocks = rest
    return "\n\n".join(blocks)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        hosts, pages, marks = [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            root = parse(html or "")
            for mark in {0, *_candidates(root)}:  # 0 stands for the page
                hosts.append(host)
                pages.append(root.mark)
                marks.append(mark)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(marks, pa.int64())], ["host", "page", "mark"])


def templates(
    pages: DataFrame,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    few_pages: int = FEW_PAGES,
    few_share: float = FEW_SHARE,
) -> DataFrame:
    """Per ``host`` its number of different ``pages``, the marks of its ``template`` subtrees and those that
    are ``likely`` some: of subtrees on a share of all pages there can only be few."""
    marks = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(_subtrees, "host string, page bigint, mark bigint")
    counts = marks.distinct().groupBy("host", "mark").agg(F.count("*").alias("pages"))
    counts = stored(counts.where((F.col("pages") >= few_pages) | (F.col("mark") == 0)), "subtrees")
    whole = counts.where("mark = 0").select("host", F.col("pages").alias("of"))
    sure = (F.col("pages") >= least_pages) & (F.col("pages") >= F.lit(least_share) * F.col("of"))
    common = counts.where("mark <> 0").join(whole, "host").where(F.col("pages") >= F.lit(few_share) * F.col("of"))
    return common.groupBy("host").agg(
        F.first("of").alias("pages"),
        F.collect_list(F.when(sure, F.col("mark"))).alias("template"),
        F.collect_list(F.when(~sure, F.col("mark"))).alias("likely"),
    )


def _extract() -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            columns = (batch.column(c).to_pylist() for c in ("html", "template", "likely"))
            texts = [main_text(parse(html or ""), set(sure or ()), set(likely or ())) for html, sure, likely in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return extract


def extract(pages: DataFrame, **least: float) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its ``n_chars`` of every page.

    The templates are stored first, so that Spark sends them to the pages if they are small. Otherwise
    both move by host, and the pages of a large host are spread over a salt for each ``HOST_PAGES``.
    """
    pages = pages.select(F.col("page_id").cast("bigint"), "url", "html", _host(F.col("url")).alias("host"))
    found = stored(templates(pages, **least), "templates")
    salts = F.ceil(F.col("pages") / HOST_PAGES)
    large = stored(found.where(F.col("pages") > HOST_PAGES).select("host", salts.alias("salts")), "hosts")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1)))
    spread = pages.join(large, "host", "left").withColumn("salt", salt).drop("salts")
    sent = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("pages")
    joined = spread.join(sent, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "template", "likely").mapInArrow(
        _extract(), "page_id bigint, url string, text string, n_chars bigint"
    )
