"""Main text of web pages: site templates are counted per host and cut out."""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import materialize

MIN_PAGES = 5
MIN_SHARE = 0.3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
NOT_TEXT = frozenset(
    "script style textarea title noscript iframe template xmp noembed noframes head nav header footer aside form "
    "button select option menu dialog svg math canvas audio video object input label fieldset".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Blocks that are text of an article and are not taken for its site's template there.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr tbody thead tfoot caption figcaption".split())
MAIN = frozenset("article main".split())
#: An open element of the first kind ends where one of the second begins.
ENDED_BY = {
    "p": BLOCK - frozenset("body head html caption tbody td tfoot th thead tr option".split()),
    "li": frozenset(["li"]),
    "dt": frozenset("dt dd".split()),
    "dd": frozenset("dt dd".split()),
    "option": frozenset(["option"]),
    "tr": frozenset("tr tbody tfoot".split()),
    "td": frozenset("td th tr tbody tfoot".split()),
    "th": frozenset("td th tr tbody tfoot".split()),
    "head": frozenset(["body"]),
}
SCOPE = frozenset("ul ol table div article section main aside nav td th body html dl".split())
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?"
    r"|footer|header|masthead|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login"
    r"|social|share|sharing|related|recommend\w*|comments?|disqus|repl(?:y|ies)|respond|widget|copyright|search)(?:$|[\s_-])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")


class _Element:
    """An open element: its kept text so far, and the hash of all that stands in it."""

    __slots__ = ("hash", "inside", "name", "parts", "removed", "main")

    def __init__(self, name: str, removed: bool, inside: bool):
        self.name, self.removed, self.inside = name, removed, inside
        self.parts: list = []
        self.hash = xxhash.xxh64()
        self.main = False


def _removed(name: str, attributes: str) -> bool:
    if name in NOT_TEXT:
        return True
    if not attributes.strip(" /") or name in ("html", "body"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id") and BOILERPLATE.search(value):
            return name not in MAIN
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
    return False


def _flat(parts: list, into: list[str]) -> None:
    todo = [iter(parts)]
    while todo:
        for part in todo[-1]:
            if isinstance(part, str):
                into.append(part)
            else:
                todo.append(iter(part))
                break
        else:
            todo.pop()


class Page:
    """One pass over a page's markup: its main text, and hashes of its element subtrees.

    ``templates`` are hashes of subtrees to leave out. Subtrees count where a template may stand:
    blocks outside the article, and in an article those that are not prose.
    """

    def __init__(self, html: str, templates: frozenset[int] = frozenset()):
        self.templates, self.hashes = templates, set()
        self.stack = [_Element("", False, False)]
        self.mains: list = []
        self._read(html)
        while len(self.stack) > 1:
            self._close()
        chosen: list[str] = []
        _flat(self.mains or self.stack[0].parts, chosen)
        blocks = "".join(chosen).split("\0")
        self.text = " ".join(" ".join(block.split()) for block in blocks if block and not block.isspace())

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            mark = html.find("<", at)
            if mark < 0:
                mark = size
            if mark > at:
                self._text(html[at:mark])
            if mark == size:
                return
            if html.startswith("<!--", mark):
                end = html.find("-->", mark + 4)
                at = size if end < 0 else end + 3
            elif html.startswith(("<!", "<?"), mark):
                end = html.find(">", mark)
                at = size if end < 0 else end + 1
            elif tag := TAG.match(html, mark):
                at = tag.end()
                close, name, attributes = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
                name = name.lower()
                if close:
                    self._end(name)
                else:
                    self._start(name, attributes)
                    if name in RAW:
                        end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                        at = end.start() if end else size
            else:
                self._text("<")
                at = mark + 1

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        top.hash.update(raw.strip().encode("utf-8", "surrogatepass"))
        if not top.removed:
            top.parts.append(unescape(raw).replace("\0", " ") if "&" in raw else raw.replace("\0", " "))

    def _start(self, name: str, attributes: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            open_name = self.stack[depth].name
            if name in ENDED_BY.get(open_name, ()):
                while len(self.stack) > depth:
                    self._close()
                break
            if open_name in SCOPE:
                break
        top = self.stack[-1]
        if name in VOID:
            top.hash.update(name.encode())
            if not top.removed:
                top.parts.append(" " if name in ("br", "wbr") else "\0" if name == "hr" else "")
            return
        removed = top.removed or _removed(name, attributes)
        element = _Element(name, removed, top.inside or name in MAIN)
        element.main = name in MAIN and not removed and not top.inside
        element.hash.update(f"{name} {attributes.strip()}".encode("utf-8", "surrogatepass"))
        self.stack.append(element)

    def _end(self, name: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name == name:
                while len(self.stack) > depth:
                    self._close()
                return
            if name not in SCOPE and self.stack[depth].name in SCOPE:
                return

    def _close(self) -> None:
        element = self.stack.pop()
        parent, value = self.stack[-1], element.hash.intdigest()
        parent.hash.update(element.hash.digest())
        block = element.name in BLOCK
        if element.removed and parent.removed:
            return
        if block and element.name not in ("html", "body", "article", "main") and not (element.inside and element.name in PROSE):
            signed = value - (1 << 64) if value >> 63 else value
            self.hashes.add(signed)
            if signed in self.templates:
                return
        if element.removed:
            return
        parts = ["\0", element.parts, "\0"] if block else element.parts
        if element.main:
            self.mains.append(parts)
        parent.parts.append(parts)


def main_text(html: str, templates: frozenset[int] = frozenset()) -> str:
    return Page(html, templates).text


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def site_templates(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """``host, templates``: hashes of the subtrees on at least ``min_pages`` and ``min_share`` of a host's pages.

    By that share a host has at most 1 / ``min_share`` times as many as an average page of it.
    """

    @F.pandas_udf("array<bigint>")
    def hashes(html: pd.Series) -> pd.Series:
        return html.map(lambda h: sorted(Page(h).hashes))

    found = pages.select(host(F.col(url_col)).alias("host"), hashes(F.coalesce(html_col, F.lit(""))).alias("hashes"))
    # null stands for the page itself, so one aggregation counts pages and subtrees
    counted = found.select("host", F.explode(F.concat("hashes", F.array(F.lit(None).cast("bigint")))).alias("hash"))
    counted = counted.groupBy("host", "hash").agg(F.count("*").alias("n"))
    counted = materialize(counted.filter(f"n >= {min_pages}"), "subtrees")
    total = counted.filter("hash is null").select("host", F.col("n").alias("pages"))
    many = counted.filter("hash is not null").join(total, "host").filter(F.col("n") >= min_share * F.col("pages"))
    return many.groupBy("host").agg(F.collect_set("hash").alias("templates"))


def extracted(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The text is that of the article or main elements, or of the whole body where a page has none,
    without elements that hold no prose by their name, class, id or role, and without the site's
    templates: subtrees that recur on many pages of the host, found by a hash of their markup. In an
    article, paragraphs and headings that recur stay. Character references are decoded, white space
    inside a block becomes one space, and blocks are joined by one space.

    A null or empty page has an empty text; broken markup is read as far as it goes; a null url
    belongs to the host without a name. Repeated rows and null ids are kept; other columns are
    ignored; an empty table gives no rows.
    """

    @F.pandas_udf("string")
    def text(html: pd.Series, templates: pd.Series) -> pd.Series:
        return pd.Series(
            [main_text(h, frozenset() if t is None else frozenset(t)) for h, t in zip(html, templates, strict=True)], dtype=object
        )

    templates = materialize(site_templates(pages, url_col, html_col).withColumnRenamed("host", "page_host"), "templates")
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html")
    )
    joined = rows.withColumn("page_host", host(F.col("url"))).join(templates, "page_host", "left")
    found = joined.select("page_id", "url", text("html", "templates").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
