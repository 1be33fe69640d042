"""Pages: charset detection and extraction, in Arrow UDFs; hashes and dates are column expressions."""

from __future__ import annotations

import codecs
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dates
from . import vocab as V
from .urls import join_url, prepare

# Labels that pages use for charsets, by the codec that reads them.
LABELS = {
    "utf-8": ("utf-8", "utf8", "unicode-1-1-utf-8"),
    "cp932": ("shift_jis", "shift-jis", "sjis", "ms_kanji", "windows-31j", "x-sjis", "csshiftjis", "ms932"),
    "euc_jp": ("euc-jp", "x-euc-jp", "cseucpkdfmtjapanese"),
    "iso2022_jp": ("iso-2022-jp", "csiso2022jp"),
    "cp1252": ("windows-1252", "iso-8859-1", "latin1", "ascii", "us-ascii", "cp1252", "l1"),
    "utf-16-le": ("utf-16", "utf-16le"),
    "utf-16-be": ("utf-16be",),
    "gb18030": ("gbk", "gb2312", "gb18030"),
    "big5": ("big5", "big5-hkscs"),
    "euc_kr": ("euc-kr", "ks_c_5601-1987"),
}
NAMES = {"utf-8": "UTF-8", "cp932": "Shift_JIS", "euc_jp": "EUC-JP", "iso2022_jp": "ISO-2022-JP", "cp1252": "windows-1252", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE", "gb18030": "gb18030", "big5": "Big5", "euc_kr": "EUC-KR"}
_CODEC = {label: codec for codec, labels in LABELS.items() for label in labels}
_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
_META = re.compile(rb"<meta[^>]*?charset\s*=\s*[\"']?([^\"';/>\s]+)", re.I)
_ASCII_SPACE = " \t\n\x0c\r"


def decode(content_type: str | None, body: bytes) -> dict:
    """Text of a page by its mark, its header, its meta element, or as UTF-8, and whether bytes were replaced."""
    source, codec = "default", "utf-8"
    mark = next((c for b, c in _BOMS if body.startswith(b)), None)
    named = next((v for k, _, v in (p.partition("=") for p in (content_type or "").split(";")[1:]) if k.strip().lower() == "charset"), None)
    header = _CODEC.get(named.strip().strip("\"'").strip().lower()) if named else None
    if mark:
        source, codec = "bom", mark
    elif header:
        source, codec = "header", header
    elif (m := _META.search(body[:1024])) and (c := _CODEC.get(m[1].decode("ascii", "replace").lower())):
        source, codec = "meta", "utf-8" if c.startswith("utf-16") else c
    for b, c in _BOMS:
        if body.startswith(b) and c == codec:
            body = body[len(b) :]
    text = body.decode(codec, "replace")
    return {"text": text, "charset": NAMES[codec], "charset_source": source, "charset_replaced": "�" in text and "�" not in body.decode(codec, "ignore")}


DECODED = T.StructType([*(T.StructField(n, T.StringType()) for n in ("text", "charset", "charset_source")), T.StructField("charset_replaced", T.BooleanType())])


@F.pandas_udf(DECODED)
def decoded(content_type: pd.Series, body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode(c if isinstance(c, str) else None, bytes(b)) if b is not None else dict.fromkeys(DECODED.names) for c, b in zip(content_type, body)], columns=DECODED.names)


# ---- a small tree ----------------------------------------------------------------------------------------------------

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An element that begins closes open ones of these names (their end tags may be left out).
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
_SCOPES = frozenset("ul ol dl table select body html td th div section article main aside".split())
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_HEAD = frozenset("title base link meta style script noscript template".split())


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []

    def walk(self, inside=lambda n: True):
        """This node and those below it in the document's order, without recursion; ``inside`` says whose children to visit."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            if inside(node):
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.html, self.head, self.body = Node("html", {}), Node("head", {}), Node("body", {})
        self.html.children = [self.head, self.body]
        self.open = [self.html, self.head]
        self.raw = 0

    def _in_body(self) -> None:
        if self.open[1] is self.head:
            self.open = [self.html, self.body]

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in reversed(attrs)}
        if tag in ("html", "head", "body"):
            node = {"html": self.html, "head": self.head, "body": self.body}[tag]
            for k, v in attrs.items():
                node.attrs.setdefault(k, v)
            if tag == "body":
                self._in_body()
            return
        if self.open[1] is self.head and tag not in _HEAD and len(self.open) == 2:
            self._in_body()
        if tag in _ENDS_P:
            self._close({"p"}, _SCOPES - {"div", "section", "article", "main", "aside"} | {"button"})
        if tag in _CLOSES:
            self._close(_CLOSES[tag], {"ul", "ol", "dl", "table", "select"} if tag != "tr" else {"table"})
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def _close(self, names, scopes) -> None:
        for i in range(len(self.open) - 1, 1, -1):
            if self.open[i].name in names:
                del self.open[i:]
                return
            if self.open[i].name in scopes:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "head":
            self._in_body()
            return
        for i in range(len(self.open) - 1, 1, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[1] is self.head and len(self.open) == 2:
            if not data.strip(_ASCII_SPACE):
                return
            self._in_body()
        self.open[-1].children.append(data)


def tree(html: str) -> _Builder:
    b = _Builder()
    b.feed(html)
    b.close()
    return b


def _marked(node: Node, mark: str) -> bool:
    return any(mark in node.attrs.get(a, "").lower() for a in ("id", "class"))


def _hidden(node: Node) -> bool:
    return node.name in V.HIDDEN


def _framed(node: Node) -> bool:
    return _hidden(node) or node.name in V.CHROME or any(_marked(node, m) for m in V.CHROME_MARKS)


# What tells the container of a page's own text, first rule first.
RULES = (
    ("main", lambda n: n.name == "main"),
    ("role_main", lambda n: n.attrs.get("role", "").strip().lower() == "main"),
    ("id_main", lambda n: "main" in n.attrs.get("id", "").lower()),
    ("content", lambda n: _marked(n, "content")),
    ("honbun", lambda n: _marked(n, "honbun")),
    ("article", lambda n: n.name == "article"),
)


def normal_text(text: str) -> str:
    """Normal form, white space of each line as one space, blank lines dropped."""
    lines = (" ".join(line.split()) for line in re.split(r"[\n\r]", unicodedata.normalize("NFKC", text)))
    return "\n".join(line for line in lines if line)


def _gather(node: Node, skip, out: list[str], links: list[Node] | None) -> None:
    todo: list[Node | str] = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        elif not skip(c):
            if links is not None and c.name == "a":
                links.append(c)
            edge = ["\n"] if c.name in V.BLOCKS else []
            todo += [*edge, *reversed(c.children), *edge]


def text_of(node: Node, skip, links: list[Node] | None = None) -> str:
    out: list[str] = []
    _gather(node, skip, out, links)
    return normal_text("".join(out))


def _candidates(node: Node):
    """Nodes below that are not framed, links left out but not what is in them."""
    kept = lambda n: n is node or not _framed(n)
    for n in node.walk(kept):
        if n is not node and n.name != "a" and kept(n):
            yield n


def container(body: Node) -> tuple[str, Node]:
    """The rule that found the page's own part, and that part: of each rule's elements the first with text."""
    found = list(_candidates(body))
    for name, rule in RULES:
        for node in found:
            if rule(node) and text_of(node, _framed):
                return name, node
    return "body", body


_TEXTS = ("title", "canonical", "robots", "rule", "body_text", "page_text")
_ANCHOR = T.StructType([T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
EXTRACTED = T.StructType([*(T.StructField(n, T.StringType()) for n in _TEXTS), T.StructField("links", T.ArrayType(T.StringType())), T.StructField("anchors", T.ArrayType(_ANCHOR))])


def extract(html: str, url: str) -> dict:
    """What the engine keeps of a page at a URL."""
    page = tree(html)
    nodes = list(page.html.walk())
    base_tag = next((n for n in nodes if n.name == "base" and "href" in n.attrs), None)
    base = join_url(url, base_tag.attrs["href"]) if base_tag else None
    base = base or url
    title = next((n for n in nodes if n.name == "title"), None)
    title_text = " ".join(unicodedata.normalize("NFKC", "".join(c for c in title.children if isinstance(c, str))).split()) if title else ""
    rel = next((n for n in nodes if n.name == "link" and "canonical" in n.attrs.get("rel", "").lower().split() and n.attrs.get("href", "").strip()), None)
    declared = (join_url(base, rel.attrs["href"].strip()) or rel.attrs["href"].strip()) if rel else None
    robots = next((n for n in nodes if n.name == "meta" and n.attrs.get("name", "").strip().lower() == "robots" and "content" in n.attrs), None)
    rule, part = container(page.body)
    found: list[Node] = []
    body_text = text_of(part, _framed, found)
    anchors, links = set(), set()
    for a in found:
        ready = prepare(join_url(base, a.attrs["href"])) if "href" in a.attrs else None
        if ready and not ready["rejection"]:
            links.add(ready["normalized"])
            anchors.add((ready["normalized"], " ".join(text_of(a, _framed).split())))
    return {
        "title": title_text or None,
        "canonical": declared,
        "robots": robots.attrs["content"].strip() if robots else None,
        "rule": rule,
        "body_text": body_text,
        "page_text": text_of(page.body, _hidden),
        "links": sorted(links, key=str.encode),
        "anchors": [{"url": u, "text": t} for u, t in sorted(anchors, key=lambda x: (x[0].encode(), x[1].encode()))],
    }


@F.pandas_udf(EXTRACTED)
def extracted(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    rows = [extract(h, u) if isinstance(h, str) and isinstance(u, str) else dict.fromkeys(EXTRACTED.names) for h, u in zip(html, url)]
    return pd.DataFrame(rows, columns=EXTRACTED.names)


def fingerprints(e: Column) -> dict[str, Column]:
    """Hashes, date and versions of an extraction, by the name of their column."""
    sha = lambda c: F.sha2(c, 256)
    return {
        "page_hash": sha(e["page_text"]),
        "title_hash": sha(e["title"]),
        "body_hash": sha(e["body_text"]),
        "links_hash": sha(F.array_join(e["links"], "\n")),
        "page_updated_on": dates.updated_on(e["page_text"]),
        "extractor_version": F.lit(V.EXTRACTOR_VERSION),
        "extractor_rule": e["rule"],
    }
