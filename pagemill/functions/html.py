"""Title, main text, categories and links of an HTML page in one parse.

This is the only Python code on the data path. It runs as an Arrow UDF, so only the html
column crosses to the Python worker and all other columns stay in the JVM.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.schemas import PARSED

# The parser travels inside the task: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements whose content is not text, elements that end an open paragraph,
# and elements that end an open heading.
NOT_TEXT = frozenset(("script", "style", "template", "rt", "rp"))
RUBY = frozenset(("rt", "rp", "ruby"))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
ENDS_HEADING = frozenset(("p", "li", "table", "form", "fieldset"))
# Where the main text is, and the label that marks the category line.
CONTENT = ("div", "text")
CATEGORY_MARK = "kategori"

_ARROW_PARSED = pa.struct([
    ("title", pa.string()),
    ("text", pa.string()),
    ("categories", pa.list_(pa.string())),
    ("hrefs", pa.list_(pa.string())),
])

#: Bytes of html that are held as Python objects at a time, whatever the rows and sizes of an Arrow batch.
PORTION = 1 << 21

# A comment, a tag, or a declaration. Quantifiers are possessive: a page is read once from
# front to back, whatever it holds.
_TOKEN = re.compile(
    r"""<(?:
      !--(?:-?>|.*?(?:--!?>|\Z))
    | (?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
      (?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?)*+)
      (?:>|\Z)
    | [!?/][^>]*+(?:>|\Z)
    )""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?"""
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
# In an attribute a character name without its semicolon stays as it is when more of a
# word or an equals sign follows: "?a=1&copy=2".
_ATTRIBUTE_REF = re.compile(r"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*(?:;|(?![a-zA-Z0-9=])))")


def _attribute(attrs: str, wanted: str) -> str | None:
    """Value of the first attribute of that name: '' without a value, None without the name."""
    for name, double, single, bare in _ATTRIBUTE.findall(attrs):
        if name.lower() == wanted:
            return _ATTRIBUTE_REF.sub(lambda ref: unescape(ref[0]), double or single or bare)
    return None


def _closes_itself(attrs: str) -> bool:
    """The tag ends in a slash that is not the end of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    last = None
    for last in _ATTRIBUTE.finditer(attrs):
        pass
    return last is None or last.end() < len(attrs)


class _Page:
    """Collects the fields while the tokens of a page go by; no tree is built."""

    def __init__(self, tag: str, token: str | None, mark: str):
        self.content_tag, self.content_token, self.mark = tag, token, mark
        self.hrefs: list[str] = []
        self.categories: list[str] = []
        self.title: list[str] | None = None
        self.content: list[str] | None = None
        self._hidden: list[str] = []  # open elements whose content is not text
        self._hidden_of = dict.fromkeys((*NOT_TEXT, *RUBY), 0)  # how many of each
        self._in_title = False
        self._depth = 0  # open elements of the content tag, from the content block inward
        self._paragraph = False
        self._strong: list[str] | None = None  # text of the paragraph's first <strong>
        self._strong_depth = 0
        self._anchor: list[str] | None = None  # text of the paragraph's open <a>
        self._anchors: list[str] = []
        self._categories_done = False

    def text(self, raw: str) -> None:
        """One text node."""
        anchor = self._anchor is not None
        if self._hidden or not (self._in_title or self._depth or self._strong_depth or anchor):
            return
        text = unescape(raw).strip()
        if not text:
            return
        if self._in_title:
            self.title.append(text)
        if self._depth:
            self.content.append(text)
        if self._strong_depth:
            self._strong.append(text)
        if anchor:
            self._anchor.append(text)

    def _end_anchor(self) -> None:
        if self._anchor:
            self._anchors.append("".join(self._anchor))
        self._anchor = None

    def end_paragraph(self) -> None:
        if not self._paragraph:
            return
        self._end_anchor()
        if self._strong is not None and self.mark in "".join(self._strong).lower():
            self.categories = self._anchors
            self._categories_done = True
        self._paragraph, self._strong, self._strong_depth = False, None, 0
        self._anchors = []

    def start(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS:
            self.end_paragraph()
            if tag in ENDS_HEADING:
                self._in_title = False
        if tag == "a":
            href = _attribute(attrs, "href")
            if href is not None:
                self.hrefs.append(href)
            if self._paragraph:
                self._end_anchor()
                self._anchor = []
        elif tag == "p":
            self._paragraph = not self._categories_done
        elif tag == "h1":
            self._in_title = self.title is None
            if self._in_title:
                self.title = []
        elif tag == "strong":
            if self._paragraph and self._strong is None:
                self._strong, self._strong_depth = [], 1
            elif self._strong_depth:
                self._strong_depth += 1
        elif tag in NOT_TEXT:
            if tag in RUBY:
                self._leave_ruby()
            self._hidden.append(tag)
            self._hidden_of[tag] += 1
        if tag == self.content_tag:
            if self._depth:
                self._depth += 1
            elif self.content is None and self._is_content(attrs):
                self.content, self._depth = [], 1

    def _is_content(self, attrs: str) -> bool:
        if self.content_token is None:
            return True
        return self.content_token in (_attribute(attrs, "class") or "").split()

    def _leave_ruby(self) -> None:
        while self._hidden and self._hidden[-1] in RUBY:
            self._unhide()

    def _unhide(self) -> str:
        tag = self._hidden.pop()
        self._hidden_of[tag] -= 1
        return tag

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_paragraph()
            if tag == "h1":
                self._in_title = False
        elif tag == "a":
            self._end_anchor()
        elif tag == "strong":
            if self._strong_depth:
                self._strong_depth -= 1
        elif tag in RUBY:
            self._leave_ruby()
        elif tag in NOT_TEXT and self._hidden_of[tag]:
            while self._unhide() != tag:
                pass
        if tag == self.content_tag and self._depth:
            self._depth -= 1


def parse_page(html: str | None, tag: str, token: str | None, mark: str) -> dict | None:
    if html is None:
        return None
    page, at = _Page(tag, token, mark), 0
    while found := _TOKEN.search(html, at):
        if found.start() > at:
            page.text(html[at : found.start()])
        at = found.end()
        if not found["tag"]:
            continue
        name, attrs = found["tag"].lower(), found["attrs"]
        if found["end"]:
            page.end(name)
            continue
        page.start(name, attrs)
        if attrs and _closes_itself(attrs):
            page.end(name)
        elif name in _RAW_END:
            close = _RAW_END[name].search(html, at)
            at = close.start() if close else len(html)
    page.text(html[at:])
    page.end_paragraph()
    return {
        "title": "".join(page.title or ()),
        "text": None if page.content is None else "\n".join(page.content),
        "categories": page.categories,
        "hrefs": page.hrefs,
    }


def portions(pages: pa.Array, size: int) -> Iterator[pa.Array]:
    """The pages in slices of about `size` bytes; a longer page is a slice of its own. Always one slice."""
    begin = upto = held = 0
    for length in pc.fill_null(pc.binary_length(pages), 0).to_pylist():
        if upto > begin and held + length > size:
            yield pages.slice(begin, upto - begin)
            begin, held = upto, 0
        upto, held = upto + 1, held + length
    yield pages.slice(begin)


def parsed(pages: pa.Array, tag: str, token: str | None, mark: str) -> pa.StructArray:
    """The fields of each page; a page becomes Python text when it is its turn, and goes when it is read."""
    rows = [parse_page(page.as_py(), tag, token, mark) for page in pages]
    fields = [
        pa.array([None if row is None else row[field.name] for row in rows], field.type)
        for field in _ARROW_PARSED
    ]
    missing = pa.array([row is None for row in rows], pa.bool_())
    return pa.StructArray.from_arrays(fields, fields=list(_ARROW_PARSED), mask=missing)


def parsed_batches(batches: Iterator[pa.Array], tag: str, token: str | None, mark: str) -> Iterator[pa.StructArray]:
    for pages in batches:
        for some in portions(pages, PORTION):
            yield parsed(some, tag, token, mark)
        del pages, some  # before the next batch is read


def parse_html(
    html: Column,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
) -> Column:
    """struct<title, text, categories, hrefs>; null html gives a null struct.

    `content` is (tag, class token) of the main-text element, the token None for any.
    `text` is null when the page has no such element; its nodes are joined by line feeds.

    A batch is parsed and returned in portions: beside the batch itself a worker holds the text and the
    results of about `PORTION` bytes of html, or of one page.

    Declared nondeterministic so that a filter on one field is not pushed below the
    projection, which would parse every page a second time.
    """
    tag, token = content

    @F.arrow_udf(returnType=PARSED)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return parsed_batches(batches, tag, token, mark)

    return parse.asNondeterministic()(html)
