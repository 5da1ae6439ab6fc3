"""Per-document HTML helper used inside the Arrow UDFs of ``html`` and ``listing``.

One forward pass over the source: ``walk`` yields open / close / text / comment events
with missing end tags filled in.  No tree is kept; removal works by cutting the output
back to where the removed element began.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from html import escape, unescape
from typing import NamedTuple

# HTML structure rules.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style"))
INLINE = frozenset("tt i b u s strike big small em strong font span".split())
CLOSES_P = frozenset(
    "p address article aside blockquote center dd div dl dt fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main nav ol pre section table td th tr ul".split()
)
CLOSED_BY = {
    "p": CLOSES_P,
    "a": frozenset(("a",)),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "thead", "tfoot")),
    "td": frozenset(("td", "th", "tr", "tbody")),
    "th": frozenset(("td", "th", "tr", "tbody")),
    "option": frozenset(("option", "optgroup")),
    "head": frozenset(("body",)),
}
# An end tag does not reach through an open element of a higher rank.
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
        "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
# Text inside these does not count as document text.
NO_TEXT = frozenset(("script", "style", "template", "rt", "rp"))

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SELECTS = re.compile(r"class|id|type", re.IGNORECASE)
_CUT_OFF = re.compile(r"<(?:!--|[A-Za-z/!?])")
_RAW_END = {tag: re.compile(rf"</{tag}[\s/>]", re.IGNORECASE) for tag in RAW_TEXT}
_META = re.compile(rb"<\s*meta", re.IGNORECASE)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([^>\"'\s/;]+)", re.IGNORECASE)
_XML_CHARSET = re.compile(rb"^\s*<\?xml[^>]*encoding\s*=\s*[\"']([^\"']+)", re.IGNORECASE)
_BODY = re.compile(rb"<\s*body[\s>]", re.IGNORECASE)
# Python's names of the charsets that web pages use.
CHARSETS = frozenset(
    "ascii utf-8 utf-16 utf-16-le utf-16-be iso8859-1 iso8859-2 iso8859-3 iso8859-4 iso8859-5 iso8859-6 iso8859-7 "
    "iso8859-8 iso8859-9 iso8859-10 iso8859-11 iso8859-13 iso8859-14 iso8859-15 iso8859-16 cp866 cp874 cp1250 cp1251 "
    "cp1252 cp1253 cp1254 cp1255 cp1256 cp1257 cp1258 koi8-r koi8-u mac-roman mac-cyrillic gb2312 gbk gb18030 big5 "
    "euc_jp shift_jis cp932 iso2022_jp euc_kr tis-620".split()
)
_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))


def decode(data: bytes) -> str:
    """Bytes to text: byte order mark, declared charset, UTF-8, then windows-1252.

    The declaration is looked for in all of the document before its body.  Names that are no
    charset of the web (Python has codecs for other things too) count as undeclared.
    """
    for mark, name in _BOMS:
        if data.startswith(mark):
            return data[len(mark):].decode(name, "replace")
    body = _BODY.search(data)
    xml = _XML_CHARSET.search(data)
    declared = xml.group(1) if xml else _meta_charset(data, body.start() if body else len(data))
    name = _charset(declared) if declared else None
    for charset in [name, "utf-8", "windows-1252"] if name else ["utf-8", "windows-1252"]:
        try:
            return data.decode(charset)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


def _meta_charset(data: bytes, stop: int) -> bytes | None:
    """The charset of the first meta element before ``stop`` that has one; each byte is met once."""
    pos = 0
    while found := _META.search(data, pos, stop):
        end = data.find(b">", found.end(), stop)
        end = stop if end < 0 else end
        named = [m.group(1) for m in _CHARSET.finditer(data, found.end() + 1, end)]
        if named:
            return named[-1]
        pos = end
    return None


def _charset(label: bytes) -> str | None:
    try:
        name = codecs.lookup(label.decode("ascii")).name
    except (LookupError, ValueError):  # unknown, not ASCII, or holding a NUL
        return None
    return name if name in CHARSETS else None


def attributes(raw: str) -> dict[str, str]:
    """Attribute map of a start tag; the first of equal names counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw):
        found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return found


class _Elements:
    """The open elements, with the places of each tag, of each higher rank and of what is no formatting.

    Every question is answered from the ends of these lists, so a start or end tag costs the
    same however many elements are open.
    """

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.solid: list[int] = []
        self.by_tag: dict[str, list[int]] = {}
        self.by_rank: dict[int, list[int]] = {rank: [] for rank in set(RANK.values())}

    def push(self, tag: str) -> None:
        place = len(self.tags)
        self.tags.append(tag)
        self.by_tag.setdefault(tag, []).append(place)
        if tag in RANK:
            self.by_rank[RANK[tag]].append(place)
        if tag not in INLINE:
            self.solid.append(place)

    def pop(self) -> str:
        tag = self.tags.pop()
        self.by_tag[tag].pop()
        if tag in RANK:
            self.by_rank[RANK[tag]].pop()
        if tag not in INLINE:
            self.solid.pop()
        return tag

    def ended_by(self, tag: str) -> int | None:
        """The depth an end tag closes down to; None if it is to be ignored."""
        places = self.by_tag.get(tag)
        if not places:
            return None
        own = RANK.get(tag, 100)
        reach = max((p[-1] for rank, p in self.by_rank.items() if rank > own and p), default=-1)
        return places[-1] if places[-1] > reach else None

    def kept_by(self, tag: str) -> int:
        """How many open elements stay open when a start tag comes."""
        keep, nth = len(self.tags), len(self.solid)
        while keep:
            inner = keep
            if tag in CLOSES_P:
                # Formatting that was left open inside a paragraph ends with the paragraph.
                inner = self.solid[nth - 1] + 1 if nth else 0
            if not inner or tag not in CLOSED_BY.get(self.tags[inner - 1], ()):
                break
            keep = inner - 1
            nth -= nth > 0 and self.solid[nth - 1] == keep
        return keep


def walk(source: str) -> Iterator[tuple[str, str, str]]:
    """Events ``(kind, value, attrs)``: open/close carry the tag, text/comment the string.

    Every open is matched by a close.  Text that is split only by ignored end tags comes
    out as one event, as one text node.
    """
    elements = _Elements()
    text: list[str] = []
    pos, last = 0, source.rfind(">")

    def flush() -> Iterator[tuple[str, str, str]]:
        if text:
            joined = "".join(text)
            text.clear()
            yield "text", unescape(joined) if "&" in joined else joined, ""

    while pos <= last:
        m = _TOKEN.search(source, pos)
        if m is None:
            break
        if m.start() > pos:
            text.append(source[pos:m.start()])
        pos = m.end()
        comment, end, tag, attrs = m.groups()
        if tag is None:
            if comment is not None:
                yield from flush()
                yield "comment", comment, ""
            continue
        tag = tag.lower()
        if end:
            depth = elements.ended_by(tag)
            if depth is not None:
                yield from flush()
                while len(elements.tags) > depth:
                    yield "close", elements.pop(), ""
            continue
        yield from flush()
        keep = elements.kept_by(tag)
        while len(elements.tags) > keep:
            yield "close", elements.pop(), ""
        yield "open", tag, attrs
        if tag in VOID:
            yield "close", tag, ""
            continue
        elements.push(tag)
        if tag in RAW_TEXT:
            end = _RAW_END[tag].search(source, pos)
            stop = end.start() if end else len(source)
            if stop > pos:
                yield "text", source[pos:stop], ""
            pos = stop
    if pos < len(source):
        # A tag or comment that is cut off by the end of the document is not text.
        cut = _CUT_OFF.search(source, pos)
        text.append(source[pos:cut.start() if cut else len(source)])
    yield from flush()
    while elements.tags:
        yield "close", elements.pop(), ""


class Removal(NamedTuple):
    """What a pass takes out: tags, class tokens, ids, hidden inputs, link texts."""

    tags: frozenset[str]
    classes: frozenset[str]
    ids: frozenset[str]
    hidden_inputs: bool
    link_text: str

    def matches(self, tag: str, attrs: dict[str, str]) -> bool:
        return (
            tag in self.tags
            or attrs.get("id") in self.ids
            or not self.classes.isdisjoint(attrs.get("class", "").split())
            or (self.hidden_inputs and tag == "input" and attrs.get("type") == "hidden")
        )


class _Open:
    """One open element during ``prune``."""

    __slots__ = ("tag", "attrs", "text_mark", "html_mark", "doomed", "children", "only")

    def __init__(self, tag: str, attrs: dict[str, str], text_mark: int, html_mark: int, doomed: bool):
        self.tag, self.attrs, self.doomed = tag, attrs, doomed
        self.text_mark, self.html_mark = text_mark, html_mark
        self.children, self.only = 0, False  # surviving children; whether a sole one holds the link text

    def add(self, only: bool) -> None:
        self.children += 1
        self.only = only and self.children == 1


def prune(source: str, removal: Removal, keep_html: bool, main_id: str = "main") -> tuple[str, str | None]:
    """Remove what ``removal`` names; return (normalised text, main content as HTML).

    The HTML is the first element with id ``main_id``, else the body, else a body made of
    everything after the head; None unless ``keep_html``.
    """
    texts: list[str] = []
    out: list[str] = []
    root = _Open("", {}, 0, 0, False)
    stack = [root]
    mains: list[tuple[int, int]] = []
    bodies: list[tuple[int, int]] = []
    muted = after_head = 0
    for kind, value, raw in walk(source):
        top = stack[-1]
        if kind == "open":
            attrs = attributes(raw) if raw and (keep_html or _SELECTS.search(raw)) else {}
            doomed = removal.matches(value, attrs)
            stack.append(_Open(value, attrs, len(texts), len(out), doomed))
            muted += value in NO_TEXT
            if keep_html and value != "html":
                out.append(_start_tag(value, attrs))
        elif kind == "close":
            element = stack.pop()
            muted -= element.tag in NO_TEXT
            if element.doomed or (element.tag == "a" and element.only):
                del texts[element.text_mark:]
                del out[element.html_mark:]
                while mains and mains[-1][0] >= element.html_mark:
                    mains.pop()
                continue
            stack[-1].add(element.only)
            if keep_html:
                if element.tag not in VOID and element.tag != "html":
                    out.append(f"</{element.tag}>")
                span = (element.html_mark, len(out))
                if element.attrs.get("id") == main_id:
                    # An outer match closes after an inner one and starts first.
                    while mains and mains[-1][0] > span[0]:
                        mains.pop()
                    mains.append(span)
                elif element.tag == "body":
                    bodies.append(span)
                elif element.tag == "head":
                    after_head = len(out)
        elif kind == "comment":
            top.add(removal.link_text in value)
            if keep_html:
                out.append(f"<!--{value}-->")
        else:
            top.add(removal.link_text in value)
            if not muted:
                texts.append(value)
            if keep_html:
                out.append(value if top.tag in RAW_TEXT else escape(value, quote=False))
    # str.split() knows exactly the whitespace of functions.text.WHITESPACE_CODES.
    text = " ".join(" ".join(texts).split())
    if not keep_html:
        return text, None
    if mains or bodies:
        start, stop = (mains or bodies)[0]
        return text, "".join(out[start:stop])
    return text, f"<body>{''.join(out[after_head:])}</body>" if out else ""


def _start_tag(tag: str, attrs: dict[str, str]) -> str:
    parts = [f" {name}={_quoted(escape(value, quote=False))}" for name, value in attrs.items()]
    return f"<{tag}{''.join(parts)}{'/' if tag in VOID else ''}>"


def _quoted(value: str) -> str:
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"{}"'.format(value.replace('"', "&quot;"))
