"""A tolerant reader of HTML: the structural elements of a page and its blocks of text."""

from __future__ import annotations

import re
from html import unescape

import xxhash

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul head button".split()
)
ENDS_P = BLOCKS - {"option", "optgroup", "html", "body", "head", "button"}
#: What a new element of this name closes, up to the elements named after it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:_-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([A-Za-z_:@][A-Za-z0-9_:.-]*+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I) for name in RAW}


#: Elements below this depth lie side by side, so that no page makes reading it quadratic.
DEEPEST = 400


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Element:
    __slots__ = ("name", "attributes", "parent", "children", "depth", "key", "linked")

    def __init__(self, name: str, attributes: dict[str, str], parent: Element | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Element | str] = []
        sign = name
        if marks := attributes.get("class") or attributes.get("id"):
            sign += "." + marks
        #: Digest of the signs from the root to here: the element's node in the style tree.
        self.key = digest(f"{parent.key}>{sign}" if parent else sign)
        self.depth = parent.depth + 1 if parent else 0
        #: Characters of the element's own text that stand in links.
        self.linked = 0


def attributes_of(rest: str) -> dict[str, str]:
    if not rest.strip("/ \t\r\n"):
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}


def read_page(html: str) -> Element:
    """The page as structural elements with blocks of text as further children.

    Inline elements leave no trace but their text. Blocks have their references decoded and
    white space as single spaces. Missing and crossed end tags are borne.
    """
    root = Element("html", {}, None)
    here, pieces, links, linked = root, [], 0, 0
    at, size = 0, len(html)

    def flush() -> None:
        nonlocal linked
        text = "".join(pieces)
        pieces.clear()
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text:
            here.children.append(text)
            here.linked += min(linked, len(text))
        linked = 0

    while at < size:
        start = html.find("<", at)
        if start < 0:
            start = size
        if start > at:
            pieces.append(html[at:start])
            if links:
                linked += start - at
        if start == size:
            break
        m = TOKEN.match(html, start)
        if not m:  # a lone sign
            pieces.append("<")
            at = start + 1
            continue
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS:
                flush()
                up = here
                while up is not None and up.name != name:
                    up = up.parent
                if up is not None and up.parent is not None:
                    here = up.parent
            elif name == "br":
                pieces.append(" ")
            continue
        if name in RAW:
            end = RAW_END[name].search(html, at)
            if not m["rest"].endswith("/") or name in ("script", "style"):
                at = end.end()
            continue
        if name == "a":
            links = 1
        elif name in ("br", "img", "wbr"):
            if name != "wbr":
                pieces.append(" ")
        elif name in BLOCKS:
            flush()
            if name == "html" or name == "body" and any(x.name == "body" for x in ancestors(here)):
                continue
            if name in ENDS_P:
                up = here
                while up is not None and up.name not in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    up = up.parent if up.name not in ("div", "section", "article", "td", "th", "li", "table", "body", "blockquote") else None
                if up is not None and up.name == "p":
                    here = up.parent
            if name in CLOSES:
                closed, within = CLOSES[name]
                up, last = here, None
                while up is not None and up.name not in within:
                    if up.name in closed:
                        last = up
                    up = up.parent
                if last is not None:
                    here = last.parent
            links = 0
            element = Element(name, attributes_of(m["rest"]), here)
            here.children.append(element)
            if name not in VOID and here.depth < DEEPEST:
                here = element
    flush()
    return root


def ancestors(element: Element | None):
    while element is not None:
        yield element
        element = element.parent


def blocks_of(element: Element, skip=lambda e: False) -> list[str]:
    """The texts below an element in page order, without branches that are skipped."""
    out, stack = [], [element]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not skip(x):
            stack.extend(reversed(x.children))
    return out


def elements_of(element: Element):
    """An element and those below it, each before its children."""
    stack = [element]
    while stack:
        x = stack.pop()
        yield x
        stack.extend(c for c in reversed(x.children) if not isinstance(c, str))
