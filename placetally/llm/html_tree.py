"""A tree of blocks from raw, possibly broken HTML."""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>",
    re.S,
)
#: What runs to the end of the page if its own end does not come.
_UNENDED = re.compile(r"<!--|<!\[CDATA\[|<[!?]")
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MARK = re.compile(r"\bdata-(keep|drop)\b")
#: Elements whose content is no text of the page.
HIDDEN = frozenset(
    "script style noscript template title iframe object svg math textarea select head audio video canvas map button".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub"
    " sup time tt u var ruby rt rp nobr".split()
)
#: A start tag of the key ends an open element of the value.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
#: An open element of the key is not ended from inside these.
HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"},
         "tbody": {"table"}}
TEXT = "#text"


class Tree:
    """Nodes in page order: block elements, and runs of text between their borders (tag ``#text``).

    ``parent`` of the root is -1.  ``names`` are the class, id and role of a
    node.  ``mark`` is keep or drop where a training page says so.
    """

    def __init__(self, page: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#root"]
        self.names: list[str] = [""]
        self.mark: list[str] = [""]
        self.pieces: dict[int, list[str]] = {}
        self.linked: dict[int, int] = {}
        self._read(page)

    def _node(self, parent: int, tag: str, names: str = "", mark: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.mark.append(mark)
        return len(self.tag) - 1

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]  # inline elements have their block's node
        open_at: dict[str, list[int]] = {}  # depths of the open elements of each tag
        endless: set[str] = set()  # hidden elements whose end does not come any more
        leaf, links, at = -1, 0, 0
        # behind the last > no tag is complete
        last = page.rfind(">") + 1

        def text(piece: str) -> None:
            nonlocal leaf
            if leaf < 0:
                if not piece or piece.isspace():
                    return
                leaf = self._node(stack[-1][1], TEXT)
                self.pieces[leaf], self.linked[leaf] = [], 0
            self.pieces[leaf].append(piece)
            if links:
                self.linked[leaf] += len(piece)

        def close(depth: int) -> None:
            nonlocal leaf, links
            while len(stack) > depth:
                tag, _ = stack.pop()
                open_at[tag].pop()
                if tag == "a":
                    links -= 1
                elif tag not in INLINE:
                    leaf = -1

        def push(tag: str, node: int) -> None:
            open_at.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))

        def innermost(tags: set[str] | frozenset) -> int:
            return max((depths[-1] for tag in tags if (depths := open_at.get(tag))), default=0)

        def find(tags: set[str], barred: set[str] | frozenset = frozenset()) -> int:
            """Depth of the innermost open element of ``tags``, 0 if there is none or a barred one lies further in."""
            depth = innermost(tags)
            return depth if depth and depth >= innermost(barred) else 0

        while token := _TOKEN.search(page, at, last):
            if token.start() > at:
                text(_decoded(page[at:token.start()]))
            at = token.end()
            name = token[2]
            if name is None:
                whole = token[0]
                if at == last < len(page) and not whole.endswith("-->" if whole.startswith("<!--") else "]]>" if whole.startswith("<![CDATA[") else ">"):
                    whole, at = page[token.start():], len(page)  # it runs to the end of the page
                if whole.startswith("<![CDATA["):
                    text(whole[9:].removesuffix("]]>"))
                continue
            tag = name.lower()
            if token[1]:
                if tag == "br":
                    text(" ")
                elif depth := find({tag}, HOLDS.get(tag, frozenset())):
                    close(depth)
                elif tag == "p":
                    leaf = -1
                continue
            if tag in HIDDEN:
                if token[3].endswith("/") and tag not in ("script", "style"):
                    continue
                if tag in endless:
                    continue
                end = re.compile(rf"</{tag}\b[^>]*>" + ("|<body\b" if tag == "head" else ""), re.I).search(page, at)
                if end is None and tag in ("head", "button"):
                    endless.add(tag)
                elif end is None:
                    at = len(page)
                else:
                    at = end.start() if end[0].lower().startswith("<body") else end.end()
                continue
            if tag in ("br", "wbr"):
                text(" " if tag == "br" else "")
                continue
            if tag in VOID:
                if tag == "hr":
                    leaf = -1
                continue
            if tag in INLINE:
                push(tag, stack[-1][1])
                links += tag == "a"
                continue
            if depth := find(ENDS.get(tag, set()), HOLDS.get(tag, frozenset())):
                close(depth)
            elif depth := find({"p"}, {"table", "button"}):
                close(depth)
            leaf = -1
            attributes = token[3]
            names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
            mark = _MARK.search(attributes)
            push(tag, self._node(stack[-1][1], tag, names, mark[1] if mark else ""))
        if at < len(page):
            rest = page[at:]
            if begun := _UNENDED.search(rest):
                text(_decoded(rest[:begun.start()]))
                if begun[0] == "<![CDATA[":
                    text(rest[begun.end():])
            else:
                # a tag that the page's end cuts off is no text
                text(_decoded(re.sub(r"<[/!a-zA-Z][^<]*\Z", "", rest)))

    def blocks(self) -> dict[int, str]:
        """Text of each text node, white space as single blanks; nodes without text are left out."""
        out = {}
        for node, pieces in self.pieces.items():
            joined = " ".join("".join(pieces).split())
            if joined:
                out[node] = joined
        return out


def _decoded(piece: str) -> str:
    return html.unescape(piece) if "&" in piece else piece
