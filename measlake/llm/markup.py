"""HTML as a stream of tokens, with the part of the page that each text stands in."""

from __future__ import annotations

import html
import re
from functools import lru_cache

import xxhash

# Where a text stands: not told by the markup, in the article, in another part of the page.
UNSURE, MAIN, OUT, TITLE = range(4)

# Element names of HTML.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that end when another of their kind begins.
SELF_ENDING = {"li", "dt", "dd", "tr", "td", "th", "option"}
ARTICLES = {"article", "main"}
PARTS = {
    "head", "nav", "header", "footer", "aside", "menu", "dialog", "template", "noscript", "select", "button",
    "object", "svg",
}
# Words of class, id and role that name a part of a page.
NAMED_PARTS = {
    "ad", "ads", "advert", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "footer", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination",
    "popup", "promo", "promotion", "recommended", "related", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
COMMENTS = {"comment", "comments", "disqus", "replies", "reply"}
ABOUT_OTHERS = {"has", "is", "no", "with", "without"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@lru_cache(maxsize=None)
def end_of(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I)


def named(rest: str) -> tuple[str, bool, bool]:
    """Class, id and role of a tag, whether they name a part of the page, and comments."""
    names = [next(v for v in found[1:] if v or v == found[-1]) for found in ATTRIBUTE.findall(rest)]
    part = comment = False
    for name in " ".join(names).lower().split():
        words = re.findall("[a-z]+", name)
        if words and words[0] not in ABOUT_OTHERS:
            comment |= not COMMENTS.isdisjoint(words)
            part |= not NAMED_PARTS.isdisjoint(words)
    return " ".join(names), part or comment, comment


class Page:
    """Token stream of a page, and its texts by block.

    ``stream``: a number for each tag (with class, id and role) and each text that
    is not blank. ``pieces``: block, where it stands, place in the stream (-1 for
    blanks), and the decoded text. Comments are no tokens.
    """

    def __init__(self, source: str) -> None:
        self.stream: list[int] = []
        self.pieces: list[tuple[int, int, int, str]] = []
        self.block = 0
        # Open elements: name, where their texts stand, whether an article inside changes that.
        self.open: list[tuple[str, int, bool]] = [("", UNSURE, True)]
        self.opened: dict[str, int] = {}
        at = 0
        while found := TOKEN.search(source, at):
            self.text(source[at : found.start()])
            at = found.end()
            name = (found["name"] or found["name2"] or "").lower()
            if found["end"] or found["end2"]:
                self.end(name)
            elif name:
                self.start(name, found["rest"] or "")
                if name in RAW:
                    close = end_of(name).search(source, at)
                    at = close.start() if close else len(source)
        self.text(source[at:])

    def text(self, raw: str) -> None:
        if not raw:
            return
        decoded = html.unescape(raw) if "&" in raw else raw
        words = " ".join(decoded.split())
        place = -1
        if words:
            place = len(self.stream)
            self.stream.append(xxhash.xxh64_intdigest(words))
        self.pieces.append((self.block, self.open[-1][1], place, decoded))

    def start(self, name: str, rest: str) -> None:
        names, part, comment = named(rest) if "=" in rest else ("", False, False)
        self.stream.append(xxhash.xxh64_intdigest(f"<{name} {names}"))
        if name == "br":
            self.pieces.append((self.block, self.open[-1][1], -1, " "))
        inline = name in INLINE
        if not inline:
            self.block += 1
            if self.open[-1][0] == "p":
                self.pop()
            if name in SELF_ENDING and self.open[-1][0] == name:
                self.pop()
        if name in VOID or name in RAW or (inline and not part):
            return
        stands, soft = self.open[-1][1:]
        if stands == OUT and not soft:
            pass
        elif comment:
            stands, soft = OUT, False
        elif name in ARTICLES:
            stands = MAIN
        elif name not in ("html", "body") and (name in PARTS or name == "form" or part):
            header = name == "header" or (part and "header" in names.lower())
            soft = name not in PARTS
            stands = TITLE if header and stands in (MAIN, TITLE) else OUT
        elif stands == TITLE and name in HEADINGS:
            stands = MAIN
        self.open.append((name, stands, soft))
        self.opened[name] = self.opened.get(name, 0) + 1

    def pop(self) -> str:
        name = self.open.pop()[0]
        self.opened[name] -= 1
        return name

    def end(self, name: str) -> None:
        self.stream.append(xxhash.xxh64_intdigest(f"</{name}"))
        if name not in INLINE:
            self.block += 1
        if self.opened.get(name):
            while self.pop() != name:
                pass

    def has_article(self) -> bool:
        return any(stands == MAIN and place >= 0 for _, stands, place, _ in self.pieces)

    def identity(self) -> int:
        """A number that pages with the same longest text share."""
        longest = max((p for p in self.pieces if p[2] >= 0), key=lambda p: (len(p[3]), p[3]), default=None)
        return self.stream[longest[2]] if longest else 0

    def unsure(self) -> list[int]:
        """Places of texts that only their repetition can judge."""
        if self.has_article():
            return []
        return [place for _, stands, place, _ in self.pieces if stands == UNSURE and place >= 0]

    def kept(self, repeated: set[int]) -> str:
        """The texts that stay, block by block, given the places that the host repeats."""
        wanted = MAIN if self.has_article() else UNSURE
        blocks: dict[int, list[str]] = {}
        for block, stands, place, text in self.pieces:
            if stands == wanted and (wanted == MAIN or place not in repeated):
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)
