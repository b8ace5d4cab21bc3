"""Trees of HTML pages: blocks, their roles, and their texts."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

BLOCKS = frozenset(
    "address article aside blockquote button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup label legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(("div", "section"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose content is no text of the page, up to their end tag.
SKIPPED = frozenset(
    "audio canvas embed iframe math noembed noframes noscript object script style svg "
    "template textarea title video xmp".split()
)
# What an opening tag closes, up to the nearest element in which it may nest again.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TAG_ROLES = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar",
    "dialog": "notice", "form": "form", "button": "form", "select": "form", "fieldset": "form",
}
ARIA_ROLES = {
    "navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header",
    "contentinfo": "footer", "complementary": "sidebar", "dialog": "notice",
    "alertdialog": "notice", "alert": "notice", "form": "form", "search": "form",
    "article": "article", "main": "article",
}
WORD_ROLES = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc sitemap",
    "header": "header masthead topbar",
    "footer": "footer colophon copyright",
    "sidebar": "sidebar sidebars aside related recommended recommendations trending widget widgets",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter "
    "subscribe paywall disclaimer banner",
    "advert": "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor "
    "sponsored sponsors promo promoted promotion outbrain taboola",
    "form": "form login signup signin search searchbox",
    "comments": "comment comments commentlist disqus respond replies discussion",
}
ROLE_OF = {word: role for role, words in WORD_ROLES.items() for word in words.split()}
CONTENT_WORDS = frozenset("article articlebody post entry story content".split())
NEGATIONS = frozenset("has no with without not".split())
# Deeper elements stay part of the element at this depth; their texts are kept.
DEEPEST = 120

MARK = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
CAMEL = re.compile(r"([a-z])([A-Z])")
LETTERS = re.compile(r"[a-z]+")


class Element:
    """A block or a boilerplate inline element; ``items`` are elements, texts, None for a break.

    ``label`` is the tag with its role, if it has one; ``named`` adds the first class
    of containers without a role.
    """

    __slots__ = ("inline", "items", "label", "links", "named", "tag")

    def __init__(self, tag: str, label: str = "", named: str = "", inline: bool = False):
        self.tag, self.label, self.named, self.inline = tag, label, named or label, inline
        self.items: list = []
        self.links = 0


def _word_role(value: str) -> str:
    """The role that the words of a class or id name; the last word that names one counts."""
    found = ""
    for name in CAMEL.sub(r"\1-\2", value).lower().split():
        words = LETTERS.findall(name)
        if not words or words[0] in NEGATIONS:
            continue
        roles = [ROLE_OF[w] for w in words if w in ROLE_OF]
        if not roles:
            if any(w in CONTENT_WORDS for w in words) and not found:
                found = "article"
        elif roles[-1] != "header" or not any(w in CONTENT_WORDS for w in words):
            found = roles[-1]
    return found


@lru_cache(maxsize=1 << 14)
def role_of(tag: str, attributes: str) -> str:
    """menu, header, footer, sidebar, notice, advert, form, comments, hidden, article or ''."""
    if not attributes:
        return TAG_ROLES.get(tag, "")
    values = {}
    for name, *given in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), unescape("".join(given)))
    style = values.get("style", "").replace(" ", "").lower()
    if "hidden" in values or "display:none" in style or values.get("aria-hidden", "").lower() == "true":
        return "hidden"
    named = _word_role(values.get("id", "")), _word_role(values.get("class", ""))
    worded = next((r for r in named if r and r != "article"), "")
    if tag in ("article", "main"):
        return worded if worded in ("comments", "advert", "sidebar") and tag == "article" else ""
    if tag in HEADINGS or tag in ("blockquote", "pre", "td", "th", "tr", "tbody", "table"):
        worded = worded if worded in ("advert", "comments") else ""
        return worded
    aria = ARIA_ROLES.get(values.get("role", "").lower(), "")
    if tag == "header" and "article" in named:
        return ""
    return worded or aria or TAG_ROLES.get(tag, "") or ("article" if "article" in named else "")


@lru_cache(maxsize=1 << 14)
def first_class(attributes: str) -> str:
    """The first class in lower-case letters, or ''."""
    for name, *given in ATTRIBUTE.findall(attributes):
        if name.lower() == "class":
            return "-".join(LETTERS.findall("".join(given).lower().partition(" ")[0]))
    return ""


def parse(html: str | None) -> Element:
    """The tree of a page, however broken: missing end tags are implied, stray ones ignored."""
    root = Element("")
    stack = [root]
    if not html:
        return root
    at, anchors = 0, 0

    def add(text: str) -> None:
        if text and (not text.isspace() or stack[-1].items):
            stack[-1].items.append(text)
            if anchors:
                stack[-1].links += len(text)

    while True:
        mark = MARK.search(html, at)
        if mark is None:
            add(html[at:])
            return root
        add(html[at : mark.start()])
        at = mark.end()
        tag = mark[2]
        if tag is None:
            continue
        tag = tag.lower()
        if mark[1]:
            if tag == "a":
                anchors = 0
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                # The end of an inline element doesn't end the blocks around it.
                if tag not in BLOCKS and not stack[depth].inline:
                    depth = 0
                    break
                depth -= 1
            if depth:
                del stack[depth:]
            elif tag in BLOCKS:
                stack[-1].items.append(None)
            continue
        if tag in SKIPPED:
            if not mark[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "a":
            anchors = 1
        elif tag == "br":
            add(" ")
            stack[-1].items.append(" ")
        elif tag == "hr":
            stack[-1].items.append(None)
        block = tag in BLOCKS
        if block:
            anchors = anchors if tag in HEADINGS or tag in ("div", "p") else 0
            closed, within = CLOSES.get(tag, ({"p"} | (HEADINGS if tag in HEADINGS else set()), ()))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in within:
                    break
                if stack[depth].tag in closed:
                    del stack[depth:]
                    if tag not in CLOSES:
                        break
                elif tag not in CLOSES and not stack[depth].inline:
                    break
        elif tag in ("br", "hr", "html", "head", "body", "img", "input", "link", "meta"):
            continue
        role = role_of(tag, mark[3].strip(" /\n\t\r\f"))
        if not block and role in ("", "article"):
            continue
        if len(stack) > DEEPEST:
            stack[-1].items.append(None)
            continue
        name = first_class(mark[3]) if tag in CONTAINERS and not role else ""
        element = Element(tag, f"{tag}:{role}" if role else tag, f"{tag}.{name}" if name else "", not block)
        stack[-1].items.append(element)
        stack.append(element)


def folded(pieces: list[str]) -> str:
    """Texts of one block: references decoded, white space folded, trimmed."""
    return " ".join(unescape("".join(pieces)).split())
