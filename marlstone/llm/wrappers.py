"""Main texts of web pages by wrappers: union-free regular expressions, one for each host."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.markup import Element, folded, parse
from marlstone.llm.storage import store

# Distinct pages after which a text that never changes counts as the host's own.
SUPPORT = 3
SLOT = "#"
FAN_IN = 64
HELD = 10_000
# Children with more labels than this are told apart by tag and role alone.
LABELS = 64
KEPT_IN_ARTICLES = ("header",)


class Wrapper:
    """One element of a host's pages, as a regular expression over its children.

    ``groups`` is a sequence of (repeated, children): a single child, once or repeated,
    or several in a repeated group, each with its flag ``optional``. No label stands
    twice among the children, so a wrapper's size is bounded by the labels, not by the
    pages; classes are part of them until there are too many (``plain``). ``most`` is the
    greatest number of occurrences in one parent. ``text`` is '' without own text, a digest if it is the same on all pages,
    else a slot. ``chars`` and ``links`` count own text and its part within links.
    """

    __slots__ = ("chars", "groups", "label", "links", "most", "optional", "pages", "plain", "seen", "text")

    def __init__(self, label: str):
        self.label, self.text, self.optional, self.plain, self.most = label, "", False, False, 1
        self.chars = self.links = self.pages = 0
        self.groups: list[tuple[bool, list[Wrapper]]] = []
        self.seen: list[str] = []

    def children(self) -> list[Wrapper]:
        return [child for _, group in self.groups for child in group]

    def packed(self) -> list:
        groups = [[repeated, [c.packed() for c in group]] for repeated, group in self.groups]
        flags = [self.optional, self.plain, self.most]
        return [self.label, self.text, flags, self.chars, self.links, self.pages, self.seen, groups]

    @classmethod
    def unpacked(cls, values: list) -> Wrapper:
        self = cls(values[0])
        _, self.text, flags, self.chars, self.links, self.pages, self.seen, groups = values
        self.optional, self.plain, self.most = flags
        self.groups = [(repeated, [cls.unpacked(c) for c in group]) for repeated, group in groups]
        return self

    def expression(self) -> str:
        """The regular expression: # a text slot, = a fixed text, ? optional, + repeated."""
        inner = [{"": "", SLOT: "#"}.get(self.text, "=")] if self.text else []
        for repeated, group in self.groups:
            parts = [c.expression() + ("?" if c.optional else "") for c in group]
            if len(group) > 1:
                inner.append(f"({' '.join(parts)})+")
            elif repeated and group[0].optional:
                inner.append(f"{group[0].expression()}*")
            else:
                inner.append(parts[0] + ("+" if repeated else ""))
        body = " ".join(inner)
        return f"{self.label}[{body}]" if self.label else body


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def of_element(element: Element) -> Wrapper:
    """The wrapper of one element: equal neighbours and returning labels become repeats."""
    wrapper = Wrapper(element.label)
    wrapper.pages = 1
    own = folded([i for i in element.items if isinstance(i, str)])
    if own:
        wrapper.text, wrapper.chars = _digest(own), len(own)
        wrapper.links = min(element.links, len(own))
    inner = [i for i in element.items if isinstance(i, Element)]
    labels = [i.named for i in inner]
    if len(set(labels)) > LABELS:
        wrapper.plain = True
        labels = [i.label for i in inner]
    first, last, order = {}, {}, []
    for at, label in enumerate(labels):
        if label not in first:
            first[label] = at
            order.append(label)
        last[label] = at
    # Labels between the first and the last place of another label share its group.
    at = 0
    while at < len(order):
        span, end = [order[at]], last[order[at]]
        at += 1
        while at < len(order) and first[order[at]] < end:
            span.append(order[at])
            end = max(end, last[order[at]])
            at += 1
        covered = slice(first[span[0]], end + 1)
        wrapper.groups.append(_folded_group(inner[covered], labels[covered], span))
    return wrapper


def _folded_group(
    elements: list[Element], labels: list[str], order: list[str]
) -> tuple[bool, list[Wrapper]]:
    """Merge the occurrences of each label; those missing in a round are optional."""
    merged: dict[str, Wrapper] = {}
    rounds, place, held = 1, -1, dict.fromkeys(order, 0)
    number = {label: i for i, label in enumerate(order)}
    for element, label in zip(elements, labels, strict=True):
        if number[label] <= place:
            rounds += 1
        place = number[label]
        held[label] += 1
        one = of_element(element)
        one.label = label
        if label in merged:
            merge(merged[label], one, same_page=True)
        else:
            merged[label] = one
    children = [merged[label] for label in order]
    for child in children:
        child.most = held[child.label]
        if len(order) > 1:
            child.optional = held[child.label] < rounds
    return len(elements) > 1, children


def _made_plain(wrapper: Wrapper) -> None:
    """Drop the classes from the labels of the children, which become one repeated group."""
    if wrapper.plain:
        return
    wrapper.plain = True
    children: dict[str, Wrapper] = {}
    for child in wrapper.children():
        child.label, child.optional = child.label.partition(".")[0], True
        if child.label in children:
            merge(children[child.label], child)
            children[child.label].most = 2
        else:
            children[child.label] = child
    if children:
        wrapper.groups = [(True, list(children.values()))]


def merge(into: Wrapper, other: Wrapper, same_page: bool = False) -> None:
    """Generalise ``into`` until it also matches what ``other`` matches.

    Unequal texts become a slot. Children are aligned from the left; at a mismatch an
    element that the other side lacks becomes optional, and elements that the two
    sides have in different orders become a repeated group.
    """
    if into.text != other.text or same_page:
        into.text = SLOT if into.text or other.text else ""
    into.chars += other.chars
    into.links += other.links
    if not same_page:
        into.pages += other.pages
    into.seen = sorted({*into.seen, *other.seen})[:SUPPORT]
    into.most = max(into.most, other.most)
    labels = {c.label for c in into.children()} | {c.label for c in other.children()}
    if into.plain or other.plain or len(labels) > LABELS:
        _made_plain(into)
        _made_plain(other)
    a, b = into.groups, other.groups
    at_a = {c.label: i for i, (_, group) in enumerate(a) for c in group}
    at_b = {c.label: i for i, (_, group) in enumerate(b) for c in group}
    out: list[tuple[bool, list[Wrapper]]] = []

    def skipped(group: tuple[bool, list[Wrapper]]) -> None:
        for child in group[1]:
            child.optional = True
        out.append(group)

    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and not any(at_b.get(c.label, -1) >= j for c in a[i][1]):
            skipped(a[i])
            i += 1
        elif j < len(b) and not any(at_a.get(c.label, -1) >= i for c in b[j][1]):
            skipped(b[j])
            j += 1
        else:
            # Widen both spans until neither shares a label with what follows.
            end_a, end_b, done_a, done_b = i, j, i, j
            while done_a <= end_a or done_b <= end_b:
                for _, group in a[done_a : end_a + 1]:
                    end_b = max([end_b, *(at_b.get(c.label, -1) for c in group)])
                done_a = end_a + 1
                for _, group in b[done_b : end_b + 1]:
                    end_a = max([end_a, *(at_a.get(c.label, -1) for c in group)])
                done_b = end_b + 1
            out.append(_joined(a[i : end_a + 1], b[j : end_b + 1]))
            i, j = end_a + 1, end_b + 1
    into.groups = out


def _joined(a: list, b: list) -> tuple[bool, list[Wrapper]]:
    """One group that matches both spans."""
    children = {c.label: c for _, group in a for c in group}
    others = [c for _, group in b for c in group]
    alike = len(a) == len(b) == 1
    if not alike or len(children) != len(others):
        known = {c.label for c in others}
        for child in [*children.values(), *others]:
            child.optional |= not alike or child.label not in known or child.label not in children
    for child in others:
        if child.label in children:
            children[child.label].optional |= child.optional
            merge(children[child.label], child)
        else:
            children[child.label] = child
    repeated = any(r for r, _ in [*a, *b]) or len(children) > 1
    return repeated, list(children.values())


def of_page(html: str | None) -> Wrapper:
    """The wrapper of a single page; ``seen`` holds a digest of its longest text."""
    root = parse(html)
    wrapper = of_element(root)
    longest = ""
    waiting = [root]
    while waiting:
        element = waiting.pop()
        for item in element.items:
            if isinstance(item, Element):
                waiting.append(item)
            elif item and len(item) > len(longest):
                longest = item
    wrapper.seen = [_digest(folded([longest]))]
    return wrapper


def _is_article(wrapper: Wrapper) -> bool:
    return wrapper.label == "article" or wrapper.label.endswith(":article")


def decide(host: Wrapper) -> dict:
    """Which elements of a host's pages hold the article, and which never do.

    Paths of labels: ``drop`` those whose role is boilerplate, ``levels`` the elements to
    read, best first (articles, main elements, the element that most text lies in, the
    page), ``weak`` what counts as boilerplate outside articles only: texts that are the
    same on ``SUPPORT`` different pages or more, and elements that are nearly all links.
    """
    chars: dict[tuple, int] = {}
    links: dict[tuple, int] = {}
    holds: set[tuple] = set()
    plain: set[tuple] = set()

    def count(w: Wrapper, path: tuple) -> bool:
        found = _is_article(w) or w.label == "main"
        chars[path], links[path] = w.chars, w.links
        if w.plain:
            plain.add(path)
        for child in w.children():
            below = (*path, child.label)
            found |= count(child, below)
            chars[path] += chars[below]
            links[path] += links[below]
        if found:
            holds.add(path)
        return found

    count(host, ())
    total = chars[()]
    drop: set[tuple] = set()
    fixed: dict[tuple, str] = {}
    weak: set[tuple] = set()
    articles: list[tuple] = []
    mains: list[tuple] = []

    def visit(w: Wrapper, path: tuple, inside: bool, in_main: bool) -> None:
        role = w.label.partition(":")[2] or {"nav": "menu"}.get(w.label, "")
        kept = inside and role in KEPT_IN_ARTICLES or in_main and w.label == "header:header"
        # An end tag that is missing, or a class that names the parts of the page.
        wraps = path in holds and 2 * chars[path] > total and role not in ("comments", "hidden")
        if role and role != "article" and not kept and not wraps:
            drop.add(path)
            return
        if _is_article(w) and not inside:
            articles.append(path)
            inside = True
        if w.label == "main":
            mains.append(path)
            in_main = True
        if not inside and path:
            if chars[path] and 5 * links[path] >= 4 * chars[path]:
                weak.add(path)
            if w.text not in ("", SLOT) and len(host.seen) >= SUPPORT and w.pages >= SUPPORT:
                fixed[path] = w.text
        for child in w.children():
            visit(child, (*path, child.label), inside, in_main)

    visit(host, (), False, False)

    def left(path: tuple) -> int:
        gone = sum(chars[p] for p in drop if p[: len(path)] == path)
        return chars[path] - gone

    whole = left(())
    levels = []
    for found in (articles, mains):
        chosen = [p for p in found if left(p)]
        if chosen and 10 * sum(map(left, chosen)) >= whole:
            levels.append(chosen)
    # The element that most of the remaining text lies in.
    path, node = (), host
    while node is not None:
        below = [
            (left((*path, c.label)), c)
            for c in node.children()
            if (*path, c.label) not in drop and c.most == 1 and c.children()
        ]
        most, child = max(below, key=lambda x: x[0], default=(0, None))
        if child is None or 4 * most < 3 * left(path):
            break
        path, node = (*path, child.label), child
    levels += [[path], [()]]
    return {
        "drop": sorted(drop),
        "weak": sorted(weak),
        "fixed": sorted((p, t) for p, t in fixed.items()),
        "levels": levels,
        "articles": sorted(articles),
        "plain": sorted(plain),
    }


class Reader:
    """Reads the main text of a host's pages by the decisions on its wrapper."""

    def __init__(self, decisions: str):
        made = json.loads(decisions)

        def paths(name: str) -> set[tuple]:
            return {tuple(p) for p in made[name]}

        self.drop, self.weak = paths("drop"), paths("weak")
        self.articles, self.plain = paths("articles"), paths("plain")
        self.fixed = {tuple(p): text for p, text in made["fixed"]}
        self.levels = [{tuple(p) for p in level} for level in made["levels"]]

    def read(self, html: str | None) -> str:
        root = parse(html)
        for level in self.levels:
            blocks: list[str] = []
            self._walk(root, (), level, False, False, blocks, [])
            if blocks:
                return "\n".join(blocks)
        return ""

    def _walk(self, element, path, level, on, article, blocks, pieces) -> None:
        on = on or path in level
        article = article or path in self.articles
        if path in self.drop or (path in self.weak and not article):
            return
        if on and not article and path in self.fixed:
            own = folded([i for i in element.items if isinstance(i, str)])
            if _digest(own) == self.fixed[path]:
                on = False

        def flush() -> None:
            text = folded(pieces)
            pieces.clear()
            if text:
                blocks.append(text)

        plain = path in self.plain
        for item in element.items:
            if item is None:
                flush()
            elif isinstance(item, str):
                if on:
                    pieces.append(item)
            else:
                if not item.inline:
                    flush()
                below = (*path, item.label if plain else item.named)
                self._walk(item, below, level, on, article, blocks, pieces)
                if not item.inline:
                    flush()
        if not path:
            flush()


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; the first path segment without a scheme; '' for null."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[^:/?#]*:)?(?://)?([^/?#]*)", 1)), F.lit(""))


_PARTS = "host string, part long, wrapper string"


def _partial_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge the pages of each host in a partition, holding a bounded number of hosts."""
    held: dict[tuple, Wrapper] = {}

    def rows() -> pd.DataFrame:
        packed = [(host, part, json.dumps(w.packed())) for (host, part), w in held.items()]
        held.clear()
        return pd.DataFrame(packed, columns=["host", "part", "wrapper"])

    for batch in batches:
        for host, part, html in batch[["host", "part", "html"]].itertuples(index=False):
            one = of_page(html if isinstance(html, str) else None)
            if (host, part) in held:
                merge(held[host, part], one)
            else:
                held[host, part] = one
                if len(held) >= HELD:
                    yield rows()
    yield rows()


def _merged(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    packed = sorted(parts["wrapper"])
    whole = Wrapper.unpacked(json.loads(packed[0]))
    for other in packed[1:]:
        merge(whole, Wrapper.unpacked(json.loads(other)))
    return pd.DataFrame([(key[0], key[1], json.dumps(whole.packed()))], columns=["host", "part", "wrapper"])


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, n_pages, expression, decisions): the wrapper of every host, from all its pages.

    Each task aligns its own pages of a host one after the other; the partial wrappers of
    a host are then aligned in rounds of ``FAN_IN`` parts, so neither a task nor the
    driver sees all pages of a host, and a wrapper's size doesn't grow with them. The
    decisions depend on sums and on equal texts only, not on the order of the pages.
    """
    given = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    numbered = given.withColumn("part", F.spark_partition_id().cast("long"))
    parts = store(numbered.mapInPandas(_partial_wrappers, _PARTS))
    last = parts.agg(F.max("part")).first()[0] or 0
    while True:
        wider = parts.withColumn("part", F.floor(F.col("part") / FAN_IN))
        parts = store(wider.groupBy("host", "part").applyInPandas(_merged, _PARTS))
        last //= FAN_IN
        if not last:
            break

    @F.pandas_udf("n_pages long, expression string, decisions string")
    def decided(wrappers: pd.Series) -> pd.DataFrame:
        rows = []
        for packed in wrappers:
            w = Wrapper.unpacked(json.loads(packed))
            rows.append((w.pages, w.expression(), json.dumps(decide(w))))
        return pd.DataFrame(rows, columns=["n_pages", "expression", "decisions"])

    return parts.select("host", decided("wrapper").alias("made")).select("host", "made.*")


@lru_cache(maxsize=1 << 12)
def _reader(decisions: str) -> Reader:
    return Reader(decisions)


def extract_articles(
    pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page, read by its host's wrapper.

    A null or empty page has an empty text, a null url is a host of its own, pages that
    repeat have a row each, long pages are read whole, and other columns are ignored; an
    empty table gives no rows. Elements nested deeper than 120 count as breaks within the
    element at that depth. The wrappers are stored before the join, so Spark knows their
    size: it broadcasts few and shuffles by host, splitting hot hosts, where there are many.
    """
    wrappers = store(infer_wrappers(pages, url, html).select("host", "decisions"))

    @F.pandas_udf("string")
    def read(pages: pd.Series, decisions: pd.Series) -> pd.Series:
        return pd.Series(
            [_reader(d).read(h if isinstance(h, str) else None) for h, d in zip(pages, decisions, strict=True)],
            dtype=object,
        )

    given = pages.select(
        F.col(page).alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    read_by = given.join(wrappers, "host", "left")
    texts = read_by.select("page_id", "url", read("html", "decisions").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
