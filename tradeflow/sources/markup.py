"""Selecting elements of HTML pages: a selector matcher over one pass of the page's tags.

``Selector`` is a list of chains (``table tr td a``, ``div.files > a[href]``).  A page's tags are read once,
with a stack of the open elements; each carries how far every chain has got, so an element is
matched when its start tag is read and the time is linear in the page.  Text inside ``script`` and ``style`` is no markup,
entities in attributes are decoded, and end tags that HTML leaves out are supplied for cells, rows, items and options.

A page whose every ``<`` starts a plainly written tag or comment is cut by one regular expression (``Reader``);
any other page is read by the standard library's parser, which is several times slower.  Both give the same elements.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

_COMPOUND = re.compile(r"\*|[A-Za-z][\w-]*|[.#][\w-]+|\[\s*[\w-]+\s*(?:=\s*(?:\"[^\"]*\"|'[^']*'|[\w./-]+)\s*)?\]")
_ATTRIBUTE = re.compile(r"\[\s*([\w-]+)\s*(?:=\s*(.*?)\s*)?\]", re.S)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag ends an open element of these kinds, up to the nearest of the last ones.
CLOSES = {
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)), "thead": (("tbody", "thead", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)), "li": (("li",), ("ul", "ol")), "option": (("option",), ("select",)),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "a": (("a",), ("table", "td", "th")),
}


_WS = r"[ \t\n\r\f]"
_NAME = r"[a-zA-Z][a-zA-Z0-9_-]*+"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'=<>`]++(?<!/))"
#: Text, and one plainly written token: an end tag, a start tag with its attributes, or a comment without "--" inside.
_TOKEN = re.compile(
    rf"[^<]*+<(?:/([a-zA-Z][a-zA-Z0-9]*+){_WS}*+>|([a-zA-Z][a-zA-Z0-9]*+)((?:{_WS}++{_NAME}(?:{_WS}*+={_WS}*+{_VALUE}|(?!{_WS}*+=)))*+){_WS}*+/?>|!--(?!-?>)(?:[^-]++|-(?!-))*+-->)"
)
_PAIR = re.compile(rf"({_NAME})(?:{_WS}*+={_WS}*+({_VALUE}))?")
#: Their text is no markup (or only in part), up to their end tag; the plain reader knows the first two.
_TEXT_END = {t: re.compile(rf"</{t}(?![^\t\n\r\f />])", re.I) for t in ("script", "style")}
_TEXT = frozenset("textarea title iframe noembed noframes xmp plaintext noscript svg math".split())
#: References that every version of the standard library decodes alike.
_PLAIN_REFERENCES = re.compile(r"(?:[^&]++|&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|amp|lt|gt|quot);)*+")


@dataclass(frozen=True)
class Step:
    """One compound of a chain: what the element must be, and whether its parent must match the step before."""

    tag: str | None
    attributes: tuple[tuple[str, str | None], ...]
    child: bool

    def fits(self, tag: str, attributes: dict[str, str]) -> bool:
        if self.tag not in (None, tag):
            return False
        for name, value in self.attributes:
            given = attributes.get(name)
            if given is None or (value is not None and (value not in given.split() if name == "class" else value != given)):
                return False
        return True


def selector(text: str) -> list[list[Step]]:
    """The chains of a selector: tags, ``*``, ``.class``, ``#id``, ``[attribute]``, ``[attribute=value]``, descendants and children."""
    chains = []
    for part in re.split(r",(?![^\[]*\])", text):
        steps, at, child, part = [], 0, False, part.strip()
        while at < len(part):
            tag, attributes, begin = None, [], at
            while at < len(part) and (m := _COMPOUND.match(part, at)):
                token = m.group()
                if token[0] in ".#":
                    attributes.append(("class" if token[0] == "." else "id", token[1:]))
                elif token[0] == "[":
                    name, value = _ATTRIBUTE.match(token).groups()
                    attributes.append((name.lower(), value.strip("\"'") if value is not None else None))
                elif at > begin:
                    break
                elif token != "*":
                    tag = token.lower()
                at = m.end()
            if at == begin:
                raise ValueError(f"not a supported selector: {text!r} at {part[at:]!r}")
            steps.append(Step(tag, tuple(attributes), child))
            gap = re.compile(r"\s*>\s*|\s+").match(part, at)
            if at < len(part) and not gap:
                raise ValueError(f"not a supported selector: {text!r} at {part[at:]!r}")
            child = bool(gap) and ">" in gap.group()
            at = gap.end() if gap else at
            if child and at == len(part):
                raise ValueError(f"not a supported selector: {text!r} ends with '>'")
        if not steps:
            raise ValueError(f"empty selector in {text!r}")
        chains.append(steps)
    return chains


_NONE: frozenset = frozenset()


class Matcher(HTMLParser):
    """Collects one attribute of the elements that a selector matches, in page order (None: the element lacks it)."""

    def __init__(self, chains: list[list[Step]], attribute: str):
        super().__init__(convert_charrefs=True)
        self.chains, self.attribute = chains, attribute
        self.found: list[str | None] = []
        # Each open element: its tag, the steps it matches itself, and those that it or an element around it matches.
        self.open: list[tuple[str, frozenset, frozenset]] = []
        self.count: dict[str, int] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._supply_ends(tag)
        given = {k: v or "" for k, v in reversed(attrs)}  # of repeated attributes the first counts
        parent, around = self.open[-1][1:] if self.open else (frozenset(), frozenset())
        own = set()
        for c, chain in enumerate(self.chains):
            for k, step in enumerate(chain):
                if (k == 0 or (c, k - 1) in (parent if step.child else around)) and step.fits(tag, given):
                    own.add((c, k))
        if any((c, len(chain) - 1) in own for c, chain in enumerate(self.chains)):
            self.found.append(given.get(self.attribute))
        if tag not in VOID:
            own = frozenset(own)
            self.open.append((tag, own, around | own if own else around))
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends void elements only, as in HTML

    def handle_endtag(self, tag: str) -> None:
        if self.count.get(tag):
            while self._close() != tag:
                pass

    def _close(self) -> str:
        tag = self.open.pop()[0]
        self.count[tag] -= 1
        return tag

    def _supply_ends(self, tag: str) -> None:
        ended = _ended(self.open, self.count, tag) if tag in CLOSES else None
        while ended is not None and len(self.open) > ended:
            self._close()


class Reader:
    """Selects on many pages: plainly written ones by one regular expression, with the steps' outcomes remembered; others by ``Matcher``."""

    #: So many outcomes are kept.
    KEPT = 4096

    def __init__(self, chains: list[list[Step]], attribute: str = "href"):
        self.chains, self.attribute = chains, attribute
        self.tags = {step.tag for chain in chains for step in chain}  # None: some step fits any tag
        self.names = sorted({name for chain in chains for step in chain for name, _ in step.attributes})
        self.outcomes: dict[tuple, tuple] = {}
        self.tells: dict[str, tuple] = {}

    def select(self, html: str | None) -> list[str]:
        """The values of the attribute on the matched elements that have it."""
        html = html or ""
        found = self.plain(html)
        if found is None:
            matcher = Matcher(self.chains, self.attribute)
            matcher.feed(html)
            matcher.close()
            found = matcher.found
        return [v for v in found if v is not None]

    def _told(self, text: str) -> tuple[tuple, str | None]:
        """Of a tag's attributes the values that steps compare, and the wanted one as it is written."""
        given: dict[str, str] = {}
        for name, value in _PAIR.findall(text):
            given.setdefault(name.lower(), value)
        if len(self.tells) >= self.KEPT:
            self.tells.clear()
        out = self.tells[text] = tuple([_value(given.get(name)) for name in self.names]), given.get(self.attribute)
        return out

    def _outcome(self, tag: str, values: tuple, parent: frozenset, around: frozenset) -> tuple[frozenset, frozenset, bool]:
        """The steps an element matches, those that it or an element around it matches, and whether it is selected."""
        given = {k: v for k, v in zip(self.names, values) if v is not None}
        own = frozenset(
            (c, k) for c, chain in enumerate(self.chains) for k, step in enumerate(chain)
            if (k == 0 or (c, k - 1) in (parent if step.child else around)) and step.fits(tag, given)
        )
        if len(self.outcomes) >= self.KEPT:
            self.outcomes.clear()
        out = self.outcomes[tag, values, parent, around] = own, around | own, any((c, len(chain) - 1) in own for c, chain in enumerate(self.chains))
        return out

    def plain(self, html: str) -> list[str | None] | None:
        """As ``Matcher.found``; None where a tag is not plainly written: the page is to be parsed instead."""
        token, outcomes, tells = _TOKEN.match, self.outcomes, self.tells
        tags, every = self.tags, None in self.tags
        found: list[str | None] = []
        opened: list[tuple[str, frozenset, frozenset]] = []
        count: dict[str, int] = {}
        at, parent, around = 0, _NONE, _NONE
        while m := token(html, at):
            at = m.end()
            ended, tag, text = m.groups()
            if ended:
                ended = ended.lower()
                if count.get(ended):
                    while True:
                        last = opened.pop()[0]
                        count[last] -= 1
                        if last == ended:
                            break
                    _, parent, around = opened[-1] if opened else ("", _NONE, _NONE)
                continue
            if not tag:
                continue
            tag = tag.lower()
            if tag in _TEXT:
                return None
            if tag in CLOSES and (ended_at := _ended(opened, count, tag)) is not None:
                for last, _, _ in opened[ended_at:]:
                    count[last] -= 1
                del opened[ended_at:]
                _, parent, around = opened[-1] if opened else ("", _NONE, _NONE)
            own, inside = _NONE, around
            if every or tag in tags:
                values, written = tells.get(text) or self._told(text)
                if _ODD in values:
                    return None
                known = outcomes.get((tag, values, parent, around)) or self._outcome(tag, values, parent, around)
                own, inside, selected = known
                if selected:
                    value = _value(written)
                    if value is _ODD:
                        return None
                    found.append(value)
            if tag not in VOID:
                opened.append((tag, own, inside))
                count[tag] = count.get(tag, 0) + 1
                parent, around = own, inside
            if tag in _TEXT_END:
                close = _TEXT_END[tag].search(html, at)
                if html[at - 2] == "/" or not close or html.find("<!--", at, close.start()) >= 0:
                    return None
                at = close.start()
        return found if html.find("<", at) < 0 else None


#: Stands for a value whose references not every version of the standard library decodes alike; no value can hold it.
_ODD = "\0&"


def _value(value: str | None) -> str | None:
    """An attribute's value as written in a tag, decoded."""
    if not value:
        return value
    if value[0] in "\"'":
        value = value[1:-1]
    if "&" not in value:
        return value
    return unescape(value) if _PLAIN_REFERENCES.fullmatch(value) else _ODD


def _ended(opened: list[tuple], count: dict[str, int], tag: str) -> int | None:
    """The place of the first open element that a start tag ends, with all in it; None if it ends none."""
    ends, limits = CLOSES[tag]
    for t in ends:
        if count.get(t):
            break
    else:
        return None
    for k in range(len(opened) - 1, -1, -1):
        if opened[k][0] in limits:
            k += 1
            break
    return next((i for i in range(k, len(opened)) if opened[i][0] in ends), None)


def select(html: str | None, chains: list[list[Step]], attribute: str = "href") -> list[str]:
    """The values of ``attribute`` on the matched elements that have it."""
    return Reader(chains, attribute).select(html)


__all__ = ["selector", "select", "Matcher", "Reader", "Step"]
