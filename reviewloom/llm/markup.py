"""A small HTML tree builder: tags cut out by one pattern, implied tags put in, visibility worked out."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
#: Comments, strings and escapes, in which braces don't count, and the marks that do.
_CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*(?:\"|(?=\n)|\Z)|'(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z)|\\.|[{};]", re.DOTALL)
_WHITE = " \t\n\f\r"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Never shown, whatever their style (a page with scripts shows no noscript).
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes datalist object audio video canvas".split())
#: Never shown inside svg, which shows text elements and foreignObject only, and inside math.
UNDRAWN = frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc metadata".split())
NOTES = frozenset("annotation annotation-xml mphantom".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary ul xmp"
    " table caption".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir xmp".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = BLOCK - frozenset("body html option optgroup caption legend li dd dt".split()) | frozenset("li dd dt".split())
_IN_HEAD = frozenset("base link meta title style script noscript template".split())
_TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
_ROWS_OF = frozenset("thead tbody tfoot".split())
#: Start tag: (open elements that it ends, elements beyond which they aren't looked for).
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **{t: (_ROWS_OF | {"caption", "colgroup"}, {"table"}) for t in (*_ROWS_OF, "caption", "colgroup")},
}
#: Elements of pages that end an open svg or math, unless one of ``_PAGE_IN`` comes first.
_BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s"
    " small span strong strike sub sup table tt u ul var".split()
)
_FOREIGN = frozenset({"svg", "math"})
_PAGE_IN = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
_SCOPE = frozenset("table td th caption template object html".split())


@dataclass(eq=False)
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)
    #: How far selectors are matched down to here: (by this element or one around it, by this element).
    matched: tuple[frozenset, frozenset] | None = None


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.stack = [self.root]
        #: Places in the stack of the open elements of each tag, so that none has to be looked for.
        self.places: dict[str, list[int]] = {}
        #: What doesn't belong in a table stands before it; it is put there when the page has ended.
        self.before: dict[Node, list[Node | str]] = {}
        self.styles: list[str] = []
        self.foreign = False  # whether the page has svg or math

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def _cut(self, at: int) -> None:
        """Close all elements from a place of the stack on."""
        for node in self.stack[at:]:
            self.places[node.tag].pop()
        del self.stack[at:]

    def _innermost(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _open(self, tags, beyond) -> int | None:
        """Place of the innermost open element of ``tags``, None if one of ``beyond`` is further in."""
        at = self._innermost(tags)
        return at if at and at >= self._innermost(beyond) else None

    def _end(self, tags, beyond) -> bool:
        at = self._open(tags, beyond)
        if at:
            self._cut(at)
        return bool(at)

    def _add(self, child: Node | str, of_table: bool = False) -> None:
        parent = self.stack[-1]
        if parent.tag in _TABLE_PARTS and not of_table:
            table = self.stack[self._innermost(("table",))]
            if table.parent:
                self.before.setdefault(table, []).append(child)
                parent = table.parent
            else:
                parent = self.root
                parent.children.append(child)
        else:
            parent.children.append(child)
        if isinstance(child, Node):
            child.parent = parent

    def finish(self) -> Node:
        """The tree, with what stood wrongly in tables put before them."""
        for parent in {table.parent: None for table in self.before}:
            waiting, done = parent.children[::-1], []
            while waiting:
                child = waiting.pop()
                # A table that stands before another may have something before it, too.
                if first := self.before.pop(child, None) if isinstance(child, Node) else None:
                    waiting += [child, *reversed(first)]
                else:
                    done.append(child)
            parent.children = done
        return self.root

    def text(self, data: str) -> None:
        if self.stack[-1].tag == "head" and data.strip(_WHITE):
            self._cut(len(self.stack) - 1)
        if self.stack[-1].tag in _TABLE_PARTS and not data.strip(_WHITE):
            return
        self._add(unescape(data) if "&" in data else data)

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> None:
        if self.foreign and tag in _BREAKS:
            self._end(_FOREIGN, _PAGE_IN)
        if tag in ("html", "body"):
            if tag == "body":
                self._end({"head"}, ())
            for name, value in attributes.items():
                self.root.attributes.setdefault(name, value)
            return
        if self.stack[-1].tag == "head" and tag not in _IN_HEAD:
            self._cut(len(self.stack) - 1)
        if tag in _CLOSES_P:
            self._end({"p"}, _SCOPE | {"button"})
        if tag in _HEADINGS and self.stack[-1].tag in _HEADINGS:
            self._cut(len(self.stack) - 1)
        if tag in _ENDS:
            self._end(*_ENDS[tag])
        of_table = False
        if tag in ("td", "th", "tr", *_ROWS_OF, "caption", "colgroup", "col"):
            of_table = self._open({"table"}, {"td", "th", "caption"}) is not None
            if not of_table:
                if tag in ("td", "th", "tr"):
                    return  # outside a table only its content counts
            elif tag in ("td", "th") and self._open({"tr"}, {"table"}) is None:
                row = Node("tr")
                self._add(row, True)
                self._push(row)
        node = Node(tag, attributes)
        self._add(node, of_table or tag in ("script", "style", "template"))
        self.foreign |= tag in _FOREIGN
        if tag not in VOID and not (closed and (tag in _FOREIGN or self.foreign and self._open(_FOREIGN, _PAGE_IN))):
            self._push(node)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._add(Node("br"))
            return
        if tag in _HEADINGS:
            self._end(_HEADINGS, _SCOPE)
        elif tag in _TABLE_PARTS | {"td", "th", "caption"}:
            self._end({tag}, {"table"} - {tag} | ({"td", "th"} if tag in ("tr", *_ROWS_OF) and self._open({tag}, {"table"}) is None else set()))
        elif not self._end({tag}, _SCOPE - {tag}) and tag == "p":
            self._add(Node("p"))


def build(html: str) -> tuple[Node, list[str]]:
    """The tree of a page, and the texts of its style sheets."""
    builder = _Builder()
    at, size = 0, len(html)
    while at < size:
        match = _TAG.search(html, at)
        if not match:
            builder.text(html[at:])
            break
        if match.start() > at:
            builder.text(html[at : match.start()])
        at = match.end()
        if tag := match["start"]:
            tag = tag.lower()
            given = match["attributes"]
            attributes = _attributes(given) if given else {}
            builder.start(tag, attributes, given.endswith("/"))
            if tag in RAW and builder.stack[-1].tag == tag:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
                end = close.start() if close else size
                content = html[at:end]
                if tag == "style":
                    if _on_screen(attributes.get("media", "")):
                        builder.styles.append(content)
                elif tag in ("textarea", "xmp"):
                    builder._add(unescape(content) if tag == "textarea" else content)
                at = end
        elif match["end"]:
            builder.end(match["end"].lower())
    return builder.finish(), builder.styles


#: Property: (value, whether it is marked as important).
Declared = dict[str, tuple[str, bool]]


def _declared(style: str) -> Declared:
    found: Declared = {}
    for declaration in style.lower().split(";"):
        name, _, value = declaration.partition(":")
        if (name := name.strip()) in ("display", "visibility", "text-align", "white-space"):
            value, mark, _ = value.partition("!")
            important = bool(mark) and declaration.rpartition("!")[2].strip() == "important"
            if important or not found.get(name, ("", False))[1]:
                found[name] = (value.strip(), important)
    return found


def _on_screen(media: str) -> bool:
    """Whether a list of media queries is known to hold on a screen, whatever its size and settings."""
    queries = [" ".join(q.lower().split()) for q in media.split(",")]
    return not media.strip() or any(re.fullmatch(r"(only )?(all|screen)|not (?!(all|screen|only)$)[a-z-]+", q) for q in queries)


def _applies(prelude: str) -> bool:
    """Whether the rules in a block are known to apply: those of a layer, and of media queries that hold."""
    match = re.match(r"@(layer|media)(?![\w-])(.*)", prelude, re.DOTALL | re.IGNORECASE)
    return bool(match) and (match[1].lower() == "layer" or _on_screen(match[2]))


def _rules(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the style rules that are known to apply on a screen.

    Rules in other at-rules (print, widths, ``@supports``, ``@container``, key frames), and rules in rules, are left out.
    """
    css = _CSS.sub(lambda m: "" if m[0].startswith("/*") else m[0], css)
    blocks: list[tuple[str, list[str]]] = []  # what stands before an open block, and its declarations
    begin = 0
    for mark in _CSS.finditer(css):
        if mark[0] not in ("{", "}", ";"):
            continue
        before, begin = css[begin : mark.start()], mark.end()
        if mark[0] == "{":
            blocks.append((before.strip(), []))
        elif blocks:
            blocks[-1][1].append(before)
            if mark[0] == "}":
                prelude, declarations = blocks.pop()
                if not prelude.startswith("@") and all(_applies(outer) for outer, _ in blocks):
                    yield prelude, ";".join(declarations)


_COMPOUND = re.compile(r"(?:\*|[a-z][a-z0-9-]*)?(?:[.#][\w-]+|\[\s*[\w-]+\s*(?:=\s*(?:\"[^\"]*\"|'[^']*'|[\w-]+)\s*)?\]|:not\([^()]*\))*", re.IGNORECASE)
_PART = re.compile(r":not\(([^()]*)\)|([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([\w-]+))\s*)?\]", re.IGNORECASE)


@dataclass(frozen=True)
class Compound:
    """Tests of one element: tag, id, classes, attributes (None: any value), and compounds that must not match."""

    tag: str
    ids: frozenset[str]
    classes: frozenset[str]
    attributes: tuple[tuple[str, str | None], ...]
    nots: tuple[Compound, ...]

    @property
    def weight(self) -> tuple[int, int, int]:
        own = (len(self.ids), len(self.classes) + len(self.attributes), int(bool(self.tag)))
        return tuple(sum(w) for w in zip(own, *[n.weight for n in self.nots], strict=True))

    @property
    def key(self) -> str:
        """What an element must have to be tested at all."""
        return next((f"#{i}" for i in self.ids), next((f".{c}" for c in self.classes), self.tag))

    def match(self, node: Node, classes: set[str]) -> bool:
        given = node.attributes
        return (
            (not self.tag or self.tag == node.tag) and self.ids <= {given.get("id", "")} and self.classes <= classes
            and all(n in given and (v is None or given[n] == v) for n, v in self.attributes)
            and not any(n.match(node, classes) for n in self.nots)
        )


def _compound(text: str) -> Compound | None:
    if not text or not _COMPOUND.fullmatch(text):
        return None
    tag = re.match(r"\*|[a-z][a-z0-9-]*", text, re.IGNORECASE)
    ids, classes, attributes, nots = set(), set(), [], []
    for part in _PART.finditer(text):
        if part[2]:
            (ids if part[2] == "#" else classes).add(part[3])
        elif part[4]:
            attributes.append((part[4].lower(), next((v for v in part.group(5, 6, 7) if v is not None), None)))
        else:
            found = [_compound(x.strip()) for x in part[1].split(",")]
            if None in found:
                return None
            nots += found
    name = tag[0].lower() if tag and tag[0] != "*" else ""
    return Compound(name, frozenset(ids), frozenset(classes), tuple(attributes), tuple(nots))


def _selector(text: str) -> list[tuple[str, Compound]] | None:
    """(what joins it to the one before, compound) from the outermost on; None for a selector with anything else in it."""
    spaced = re.sub(r"\s*>\s*", " > ", text.strip())
    # Blanks inside of brackets join nothing.
    words = re.findall(r"(?:\[[^\]]*\]|\([^()]*\)|[^\s\[(])+", spaced)
    found, joint = [], " "
    for word in words:
        if word == ">":
            if joint == ">" or not found:
                return None
            joint = ">"
            continue
        compound = _compound(word)
        if compound is None:
            return None
        found.append((joint, compound))
        joint = " "
    return found if found and joint == " " else None


class Sheet:
    """Rules of a page's style sheets that bear on visibility and layout, with the cascade: importance, inline styles, weight, order.

    Selectors are compounds of tag, class, id, attribute and ``:not``, joined as descendants or children; rules with other
    selectors, and rules that apply only under a condition not known to hold on a screen, hide nothing. A selector is followed
    from the outside in: each element takes over how far it has matched around it, so no element looks at those around it again.
    """

    def __init__(self, styles: list[str]) -> None:
        #: What an element has: the (selector, place in it, joint, compound) to be tested.
        self.tests: dict[str, list[tuple[int, int, str, Compound]]] = {}
        self.rules: list[tuple[int, tuple[int, int, int], Declared]] = []  # (last place, weight, declarations) per selector
        for style in styles:
            for selectors, body in _rules(style):
                if declared := _declared(body):
                    for text in re.findall(r"(?:\[[^\]]*\]|\([^()]*\)|[^,\[(])+", selectors):
                        if parts := _selector(text):
                            for place, (joint, compound) in enumerate(parts):
                                self.tests.setdefault(compound.key, []).append((len(self.rules), place, joint, compound))
                            weight = tuple(map(sum, zip(*[c.weight for _, c in parts], strict=True)))
                            self.rules.append((len(parts) - 1, weight, declared))

    def _matched(self, node: Node) -> tuple[frozenset, frozenset]:
        """Follow the selectors down to ``node``, from the innermost element around it that has been reached."""
        path = []
        at: Node | None = node
        while at is not None and at.matched is None:
            path.append(at)
            at = at.parent
        around, outer = at.matched if at is not None else (frozenset(), frozenset())
        for at in reversed(path):
            classes = set(at.attributes.get("class", "").split())
            keys = ["", at.tag, *[f".{c}" for c in classes]]
            if "id" in at.attributes:
                keys.append(f"#{at.attributes['id']}")
            here = frozenset(
                (rule, place) for key in keys for rule, place, joint, compound in self.tests.get(key, ())
                if (not place or (rule, place - 1) in (outer if joint == ">" else around)) and compound.match(at, classes)
            )
            around, outer = (around if here <= around else around | here), here
            at.matched = (around, outer)
        return around, outer

    def style(self, node: Node) -> dict[str, str]:
        best: dict[str, tuple[tuple, str]] = {}
        if "hidden" in node.attributes:
            best["display"] = ((False, -1), "none")

        def offer(declared: Declared, rank: tuple) -> None:
            for name, (value, important) in declared.items():
                if name not in best or (important, *rank) >= best[name][0]:
                    best[name] = ((important, *rank), value)

        if self.rules:
            for rule, place in self._matched(node)[1]:
                last, weight, declared = self.rules[rule]
                if place == last:
                    offer(declared, (0, weight, rule))
        if "style" in node.attributes:
            offer(_declared(node.attributes["style"]), (1,))
        return {name: value for name, (_, value) in best.items()}
