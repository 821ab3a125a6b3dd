"""A small element tree over the standard library's HTML parser, for the Arrow functions beside it."""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}


class Element:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def has_class(self, name: str) -> bool:
        own = self.attrs.get("class", "")
        return own == name or name in own.split()

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def walk(self):
        for c in self.elements():
            yield c
            yield from c.walk()

    def find_all(self, tag: str, cls: str | None = None, direct: bool = False, **attrs: str) -> list[Element]:
        among = self.elements() if direct else self.walk()
        return [e for e in among if e.tag == tag and (cls is None or e.has_class(cls)) and all(e.attrs.get(k) == v for k, v in attrs.items())]

    def find(self, tag: str, cls: str | None = None, direct: bool = False, **attrs: str) -> Element | None:
        return next(iter(self.find_all(tag, cls, direct, **attrs)), None)

    def following(self) -> list[Element]:
        own = self.parent.elements()
        return own[own.index(self) + 1 :]

    def strings(self):
        for c in self.children:
            if isinstance(c, Element):
                if c.tag not in HIDDEN:
                    yield from c.strings()
            else:
                yield c

    def text(self, separator: str = "") -> str:
        """All texts below, each stripped, joined."""
        return separator.join(s for s in (x.strip() for x in self.strings()) if s)

    def only_string(self) -> str | None:
        """The text of an element that holds a single text, however deep."""
        if len(self.children) != 1:
            return None
        c = self.children[0]
        return c.only_string() if isinstance(c, Element) else c


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data):
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def markdown(e: Element) -> str:
    """Headings, paragraphs, lists, links and emphasis as Markdown; other elements as their text."""

    def inline(node: Element) -> str:
        out = []
        for c in node.children:
            if isinstance(c, str):
                out.append(" ".join(c.split()).join((" " if c[:1].isspace() else "", " " if c[-1:].isspace() and c.strip() else "")))
            elif c.tag in HIDDEN:
                continue
            elif c.tag == "br":
                out.append("\n")
            elif c.tag == "a" and c.attrs.get("href"):
                out.append(f"[{inline(c).strip()}]({c.attrs['href']})")
            elif c.tag in ("b", "strong") and c.text():
                out.append(f"**{inline(c).strip()}**")
            elif c.tag in ("i", "em") and c.text():
                out.append(f"*{inline(c).strip()}*")
            else:
                out.append(inline(c))
        return "".join(out)

    blocks: list[str] = []

    def block(node: Element) -> None:
        loose = Element("p", {}, None)
        for c in [*node.children, None]:
            inner = isinstance(c, Element) and (c.tag in ("p", "ul", "ol", "div", "section", "article", "header", "footer", "table", "tr", "blockquote", "main") or c.tag[:1] == "h" and c.tag[1:].isdigit())
            if c is not None and not inner:
                loose.children.append(c)
                continue
            if said := inline(loose).strip():
                blocks.append(said)
            loose = Element("p", {}, None)
            if c is None:
                continue
            if c.tag[1:].isdigit():
                blocks.append("#" * int(c.tag[1:]) + " " + inline(c).strip())
            elif c.tag in ("ul", "ol"):
                items = c.find_all("li", direct=True)
                blocks.append("\n".join(f"{'*' if c.tag == 'ul' else f'{k}.'} {inline(x).strip()}" for k, x in enumerate(items, 1)))
            elif c.tag == "tr":
                blocks.append("| " + " | ".join(inline(x).strip() for x in c.elements()) + " |")
            else:
                block(c)

    block(e)
    return "\n\n".join(b for b in blocks if b.strip())
