"""A small element tree over the lexer, with the lenient rules of a tag-soup parser.

An end tag closes the nearest open element of its name and what is open inside
it, or is ignored; nothing else closes an element but the end of the page.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from .tokens import START, TEXT, VOID, attributes, decoded, tokens

#: Elements whose text is not text of the elements around them.
SILENT = frozenset(("script", "style", "template"))


class Element:
    __slots__ = ("_attrs", "_raw", "kids", "tag")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self._raw, self._attrs = tag, raw, None
        self.kids: list[Element | str] = []

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = attributes(self._raw) if self._raw else {}
        return self._attrs

    def get(self, name: str) -> str | None:
        return self.attrs.get(name)

    def walk(self) -> Iterator[Element]:
        """All elements inside, in document order."""
        todo = [k for k in reversed(self.kids) if isinstance(k, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo += [k for k in reversed(e.kids) if isinstance(k, Element)]

    def find(self, tags: Iterable[str] | None = None, class_has: Iterable[str] = (), attr: str | None = None) -> Iterator[Element]:
        """Elements inside with one of the tags, a class that contains one of the words, and the attribute."""
        for e in self.walk():
            if tags is not None and e.tag not in tags:
                continue
            if attr is not None and attr not in e.attrs:
                continue
            if class_has:
                value = e.attrs.get("class", "").lower()
                if not any(word in value for word in class_has):
                    continue
            yield e

    def text(self) -> str:
        """Its pieces of text, each stripped, joined with nothing between them."""
        out, todo = [], list(reversed(self.kids))
        while todo:
            k = todo.pop()
            if isinstance(k, str):
                out.append(k.strip())
            elif k.tag not in SILENT:
                todo += reversed(k.kids)
        return "".join(out)


def parse(html: str) -> Element:
    root = Element("#document")
    stack, count = [root], {}
    pending: list[str] = []  # text between two tags is one piece

    def flush() -> None:
        if pending:
            stack[-1].kids.append(decoded("".join(pending)))
            pending.clear()

    for kind, name, raw in tokens(html):
        if kind == TEXT:
            pending.append(name)
            continue
        flush()
        if kind == START:
            e = Element(name, raw)
            stack[-1].kids.append(e)
            if name not in VOID:
                stack.append(e)
                count[name] = count.get(name, 0) + 1
        elif count.get(name):
            while True:
                e = stack.pop()
                count[e.tag] -= 1
                if e.tag == name:
                    break
    flush()
    return root
