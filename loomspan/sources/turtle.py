"""A small reader and writer of Turtle and N-Triples for the driver: mappings are a few hundred triples."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import urljoin

from ..names import RDF, XSD


@dataclass(frozen=True)
class Iri:
    value: str


@dataclass(frozen=True)
class Blank:
    label: str


@dataclass(frozen=True)
class Literal:
    text: str
    datatype: str | None = None
    language: str | None = None


Term = Iri | Blank | Literal


class Graph:
    """Triples in document order, without repeats."""

    def __init__(self, triples: Iterable[tuple[Term, Iri, Term]] = ()):
        self.triples: dict[tuple[Term, Iri, Term], None] = {}
        self._of: dict[Term, list[tuple[Iri, Term]]] = {}
        self.prefixes: dict[str, str] = {}
        for t in triples:
            self.add(*t)

    def add(self, s: Term, p: Iri, o: Term) -> None:
        if (s, p, o) not in self.triples:
            self.triples[s, p, o] = None
            self._of.setdefault(s, []).append((p, o))

    def objects(self, s: Term, p: str) -> list[Term]:
        return [o for q, o in self._of.get(s, []) if q.value == p]

    def value(self, s: Term, p: str) -> Term | None:
        return next(iter(self.objects(s, p)), None)

    def subjects(self, p: str, o: Term | None = None) -> list[Term]:
        return list(dict.fromkeys(s for s, q, x in self.triples if q.value == p and (o is None or x == o)))

    def reachable(self, roots: Iterable[Term]) -> set[Term]:
        """Blank nodes below ``roots``, and the roots."""
        seen, todo = set(), list(roots)
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += [o for _, o in self._of.get(at, []) if isinstance(o, Blank)]
        return seen


_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
    |(?P<long>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3})
    |(?P<short>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<iri><[^<>"{}|^`\s]*>)
    |(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<caret>\^\^)
    |(?P<blank>_:[\w.-]*\w)
    |(?P<number>[+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)|\.\d+(?:[eE][+-]?\d+)?|\d+\.\d+|\d+))
    |(?P<name>(?:[^\W\d_][\w.-]*)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])(?:(?:[\w:.-]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])*(?:[\w:-]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%]))?)?)
    |(?P<word>[A-Za-z]+)
    |(?P<mark>[.;,\[\]()])""",
    re.X | re.S,
)
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.S)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _PLAIN.get(m[3], m[3]), text)


class TurtleError(ValueError):
    pass


class _Reader:
    def __init__(self, text: str, base: str):
        self.base, self.graph, self.blanks = base, Graph(), 0
        self.tokens: list[tuple[str, str, int]] = []
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TurtleError(f"line {text.count(chr(10), 0, at) + 1}: cannot read {text[at : at + 30]!r}")
            if m.lastgroup != "skip":
                self.tokens.append((m.lastgroup, m[0], at))
            at = m.end()
        self.text, self.at = text, 0

    def fail(self, what: str) -> TurtleError:
        at = self.tokens[self.at][2] if self.at < len(self.tokens) else len(self.text)
        return TurtleError(f"line {self.text.count(chr(10), 0, at) + 1}: {what}")

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at][:2] if self.at < len(self.tokens) else ("end", "")

    def take(self, mark: str | None = None) -> tuple[str, str]:
        kind, text = self.peek()
        if kind == "end" or mark is not None and text != mark:
            raise self.fail(f"expected {mark or 'more'}, found {text or 'the end'}")
        self.at += 1
        return kind, text

    def iri(self, text: str) -> Iri:
        own = _unescaped(text[1:-1])
        if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", own):
            return Iri(own)
        return Iri(self.base.split("#")[0] + own if own.startswith("#") or not own else urljoin(self.base, own))

    def name(self, text: str) -> Iri:
        prefix, local = text.split(":", 1)
        if prefix not in self.graph.prefixes:
            raise self.fail(f"prefix {prefix}: is not declared")
        return Iri(self.graph.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local))

    def document(self) -> Graph:
        while self.peek()[0] != "end":
            kind, text = self.peek()
            if kind == "at" and text in ("@prefix", "@base") or kind == "word" and text.lower() in ("prefix", "base"):
                self.take()
                if text.lower().lstrip("@") == "prefix":
                    prefix = self.take()[1]
                    self.graph.prefixes[prefix[:-1]] = self.iri(self.take()[1]).value
                else:
                    self.base = self.iri(self.take()[1]).value
                if text.startswith("@"):
                    self.take(".")
                continue
            subject = self.term()
            if not (isinstance(subject, Blank) and self.peek()[1] == "."):
                self.properties(subject)
            self.take(".")
        return self.graph

    def properties(self, subject: Term) -> None:
        while True:
            kind, text = self.take()
            verb = Iri(RDF + "type") if (kind, text) == ("word", "a") else self.iri(text) if kind == "iri" else self.name(text) if kind == "name" else None
            if verb is None:
                raise self.fail(f"{text} is no predicate")
            self.graph.add(subject, verb, self.term())
            while self.peek()[1] == ",":
                self.take()
                self.graph.add(subject, verb, self.term())
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]", ""):
                return

    def fresh(self) -> Blank:
        self.blanks += 1
        return Blank(f"b{self.blanks}")

    def term(self) -> Term:
        kind, text = self.take()
        if kind == "iri":
            return self.iri(text)
        if kind == "name":
            return self.name(text)
        if kind == "blank":
            return Blank(text[2:])
        if kind in ("long", "short"):
            n = 3 if kind == "long" else 1
            body = _unescaped(text[n:-n])
            after, word = self.peek()
            if after == "at":
                self.take()
                return Literal(body, None, word[1:].lower())
            if after == "caret":
                self.take()
                return Literal(body, self.term().value)
            return Literal(body)
        if kind == "number":
            return Literal(text, XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"))
        if kind == "word" and text in ("true", "false"):
            return Literal(text, XSD + "boolean")
        if text == "[":
            node = self.fresh()
            if self.peek()[1] != "]":
                self.properties(node)
            self.take("]")
            return node
        if text == "(":
            members = []
            while self.peek()[1] != ")":
                members.append(self.term())
            self.take(")")
            node: Term = Iri(RDF + "nil")
            for member in reversed(members):
                cell = self.fresh()
                self.graph.add(cell, Iri(RDF + "first"), member)
                self.graph.add(cell, Iri(RDF + "rest"), node)
                node = cell
            return node
        raise self.fail(f"unexpected {text}")


def parse_turtle(text: str, base: str = "urn:mapping") -> Graph:
    """Read Turtle or N-Triples; relative IRIs such as <#X> are below ``base``."""
    return _Reader(text.lstrip("﻿"), base).document()


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t")


def term_text(t: Term) -> str:
    if isinstance(t, Iri):
        return f"<{t.value}>"
    if isinstance(t, Blank):
        return f"_:{t.label}"
    tail = f"@{t.language}" if t.language else f"^^<{t.datatype}>" if t.datatype else ""
    return f'"{escaped(t.text)}"{tail}'


def write_turtle(graph: Graph) -> str:
    """The graph in Turtle, a subject to a paragraph."""
    subjects: dict[Term, list[str]] = {}
    for s, p, o in graph.triples:
        subjects.setdefault(s, []).append(f"{'a' if p.value == RDF + 'type' else term_text(p)} {term_text(o)}")
    return "\n\n".join(f"{term_text(s)} " + " ;\n  ".join(rows) + " ." for s, rows in subjects.items()) + "\n"


def write_ntriples(graph: Graph) -> str:
    return "".join(f"{term_text(s)} {term_text(p)} {term_text(o)} .\n" for s, p, o in graph.triples)
