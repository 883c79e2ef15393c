"""What a mapping compiles to: a small tree on the driver, never distributed."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Literal as Choice

_FIELD = re.compile(r"\{([^{}]*)\}")


@dataclass(frozen=True)
class Template:
    """Text with {fields}."""

    text: str

    @property
    def fields(self) -> list[str]:
        return _FIELD.findall(self.text)

    @property
    def parts(self) -> list[tuple[str, bool]]:
        """(text or field, whether it is a field)."""
        return [(p, k % 2 == 1) for k, p in enumerate(_FIELD.split(self.text)) if p or k % 2]

    @property
    def dynamic(self) -> bool:
        return "{" in self.text


@dataclass(frozen=True)
class Source:
    kind: Choice["json", "csv", "parquet", "sql", "table"]
    path: str = ""
    iterator: str = ""
    query: str = ""


@dataclass(frozen=True)
class EntitySpec:
    kind: Choice["item", "property"]
    template: Template | None = None
    explicit_id: Template | None = None
    classes: tuple[str, ...] = ()
    property_type: str | None = None

    @property
    def key(self) -> Template:
        """The key inside statement names: the template before the id."""
        return self.template or self.explicit_id


@dataclass(frozen=True)
class ValueSpec:
    kind: Choice["reference", "constant", "template", "entity", "parent"]
    text: str = ""
    entity: EntitySpec | None = None
    datatype: str | None = None
    language: str | None = None
    parent: str | None = None
    conditions: tuple[tuple[str, str], ...] = ()

    @property
    def suffix(self) -> str:
        """What the value adds to its statement's name: one rule for statements, ranks, qualifiers and references."""
        if self.kind == "reference":
            return "_{" + self.text + "}"
        if self.kind == "entity":
            return "_" + self.entity.key.text
        if self.kind == "parent":
            return "_{" + self.conditions[0][0] + "}" if self.conditions else ""
        return "_" + self.text if self.kind == "template" else ""


@dataclass(frozen=True)
class TermMap:
    kind: Choice["label", "description", "alias"]
    value: ValueSpec


@dataclass(frozen=True)
class PropertyRef:
    iri: str
    declared_type: str | None = None


@dataclass(frozen=True)
class Snak:
    property: PropertyRef
    value: ValueSpec


@dataclass(frozen=True)
class StatementMap:
    stat_id: int
    property: PropertyRef
    value: ValueSpec
    rank: str = "normal"
    qualifiers: tuple[Snak, ...] = ()
    references: tuple[tuple[int, tuple[Snak, ...]], ...] = ()

    def name(self, entity: EntitySpec) -> Template:
        return Template(f"{entity.key.text}_{self.stat_id}{self.value.suffix}")


@dataclass(frozen=True)
class MappingBlock:
    name: str
    source: Source
    entity: EntitySpec
    terms: tuple[TermMap, ...] = ()
    statements: tuple[StatementMap, ...] = ()


@dataclass(frozen=True)
class Declaration:
    """A class or property that the mapping itself declares."""

    iri: str
    labels: tuple[tuple[str | None, str], ...] = ()
    descriptions: tuple[tuple[str | None, str], ...] = ()
    aliases: tuple[tuple[str | None, str], ...] = ()
    property_types: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()


@dataclass
class Plan:
    blocks: list[MappingBlock] = field(default_factory=list)
    classes: list[Declaration] = field(default_factory=list)
    properties: list[Declaration] = field(default_factory=list)

    def block(self, name: str) -> MappingBlock:
        return next(b for b in self.blocks if b.name == name)
