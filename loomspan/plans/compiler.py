"""From a mapping graph to a plan, with every problem of the mapping in one error."""

from __future__ import annotations

from urllib.parse import quote

from ..names import ITEM, ITEM_ID, MAPPING_BASE, PROPERTY, PROPERTY_ID, PROPERTY_TYPES, RANKS, RDF, RML
from ..sources.turtle import Blank, Graph, Iri, Literal, Term, parse_turtle
from .ir import Declaration, EntitySpec, MappingBlock, Plan, PropertyRef, Snak, Source, StatementMap, Template, TermMap, ValueSpec

TYPE = RDF + "type"


class MappingError(ValueError):
    """Everything that is wrong with a mapping."""


def encode(text: str) -> str:
    """Percent-encoding of all but unreserved characters."""
    return quote(text, safe="")


def vocabulary_of(graph: Graph) -> str:
    """The namespace of the mapping's own terms, told by the class of its blocks or declarations."""
    for name in ("StatementsMap", "Class", "Property"):
        for _, p, o in graph.triples:
            if p.value == TYPE and isinstance(o, Iri) and o.value.endswith("#" + name) and not o.value.startswith(RDF):
                return o.value[: -len(name)]
    raise MappingError("no block, class or property is declared")


class Compiler:
    def __init__(self, graph: Graph):
        self.g, self.v = graph, vocabulary_of(graph)
        self.problems: list[str] = []
        self.number = 0

    # Reading ---------------------------------------------------------------

    def one(self, node: Term, name: str, namespace: str | None = None) -> Term | None:
        return self.g.value(node, (namespace or self.v) + name)

    def all(self, node: Term, name: str) -> list[Term]:
        return self.g.objects(node, self.v + name)

    def text(self, node: Term, name: str) -> str | None:
        found = self.one(node, name)
        return None if found is None else found.text if isinstance(found, Literal) else found.value if isinstance(found, Iri) else None

    def template(self, node: Term, name: str) -> Template | None:
        found = self.text(node, name)
        return None if found is None else Template(found)

    def fragment(self, node: Term) -> str:
        if isinstance(node, Iri) and "#" in node.value:
            return node.value.split("#", 1)[1]
        self.problems.append(f"{getattr(node, 'value', node)} has neither a template nor a #name to be its key")
        return ""

    # Parts -----------------------------------------------------------------

    def source(self, node: Term) -> Source:
        query = self.g.value(node, RML + "query")
        path = self.g.value(node, RML + "source")
        iterator = self.g.value(node, RML + "iterator")
        if query is not None:
            return Source("sql", query=query.text)
        if path is None:
            self.problems.append("a logical source has neither rml:source nor rml:query")
            return Source("json")
        text = path.text if isinstance(path, Literal) else path.value
        kind = "csv" if text.lower().endswith((".csv", ".tsv")) else "parquet" if text.lower().endswith(".parquet") else "json" if "." in text.rsplit("/", 1)[-1] else "table"
        return Source(kind, text, iterator.text if iterator else "")

    def class_iri(self, node: Term) -> str:
        key = self.text(node, "entityTemplate")
        return ITEM + encode(key if key is not None else self.fragment(node))

    def entity(self, node: Term, where: str) -> EntitySpec:
        declared = self.one(node, "entityType")
        kind = "property" if declared == Iri(self.v + "Property") else "item"
        template, explicit = self.template(node, "entityTemplate"), self.template(node, "entityId")
        if template is None and explicit is None:
            self.problems.append(f"{where}: an entity needs entityTemplate or entityId")
            template = Template("")
        classes = [self.class_iri(c) for c in self.all(node, "class")] + [ITEM_ID + c.text for c in self.all(node, "classId")]
        ptype = self.property_type(self.one(node, "propertyType"), where) if kind == "property" else None
        return EntitySpec(kind, template, explicit, tuple(classes) if kind == "item" else (), ptype)

    def property_type(self, found: Term | None, where: str) -> str | None:
        if found is None:
            return None
        name = found.value.removeprefix(self.v) if isinstance(found, Iri) and found.value.startswith(self.v) else None
        if name not in PROPERTY_TYPES:
            self.problems.append(f"{where}: {getattr(found, 'value', found)} is no property type")
            return None
        return PROPERTY_TYPES[name]

    def property(self, node: Term, where: str) -> PropertyRef:
        """propertyId, then propertyMap, then property with a template, with a type, or an outside IRI as it is."""
        explicit = self.text(node, "propertyId")
        if explicit is not None:
            return PropertyRef(PROPERTY_ID + explicit)
        blank = self.one(node, "propertyMap")
        if blank is not None:
            own = self.text(blank, "entityId")
            if own is not None:
                return PropertyRef(PROPERTY_ID + own)
            key = self.text(blank, "entityTemplate")
            return PropertyRef(PROPERTY + encode(key if key is not None else self.fragment(blank)))
        const = self.one(node, "property")
        if const is None:
            self.problems.append(f"{where}: no property, propertyMap or propertyId")
            return PropertyRef("")
        key = self.text(const, "entityTemplate")
        if key is not None:
            return PropertyRef(PROPERTY + encode(key))
        if self.one(const, "propertyType") is not None:
            return PropertyRef(PROPERTY + self.fragment(const))
        return PropertyRef(const.value if isinstance(const, Iri) else "")

    def value(self, node: Term | None, where: str) -> ValueSpec:
        if node is None:
            self.problems.append(f"{where}: no valueMap")
            return ValueSpec("constant")
        datatype, language = self.text(node, "datatype"), self.text(node, "language")
        if self.one(node, "reference") is not None:
            return ValueSpec("reference", self.text(node, "reference"), None, datatype, language)
        if self.one(node, "constant") is not None:
            found = self.one(node, "constant")
            if isinstance(found, Literal):
                return ValueSpec("constant", found.text, None, datatype or found.datatype, language or found.language)
            return ValueSpec("constant", found.value, EntitySpec("item"), datatype, language)
        if self.one(node, "template") is not None:
            return ValueSpec("template", self.text(node, "template"), None, datatype, language)
        if self.one(node, "entityTemplate") is not None or self.one(node, "entityId") is not None:
            return ValueSpec("entity", entity=self.entity(node, where))
        parent = self.one(node, "parentStatementsMap")
        if parent is not None:
            pairs = tuple((self.text(c, "child"), self.text(c, "parent")) for c in self.all(node, "joinCondition"))
            return ValueSpec("parent", parent=getattr(parent, "value", ""), conditions=pairs)
        self.problems.append(f"{where}: a value needs reference, constant, template, entity or parent map")
        return ValueSpec("constant")

    def snak(self, node: Term, where: str) -> Snak:
        return Snak(self.property(node, where), self.value(self.one(node, "valueMap"), where))

    def rank(self, node: Term, where: str) -> str:
        found = self.all(node, "rank")
        names = {getattr(r, "value", "").removeprefix(self.v) for r in found}
        if len(names) > 1 or names - RANKS.keys():
            self.problems.append(f"{where}: rank must be one of {', '.join(RANKS)}")
            return "normal"
        return RANKS[names.pop()] if names else "normal"

    def statement(self, node: Term, where: str) -> StatementMap:
        self.number += 1
        where = f"{where}, statement {self.number}"
        value = self.value(self.one(node, "valueMap"), where)
        if value.kind == "parent" and not value.conditions:
            self.problems.append(f"{where}: a parent map needs a join condition")
        references = tuple((k + 1, tuple(self.snak(r, where) for r in self.all(ref, "referenceRecord"))) for k, ref in enumerate(self.all(node, "referenceMap")))
        return StatementMap(self.number, self.property(node, where), value, self.rank(node, where), tuple(self.snak(q, where) for q in self.all(node, "qualifierMap")), references)

    def block(self, node: Term) -> MappingBlock:
        name = getattr(node, "value", str(node))
        source = self.one(node, "logicalSource", RML)
        entity = self.one(node, "entityMap")
        if source is None or entity is None:
            self.problems.append(f"{name}: needs a logical source and an entity map")
        spec = self.entity(entity, name) if entity is not None else EntitySpec("item", Template(""))
        if spec.kind == "property" and spec.property_type is None:
            self.problems.append(f"{name}: a property entity needs a propertyType")
        terms = tuple(TermMap(kind, self.value(t, name)) for kind in ("label", "description", "alias") for t in self.all(node, f"{kind}Map"))
        return MappingBlock(name, self.source(source) if source is not None else Source("json"), spec, terms, tuple(self.statement(s, name) for s in self.all(node, "statementMap")))

    # Declarations ----------------------------------------------------------

    def declaration(self, node: Term, iri: str) -> Declaration:
        tagged = lambda name: tuple((x.language, x.text) for x in self.all(node, name) if isinstance(x, Literal))
        types = tuple(filter(None, (self.property_type(t, iri) for t in self.all(node, "propertyType"))))
        parents = tuple(self.class_iri(p) for p in self.all(node, "subclassOf"))
        return Declaration(iri, tagged("label"), tagged("description"), tagged("alias"), types, parents)

    def merged(self, found: list[Declaration]) -> list[Declaration]:
        """One declaration per IRI, as their triples would unite."""
        by: dict[str, list[Declaration]] = {}
        for d in found:
            by.setdefault(d.iri, []).append(d)
        unite = lambda own, name: tuple(dict.fromkeys(x for d in own for x in getattr(d, name)))
        return [Declaration(iri, *(unite(own, n) for n in ("labels", "descriptions", "aliases", "property_types", "parents"))) for iri, own in by.items()]

    def classes(self) -> list[Declaration]:
        nodes = dict.fromkeys(self.g.subjects(TYPE, Iri(self.v + "Class")))
        nodes |= dict.fromkeys(o for _, p, o in self.g.triples if p.value == self.v + "class")
        return self.merged([self.declaration(n, self.class_iri(n)) for n in nodes])

    def properties(self) -> list[Declaration]:
        nodes = dict.fromkeys(self.g.subjects(TYPE, Iri(self.v + "Property")))
        nodes |= dict.fromkeys(self.g.subjects(self.v + "propertyType"))
        found = []
        for n in nodes:
            key = self.text(n, "entityTemplate")
            if key is not None and "{" in key or self.one(n, "entityId") is not None:
                continue  # rows declare these
            found.append(self.declaration(n, PROPERTY + encode(key if key is not None else self.fragment(n))))
        return self.merged(found)

    def plan(self) -> Plan:
        blocks = [self.block(b) for b in self.g.subjects(TYPE, Iri(self.v + "StatementsMap"))]
        plan = Plan(blocks, self.classes(), self.properties())
        names = {b.name for b in blocks}
        for b in blocks:
            for s in b.statements:
                for v in [s.value, *(q.value for q in s.qualifiers), *(x.value for _, r in s.references for x in r)]:
                    if v.kind == "parent" and v.parent not in names:
                        self.problems.append(f"{b.name}: parent map {v.parent} is not defined")
        if self.problems:
            raise MappingError("; ".join(dict.fromkeys(self.problems)))
        return plan


def compile_mapping(text: str, base: str = MAPPING_BASE) -> Plan:
    """Compile a mapping document in Turtle."""
    return Compiler(parse_turtle(text, base)).plan()


def schema_graph(plan: Plan) -> Graph:
    """Declared classes and properties as triples."""
    from ..names import RDFS, SKOS

    graph = Graph()
    for kind, found in ((Iri(RDFS + "Class"), plan.classes), (Iri(RDF + "Property"), plan.properties)):
        for d in found:
            s = Iri(d.iri)
            graph.add(s, Iri(TYPE), kind)
            for p, pairs in ((RDFS + "label", d.labels), (RDFS + "comment", d.descriptions), (SKOS + "altLabel", d.aliases)):
                for language, text in pairs:
                    graph.add(s, Iri(p), Literal(text, None, language))
            for parent in d.parents:
                graph.add(s, Iri(RDFS + "subClassOf"), Iri(parent))
            for t in d.property_types:
                graph.add(s, Iri(PROPERTY + "datatype"), Literal(t))
    return graph


def plan_graph(plan: Plan) -> Graph:
    """The plan's blocks as RML: a triples map each, with a predicate-object map for every term, statement, qualifier and snak."""
    from ..names import QUALIFIER, RDFS, REFERENCE, REFERENCE_NODE, RR, SKOS, STATEMENT

    graph, count = Graph(), 0

    def node() -> Blank:
        nonlocal count
        count += 1
        return Blank(f"n{count}")

    def put(s: Term, p: str, o: Term | str | None) -> None:
        if o is not None:
            graph.add(s, Iri(p), Literal(o) if isinstance(o, str) else o)

    def text_map(s: Term, text: str, prefix: str = "") -> None:
        put(s, RR + ("template" if "{" in text else "constant"), Literal(prefix + text) if "{" in text else Iri(prefix + encode(text)))

    def entity_map(s: Term, e: EntitySpec) -> None:
        prefix = (ITEM_ID if e.kind == "item" else PROPERTY_ID) if e.explicit_id is not None else ITEM if e.kind == "item" else PROPERTY
        text_map(s, (e.explicit_id or e.template).text, prefix)

    def value_map(v: ValueSpec) -> Term:
        m = node()
        if v.kind == "reference":
            put(m, RML + "reference", v.text)
        elif v.kind == "template":
            put(m, RR + "template", v.text)
            put(m, RR + "termType", Iri(RR + "Literal"))
        elif v.kind == "entity":
            entity_map(m, v.entity)
        elif v.kind == "parent":
            put(m, RR + "parentTriplesMap", Iri(v.parent))
            for child, parent in v.conditions:
                put(m, RR + "joinCondition", c := node())
                put(c, RR + "child", child)
                put(c, RR + "parent", parent)
        else:
            put(m, RR + "constant", Iri(v.text) if v.entity is not None else Literal(v.text))
        put(m, RR + "datatype", Iri(v.datatype) if v.datatype else None)
        put(m, RR + "language", v.language)
        return m

    def pair(s: Term, predicate: str, o: Term) -> None:
        put(s, RR + "predicateObjectMap", m := node())
        put(m, RR + "predicate", Iri(predicate))
        put(m, RR + "objectMap", o)

    def constant(iri: str) -> Term:
        put(m := node(), RR + "constant", Iri(iri))
        return m

    def triples_map(name: str, source: Source) -> Term:
        put(t := Iri(name), TYPE, Iri(RR + "TriplesMap"))
        put(t, RML + "logicalSource", at := node())
        for p, x in (("source", source.path), ("iterator", source.iterator), ("query", source.query)):
            put(at, RML + p, x or None)
        return t

    terms = {"label": RDFS + "label", "description": RDFS + "comment", "alias": SKOS + "altLabel"}
    for b in plan.blocks:
        t = triples_map(b.name, b.source)
        put(t, RR + "subjectMap", s := node())
        entity_map(s, b.entity)
        for c in b.entity.classes:
            put(s, RR + "class", Iri(c))
        for x in b.terms:
            pair(t, terms[x.kind], value_map(x.value))
        for x in b.statements:
            own = triples_map(f"{b.name}/statement/{x.stat_id}", b.source)
            text = x.name(b.entity).text
            put(own, RR + "subjectMap", m := node())
            text_map(m, text, STATEMENT)
            subject = node()
            entity_map(subject, b.entity)
            pair(own, STATEMENT + "subject", subject)
            pair(own, STATEMENT + "property", constant(x.property.iri))
            pair(own, STATEMENT + "value", value_map(x.value))
            pair(own, STATEMENT + "rank", constant(STATEMENT + x.rank))
            for q in x.qualifiers:
                pair(own, QUALIFIER + q.property.iri.removeprefix(PROPERTY), value_map(q.value))
            for k, records in x.references:
                ref = triples_map(f"{b.name}/statement/{x.stat_id}/reference/{k}", b.source)
                put(ref, RR + "subjectMap", m := node())
                text_map(m, f"{text}_{k}", REFERENCE_NODE)
                for r in records:
                    pair(ref, REFERENCE + r.property.iri.removeprefix(PROPERTY), value_map(r.value))
    return graph


def strip_mapping(graph: Graph) -> Graph:
    """The graph without the vocabulary's edges, all that hangs on blank nodes below them, and the types of blocks, classes and properties."""
    v = vocabulary_of(graph)
    kinds = {Iri(v + name) for name in ("Class", "Property", "StatementsMap")}
    own = [(s, p, o) for s, p, o in graph.triples if p.value.startswith(v)]
    below = graph.reachable({o for _, _, o in own if isinstance(o, Blank)})
    gone = {*own, *((s, p, o) for s, p, o in graph.triples if s in below or p.value == TYPE and o in kinds)}
    return Graph([t for t in graph.triples if t not in gone])


__all__ = ["MappingError", "compile_mapping", "encode", "plan_graph", "schema_graph", "strip_mapping", "vocabulary_of"]
