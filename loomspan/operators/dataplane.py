"""A plan over its sources: one pass over each source makes all rows of a kind that need no join.

A row fans out by one explode into (map, the source columns that the map uses),
not by a union of a scan per statement map. Where no two source rows have the same
values in the columns that all maps use, which one count by these columns tells,
the narrow rows differ already; else they are made distinct before templates spell
them out as IRIs. Where different source rows can't spell the same output row,
which types and templates tell, that is all; else the output is made distinct once
more. Parent joins have a select each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values
from ..functions.terms import UnknownField, field, field_path, template
from ..names import ITEM, ITEM_ID, NA_VALUES, PROPERTY, PROPERTY_ID, REFERENCE_NODE, STATEMENT
from ..plans.compiler import encode
from ..plans.ir import EntitySpec, MappingBlock, Plan, Source, Template, ValueSpec
from ..scratch import empty, small
from ..sources.readers import load

TYPES = "iri string, class_iri string"
DECLS = "iri string, property_type string"
TERMS = "iri string, kind string, lang string, value string"
STATEMENTS = f"stmt_iri string, subject_iri string, prop_iri string, value {values.VALUE}, rank string, stat_id int"
QUALIFIERS = f"stmt_iri string, prop_iri string, value {values.VALUE}"
SNAKS = f"stmt_iri string, ref_iri string, ref_id int, prop_iri string, value {values.VALUE}"
SCHEMAS = {"types": TYPES, "property_decls": DECLS, "terms": TERMS, "statements": STATEMENTS, "qualifiers": QUALIFIERS, "ref_snaks": SNAKS}


@dataclass
class Rows:
    """The data plane's tables."""

    types: DataFrame
    property_decls: DataFrame
    terms: DataFrame
    statements: DataFrame
    qualifiers: DataFrame
    ref_snaks: DataFrame


def entity_iri(df: DataFrame, spec: EntitySpec, na: Iterable[str] = NA_VALUES) -> Column:
    """The entity's IRI on a row; a constant key is encoded whole, of a template the fields."""
    if spec.explicit_id is not None:
        return F.concat(F.lit(ITEM_ID if spec.kind == "item" else PROPERTY_ID), template(df, spec.explicit_id, True, na))
    prefix = ITEM if spec.kind == "item" else PROPERTY
    if not spec.template.dynamic:
        return F.lit(prefix + encode(spec.template.text))
    return F.concat(F.lit(prefix), template(df, spec.template, True, na))


def value_column(df: DataFrame, spec: ValueSpec, na: Iterable[str] = NA_VALUES) -> Column:
    """The value on a row as STRUCT<kind, lex, datatype, lang>; all kinds but parent joins."""
    if spec.kind == "reference":
        return values.literal(field(df, spec.text, na), spec.datatype, spec.language)
    if spec.kind == "template":
        return values.literal(template(df, Template(spec.text), False, na), spec.datatype, spec.language)
    if spec.kind == "entity":
        return values.iri(entity_iri(df, spec.entity, na))
    return values.iri(F.lit(spec.text)) if spec.entity is not None else values.literal(F.lit(spec.text), spec.datatype, spec.language)


@dataclass
class _Map:
    """What makes one row of ``table`` from a source row: the templates and fields it uses, and the row's columns, named, over a frame."""

    table: str
    templates: list[Template]
    make: Callable[[DataFrame], list[Column]]
    #: Rows of maps with other marks differ, whatever the data.
    mark: tuple

    @property
    def fields(self) -> list[str]:
        return list(dict.fromkeys(f for t in self.templates for f in t.fields))


def _value_template(spec: ValueSpec) -> Template:
    """The template whose text the value's text follows."""
    if spec.kind == "reference":
        return Template("{" + spec.text + "}")
    if spec.kind == "template":
        return Template(spec.text)
    return spec.entity.key if spec.kind == "entity" else Template("")


def _one_to_one(text: Template, kinds: dict[str, T.DataType]) -> bool:
    """Whether different fields always give different text: all but the last are whole numbers or dates, set apart by other characters."""
    parts = text.parts
    at = [k for k, (_, is_field) in enumerate(parts) if is_field]
    for k in at[:-1]:
        apart = k + 1 < len(parts) and not parts[k + 1][1] and not parts[k + 1][0][0] in "0123456789-"
        if not apart or not isinstance(kinds.get(parts[k][0]), (T.IntegralType, T.DateType)):
            return False
    return True


def _by_map(columns: list[Column]) -> Column:
    """The column of the map __m; what several maps share is spelled once."""
    alike: dict[str, list[int]] = {}
    for k, c in enumerate(columns):
        alike.setdefault(str(c), []).append(k)
    first, *rest = alike.values()
    case = None
    for own in rest:
        case = (F if case is None else case).when(F.col("__m").isin(*own), columns[own[0]])
    return columns[first[0]] if case is None else case.otherwise(columns[first[0]])


def _dealt_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows of a table in which few are the same: dealt out as they come, as a table of those seen would only fill the memory of the tasks that make them."""
    return df.repartition(*df.columns).distinct()


KEYS = {"types": ("iri",), "property_decls": ("iri",), "terms": ("iri", "value"), "statements": ("stmt_iri", "subject_iri", "value.lex"), "qualifiers": ("stmt_iri", "value.lex"), "ref_snaks": ("stmt_iri", "ref_iri", "value.lex")}


class _Builder:
    def __init__(self, spark: SparkSession, plan: Plan, root: str, tables: dict[str, DataFrame] | None, na: Iterable[str]):
        self.spark, self.plan, self.root, self.tables, self.na = spark, plan, root, tables, tuple(na)
        self.frames: dict[Source, DataFrame] = {}
        self.out: dict[str, list[DataFrame]] = {k: [] for k in SCHEMAS}
        self.marks: dict[str, list[tuple]] = {k: [] for k in SCHEMAS}
        self.distinct = dict.fromkeys(SCHEMAS, True)  # different narrow rows make different rows
        self.keys: dict[Source, dict[frozenset[str], bool]] = {}  # columns of a source, and whether no two rows are the same in them

    def frame(self, source: Source) -> DataFrame:
        if source not in self.frames:
            self.frames[source] = load(self.spark, source, self.root, self.tables)
        return self.frames[source]

    def is_key(self, source: Source, columns: Iterable[str]) -> bool:
        """Whether no two rows of the source have the same values in ``columns``; they are counted once."""
        own, found = frozenset(columns), self.keys.setdefault(source, {})
        df = self.frame(source)
        if not own or not df._jdf.queryExecution().analyzed().deterministic():
            return False
        for known, unique in found.items():
            if known <= own if unique else own <= known:
                return unique
        by = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(sorted(own))]
        found[own] = df.select(*by).groupBy(*[f"c{k}" for k in range(len(by))]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        return found[own]

    def parent(self, df: DataFrame, spec: ValueSpec) -> DataFrame:
        """``df`` with the parent's subject as __parent: joined on the conditions, or read off the row itself without any."""
        block = self.plan.block(spec.parent)
        if not spec.conditions:
            return df.withColumn("__parent", entity_iri(df, block.entity, self.na))
        other = self.frame(block.source)
        keys = [field(other, p, self.na).alias(f"__p{k}") for k, (_, p) in enumerate(spec.conditions)]
        right = other.select(*keys, entity_iri(other, block.entity, self.na).alias("__parent")).where("__parent is not null").distinct()
        left = df.withColumns({f"__c{k}": field(df, c, self.na) for k, (c, _) in enumerate(spec.conditions)})
        cond = reduce(lambda a, b: a & b, [F.col(f"__c{k}") == F.col(f"__p{k}") for k in range(len(spec.conditions))])
        # Spark sends the parent to all tasks when its size allows, and shuffles both sides when it doesn't.
        return left.join(right, cond, "inner")

    def add(self, name: str, source: Source, df: DataFrame, maps: list[_Map], *more: str) -> None:
        """Rows of the table ``name`` by ``maps`` over a frame of the source; ``more``: columns that they use beside its fields, which differ where the rest is the same."""
        if not maps:
            return
        kinds: dict[str, T.DataType] = {}
        whole = True  # no map uses a part of a column
        used: list[list[str]] = []
        for m in maps:
            own = list(more)
            for f in m.fields:
                try:
                    path, kind = field_path(df.schema, f)
                except UnknownField:
                    continue
                kinds[f] = kind
                whole &= len(path) == 1
                own.append(path[0])
            used.append(list(dict.fromkeys(own)))
        columns = list(dict.fromkeys(c for own in used for c in own))
        quoted = lambda c: F.col(f"`{c}`")
        has_map = any("map<" in df.schema[c].dataType.simpleString() for c in columns)  # maps can't be compared
        common = sorted(set.intersection(*map(set, used)) - set(more))
        once = DataFrame.distinct
        if not has_map and self.is_key(source, common):
            # Rows are dealt out before they fan out: a small file is one task.
            once, df = (lambda d: d), df.select(*map(quoted, columns)).repartition(2 * self.spark.sparkContext.defaultParallelism, *map(quoted, common))
        if has_map:
            rows = [F.struct(*m.make(df)) for m in maps]
            out = df.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
        elif len(maps) == 1:
            narrow = once(df.select(*[quoted(c) for c in columns])) if columns else df.select(F.lit(0).alias("__m")).distinct()
            out = narrow.select(*maps[0].make(narrow))
        else:
            rows = [F.struct(F.lit(k).alias("__m"), *[(quoted(c) if c in own else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in columns]) for k, own in enumerate(used)]
            narrow = once(df.select(F.explode(F.array(*rows)).alias("x")).select("x.*"))
            made = [m.make(narrow) for m in maps]
            out = narrow.select(*[_by_map(list(column)) for column in zip(*made)])
            out = out.toDF(*[f.name for f in T.StructType.fromDDL(SCHEMAS[name]).fields])
        self.out[name].append(out.where(" and ".join(f"{c} is not null" for c in KEYS[name])))
        self.marks[name] += [m.mark for m in maps]
        self.distinct[name] &= not has_map and whole and all(_one_to_one(t, kinds) for m in maps for t in m.templates)

    def source(self, source: Source, blocks: list[MappingBlock]) -> None:
        df = self.frame(source)
        maps: dict[str, list[_Map]] = {k: [] for k in SCHEMAS}
        joined: list[tuple[DataFrame, _Map]] = []
        na = self.na
        for b in blocks:
            iri = lambda d, b=b: entity_iri(d, b.entity, na)
            key = b.entity.explicit_id or b.entity.template
            maps["types"] += [_Map("types", [key], lambda d, c=c, iri=iri: [iri(d).alias("iri"), F.lit(c).alias("class_iri")], (b.name, c)) for c in b.entity.classes]
            if b.entity.kind == "property" and b.entity.property_type:
                maps["property_decls"].append(_Map("property_decls", [key], lambda d, b=b, iri=iri: [iri(d).alias("iri"), F.lit(b.entity.property_type).alias("property_type")], (b.name,)))
            for t in b.terms:

                def term(d: DataFrame, t=t, iri=iri) -> list[Column]:
                    v = value_column(d, t.value, na)
                    return [iri(d).alias("iri"), F.lit(t.kind).alias("kind"), v["lang"].alias("lang"), v["lex"].alias("value")]

                maps["terms"].append(_Map("terms", [key, _value_template(t.value)], term, (b.name, t.kind, t.value.language)))
            for s in b.statements:
                text = s.name(b.entity)
                name = lambda d, text=text: template(d, text, True, na)
                stmt = lambda d, name=name: F.concat(F.lit(STATEMENT), name(d)).alias("stmt_iri")

                def statement(d: DataFrame, v: Column, iri=iri, stmt=stmt, s=s) -> list[Column]:
                    return [stmt(d), iri(d).alias("subject_iri"), F.lit(s.property.iri).alias("prop_iri"), v.alias("value"), F.lit(s.rank).alias("rank"), F.lit(s.stat_id).alias("stat_id")]

                def qualifier(d: DataFrame, v: Column, q: Snak, stmt=stmt) -> list[Column]:
                    return [stmt(d), F.lit(q.property.iri).alias("prop_iri"), v.alias("value")]

                def snak(d: DataFrame, v: Column, k: int, r: Snak, stmt=stmt, name=name) -> list[Column]:
                    return [stmt(d), F.concat(F.lit(REFERENCE_NODE), name(d), F.lit(f"_{k}")).alias("ref_iri"), F.lit(k).alias("ref_id"), F.lit(r.property.iri).alias("prop_iri"), v.alias("value")]

                wanted = [("statements", s.value, statement, (s.stat_id,))]
                wanted += [("qualifiers", q.value, lambda d, v, q=q, f=qualifier: f(d, v, q), (s.stat_id, q.property.iri)) for q in s.qualifiers]
                wanted += [("ref_snaks", r.value, lambda d, v, k=k, r=r, f=snak: f(d, v, k, r), (s.stat_id, k, r.property.iri)) for k, records in s.references for r in records]
                for table, spec, make, mark in wanted:
                    if spec.kind == "parent":
                        joined.append((self.parent(df, spec), _Map(table, [text, key], lambda d, make=make: make(d, values.iri(F.col("__parent"))), mark)))
                    else:
                        maps[table].append(_Map(table, [text, key, _value_template(spec)], lambda d, make=make, spec=spec: make(d, value_column(d, spec, na)), mark))
        for table, own in maps.items():
            self.add(table, source, df, own)
        for frame, m in joined:
            self.add(m.table, source, frame, [m], "__parent")

    def rows(self) -> Rows:
        sources: dict[Source, list[MappingBlock]] = {}
        for b in self.plan.blocks:
            sources.setdefault(b.source, []).append(b)
        for source, blocks in sources.items():
            self.source(source, blocks)
        made = {}
        for name, schema in SCHEMAS.items():
            if not self.out[name]:
                made[name] = empty(self.spark, schema)
                continue
            whole = reduce(DataFrame.unionByName, self.out[name]).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])
            marks = self.marks[name]
            apart = len(marks) == 1 or name in ("statements", "qualifiers", "ref_snaks") and len(set(marks)) == len(marks)
            made[name] = whole if apart and self.distinct[name] else _dealt_distinct(whole)
        return Rows(**made)


def build(spark: SparkSession, plan: Plan, root: str = "", tables: dict[str, DataFrame] | None = None, na: Iterable[str] = NA_VALUES) -> Rows:
    """The data plane of a plan. ``root`` is put before relative paths; ``tables`` stand in for sources."""
    return _Builder(spark, plan, root, tables, na).rows()


def declared_terms(spark: SparkSession, declarations: list) -> DataFrame:
    """Terms of declared classes or properties."""
    rows = [(d.iri, kind, lang, text) for d in declarations for kind, pairs in (("label", d.labels), ("description", d.descriptions), ("alias", d.aliases)) for lang, text in pairs]
    return small(spark, rows, TERMS)


def triples(rows: Rows) -> DataFrame:
    """The data plane as (s, p, o) triples, for export."""
    from ..names import PROPERTY as P
    from ..names import QUALIFIER, QUALIFIER_ID, RDF, RDFS, REFERENCE, REFERENCE_ID, SKOS

    def edge(iri: Column, own: str, by_id: str) -> Column:
        return F.when(iri.startswith(P), F.concat(F.lit(own), F.substr(iri, F.lit(len(P) + 1), F.length(iri)))).when(iri.startswith(PROPERTY_ID), F.concat(F.lit(by_id), F.substr(iri, F.lit(len(PROPERTY_ID) + 1), F.length(iri)))).otherwise(iri)

    o = lambda c: c.cast(values.VALUE).alias("o")
    text = F.struct(F.lit("literal").alias("kind"), F.col("value").alias("lex"), F.lit(None).cast("string").alias("datatype"), F.col("lang").alias("lang"))
    kinds = F.create_map(F.lit("label"), F.lit(RDFS + "label"), F.lit("description"), F.lit(RDFS + "comment"), F.lit("alias"), F.lit(SKOS + "altLabel"))

    def each(df: DataFrame, *made: tuple[str, Column, Column]) -> DataFrame:
        """Several triples of a row, in one pass."""
        return df.select(F.explode(F.array(*[F.struct(F.col(s).alias("s"), p.alias("p"), o(v)) for s, p, v in made])).alias("x")).select("x.*")

    parts = [
        rows.types.select(F.col("iri").alias("s"), F.lit(RDF + "type").alias("p"), o(values.iri(F.col("class_iri")))),
        rows.terms.select(F.col("iri").alias("s"), kinds[F.col("kind")].alias("p"), o(text)),
        each(rows.statements, ("stmt_iri", F.lit(STATEMENT + "subject"), values.iri(F.col("subject_iri"))), ("stmt_iri", F.lit(STATEMENT + "property"), values.iri(F.col("prop_iri"))), ("stmt_iri", F.lit(STATEMENT + "value"), F.col("value"))),
        rows.qualifiers.select(F.col("stmt_iri").alias("s"), edge(F.col("prop_iri"), QUALIFIER, QUALIFIER_ID).alias("p"), o(F.col("value"))),
        each(rows.ref_snaks, ("stmt_iri", F.lit(STATEMENT + "reference"), values.iri(F.col("ref_iri"))), ("ref_iri", edge(F.col("prop_iri"), REFERENCE, REFERENCE_ID), F.col("value"))),
    ]
    return _dealt_distinct(reduce(DataFrame.unionByName, parts))
