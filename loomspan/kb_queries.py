"""Registered queries that run the engine's own operators: mappings in Turtle, file sources, resolution, upserts and whole runs.

The driver's tables stand in for sources, and for what a store already has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .functions import terms as tm
from .functions import values as vl
from .names import ITEM, ITEM_ID, PROPERTY, PROPERTY_ID, RDF, RDFS, STATEMENT, XSD
from .operators import reconcile as rc
from .operators import store as st
from .operators import upsert as up
from .operators.dataplane import Rows, build, triples
from .operators.store import LOOKUP, SCHEMAS, Store
from .plans.compiler import compile_mapping, plan_graph, schema_graph, strip_mapping
from .plans.ir import Declaration, Plan, Source
from .queries import _ITEM, _STMT, QUERIES, SQL, _flat, _t, query
from .run import counters, execute
from .scratch import empty, scratch_dir, written
from .sources.readers import bad_lines, load, ntriple, read_csv, read_ntriples, translate_sql
from .sources.turtle import Graph, Iri, parse_turtle, term_text

__all__ = ["QUERIES", "SQL"]


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) and not p.startswith("$") else F.col(p[1:]).cast("string") if isinstance(p, str) else p for p in parts])


def _path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}/{name}"


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _kb(spark: SparkSession, **tables: DataFrame) -> Store:
    return Store.empty(spark).append(**tables)


def _entities(df: DataFrame, id_: Column, kind: str = "item", datatype: Column | None = None) -> DataFrame:
    return df.select(id_.alias("id"), F.lit(kind).alias("kind"), (datatype if datatype is not None else _none()).alias("datatype"))


def _lookup(df: DataFrame, iri: Column, id_: Column, kind: str = "item", datatype: Column | None = None) -> DataFrame:
    return df.select(iri.alias("iri"), id_.alias("id"), F.lit(kind).alias("kind"), (datatype if datatype is not None else _none()).alias("datatype"))


def _labels(df: DataFrame, who: Column, value: Column, name: str = "iri", kind: str = "label", lang: str = "en") -> DataFrame:
    return df.select(who.alias(name), F.lit(kind).alias("kind"), F.lit(lang).alias("lang"), value.alias("value"))


# File sources ---------------------------------------------------------------------------


def _json_array(df: DataFrame, path: str, head: str = "[", tail: str = "]") -> str:
    """A file with one JSON array of a small table's rows."""
    one = df.select(F.to_json(F.struct(*df.columns)).alias("x")).agg(F.concat(F.lit(head), F.array_join(F.collect_list("x"), ",\n"), F.lit(tail)).alias("value"))
    one.write.text(path)
    return path


def _one_text(rows: DataFrame, path: str) -> None:
    """A file with one line for each of the ordered ``rows`` (value), whose ranges are written by a task each and then put one after another."""
    spark = rows.sparkSession
    rows.write.text(f"{path}.parts")
    at, fs = st._hadoop(spark, path)
    parts = [f.getPath() for f in fs.listStatus(st._hadoop(spark, f"{path}.parts")[0])]
    out = fs.create(at, True)
    for p in sorted((p for p in parts if p.getName().startswith("part-")), key=lambda p: p.getName()):
        part = fs.open(p)
        spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
        part.close()
    out.close()


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS nothing FROM supplier")
def source_json_scan(spark: SparkSession, d: str) -> DataFrame:
    """A JSON file with an iterator; nested fields by dotted names, one of which no row has."""
    rows = _t(spark, d, "supplier").select("s_suppkey", "s_name", F.struct(F.col("s_nationkey").alias("the.nation")).alias("at"))
    path = _json_array(rows, _path(spark, "suppliers.json"), '{"found": [', "]}")
    df = load(spark, Source("json", path, "$.found[*]"))
    return df.select(tm.field(df, "s_suppkey").alias("key"), tm.field(df, "s_name").alias("name"), tm.field(df, "at.the.nation").alias("nation"), tm.field(df, "at.nothing").alias("nothing"))


@query("SELECT c_custkey AS key, lower(c_name) AS name FROM customer WHERE c_nationkey IN (1, 2, 3)")
def source_sql_over_json(spark: SparkSession, d: str) -> DataFrame:
    path = _json_array(_t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), _path(spark, "customers.json"))
    return spark.sql(translate_sql(spark, f"""SELECT "c_custkey" AS key, lower("c_name") AS name FROM read_json('{path}') WHERE "c_nationkey" IN (1, 2, 3)"""))


@query("SELECT c_custkey AS key, c_mktsegment AS segment FROM customer")
def source_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of JSON, a source that is split."""
    path = _path(spark, "customers.jsonl")
    _t(spark, d, "customer").select("c_custkey", "c_mktsegment").write.json(path)
    return load(spark, Source("json", path)).select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))


@query("SELECT CAST(doc_id AS VARCHAR) AS key, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS words FROM documents WHERE text <> ''")
def source_sql_over_csv(spark: SparkSession, d: str) -> DataFrame:
    """SQL over a CSV file whose cells hold quotes, commas and line breaks."""
    path = _path(spark, "texts.csv")
    rows = _t(spark, d, "documents").where("text <> ''").select("doc_id", F.replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")).alias("the text"))
    rows.write.options(header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return spark.sql(translate_sql(spark, f"""SELECT "doc_id" AS key, "the text" AS words FROM read_csv('{path}') WHERE "the text" IS NOT NULL"""))


@query("SELECT 'urn:d:' || doc_id AS s, 'urn:text' AS p, 'literal' AS kind, text AS lex, lower(lang) AS lang FROM documents WHERE text IS NOT NULL")
def ntriples_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """N-Triples written, checked line by line and read again."""
    path = _path(spark, "texts.nt")
    value = F.struct(F.lit("literal").alias("kind"), F.col("text").alias("lex"), _none().alias("datatype"), F.col("lang").alias("lang"))
    _t(spark, d, "documents").where("text is not null").select(ntriple(_text("urn:d:", "$doc_id"), F.lit("urn:text"), value).alias("value")).write.text(path)
    return read_ntriples(spark, path).select("s", "p", "o.kind", "o.lex", F.lower("o.lang").alias("lang"))


@query("SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS line, 'row ' || o_orderkey AS value FROM orders QUALIFY o_orderkey % 7 = 0")
def ntriples_malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers of what is no triple, in one file that is read in many splits."""
    path = _path(spark, "orders.nt")
    line = F.when(F.col("o_orderkey") % 7 == 0, _text("row ", "$o_orderkey")).otherwise(_text("<urn:o:", "$o_orderkey", "> <urn:p> <urn:x> ."))
    _one_text(_t(spark, d, "orders").select("o_orderkey", line.alias("value")).orderBy("o_orderkey").select("value"), path)
    return bad_lines(spark, path).select("line", "value")


# A mapping in Turtle -----------------------------------------------------------------------

_V = "https://example.org/map#"
MAPPING = f"""@prefix m: <{_V}> . @prefix rml: <http://semweb.mmlab.be/ns/rml#> . @prefix xsd: <{XSD}> . @prefix rdfs: <{RDFS}> .
<#state> a m:Property ; m:label "state"@en, "Zustand"@de ; m:description "how far it is"@en ; m:propertyType m:string .
<#count> a m:Property ; m:label "count"@en ; m:propertyType m:quantity .
<#day> a m:Property ; m:label "day"@en ; m:propertyType m:time .
<#buyer> a m:Property ; m:label "buyer"@en ; m:alias "client"@en ; m:propertyType m:item .
<#Sale> a m:Class ; m:label "sale"@en ; m:subclassOf <#Deal> .
<#Deal> a m:Class ; m:label "deal"@en ; m:description "what two agree on"@en .
<#Buyers> a m:StatementsMap ;
  rml:logicalSource [ rml:source "customer" ] ;
  m:entityMap [ m:entityTemplate "Customer_{{c_custkey}}" ; m:class [ a m:Class ; m:entityTemplate "Customer" ; m:label "customer"@en ] ] ;
  m:labelMap [ m:reference "c_name" ; m:language "en" ] .
<#Orders> a m:StatementsMap ;
  rml:logicalSource [ rml:query "SELECT *, date_format(o_orderdate, 'yyyy-MM-dd') AS day FROM orders" ] ;
  m:entityMap [ m:entityTemplate "Order_{{o_orderkey}}" ; m:class <#Sale> ] ;
  m:labelMap [ m:template "Order {{o_orderkey}}" ; m:language "en" ] ; m:descriptionMap [ m:constant "an order" ; m:language "en" ] ; m:aliasMap [ m:reference "o_orderkey" ; m:language "fr" ] ;
  m:statementMap [ m:property <#state> ; m:valueMap [ m:reference "o_orderstatus" ; m:datatype xsd:string ] ; m:rank m:PreferredRank ;
    m:qualifierMap [ m:property <#count> ; m:valueMap [ m:reference "o_custkey" ] ] ;
    m:qualifierMap [ m:property <#state> ; m:valueMap [ m:constant "fixed" ] ] ;
    m:qualifierMap [ m:property <#state> ; m:valueMap [ m:template "number {{o_orderkey}}" ] ] ;
    m:qualifierMap [ m:property <#buyer> ; m:valueMap [ m:entityTemplate "Customer_{{o_custkey}}" ] ] ;
    m:qualifierMap [ m:property <#buyer> ; m:valueMap [ m:entityTemplate "Anyone at all" ] ] ;
    m:qualifierMap [ m:property <#buyer> ; m:valueMap [ m:parentStatementsMap <#Buyers> ; m:joinCondition [ m:child "o_custkey" ; m:parent "c_custkey" ] ] ] ;
    m:qualifierMap [ m:property <#buyer> ; m:valueMap [ m:parentStatementsMap <#Orders> ] ] ;
    m:referenceMap [ m:referenceRecord [ m:property <#state> ; m:valueMap [ m:constant "book" ] ] ; m:referenceRecord [ m:property <#day> ; m:valueMap [ m:reference "day" ] ] ;
      m:referenceRecord [ m:property <#state> ; m:valueMap [ m:template "page {{o_orderkey}}" ] ] ] ;
    m:referenceMap [ m:referenceRecord [ m:property <#buyer> ; m:valueMap [ m:entityTemplate "Customer_{{o_custkey}}" ] ] ; m:referenceRecord [ m:property <#buyer> ; m:valueMap [ m:entityTemplate "Anyone at all" ] ] ;
      m:referenceRecord [ m:property <#buyer> ; m:valueMap [ m:parentStatementsMap <#Buyers> ; m:joinCondition [ m:child "o_custkey" ; m:parent "c_custkey" ] ] ] ;
      m:referenceRecord [ m:property <#buyer> ; m:valueMap [ m:parentStatementsMap <#Orders> ] ] ] ] ;
  m:statementMap [ m:propertyMap [ m:entityTemplate "count" ] ; m:valueMap [ m:reference "o_custkey" ; m:datatype xsd:integer ] ] ;
  m:statementMap [ m:propertyId "P9" ; m:valueMap [ m:reference "day" ; m:datatype xsd:date ] ; m:rank m:DeprecatedRank ] ;
  m:statementMap [ m:property rdfs:subClassOf ; m:valueMap [ m:entityTemplate "Deal" ] ] .
"""
_CHILD = "CAST(o_orderkey AS VARCHAR)"
_O1 = f"{_STMT} || 'Order_' || o_orderkey || '_1_' || o_orderstatus"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


def _mapped(spark: SparkSession, d: str) -> Rows:
    return build(spark, compile_mapping(MAPPING), tables={"customer": _t(spark, d, "customer"), "orders": _t(spark, d, "orders")})


def _value_sql(kind: str, lex: str, datatype: str = "NULL") -> str:
    return f"'{kind}' AS value_kind, {lex} AS value_lex, CAST({datatype} AS VARCHAR) AS value_datatype, CAST(NULL AS VARCHAR) AS value_lang"


@query(
    " UNION ".join(
        f"SELECT {_STMT} || 'Order_' || o_orderkey || '_{k}' || {tail} AS stmt_iri, {_ITEM} || 'Order_' || o_orderkey AS subject_iri, '{p}' AS prop_iri, '{rank}' AS rank, CAST({k} AS INTEGER) AS stat_id, {_value_sql(kind, lex, dt)} FROM orders"
        for k, p, tail, rank, kind, lex, dt in (
            (1, PROPERTY + "state", "'_' || o_orderstatus", "preferred", "literal", "o_orderstatus", f"'{XSD}string'"),
            (2, PROPERTY + "count", "'_' || o_custkey", "normal", "literal", "CAST(o_custkey AS VARCHAR)", f"'{XSD}integer'"),
            (3, PROPERTY_ID + "P9", f"'_' || {_DAY}", "deprecated", "literal", _DAY, f"'{XSD}date'"),
            (4, RDFS + "subClassOf", "'_Deal'", "normal", "iri", f"'{ITEM}Deal'", "NULL"),
        )
    )
)
def mapping_statements(spark: SparkSession, d: str) -> DataFrame:
    """A Turtle mapping's statements: a property by its name, by a map, by an id and from outside; all three ranks."""
    return _flat(_mapped(spark, d).statements)


@query(
    " UNION ".join(
        f"SELECT {_O1} AS stmt_iri, '{PROPERTY}{p}' AS prop_iri, {_value_sql(kind, lex)} FROM orders{more}"
        for p, kind, lex, more in (
            ("count", "literal", "CAST(o_custkey AS VARCHAR)", ""), ("state", "literal", "'fixed'", ""), ("state", "literal", "'number ' || o_orderkey", ""), ("buyer", "iri", f"{_ITEM} || 'Customer_' || o_custkey", ""), ("buyer", "iri", f"{_ITEM} || 'Anyone%20at%20all'", ""),
            ("buyer", "iri", f"{_ITEM} || 'Customer_' || c_custkey", " JOIN customer ON o_custkey = c_custkey"), ("buyer", "iri", f"{_ITEM} || 'Order_' || o_orderkey", ""),
        )
    )
)
def mapping_qualifiers(spark: SparkSession, d: str) -> DataFrame:
    """Qualifiers of all kinds of value: field, constant, template, entity template, entity, parent with and without a condition."""
    return _flat(_mapped(spark, d).qualifiers)


@query(
    " UNION ".join(
        f"SELECT {_O1} AS stmt_iri, 'urn:wikibase:statementreference:Order_' || o_orderkey || '_1_' || o_orderstatus || '_{k}' AS ref_iri, CAST({k} AS INTEGER) AS ref_id, '{PROPERTY}{p}' AS prop_iri, {_value_sql(kind, lex)} FROM orders{more}"
        for k, p, kind, lex, more in (
            (1, "state", "literal", "'book'", ""), (1, "day", "literal", _DAY, ""), (1, "state", "literal", "'page ' || o_orderkey", ""), (2, "buyer", "iri", f"{_ITEM} || 'Customer_' || o_custkey", ""), (2, "buyer", "iri", f"{_ITEM} || 'Anyone%20at%20all'", ""),
            (2, "buyer", "iri", f"{_ITEM} || 'Customer_' || c_custkey", " JOIN customer ON o_custkey = c_custkey"), (2, "buyer", "iri", f"{_ITEM} || 'Order_' || o_orderkey", ""),
        )
    )
)
def mapping_reference_snaks(spark: SparkSession, d: str) -> DataFrame:
    """Snaks of all kinds of value."""
    return _flat(_mapped(spark, d).ref_snaks)


@query(
    f"SELECT {_ITEM} || 'Order_' || o_orderkey AS iri, 'label' AS kind, 'en' AS lang, 'Order ' || o_orderkey AS value FROM orders UNION SELECT {_ITEM} || 'Order_' || o_orderkey, 'description', 'en', 'an order' FROM orders UNION SELECT {_ITEM} || 'Order_' || o_orderkey, 'alias', 'fr', {_CHILD} FROM orders UNION SELECT {_ITEM} || 'Customer_' || c_custkey, 'label', 'en', c_name FROM customer"
)
def mapping_terms(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).terms


@query(f"SELECT {_ITEM} || 'Order_' || o_orderkey AS iri, {_ITEM} || 'Sale' AS class_iri FROM orders UNION SELECT {_ITEM} || 'Customer_' || c_custkey, {_ITEM} || 'Customer' FROM customer")
def mapping_types(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).types


@query(
    "SELECT p, CAST(n AS BIGINT) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{p}' AS p, {n} AS n" for p, n in ((RDF + "type", "o + c"), (RDFS + "label", "o + c"), (RDFS + "comment", "o"), ("http://www.w3.org/2004/02/skos/core#altLabel", "o"), (STATEMENT + "subject", "4 * o"), (STATEMENT + "property", "4 * o"), (STATEMENT + "value", "4 * o"), ("urn:wikibase:qualifier:count", "o"), ("urn:wikibase:qualifier:state", "2 * o"), ("urn:wikibase:qualifier:buyer", "3 * o"), (STATEMENT + "reference", "2 * o"), ("urn:wikibase:reference:state", "2 * o"), ("urn:wikibase:reference:day", "o"), ("urn:wikibase:reference:buyer", "3 * o")))
    .replace(" AS n", " AS n FROM (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c)")
    + ")"
)
def mapping_triples(spark: SparkSession, d: str) -> DataFrame:
    """The whole graph as triples, counted by predicate: equal triples are one."""
    return triples(_mapped(spark, d)).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


def _triples_sql(rows: list[tuple[str, str, str]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows) + ") AS t(s, p, o)"


def _graph(spark: SparkSession, graph: Graph) -> DataFrame:
    return spark.createDataFrame([tuple(map(term_text, t)) for t in graph.triples], "s string, p string, o string")


_CLASS, _PROP_OF, _A, _L, _C, _ALT = f"<{RDFS}Class>", f"<{RDF}Property>", f"<{RDF}type>", f"<{RDFS}label>", f"<{RDFS}comment>", "<http://www.w3.org/2004/02/skos/core#altLabel>"


@query(
    _triples_sql(
        [(f"<{ITEM}{n}>", _A, _CLASS) for n in ("Sale", "Deal", "Customer")] + [(f"<{PROPERTY}{n}>", _A, _PROP_OF) for n in ("state", "count", "day", "buyer")]
        + [(f"<{ITEM}Sale>", _L, '"sale"@en'), (f"<{ITEM}Deal>", _L, '"deal"@en'), (f"<{ITEM}Deal>", _C, '"what two agree on"@en'), (f"<{ITEM}Customer>", _L, '"customer"@en'), (f"<{ITEM}Sale>", f"<{RDFS}subClassOf>", f"<{ITEM}Deal>")]
        + [(f"<{PROPERTY}state>", _L, '"state"@en'), (f"<{PROPERTY}state>", _L, '"Zustand"@de'), (f"<{PROPERTY}state>", _C, '"how far it is"@en'), (f"<{PROPERTY}count>", _L, '"count"@en'), (f"<{PROPERTY}day>", _L, '"day"@en'), (f"<{PROPERTY}buyer>", _L, '"buyer"@en'), (f"<{PROPERTY}buyer>", _ALT, '"client"@en')]
        + [(f"<{PROPERTY}{n}>", f"<{PROPERTY}datatype>", f'"{t}"') for n, t in (("state", "string"), ("count", "quantity"), ("day", "time"), ("buyer", "wikibase-item"))]
    )
)
def schema_triples(spark: SparkSession, d: str) -> DataFrame:
    """Declared classes and properties, with their terms, hierarchy and datatypes."""
    return _graph(spark, schema_graph(compile_mapping(MAPPING)))


@query("SELECT 'http://www.w3.org/ns/r2rml#' || p AS p, CAST(n AS BIGINT) AS n FROM (VALUES ('predicateObjectMap', 34), ('subjectMap', 8), ('parentTriplesMap', 4), ('joinCondition', 2), ('template', 17)) AS t(p, n)")
def plan_as_rml(spark: SparkSession, d: str) -> DataFrame:
    """The plan written as RML in Turtle and read again: triples by predicate."""
    from .sources.turtle import write_turtle

    counted: dict[str, int] = {}
    for _, p, _ in parse_turtle(write_turtle(plan_graph(compile_mapping(MAPPING)))).triples:
        counted[p.value] = counted.get(p.value, 0) + 1
    kept = ("predicateObjectMap", "subjectMap", "parentTriplesMap", "joinCondition", "template")
    return spark.createDataFrame([("http://www.w3.org/ns/r2rml#" + k, counted["http://www.w3.org/ns/r2rml#" + k]) for k in kept], "p string, n long")


@query(_triples_sql([("<urn:a>", "<urn:b>", '"kept"'), ("<urn:mapping#state>", "<urn:seen>", '"kept too"')]))
def mapping_stripped(spark: SparkSession, d: str) -> DataFrame:
    """A document without what the vocabulary says: edges, blank nodes below them, and declared types."""
    graph = strip_mapping(parse_turtle(MAPPING + '<urn:a> <urn:b> "kept" . <#state> <urn:seen> "kept too" .'))
    return _graph(spark, Graph([t for t in graph.triples if "rml#" not in t[1].value and not term_text(t[0]).startswith("_:")]))


# Terms and values -----------------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN lower(trim(source)) NOT IN ('', 'none', 'null', 'nan') THEN trim(source) END AS value, CASE WHEN position('c' IN source) > 0 THEN substr(source, position('c' IN source) + 1) ELSE '' END AS after FROM documents")
def clean_and_after(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", tm.clean_text(F.concat(F.lit(" \t"), "source", F.lit("\n"))).alias("value"), tm.str_after(F.col("source"), "c").alias("after"))


@query("SELECT event_id, k AS want, CASE k WHEN 'wikibase-item' THEN '{\"value\":{\"entity-type\":\"item\",\"id\":\"Q' || event_id || '\"},\"type\":\"wikibase-entityid\"}' WHEN 'wikibase-property' THEN '{\"value\":{\"entity-type\":\"property\",\"id\":\"Q' || event_id || '\"},\"type\":\"wikibase-entityid\"}' WHEN 'monolingualtext' THEN '{\"value\":{\"text\":\"' || event_type || '\",\"language\":\"de\"},\"type\":\"monolingualtext\"}' WHEN 'quantity' THEN '{\"value\":{\"amount\":\"+' || event_id || '\",\"unit\":\"1\"},\"type\":\"quantity\"}' WHEN 'time' THEN '{\"value\":{\"time\":\"+' || strftime(ts, '%Y-%m-%d') || 'T00:00:00Z\",\"timezone\":0,\"before\":0,\"after\":0,\"precision\":11,\"calendarmodel\":\"http://www.wikidata.org/entity/Q1985727\"},\"type\":\"time\"}' ELSE '{\"value\":\"' || event_type || '\",\"type\":\"string\"}' END AS body FROM events, (VALUES ('wikibase-item'), ('wikibase-property'), ('string'), ('external-id'), ('url'), ('monolingualtext'), ('quantity'), ('time')) AS w(k)")
def value_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """The datavalue's JSON for every datatype."""
    kinds = ("wikibase-item", "wikibase-property", "string", "external-id", "url", "monolingualtext", "quantity", "time")
    df = _t(spark, d, "events").withColumn("want", F.explode(F.array(*map(F.lit, kinds))))
    day = F.col("want") == "time"
    lex = F.when(day, F.date_format("ts", "yyyy-MM-dd")).when(F.col("want") == "quantity", F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    value = F.struct(F.lit("literal").alias("kind"), lex.alias("lex"), F.when(day, XSD + "date").alias("datatype"), F.when(F.col("want") == "monolingualtext", "de").alias("lang"))
    return df.select("event_id", "want", vl.envelope(vl.convert(value, F.col("want"), _text("Q", "$event_id"))).alias("body"))


@query(f"SELECT {_ITEM} || doc_id AS iri, 'label' AS kind, coalesce(CASE WHEN lang <> 'fr' THEN lang END, 'en') AS lang, source AS value FROM documents")
def language_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Terms without a language get the default; all must be supported."""
    terms = _t(spark, d, "documents").select(_text(ITEM, "$doc_id").alias("iri"), F.lit("label").alias("kind"), F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"), F.col("source").alias("value"))
    config = Config(language="en", languages=frozenset({"en", "de", "es", "fr", "it"}))
    return rc.resolve_languages(terms, config.language, set(config.languages))


@query(f"SELECT DISTINCT {_ITEM} || p_partkey AS iri, k AS kind, 'en' AS lang, CASE k WHEN 'alias' THEN p_brand || ' made' ELSE p_name END AS value FROM part, (VALUES ('label'), ('alias')) AS v(k)")
def collected_terms(spark: SparkSession, d: str) -> DataFrame:
    """Terms cleaned, with white space collapsed, blanks and stand-ins for nothing dropped, each once."""
    part = _t(spark, d, "part")
    who = _text(ITEM, "$p_partkey")
    rows = [_labels(part, who, _text(" ", "$p_name", "\t")), _labels(part, who, F.col("p_name")), _labels(part, who, _text("$p_brand", "\n  made"), kind="alias"), _labels(part, who, F.lit("  NaN "), kind="alias"), _labels(part, who, F.lit(" "), kind="description")]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return rc.collect_terms(out)


@query("SELECT 'n' || c_nationkey AS key, 'has ' || count(DISTINCT c_mktsegment) || ' different descriptions in de' AS reason FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1")
def description_conflict_check(spark: SparkSession, d: str) -> DataFrame:
    return rc.term_conflicts(_labels(_t(spark, d, "customer"), _text("n", "$c_nationkey"), F.col("c_mktsegment"), kind="description", lang="de"))


@query("SELECT DISTINCT event_type AS iri, 'string' AS datatype FROM events")
def single_property_type(spark: SparkSession, d: str) -> DataFrame:
    return rc.single_property_types(_t(spark, d, "events").select(F.col("event_type").alias("iri"), F.lit("string").alias("datatype")))


# The store and its lookups ------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('LANGUAGE', 'de'), ('LANGUAGES', 'de,en'), ('SEARCH_WIKIBASE', 'false'), ('STORE_FILE', 'true'), ('VERBOSE', '2'), ('SCHEMA_OUTPUT_PATH', '/base/schema.ttl'), ('LOOKUP_FILE', '/base/l.json')) AS t(name, value)")
def settings_from_environment(spark: SparkSession, d: str) -> DataFrame:
    """Settings as they are read: words for true and false, numbers, suffixes, paths below a base, the default language among those supported."""
    c = Config.from_env({"LANGUAGE": "de", "LANGUAGES": "en, de", "SEARCH_WIKIBASE": "f", "STORE_FILE": "T", "VERBOSE": " 2", "SCHEMA_OUTPUT_PATH": "schema.xml", "LOOKUP_FILE": "l.json"}, "/base")
    rows = [("LANGUAGE", c.language), ("LANGUAGES", ",".join(sorted(c.languages))), ("SEARCH_WIKIBASE", str(c.search).lower()), ("STORE_FILE", str(c.store_lookup).lower()), ("VERBOSE", str(c.verbose)), ("SCHEMA_OUTPUT_PATH", c.schema_output), ("LOOKUP_FILE", c.lookup)]
    return spark.createDataFrame(rows, "name string, value string")


def _cached(spark: SparkSession, d: str) -> DataFrame:
    items = _lookup(_t(spark, d, "customer"), _text(ITEM + "Käufer_", "$c_custkey"), _text("Q", "$c_custkey"))
    return items.unionByName(_lookup(_t(spark, d, "nation"), _text(PROPERTY, "$n_name"), _text("P", "$n_nationkey"), "property", F.lit("string")))


_CACHED = f"SELECT {_ITEM} || 'Käufer_' || c_custkey AS iri, 'Q' || c_custkey AS id, 'item' AS kind, CAST(NULL AS VARCHAR) AS datatype FROM customer UNION ALL SELECT '{PROPERTY}' || n_name, 'P' || n_nationkey, 'property', 'string' FROM nation"


@query(_CACHED)
def lookup_cache_json(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "lookup.json")
    st.save_lookup(_cached(spark, d), path)
    return st.load_lookup(spark, path)


@query(_CACHED)
def lookup_cache_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "lookup")
    st.save_lookup(spark.createDataFrame([("old", "Q1", "item", None)], LOOKUP), path)
    st.save_lookup(_cached(spark, d), path)
    return st.load_lookup(spark, path)


@query("SELECT 'Q' || c_custkey AS id, 'item' AS kind, CAST(NULL AS VARCHAR) AS datatype FROM customer UNION ALL SELECT 'P' || n_nationkey, 'property', 'url' FROM nation")
def store_adds_parts(spark: SparkSession, d: str) -> DataFrame:
    """A store on disk: what a later run adds is written beside what is there."""
    path = _path(spark, "kb")
    _kb(spark, entities=_entities(_t(spark, d, "customer"), _text("Q", "$c_custkey"))).write(path)
    Store.load(spark, path).append(entities=_entities(_t(spark, d, "nation"), _text("P", "$n_nationkey"), "property", F.lit("url"))).write(path)
    return Store.load(spark, path).entities


@query("SELECT 'Q' || c_custkey AS id FROM customer WHERE c_custkey NOT BETWEEN 100 AND 300")
def bulk_delete_range(spark: SparkSession, d: str) -> DataFrame:
    """The store without items Q100 to Q300."""
    store, _, _ = _kb(spark, entities=_entities(_t(spark, d, "customer"), _text("Q", "$c_custkey"))).delete_range(spark, "Q", 100, 300)
    return store.entities.select("id")


_PARTS = "p_partkey % 7 = 3"


@query(f"SELECT 'Q' || p_partkey AS id, 'label' AS kind, 'en' AS lang, p_name AS value FROM part WHERE NOT ({_PARTS})")
def entity_delete(spark: SparkSession, d: str) -> DataFrame:
    """What is left of the terms when some entities go."""
    part, who = _t(spark, d, "part"), _text("Q", "$p_partkey")
    store = _kb(spark, entities=_entities(part, who), terms=_labels(part, who, F.col("p_name"), "id"))
    return store.delete(part.where(_PARTS).select(who.alias("id"))).terms


@query("SELECT DISTINCT 'Q' || o_custkey AS id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def entities_existing(spark: SparkSession, d: str) -> DataFrame:
    store = _kb(spark, entities=_entities(_t(spark, d, "customer").where("c_acctbal > 0"), _text("Q", "$c_custkey")))
    return store.existing(_t(spark, d, "orders").select(_text("Q", "$o_custkey").alias("id")).distinct())


@query("SELECT 'Käufer_' || c_custkey AS name, 'Q' || c_custkey AS id FROM customer WHERE c_acctbal > 0")
def stale_cache_eviction(spark: SparkSession, d: str) -> DataFrame:
    store = _kb(spark, entities=_entities(_t(spark, d, "customer").where("c_acctbal > 0"), _text("Q", "$c_custkey")))
    return st.evict_stale(_cached(spark, d), store).select(tm.iri_suffix(F.col("iri"), ITEM).alias("name"), "id")


def _direct(spark: SparkSession, d: str) -> tuple[DataFrame, Store]:
    iris = _t(spark, d, "orders").select(_text(ITEM_ID + "Q", "$o_custkey").alias("iri")).unionByName(_t(spark, d, "nation").select(_text(PROPERTY_ID + "P", "$n_nationkey").alias("iri")))
    iris = iris.unionByName(_t(spark, d, "nation").select(_text(ITEM, "$n_name").alias("iri")))
    people = _t(spark, d, "customer").select("c_custkey").union(_t(spark, d, "orders").select("o_custkey")).distinct()
    return iris, _kb(spark, entities=_entities(people, _text("Q", "$c_custkey")).unionByName(_entities(_t(spark, d, "nation"), _text("P", "$n_nationkey"), "property", F.lit("time"))))


@query(f"SELECT DISTINCT '{ITEM_ID}Q' || o_custkey AS iri, 'Q' || o_custkey AS id, 'item' AS kind, CAST(NULL AS VARCHAR) AS datatype FROM orders UNION ALL SELECT '{PROPERTY_ID}P' || n_nationkey, 'P' || n_nationkey, 'property', 'time' FROM nation")
def direct_ids(spark: SparkSession, d: str) -> DataFrame:
    """IRIs that hold an id: they exist, and properties have a datatype."""
    return rc.direct_ids(*_direct(spark, d))


@query(f"SELECT DISTINCT '{ITEM_ID}' || id AS key, CASE WHEN NOT regexp_matches(id, '^Q[0-9]+$') THEN 'is no id' ELSE 'does not exist' END AS reason FROM (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE 'Q' END || o_custkey AS id FROM orders) LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 WHERE NOT regexp_matches(id, '^Q[0-9]+$') OR c_custkey IS NULL UNION ALL SELECT '{PROPERTY_ID}P' || n_nationkey, 'has no datatype' FROM nation WHERE n_nationkey % 2 = 1")
def direct_id_validation(spark: SparkSession, d: str) -> DataFrame:
    """Ids of a wrong form, that don't exist, or of properties without a datatype."""
    found = _t(spark, d, "orders").select(_text(F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise("Q"), "$o_custkey").alias("id")).distinct().select(_text(ITEM_ID, "$id").alias("iri"), F.lit("item").alias("kind"), "id")
    found = found.unionByName(_t(spark, d, "nation").select(_text(PROPERTY_ID + "P", "$n_nationkey").alias("iri"), F.lit("property").alias("kind"), _text("P", "$n_nationkey").alias("id")))
    nations = _entities(_t(spark, d, "nation"), _text("P", "$n_nationkey"), "property", F.when(F.col("n_nationkey") % 2 == 0, "string"))
    return rc.direct_id_problems(found, _kb(spark, entities=_entities(_t(spark, d, "customer").where("c_acctbal > 0"), _text("Q", "$c_custkey")).unionByName(nations)))


# Search and resolution ------------------------------------------------------------------------------


def _named_parts(spark: SparkSession, d: str, kind: str = "item", datatype: Column | None = None) -> Store:
    part, who = _t(spark, d, "part"), _text("Q" if kind == "item" else "P", "$p_partkey")
    return _kb(spark, entities=_entities(part, who, kind, datatype), terms=_labels(part, who, _text("$p_type", " "), "id").unionByName(_labels(part, who, F.col("p_brand"), "id", "alias")))


_WANTED = "SELECT DISTINCT upper(p_type) AS k FROM part UNION SELECT DISTINCT upper(p_brand) FROM part UNION SELECT 'NOTHING'"


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    words = part.select(F.upper("p_type").alias("k")).unionByName(part.select(F.upper("p_brand").alias("k"))).distinct().unionByName(spark.createDataFrame([("NOTHING",)], "k string"))
    return words.select(F.col("k").alias("iri"), F.lit("en").alias("lang"), F.lower("k").alias("key"))


@query(f"SELECT k AS iri, 'Q' || min(p_partkey) AS id, CAST(count(DISTINCT p_partkey) AS BIGINT) AS matches FROM ({_WANTED}) JOIN part ON k = upper(p_type) OR k = upper(p_brand) GROUP BY k")
def label_search_first_match(spark: SparkSession, d: str) -> DataFrame:
    """The first item by number whose label or alias is the wanted one, whatever its case and the blanks around it."""
    return rc.search_matches(_wanted(spark, d), _named_parts(spark, d), "item")


@query(f"SELECT k AS iri, 'P' || min(p_partkey) AS id FROM ({_WANTED}) JOIN part ON (k = upper(p_type) OR k = upper(p_brand)) AND p_size % 2 = 0 GROUP BY k")
def property_search_by_datatype(spark: SparkSession, d: str) -> DataFrame:
    store = _named_parts(spark, d, "property", F.when(F.col("p_size") % 2 == 0, "url").otherwise("time"))
    return rc.search_matches(_wanted(spark, d).withColumn("datatype", F.lit("url")), store, "property", True).select("iri", "id")


@query("SELECT 'Q' || p_partkey AS id FROM part WHERE upper(p_brand) = 'BRAND#2' OR upper(p_type) = 'BRAND#2'")
def store_search(spark: SparkSession, d: str) -> DataFrame:
    return _named_parts(spark, d).search(" brand#2", "en")


@query(f"SELECT {_ITEM} || 'Customer_' || c_custkey AS iri, 'Q' || (40 + dense_rank() OVER (ORDER BY leader)) AS id FROM (SELECT c_custkey, min({_ITEM} || 'Customer_' || c_custkey) OVER (PARTITION BY lower(c_mktsegment), c_nationkey) AS leader FROM customer)")
def same_run_key_merge(spark: SparkSession, d: str) -> DataFrame:
    """New items with one label are one item; the first by IRI leads, and numbers go on after the store's."""
    c = _t(spark, d, "customer")
    terms = _labels(c, _text(ITEM + "Customer_", "$c_custkey"), _text(F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")), " ", "$c_nationkey"))
    kb = _kb(spark, entities=spark.createDataFrame([("Q40", "item", None), ("P90", "property", "url")], SCHEMAS["entities"]))
    found = rc.resolve(terms.select("iri", _none().alias("datatype")), terms, empty(spark, LOOKUP), kb, "item")
    return found.ids.select("iri", "id")


@query(
    f"""WITH p AS (SELECT p_partkey, {_ITEM} || 'Part_' || p_partkey AS iri, p_type || ' ' || p_size AS label FROM part),
s AS (SELECT label, 1 + min(p_partkey) AS n FROM p WHERE p_partkey % 3 = 0 AND label LIKE 'ECONOMY%' GROUP BY label),
k AS (SELECT label, 1000000000 + min(p_partkey) AS n FROM p WHERE p_partkey % 10 = 0 GROUP BY label),
f AS (SELECT p.*, CASE WHEN p_partkey % 10 = 0 THEN 1000000000 + p_partkey ELSE coalesce(least(s.n, k.n), s.n, k.n) END AS known FROM p LEFT JOIN s USING (label) LEFT JOIN k USING (label)),
l AS (SELECT *, min(iri) OVER (PARTITION BY label) AS leader FROM f),
m AS (SELECT leader, row_number() OVER (ORDER BY leader) AS r FROM (SELECT DISTINCT leader FROM l WHERE known IS NULL))
SELECT iri, 'Q' || coalesce(known, (SELECT max(1000000000 + p_partkey) FROM p WHERE p_partkey % 10 = 0) + r) AS id FROM l LEFT JOIN m USING (leader)"""
)
def resolve_items(spark: SparkSession, d: str) -> DataFrame:
    """Items that are cached, found by label in the store or in the run, or new."""
    part = _t(spark, d, "part").withColumn("label", _text("$p_type", " ", "$p_size"))
    terms = _labels(part, _text(ITEM + "Part_", "$p_partkey"), F.col("label"))
    there = part.where("p_partkey % 3 = 0 and label like 'ECONOMY%'").withColumn("id", _text("Q", (F.col("p_partkey") + 1).cast("string")))
    known = part.where("p_partkey % 10 = 0").withColumn("id", _text("Q", (F.col("p_partkey") + 1_000_000_000).cast("string")))
    kb = _kb(spark, entities=_entities(there, F.col("id")).unionByName(_entities(known, F.col("id"))), terms=_labels(there, F.col("id"), F.upper("label"), "id"))
    lookup = _lookup(known, _text(ITEM + "Part_", "$p_partkey"), F.col("id"))
    return rc.resolve(terms.select("iri", _none().alias("datatype")), terms, lookup, kb, "item").ids.select("iri", "id")


@query(f"SELECT {_ITEM} || 'Customer_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS iri, 'Q' || (1 + c_custkey // 6) AS id FROM customer")
def resolve_through_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Chains of items of one run, each with the next one's label as an alias: a chain is one item."""
    c = _t(spark, d, "customer")
    iri = F.concat(F.lit(ITEM + "Customer_"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    terms = _labels(c, iri, F.col("c_name")).unionByName(_labels(c.where("c_custkey % 6 < 5"), iri, F.concat(F.lit("CUSTOMER#"), F.lpad((F.col("c_custkey") + 1).cast("string"), 9, "0")), kind="alias"))
    found = rc.resolve(c.select(iri.alias("iri"), _none().alias("datatype")), terms, empty(spark, LOOKUP), Store.empty(spark), "item")
    return found.ids.select("iri", "id")


@query(f"SELECT {_ITEM} || 'Nation_' || n_nationkey AS iri, CASE WHEN n_nationkey % 2 = 0 THEN 'Q' || (1 + n_nationkey) ELSE 'Q' || (100 + row_number() OVER (PARTITION BY n_nationkey % 2 ORDER BY {_ITEM} || 'Nation_' || n_nationkey)) END AS id FROM nation")
def resolve_without_search(spark: SparkSession, d: str) -> DataFrame:
    """Without a search, only an item with the same label and description is taken over."""
    n = _t(spark, d, "nation")
    terms = _labels(n, _text(ITEM + "Nation_", "$n_nationkey"), F.col("n_name")).unionByName(_labels(n, _text(ITEM + "Nation_", "$n_nationkey"), F.lit("a nation"), kind="description"))
    who = _text("Q", (F.col("n_nationkey") + 1).cast("string"))
    about = F.when(F.col("n_nationkey") % 2 == 0, "a nation").otherwise("another")
    kb = _kb(spark, entities=_entities(n, who).unionByName(spark.createDataFrame([("Q100", "item", None)], SCHEMAS["entities"])), terms=_labels(n, who, F.col("n_name"), "id").unionByName(_labels(n, who, about, "id", "description")))
    found = rc.resolve(n.select(_text(ITEM + "Nation_", "$n_nationkey").alias("iri"), _none().alias("datatype")), terms, empty(spark, LOOKUP), kb, "item", search=False)
    return found.ids.select("iri", "id")


@query(f"SELECT '{PROPERTY}' || event_type AS iri, CASE WHEN event_type = 'view' THEN 'P7' ELSE 'P' || (7 + row_number() OVER (PARTITION BY event_type = 'view' ORDER BY event_type)) END AS id, 'property' AS kind, 'quantity' AS datatype FROM (SELECT DISTINCT event_type FROM events)")
def resolve_properties(spark: SparkSession, d: str) -> DataFrame:
    """Properties by label and datatype; the others are new."""
    e = _t(spark, d, "events").select("event_type").distinct()
    terms = _labels(e, _text(PROPERTY, "$event_type"), F.col("event_type"))
    kb = _kb(spark, entities=spark.createDataFrame([("P7", "property", "quantity")], SCHEMAS["entities"]), terms=spark.createDataFrame([("P7", "label", "en", "View")], SCHEMAS["terms"]))
    return rc.resolve(terms.select("iri", F.lit("quantity").alias("datatype")), terms, empty(spark, LOOKUP), kb, "property").ids


@query("SELECT 'Q' || (40 + row_number() OVER (ORDER BY n_name)) AS id, 'item' AS kind, CAST(NULL AS VARCHAR) AS datatype FROM nation WHERE n_nationkey > 3")
def created_items(spark: SparkSession, d: str) -> DataFrame:
    """The entities that a resolution creates: those that the lookup has aren't among them."""
    n = _t(spark, d, "nation")
    terms = _labels(n, _text(ITEM, "$n_name"), F.col("n_name"))
    known = _lookup(n.where("n_nationkey <= 3"), _text(ITEM, "$n_name"), _text("Q", (F.col("n_nationkey") + 37).cast("string")))
    kb = _kb(spark, entities=known.select("id", "kind", "datatype"))
    return rc.resolve(terms.select("iri", _none().alias("datatype")), terms, known, kb, "item").created


# Adding what the store lacks ---------------------------------------------------------------------------


def _item_claims(df: DataFrame, subject: Column, pid: str, value: Column) -> DataFrame:
    return up.claims_for(df.select(subject.alias("subject_id"), F.lit(pid).alias("pid"), value.alias("value_id"))).select(*up.CLAIM)


@query("SELECT 'Q' || o_orderkey AS subject_id, 'P1' AS pid, 'Q' || o_custkey AS value_key, 'Q' || o_orderkey || '$' || sha256('P1|Q' || o_custkey) AS guid FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 4 = 2")
def existing_claims_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Claims that the store lacks; one of its claims that has no value matches nothing."""
    o = _t(spark, d, "orders")
    claims = _item_claims(o, _text("Q", "$o_orderkey"), "P1", _text("Q", "$o_custkey"))
    there = claims.where(F.substring("subject_id", 2, 20).cast("long") % 2 == 0).withColumn("snaktype", F.when(F.substring("subject_id", 2, 20).cast("long") % 4 == 2, "somevalue").otherwise("value"))
    return up.missing_claims(claims.unionByName(claims), _kb(spark, claims=there)).select("subject_id", "pid", "value_key", "guid")


@query("SELECT 'Q' || c_custkey AS subject_id, 'P1' AS pid, 'Q' || c_nationkey AS value_key, '{\"value\":{\"entity-type\":\"item\",\"id\":\"Q' || c_nationkey || '\"},\"type\":\"wikibase-entityid\"}' AS body FROM customer WHERE c_custkey % 3 = 0")
def claims_of_subjects(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    kb = _kb(spark, claims=_item_claims(c, _text("Q", "$c_custkey"), "P1", _text("Q", "$c_nationkey")))
    return kb.claims_of(c.where("c_custkey % 3 = 0").select(_text("Q", "$c_custkey").alias("id"))).select("subject_id", "pid", "value_key", vl.envelope(F.col("value")).alias("body"))


@query("SELECT 'Q' || c_custkey AS subject_id, 'P2' AS pid, 'Q900000' || c_nationkey AS value_key, 'normal' AS rank FROM customer WHERE c_custkey % 4 <> 0")
def instance_of_push(spark: SparkSession, d: str) -> DataFrame:
    """instance-of claims that the store lacks."""
    c = _t(spark, d, "customer")
    items = _lookup(c, _text(ITEM + "Customer_", "$c_custkey"), _text("Q", "$c_custkey")).unionByName(_lookup(_t(spark, d, "nation"), _text(ITEM + "Nation_", "$n_nationkey"), _text("Q900000", "$n_nationkey")))
    kb = Store(**Store.empty(spark).append(claims=_item_claims(c.where("c_custkey % 4 = 0"), _text("Q", "$c_custkey"), "P2", _text("Q900000", "$c_nationkey"))).tables)
    types = c.select(_text(ITEM + "Customer_", "$c_custkey").alias("iri"), _text(ITEM + "Nation_", "$c_nationkey").alias("class_iri"))
    return up.add_instance_of(kb, types, items, "P2").added["claims"][0].select("subject_id", "pid", "value_key", "rank")


@query("SELECT 'Q' || (10 + n_nationkey) AS subject_id, 'P3' AS pid, 'Q' || (1 + n_regionkey) AS value_key FROM nation")
def subclass_of_push(spark: SparkSession, d: str) -> DataFrame:
    """subclass-of claims between declared classes."""
    n = _t(spark, d, "nation")
    declared = [Declaration(f"{ITEM}N{r['n_nationkey']}", parents=(f"{ITEM}R{r['n_regionkey']}",)) for r in n.collect()]  # a mapping's declarations
    items = _lookup(n, _text(ITEM + "N", "$n_nationkey"), _text("Q", (F.col("n_nationkey") + 10).cast("string"))).unionByName(_lookup(_t(spark, d, "region"), _text(ITEM + "R", "$r_regionkey"), _text("Q", (F.col("r_regionkey") + 1).cast("string"))))
    return up.add_subclass_of(spark, Store.empty(spark), declared, items, "P3").claims.select("subject_id", "pid", "value_key")


def _order_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Orders and most customers have ids, and so have the mapping's properties but for P9."""
    out = _lookup(_t(spark, d, "orders"), _text(ITEM + "Order_", "$o_orderkey"), _text("Q1", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")))
    out = out.unionByName(_lookup(_t(spark, d, "orders").select(F.col("o_custkey")).distinct().where("o_custkey % 7 <> 0"), _text(ITEM + "Customer_", "$o_custkey"), _text("Q2", F.lpad(F.col("o_custkey").cast("string"), 12, "0"))))
    names = [(PROPERTY + "state", "P1", "string"), (PROPERTY + "count", "P2", "quantity"), (PROPERTY + "day", "P3", "time"), (PROPERTY + "buyer", "P4", "wikibase-item"), (PROPERTY_ID + "P9", "P9", "time"), (RDFS + "subClassOf", "P5", "wikibase-item")]
    out = out.unionByName(spark.createDataFrame([(iri, i, "property", t) for iri, i, t in names], LOOKUP))
    return out.unionByName(spark.createDataFrame([(ITEM + "Deal", "Q5", "item", None)], LOOKUP))


_Q1 = "'Q1' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
_Q2 = "'Q2' || lpad(CAST(o_custkey AS VARCHAR), 12, '0')"
_DONE = "o_orderkey % 4 = 0"


def _order_claims_there(spark: SparkSession, d: str) -> Store:
    """A store that has the state of each fourth order."""
    o = _t(spark, d, "orders").where(_DONE)
    value = F.struct(F.lit("literal").alias("kind"), F.col("o_orderstatus").alias("lex"), F.lit(XSD + "string").alias("datatype"), _none().alias("lang"))
    claims = up.with_guid(o.select(_text("Q1", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("subject_id"), F.lit("P1").alias("pid"), F.lit("string").alias("datatype"), vl.convert(value, F.lit("string"), _none()).alias("value"), F.lit("normal").alias("rank")))
    return _kb(spark, claims=claims.select(*up.CLAIM))


@query(
    f"""SELECT {_Q1} AS subject_id, 'P1' AS pid, 'string' AS datatype, 'preferred' AS rank, o_orderstatus AS value_key, {_Q1} || '$' || sha256('P1|' || o_orderstatus) AS guid FROM orders WHERE NOT ({_DONE})
UNION ALL SELECT {_Q1}, 'P2', 'quantity', 'normal', '+' || o_custkey, {_Q1} || '$' || sha256('P2|+' || o_custkey) FROM orders
UNION ALL SELECT {_Q1}, 'P9', 'time', 'deprecated', '+' || {_DAY} || 'T00:00:00Z/11', {_Q1} || '$' || sha256('P9|+' || {_DAY} || 'T00:00:00Z/11') FROM orders
UNION ALL SELECT {_Q1}, 'P5', 'wikibase-item', 'normal', 'Q5', {_Q1} || '$' || sha256('P5|Q5') FROM orders"""
)
def add_statements(spark: SparkSession, d: str) -> DataFrame:
    """Statements as claims, with their ranks; those that the store has aren't added again."""
    store, _, _, _ = up.add_statements(_order_claims_there(spark, d), _mapped(spark, d).statements, _order_lookup(spark, d), "en")
    return store.added["claims"][-1].select("subject_id", "pid", "datatype", "rank", "value_key", "guid")


def _event_statements(spark: SparkSession, d: str) -> DataFrame:
    value = F.struct(F.when(F.col("event_type") == "signup", "iri").otherwise("literal").alias("kind"), F.when(F.col("event_type") == "signup", _text(ITEM, "$user_id")).otherwise(F.col("props")).alias("lex"), _none().alias("datatype"), _none().alias("lang"))
    return _t(spark, d, "events").select(_text(STATEMENT, "$event_id").alias("stmt_iri"), F.lit(ITEM + "0").alias("subject_iri"), _text(PROPERTY, "$event_type").alias("prop_iri"), value.alias("value"), F.lit("normal").alias("rank"), F.lit(1).alias("stat_id"))


def _event_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = [(ITEM + "0", "Q0", "item", None), (PROPERTY + "view", "P1", "property", None), (PROPERTY + "purchase", "P2", "property", "quantity"), (PROPERTY + "signup", "P3", "property", "wikibase-item"), (PROPERTY + "error", "P4", "property", "string")]
    return spark.createDataFrame(rows, LOOKUP).unionByName(_lookup(_t(spark, d, "events").where("user_id % 2 = 0").select("user_id").where("user_id <> 0").distinct(), _text(ITEM, "$user_id"), _text("Q", "$user_id")))


@query(
    f"SELECT '{STATEMENT}' || event_id AS key, CASE event_type WHEN 'click' THEN 'no property {PROPERTY}click' WHEN 'view' THEN 'no datatype for {PROPERTY}view' WHEN 'purchase' THEN 'plain value does not fit quantity' ELSE 'no id for {ITEM}' || user_id END AS reason, 'statements' AS stage FROM events WHERE event_type IN ('click', 'view', 'purchase') OR event_type = 'signup' AND user_id % 2 = 1"
)
def statement_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Statements that can't be added: no property, no datatype, no fitting value, no id for the entity named."""
    _, rejects = up.with_values(_event_statements(spark, d), _event_lookup(spark, d), "en", "statements", "stmt_iri")
    return rejects.select("key", "reason", "stage")


@query(f"SELECT '{STATEMENT}' || event_id AS stmt_iri, CASE event_type WHEN 'signup' THEN 'P3' ELSE 'P4' END AS pid, CASE event_type WHEN 'signup' THEN 'Q' || user_id ELSE props END AS value_key FROM events WHERE event_type = 'error' OR event_type = 'signup' AND user_id % 2 = 0")
def lookup_join_values(spark: SparkSession, d: str) -> DataFrame:
    """Statements with the ids of their properties and of the entities that they name."""
    done, _ = up.with_values(_event_statements(spark, d), _event_lookup(spark, d), "en", "statements", "stmt_iri")
    return done.select("stmt_iri", "pid", vl.match_key(F.col("wiki")).alias("value_key"))


@query("SELECT 's' || l_orderkey AS key, 'more than one ' || concat_ws(', ', CASE WHEN count(DISTINCT l_suppkey) > 1 THEN 'subject' END, CASE WHEN count(DISTINCT l_partkey) > 1 THEN 'value' END, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'rank' END) AS reason, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'error' ELSE 'warning' END AS severity FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1 OR count(DISTINCT l_partkey) > 1 OR count(DISTINCT l_returnflag) > 1")
def cardinality_check(spark: SparkSession, d: str) -> DataFrame:
    """Statements with more than one subject, value or rank."""
    value = vl.literal(F.col("l_partkey").cast("string"))
    rows = _t(spark, d, "lineitem").select(_text("s", "$l_orderkey").alias("stmt_iri"), _text("i", "$l_suppkey").alias("subject_iri"), F.lit("p").alias("prop_iri"), value.alias("value"), F.col("l_returnflag").alias("rank"))
    return up.cardinality(rows).select("key", "reason", "severity")


def _new_orders(spark: SparkSession, d: str) -> DataFrame:
    """Names and ids of new statements: all but each fourth."""
    o = _t(spark, d, "orders").where(f"not ({_DONE})")
    return o.select(F.concat(F.lit(STATEMENT + "Order_"), F.col("o_orderkey").cast("string"), F.lit("_1_"), "o_orderstatus").alias("stmt_iri"), _text("g", "$o_orderkey").alias("guid"))


@query(
    f"""SELECT 'g' || o_orderkey AS guid, 'P2' AS pid, '+' || o_custkey AS value_key FROM orders WHERE NOT ({_DONE}) UNION SELECT 'g' || o_orderkey, 'P1', 'fixed' FROM orders WHERE NOT ({_DONE})
UNION SELECT 'g' || o_orderkey, 'P1', 'number ' || o_orderkey FROM orders WHERE NOT ({_DONE}) UNION SELECT 'g' || o_orderkey, 'P4', {_Q2} FROM orders WHERE NOT ({_DONE}) AND o_custkey % 7 <> 0 UNION SELECT 'g' || o_orderkey, 'P4', {_Q1} FROM orders WHERE NOT ({_DONE})"""
)
def add_qualifiers(spark: SparkSession, d: str) -> DataFrame:
    """Qualifiers of new statements only, equal ones once; those that name nothing known are rejects."""
    store, _ = up.add_qualifiers(Store.empty(spark), _mapped(spark, d).qualifiers, _new_orders(spark, d), _order_lookup(spark, d), "en")
    return store.qualifiers.select("guid", "pid", vl.match_key(F.col("value")).alias("value_key"))


@query(
    f"""SELECT 'g' || o_orderkey AS guid, CAST(3 AS INTEGER) AS snaks, 'P1=book P1=page ' || o_orderkey || ' P3=+' || {_DAY} || 'T00:00:00Z/11' AS held FROM orders WHERE NOT ({_DONE})
UNION ALL SELECT 'g' || o_orderkey, CAST(CASE WHEN o_custkey % 7 <> 0 THEN 2 ELSE 1 END AS INTEGER), 'P4=' || {_Q1} || CASE WHEN o_custkey % 7 <> 0 THEN ' P4=' || {_Q2} ELSE '' END FROM orders WHERE NOT ({_DONE})"""
)
def add_references(spark: SparkSession, d: str) -> DataFrame:
    """References of new statements with all their valid snaks together."""
    store, _ = up.add_references(Store.empty(spark), _mapped(spark, d).ref_snaks, _new_orders(spark, d), _order_lookup(spark, d), "en")
    told = F.array_sort(F.transform("snaks", lambda s: F.concat(s["pid"], F.lit("="), vl.match_key(s["value"]))))
    return store.references.select("guid", F.size("snaks").alias("snaks"), F.array_join(told, " ").alias("held"))


@query(f"""SELECT 'g' || o_orderkey AS guid, 'P1' AS pid, '{{"value":"book","type":"string"}} {{"value":"page ' || o_orderkey || '","type":"string"}}' AS bodies FROM orders WHERE NOT ({_DONE})""")
def reference_payload_by_property(spark: SparkSession, d: str) -> DataFrame:
    """Snaks grouped by property as the store takes them: the strings of each first reference."""
    store, _ = up.add_references(Store.empty(spark), _mapped(spark, d).ref_snaks.where("ref_id = 1"), _new_orders(spark, d), _order_lookup(spark, d), "en")
    return up.snaks_by_property(store.references).select("guid", F.explode("snaks").alias("pid", "bodies")).where("pid = 'P1'").select("guid", "pid", F.array_join("bodies", " ").alias("bodies"))


@query("SELECT 'Q' || p_partkey AS id, 'label' AS kind, 'en' AS lang, p_name AS value FROM part WHERE p_partkey % 2 = 1 UNION ALL SELECT 'Q' || p_partkey, 'alias', 'en', p_brand FROM part WHERE p_partkey % 3 = 0")
def terms_push(spark: SparkSession, d: str) -> DataFrame:
    """Terms that the store lacks; entities without terms add nothing."""
    part = _t(spark, d, "part")
    iri, id_ = _text(ITEM, "$p_partkey"), _text("Q", "$p_partkey")
    kb = _kb(spark, terms=_labels(part.where("p_partkey % 2 = 0"), id_, F.upper("p_name"), "id").unionByName(_labels(part.where("p_partkey % 3 <> 0"), id_, F.col("p_brand"), "id", "alias")))
    wanted = _labels(part, iri, F.col("p_name")).unionByName(_labels(part, iri, F.col("p_brand"), kind="alias"))
    store, _ = up.add_terms(kb, wanted, _lookup(part, iri, id_))
    return store.added["terms"][-1]


@query(f"SELECT c_custkey AS key, 'Q' || c_custkey AS id FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, CAST(NULL AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0")
def lookup_join_items(spark: SparkSession, d: str) -> DataFrame:
    """Values that name items, with their ids where the lookup has them."""
    c = _t(spark, d, "customer")
    lookup = _lookup(c.where("c_custkey % 3 <> 0"), _text(ITEM + "Customer_", "$c_custkey"), _text("Q", "$c_custkey")).unionByName(spark.createDataFrame([(PROPERTY + "p", "P1", "property", "wikibase-item")], LOOKUP))
    rows = c.select(F.col("c_custkey").alias("key"), F.lit(PROPERTY + "p").alias("prop_iri"), vl.iri(_text(ITEM + "Customer_", "$c_custkey")).alias("value"))
    done, rejects = up.with_values(rows, lookup, "en", "values", "key")
    return done.select("key", F.col("value_id").alias("id")).unionByName(rejects.select("key", _none().alias("id")))


@query("""SELECT 'g' || o_orderkey AS key, '{"action":"wbsetclaim","claim":"{\\"type\\":\\"statement\\",\\"id\\":\\"g' || o_orderkey || '\\",\\"rank\\":\\"normal\\",\\"mainsnak\\":{\\"snaktype\\":\\"value\\",\\"property\\":\\"P1\\",\\"datavalue\\":{\\"value\\":\\"' || o_orderpriority || '\\",\\"type\\":\\"string\\"}}}"}' AS body FROM orders""")
def claim_requests(spark: SparkSession, d: str) -> DataFrame:
    """What is sent to a remote store for each new claim."""
    from .sources.remote import claim_requests

    value = vl.convert(vl.literal(F.col("o_orderpriority"), XSD + "string"), F.lit("string"), _none())
    return claim_requests(_t(spark, d, "orders").select(_text("g", "$o_orderkey").alias("guid"), F.lit("P1").alias("pid"), value.alias("value"), F.lit("normal").alias("rank")))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Q' || event_id WHEN 1 THEN 'P' || event_id END AS id FROM events")
def conflicting_ids(spark: SparkSession, d: str) -> DataFrame:
    """The entity that a remote store's refusal names."""
    from .sources.remote import conflicting_id

    told = F.when(F.col("event_id") % 3 == 0, _text("Item [[Item:Q", "$event_id", "|Q1]] has it")).when(F.col("event_id") % 3 == 1, _text("[[Property:P", "$event_id", "]]")).otherwise(F.lit("Q5 is no link"))
    return _t(spark, d, "events").select("event_id", conflicting_id(told).alias("id"))


# Whole runs ------------------------------------------------------------------------------------------------


_RUNS: dict[tuple[str, str], tuple] = {}


def _run(spark: SparkSession, d: str) -> tuple:
    """The mapping over all customers and orders, into a store that has P9 and a class; run once for all queries of an application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        kb = _kb(spark, entities=spark.createDataFrame([("P9", "property", "time"), ("Q3", "item", None)], SCHEMAS["entities"]), terms=spark.createDataFrame([("Q3", "label", "en", "Deal"), ("Q3", "label", "de", "Geschäft")], SCHEMAS["terms"]))
        stale = spark.createDataFrame([(ITEM + "Gone", "Q77", "item", None)], LOOKUP)
        plan = compile_mapping(MAPPING)
        tables = {"customer": _t(spark, d, "customer"), "orders": _t(spark, d, "orders")}
        _RUNS[key] = plan, execute(spark, plan, Store(**kb.tables), stale, tables=tables), tables
    return _RUNS[key]


@query(
    f"""SELECT {_ITEM} || 'Order_' || o_orderkey AS subject, 'state' AS property, o_orderstatus AS value, 'preferred' AS rank FROM orders
UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'count', '+' || o_custkey, 'normal' FROM orders
UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'P9', '+' || {_DAY} || 'T00:00:00Z/11', 'deprecated' FROM orders
UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'instance of', {_ITEM} || 'Sale', 'normal' FROM orders
UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'subclass of', {_ITEM} || 'Deal', 'normal' FROM orders
UNION ALL SELECT {_ITEM} || 'Customer_' || c_custkey, 'instance of', {_ITEM} || 'Customer', 'normal' FROM customer
UNION ALL SELECT {_ITEM} || 'Sale', 'subclass of', {_ITEM} || 'Deal', 'normal'"""
)
def run_claims(spark: SparkSession, d: str) -> DataFrame:
    """All claims of a whole run, with IRIs and labels in place of ids."""
    _, out, _ = _run(spark, d)
    items = out.lookup.where("kind = 'item'").select("iri", "id")
    names = out.store.terms.where("kind = 'label' and lang = 'en'").select(F.col("id").alias("pid"), F.col("value").alias("name"))
    told = out.store.claims.join(items.select(F.col("id").alias("subject_id"), F.col("iri").alias("subject")), "subject_id").join(items.select(F.col("id").alias("value_key"), F.col("iri").alias("named")), "value_key", "left").join(names, "pid", "left")
    return told.select("subject", F.coalesce("name", "pid").alias("property"), F.coalesce("named", "value_key").alias("value"), "rank")


@query(
    f"""SELECT {_ITEM} || 'Order_' || o_orderkey AS iri, 'label' AS kind, 'en' AS lang, 'Order ' || o_orderkey AS value FROM orders UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'description', 'en', 'an order' FROM orders UNION ALL SELECT {_ITEM} || 'Order_' || o_orderkey, 'alias', 'fr', {_CHILD} FROM orders
UNION ALL SELECT {_ITEM} || 'Customer_' || c_custkey, 'label', 'en', c_name FROM customer UNION ALL SELECT {_ITEM} || 'Customer_' || o_custkey, 'label', 'en', 'Customer_' || o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT * FROM (VALUES ('{ITEM}Sale', 'label', 'en', 'sale'), ('{ITEM}Deal', 'label', 'en', 'Deal'), ('{ITEM}Deal', 'label', 'de', 'Geschäft'), ('{ITEM}Deal', 'description', 'en', 'what two agree on'), ('{ITEM}Customer', 'label', 'en', 'customer'), ('{ITEM}Anyone%20at%20all', 'label', 'en', 'Anyone%20at%20all')) AS t(a, b, c, e)"""
)
def run_item_terms(spark: SparkSession, d: str) -> DataFrame:
    """All terms of items after a run: a class was found by its label and keeps its terms, and entities without a label get their key."""
    _, out, _ = _run(spark, d)
    return out.store.terms.join(out.lookup.where("kind = 'item'").select("iri", "id"), "id").select("iri", "kind", "lang", "value")


@query(f"SELECT * FROM (VALUES ('{PROPERTY}state', 'string'), ('{PROPERTY}count', 'quantity'), ('{PROPERTY}day', 'time'), ('{PROPERTY}buyer', 'wikibase-item'), ('{PROPERTY_ID}P9', 'time'), ('{PROPERTY}instanceOf', 'wikibase-item'), ('{PROPERTY}subclassOf', 'wikibase-item')) AS t(iri, datatype)")
def run_properties(spark: SparkSession, d: str) -> DataFrame:
    """All properties after a run: declared, direct, and the two that are built in."""
    _, out, _ = _run(spark, d)
    return out.lookup.where("kind = 'property'").join(out.store.entities.where("kind = 'property'").select("id"), "id", "left_semi").select("iri", "datatype")


@query(
    """SELECT 'entities' AS stage, 'added' AS event, CAST(6 + 3 + (SELECT count(*) FROM orders) + (SELECT count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)) AS BIGINT) AS n
UNION ALL SELECT 'lookup', 'evicted', 1
UNION ALL SELECT 'claims', 'added', 1 + (SELECT count(*) FROM customer) + 5 * (SELECT count(*) FROM orders)
UNION ALL SELECT 'qualifiers', 'added', 6 * (SELECT count(*) FROM orders)
UNION ALL SELECT 'references', 'added', 2 * (SELECT count(*) FROM orders)"""
)
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """What a run adds, table by table, and what left the lookup."""
    _, out, _ = _run(spark, d)
    return counters(out).where("stage <> 'terms'")


@query("SELECT name, CAST(0 AS BIGINT) AS added FROM (VALUES ('entities'), ('terms'), ('claims'), ('qualifiers'), ('references')) AS t(name)")
def run_again_adds_nothing(spark: SparkSession, d: str) -> DataFrame:
    """A second run over the same data."""
    plan, out, tables = _run(spark, d)
    first = Store(**{k: written(df, k) for k, df in out.store.tables.items()})
    again = execute(spark, plan, first, out.lookup, tables=tables)
    return spark.createDataFrame([(k, sum(df.count() for df in again.store.added.get(k, ()))) for k in SCHEMAS], "name string, added long")
