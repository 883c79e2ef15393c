"""The engine's registered queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import terms as tm
from .functions import values as vl
from .names import ITEM, NA_VALUES, PROPERTY, RDF, STATEMENT, XSD
from .operators import reconcile as rc
from .operators.dataplane import Rows, build
from .plans.ir import EntitySpec, MappingBlock, Plan, PropertyRef, Snak, Source, StatementMap, Template, TermMap, ValueSpec
from .sources.readers import ntriple, translate_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _item(key: str) -> EntitySpec:
    return EntitySpec("item", Template(key))


def _block(table: str, entity: EntitySpec, *statements: StatementMap, terms: tuple[TermMap, ...] = ()) -> MappingBlock:
    return MappingBlock(f"#{table}", Source("table", table), entity, terms, statements)


def _rows(spark: SparkSession, d: str, *blocks: MappingBlock) -> Rows:
    tables = {b.source.path: _t(spark, d, b.source.path) for b in blocks}
    return build(spark, Plan(list(blocks)), tables=tables)


def _flat(df: DataFrame) -> DataFrame:
    """Statement, qualifier or snak rows with the value's parts as columns."""
    return df.select(*[c for c in df.columns if c != "value"], F.col("value.kind").alias("value_kind"), F.col("value.lex").alias("value_lex"), F.col("value.datatype").alias("value_datatype"), F.col("value.lang").alias("value_lang"))


def _flat_sql(stmt: str, subject: str, prop: str, kind: str, lex: str, datatype: str = "NULL", lang: str = "NULL", rank: str = "normal", stat_id: int = 1, tail: str = "") -> str:
    return f"SELECT DISTINCT {stmt} AS stmt_iri, {subject} AS subject_iri, '{prop}' AS prop_iri, '{rank}' AS rank, CAST({stat_id} AS INTEGER) AS stat_id, '{kind}' AS value_kind, {lex} AS value_lex, CAST({datatype} AS VARCHAR) AS value_datatype, CAST({lang} AS VARCHAR) AS value_lang {tail}"


_STMT, _ITEM, _PROP = f"'{STATEMENT}'", f"'{ITEM}'", PROPERTY
_CUSTOMER, _NATION, _ORDER, _PART, _LINE = _item("Customer_{c_custkey}"), _item("Nation_{n_nationkey}"), _item("Order_{o_orderkey}"), _item("Part_{p_partkey}"), _item("Line_{l_orderkey}_{l_linenumber}")


def _ref(name: str, datatype: str | None = None, lang: str | None = None) -> ValueSpec:
    return ValueSpec("reference", name, None, datatype, lang)


# Statements of every kind of value ---------------------------------------------


@query(_flat_sql(f"{_STMT} || 'Customer_' || c_custkey || '_1_' || c_nationkey", f"{_ITEM} || 'Customer_' || c_custkey", _PROP + "nation", "iri", f"{_ITEM} || 'Nation_' || n_nationkey", tail="FROM customer JOIN nation ON c_nationkey = n_nationkey"))
def customer_nation_statements(spark: SparkSession, d: str) -> DataFrame:
    value = ValueSpec("parent", parent="#nation", conditions=(("c_nationkey", "n_nationkey"),))
    return _flat(_rows(spark, d, _block("customer", _CUSTOMER, StatementMap(1, PropertyRef(PROPERTY + "nation"), value)), _block("nation", _NATION)).statements)


@query(_flat_sql(f"{_STMT} || 'Order_' || o_orderkey || '_1_' || o_custkey", f"{_ITEM} || 'Order_' || o_orderkey", _PROP + "customer", "iri", f"{_ITEM} || 'Customer_' || c_custkey", tail="FROM orders JOIN customer ON o_custkey = c_custkey"))
def parent_join_value(spark: SparkSession, d: str) -> DataFrame:
    value = ValueSpec("parent", parent="#customer", conditions=(("o_custkey", "c_custkey"),))
    return _flat(_rows(spark, d, _block("orders", _ORDER, StatementMap(1, PropertyRef(PROPERTY + "customer"), value)), _block("customer", _CUSTOMER)).statements)


@query(_flat_sql(f"{_STMT} || 'Part_' || a.l_partkey || '_1_' || a.l_orderkey", f"{_ITEM} || 'Part_' || a.l_partkey", _PROP + "line", "iri", f"{_ITEM} || 'Line_' || b.l_orderkey || '_' || b.l_linenumber || '_' || b.l_suppkey", tail="FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber"))
def parent_join_multi_condition(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "lineitem")
    value = ValueSpec("parent", parent="#lineitem", conditions=(("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber")))
    plan = Plan([_block("ordered", _item("Part_{l_partkey}"), StatementMap(1, PropertyRef(PROPERTY + "line"), value)), _block("lineitem", _item("Line_{l_orderkey}_{l_linenumber}_{l_suppkey}"))])
    return _flat(build(spark, plan, tables={"ordered": lines, "lineitem": lines}).statements)


@query(
    " UNION ALL ".join(
        "(" + _flat_sql(f"{_STMT} || 'Order_' || o_orderkey || '_{k}_' || {key}", f"{_ITEM} || 'Order_' || o_orderkey", _PROP + p, "literal", lex, f"'{XSD}{t}'", stat_id=k, tail="FROM orders") + ")"
        for k, p, key, lex, t in ((1, "status", "o_orderstatus", "o_orderstatus", "string"), (2, "priority", "url_encode(o_orderpriority)", "o_orderpriority", "string"), (3, "owner", "o_custkey", "CAST(o_custkey AS VARCHAR)", "integer"))
    )
)
def statement_field_values(spark: SparkSession, d: str) -> DataFrame:
    made = [StatementMap(k, PropertyRef(PROPERTY + p), _ref(f, XSD + t)) for k, p, f, t in ((1, "status", "o_orderstatus", "string"), (2, "priority", "o_orderpriority", "string"), (3, "owner", "o_custkey", "integer"))]
    return _flat(_rows(spark, d, _block("orders", _ORDER, *made)).statements)


@query(_flat_sql(f"{_STMT} || 'Part_' || p_partkey || '_1'", f"{_ITEM} || 'Part_' || p_partkey", _PROP + "catalogue", "literal", "'spring'", f"'{XSD}string'", tail="FROM part"))
def statement_constant_value(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_rows(spark, d, _block("part", _PART, StatementMap(1, PropertyRef(PROPERTY + "catalogue"), ValueSpec("constant", "spring", None, XSD + "string")))).statements)


@query(_flat_sql(f"{_STMT} || 'Part_' || p_partkey || '_1_Spare part'", f"{_ITEM} || 'Part_' || p_partkey", _PROP + "kind", "iri", f"{_ITEM} || 'Spare%20part'", tail="FROM part"))
def statement_entity_constant(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_rows(spark, d, _block("part", _PART, StatementMap(1, PropertyRef(PROPERTY + "kind"), ValueSpec("entity", entity=_item("Spare part"))))).statements)


@query(_flat_sql(f"{_STMT} || 'Part_' || p_partkey || '_1_' || url_encode(p_name) || ' of ' || url_encode(p_brand)", f"{_ITEM} || 'Part_' || p_partkey", _PROP + "title", "literal", "p_name || ' of ' || p_brand", tail="FROM part"))
def statement_template_value(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_rows(spark, d, _block("part", _PART, StatementMap(1, PropertyRef(PROPERTY + "title"), ValueSpec("template", "{p_name} of {p_brand}")))).statements)


@query(_flat_sql(f"{_STMT} || 'Part_' || p_partkey || '_1_Brand_' || url_encode(p_brand)", f"{_ITEM} || 'Part_' || p_partkey", "urn:wikibase:propertyIRI:P31", "iri", f"{_ITEM} || 'Brand_' || url_encode(p_brand)", rank="preferred", tail="FROM part"))
def statement_entity_template(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_rows(spark, d, _block("part", _PART, StatementMap(1, PropertyRef("urn:wikibase:propertyIRI:P31"), ValueSpec("entity", entity=_item("Brand_{p_brand}")), "preferred"))).statements)


@query(" UNION ALL ".join(f"SELECT {_STMT} || 'Order_' || o_orderkey || '_{k}_' || o_custkey AS stmt, '{rank}' AS rank FROM orders" for k, rank in ((1, "preferred"), (2, "normal"), (3, "deprecated"))))
def statement_rank(spark: SparkSession, d: str) -> DataFrame:
    made = [StatementMap(k, PropertyRef(PROPERTY + "customer"), _ref("o_custkey"), rank) for k, rank in ((1, "preferred"), (2, "normal"), (3, "deprecated"))]
    return _rows(spark, d, _block("orders", _ORDER, *made)).statements.select(F.col("stmt_iri").alias("stmt"), "rank")


def _line_block(*extra) -> MappingBlock:
    qualifiers = (Snak(PropertyRef(PROPERTY + "status"), _ref("l_linestatus", XSD + "string")), Snak(PropertyRef(PROPERTY + "flag"), _ref("l_returnflag")))
    references = tuple((k, (Snak(PropertyRef(PROPERTY + "source"), ValueSpec("constant", f"book {k}")), Snak(PropertyRef(PROPERTY + "clerk"), _ref("l_suppkey")))) for k in (1, 2))
    return _block("lineitem", _LINE, StatementMap(1, PropertyRef(PROPERTY + "part"), _ref("l_partkey"), "normal", qualifiers + extra, references))


_LINE_STMT = f"{_STMT} || 'Line_' || l_orderkey || '_' || l_linenumber || '_1_' || l_partkey"


@query(
    f"SELECT DISTINCT {_LINE_STMT} AS stmt_iri, '{_PROP}status' AS prop_iri, 'literal' AS value_kind, l_linestatus AS value_lex, '{XSD}string' AS value_datatype, CAST(NULL AS VARCHAR) AS value_lang FROM lineitem UNION SELECT DISTINCT {_LINE_STMT}, '{_PROP}flag', 'literal', l_returnflag, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM lineitem"
)
def qualifier_rows(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_rows(spark, d, _line_block()).qualifiers)


@query(f"SELECT DISTINCT {_LINE_STMT} AS stmt_iri, '{_PROP}supplier' AS prop_iri, 'iri' AS value_kind, {_ITEM} || 'Supplier_' || s_suppkey AS value_lex, CAST(NULL AS VARCHAR) AS value_datatype, CAST(NULL AS VARCHAR) AS value_lang FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def qualifier_parent_join(spark: SparkSession, d: str) -> DataFrame:
    value = ValueSpec("parent", parent="#supplier", conditions=(("l_suppkey", "s_suppkey"),))
    rows = _rows(spark, d, _line_block(Snak(PropertyRef(PROPERTY + "supplier"), value)), _block("supplier", _item("Supplier_{s_suppkey}")))
    return _flat(rows.qualifiers.where(F.col("prop_iri") == PROPERTY + "supplier"))


_REF = "'urn:wikibase:statementreference:Line_' || l_orderkey || '_' || l_linenumber || '_1_' || l_partkey || '_' || k"


@query(f"SELECT DISTINCT {_LINE_STMT} AS stmt_iri, {_REF} AS ref_iri, CAST(k AS INTEGER) AS ref_id FROM lineitem, (VALUES (1), (2)) AS r(k)")
def reference_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _line_block()).ref_snaks.select("stmt_iri", "ref_iri", "ref_id").distinct()


@query(f"SELECT {_REF} AS ref_iri, p AS prop_iri, CAST(count(DISTINCT CASE WHEN p = '{_PROP}source' THEN 'book ' || k ELSE CAST(l_suppkey AS VARCHAR) END) AS BIGINT) AS snaks FROM lineitem, (VALUES (1), (2)) AS r(k), (VALUES ('{_PROP}source'), ('{_PROP}clerk')) AS q(p) GROUP BY 1, 2")
def reference_snaks_grouped(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _line_block()).ref_snaks.groupBy("ref_iri", "prop_iri").agg(F.count(F.lit(1)).alias("snaks"))


# Terms ----------------------------------------------------------------------------


@query(f"SELECT DISTINCT {_ITEM} || 'Customer_' || c_custkey AS iri, 'label' AS kind, 'en' AS lang, c_name AS value FROM customer")
def term_label_reference(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _block("customer", _CUSTOMER, terms=(TermMap("label", _ref("c_name", None, "en")),))).terms


@query(f"SELECT DISTINCT {_ITEM} || 'Part_' || p_partkey AS iri, k AS kind, 'en' AS lang, CASE k WHEN 'label' THEN p_name || ' (' || p_brand || ')' ELSE p_type END AS value FROM part, (VALUES ('label'), ('description')) AS v(k)")
def term_label_template(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _block("part", _PART, terms=(TermMap("label", ValueSpec("template", "{p_name} ({p_brand})", None, None, "en")), TermMap("description", _ref("p_type", None, "en"))))).terms


@query(f"SELECT DISTINCT {_ITEM} || 'Region_' || r_regionkey AS iri, 'alias' AS kind, 'fr' AS lang, 'région' AS value FROM region")
def term_constant(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _block("region", _item("Region_{r_regionkey}"), terms=(TermMap("alias", ValueSpec("constant", "région", None, None, "fr")),))).terms


@query("SELECT o_orderpriority AS raw, url_encode(o_orderpriority) AS encoded FROM orders UNION SELECT text, url_encode(text) FROM documents")
def iri_percent_encode(spark: SparkSession, d: str) -> DataFrame:
    raw = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("raw")).unionByName(_t(spark, d, "documents").select(F.col("text").alias("raw")))
    return raw.distinct().select("raw", tm.pct(F.col("raw")).alias("encoded"))


_TYPES = (("customer", "Customer", "c_custkey"), ("supplier", "Supplier", "s_suppkey"), ("part", "Part", "p_partkey"))


@query(" UNION ".join(f"SELECT {_ITEM} || '{n}_' || {k} AS iri, {_ITEM} || '{n}' AS class_iri FROM {t}" for t, n, k in _TYPES))
def instance_of_triples(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, *[_block(t, EntitySpec("item", Template(f"{n}_{{{k}}}"), None, (ITEM + n,))) for t, n, k in _TYPES]).types


@query(f"SELECT DISTINCT '{_PROP}' || url_encode(event_type) AS iri, 'string' AS property_type FROM events")
def property_entities(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _block("events", EntitySpec("property", Template("{event_type}"), None, (), "string"))).property_decls


# Text and values --------------------------------------------------------------------


@query("SELECT event_id, CASE WHEN event_type NOT IN ('click', '', 'none') THEN event_type END AS event_type, CASE WHEN props NOT IN ('', 'nan', 'None', 'none', 'null', 'NULL') THEN props END AS props FROM events")
def na_filter(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select("event_id", tm.na_filter(F.col("event_type"), ("click", "", "none")).alias("event_type"), tm.na_filter(F.col("props"), NA_VALUES).alias("props"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS value FROM documents")
def clean_normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", tm.normalize_text(F.col("text")).alias("value"))


def _events_value(spark: SparkSession, d: str) -> DataFrame:
    """One value per event: numbers, dates, text with a language, plain text and IRIs by turns."""
    turn, none = F.col("event_id") % 6, F.lit(None).cast("string")
    number, stamp = F.floor("value").cast("string"), F.date_format("ts", "yyyy-MM-dd")
    lex = F.when(turn == 0, number).when(turn == 1, stamp).when(turn == 4, F.concat(F.lit(ITEM), "event_type")).when(turn == 5, F.concat(F.lit("https://example.org/"), "event_type")).otherwise(F.col("event_type"))
    kind = F.when(turn >= 4, "iri").otherwise("literal")
    datatype = F.when(turn == 0, XSD + "integer").when(turn == 1, XSD + "date")
    value = F.struct(kind.alias("kind"), lex.alias("lex"), datatype.alias("datatype"), F.when(turn == 2, F.lit("en")).otherwise(none).alias("lang"))
    return _t(spark, d, "events").select("event_id", value.alias("value"))


_HAS = "CASE event_id % 6 WHEN 0 THEN 'quantity' WHEN 1 THEN 'time' WHEN 2 THEN 'monolingualtext' WHEN 4 THEN 'wikibase-item' WHEN 5 THEN 'url' END"
_LEX = f"CASE event_id % 6 WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 4 THEN '{ITEM}' || event_type WHEN 5 THEN 'https://example.org/' || event_type ELSE event_type END"


@query(f"SELECT event_id, {_HAS} AS datatype FROM events")
def value_datatype_infer(spark: SparkSession, d: str) -> DataFrame:
    return _events_value(spark, d).select("event_id", vl.infer(F.col("value")).alias("datatype"))


@query(
    f"SELECT event_id, want, CASE WHEN ok THEN lex END AS lex, CASE WHEN NOT ok THEN coalesce(has, 'plain value') || ' does not fit ' || want END AS reject FROM (SELECT *, CASE WHEN want IN ('string', 'external-id') THEN coalesce(has = 'monolingualtext', true) WHEN want = 'monolingualtext' THEN coalesce(has NOT IN ('wikibase-item', 'url'), true) WHEN want = 'url' THEN coalesce(has = 'url', true) ELSE coalesce(has = want, false) END AS ok FROM (SELECT event_id, {_LEX} AS lex, {_HAS} AS has FROM events), (VALUES ('string'), ('external-id'), ('url'), ('quantity'), ('time'), ('monolingualtext'), ('wikibase-item'), ('wikibase-property')) AS w(want))"
)
def value_normalize_reject(spark: SparkSession, d: str) -> DataFrame:
    wants = F.array(*[F.lit(w) for w in ("string", "external-id", "url", "quantity", "time", "monolingualtext", "wikibase-item", "wikibase-property")])
    rows = _events_value(spark, d).withColumn("want", F.explode(wants)).withColumn("n", vl.normalize(F.col("value"), F.col("want")))
    return rows.select("event_id", "want", F.col("n.value.lex").alias("lex"), F.col("n.reject").alias("reject"))


def _converted(df: DataFrame, lex: Column, datatype: str | None, want: str, lang: Column | None = None) -> Column:
    value = F.struct(F.lit("literal").alias("kind"), lex.alias("lex"), F.lit(datatype).cast("string").alias("datatype"), (lang if lang is not None else F.lit(None).cast("string")).alias("lang"))
    return vl.convert(value, F.lit(want), F.lit(None).cast("string"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 0 THEN '' ELSE '+' END || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, '1' AS unit FROM orders")
def value_convert_quantity(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "orders")
    w = _converted(df, F.col("o_totalprice").cast("decimal(18,2)").cast("string"), XSD + "decimal", "quantity")
    return df.select("o_orderkey", w["amount"].alias("amount"), w["unit"].alias("unit"))


@query("SELECT o_orderkey, k AS kind, '+' || CASE k WHEN 'gYear' THEN strftime(o_orderdate, '%Y') || '-00-00T00:00:00Z' WHEN 'gYearMonth' THEN strftime(o_orderdate, '%Y-%m') || '-00T00:00:00Z' WHEN 'date' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS time, CAST(CASE k WHEN 'gYear' THEN 9 WHEN 'gYearMonth' THEN 10 ELSE 11 END AS INTEGER) AS precision FROM orders, (VALUES ('gYear'), ('gYearMonth'), ('date'), ('dateTime')) AS v(k)")
def value_convert_time(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "orders")
    forms = {"gYear": "yyyy", "gYearMonth": "yyyy-MM", "date": "yyyy-MM-dd", "dateTime": "yyyy-MM-dd'T'HH:mm:ss"}
    made = [F.struct(F.lit(k).alias("kind"), F.date_format("o_orderdate", f).alias("lex")) for k, f in forms.items()]
    rows = df.select("o_orderkey", F.explode(F.array(*made)).alias("x")).select("o_orderkey", "x.kind", "x.lex")
    time, precision = vl.time_text(F.col("lex"), F.concat(F.lit(XSD), "kind"))
    return rows.select("o_orderkey", "kind", time.alias("time"), precision.alias("precision"))


@query(r"SELECT doc_id, trim(source, chr(32)) AS text, CASE WHEN lang IN ('de', 'fr') THEN lang ELSE 'en' END AS language FROM documents")
def value_convert_monolingual(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "documents")
    w = _converted(df, F.col("source"), None, "monolingualtext", F.when(F.col("lang").isin("de", "fr"), F.col("lang")))
    return df.select("doc_id", w["text"].alias("text"), w["language"].alias("language"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 0 THEN '' ELSE '+' END || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS quantity_key, '+' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z/11' AS time_key, '{\"text\":\"' || o_orderpriority || '\",\"language\":\"en\"}' AS text_key FROM orders")
def values_match_key(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "orders")
    q = _converted(df, F.col("o_totalprice").cast("decimal(18,2)").cast("string"), XSD + "decimal", "quantity")
    t = _converted(df, F.date_format("o_orderdate", "yyyy-MM-dd"), XSD + "date", "time")
    m = _converted(df, F.col("o_orderpriority"), None, "monolingualtext")
    return df.select("o_orderkey", vl.match_key(q).alias("quantity_key"), vl.match_key(t).alias("time_key"), vl.match_key(m).alias("text_key"))


# Lookup, conflicts and upserts ---------------------------------------------------------


@query("SELECT 'n' || c_nationkey AS key, 'has ' || count(DISTINCT c_mktsegment) || ' different labels in en' AS reason FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1")
def label_conflict_check(spark: SparkSession, d: str) -> DataFrame:
    terms = _t(spark, d, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("iri"), F.lit("label").alias("kind"), F.lit("en").alias("lang"), F.col("c_mktsegment").alias("value"))
    return rc.term_conflicts(terms)


@query("SELECT iri, 'Q' || (1000 + row_number() OVER (ORDER BY iri)) AS id FROM (SELECT 'Order_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS iri FROM orders)")
def id_allocation(spark: SparkSession, d: str) -> DataFrame:
    iris = _t(spark, d, "orders").select(F.concat(F.lit("Order_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("iri"))
    return rc.dense_numbers(iris, "iri", "n").select("iri", F.concat(F.lit("Q"), (F.col("n") + 1000).cast("string")).alias("id"))


@query("SELECT DISTINCT c_custkey AS id, 'alias' AS kind, 'en' AS lang, c_mktsegment AS value FROM customer c WHERE NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = c.c_custkey AND x.c_custkey % 2 = 0 AND x.c_mktsegment = c.c_mktsegment) UNION ALL SELECT DISTINCT c_custkey, 'label', 'en', c_name FROM customer WHERE c_custkey % 3 <> 0")
def terms_diff(spark: SparkSession, d: str) -> DataFrame:
    from .operators.store import Store
    from .operators.upsert import terms_diff as diff

    c = _t(spark, d, "customer")

    def rows(df: DataFrame, kind: str, column: str) -> DataFrame:
        return df.select(F.col("c_custkey").alias("id"), F.lit(kind).alias("kind"), F.lit("en").alias("lang"), F.col(column).alias("value"))

    wanted = rows(c, "label", "c_name").unionByName(rows(c, "alias", "c_mktsegment"))
    there = rows(c.where("c_custkey % 3 = 0"), "label", "c_name").unionByName(rows(c.where("c_custkey % 2 = 0"), "alias", "c_mktsegment"))
    none = spark.createDataFrame([], "id string")
    return diff(wanted, Store(none, there, none, none, none))


@query("SELECT 'Supplier_' || s_suppkey AS iri, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'Supplier_' || s_suppkey END AS label FROM supplier")
def label_fallback_suffix(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier").withColumn("iri", F.concat(F.lit(ITEM + "Supplier_"), "s_suppkey"))
    terms = s.where("s_suppkey % 2 = 0").select("iri", F.lit("label").alias("kind"), F.lit("en").alias("lang"), F.col("s_name").alias("value"))
    out = rc.with_fallback_labels(s.select("iri"), terms, "en")
    return out.select(tm.iri_suffix(F.col("iri"), ITEM).alias("iri"), F.col("value").alias("label"))


@query(f"SELECT {_ITEM} || 'Customer_' || o_custkey AS iri FROM orders UNION SELECT {_ITEM} || 'Order_' || o_orderkey FROM orders")
def distinct_iris(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select(F.concat(F.lit(ITEM + "Order_"), "o_orderkey").alias("s"), F.concat(F.lit(ITEM + "Customer_"), "o_custkey").alias("o"))
    return rc.distinct_iris(o, "s", "o")


@query(" UNION ".join(f"SELECT {_ITEM} || '{n}_' || {k} AS s, '{RDF}type' AS p, {_ITEM} || '{n}' AS o FROM {t}" for t, n, k in _TYPES))
def cross_source_union(spark: SparkSession, d: str) -> DataFrame:
    return instance_of_triples(spark, d).select(F.col("iri").alias("s"), F.lit(RDF + "type").alias("p"), F.col("class_iri").alias("o"))


@query(r"""SELECT '<urn:d:' || doc_id || '> <urn:text> "' || replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"@' || lang || ' .' AS line FROM documents""")
def ntriples_serialize(spark: SparkSession, d: str) -> DataFrame:
    value = F.struct(F.lit("literal").alias("kind"), F.col("text").alias("lex"), F.lit(None).cast("string").alias("datatype"), F.col("lang").alias("lang"))
    return _t(spark, d, "documents").select(ntriple(F.concat(F.lit("urn:d:"), "doc_id"), F.lit("urn:text"), value).alias("line"))


# SQL sources, through the dialect ---------------------------------------------------------


def _sql_source(name: str, text: str, oracle: str | None = None) -> None:
    """A query in the mapping dialect, which DuckDB runs as it is; ``{files}`` are the tables' Parquet files."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        import re

        named = re.sub(r"\b(FROM|,|JOIN)\s+@(\w+)", lambda m: f"{m[1]} read_parquet('{d}/{m[2]}.parquet')", text)
        return spark.sql(translate_sql(spark, named))

    run.__name__ = name
    QUERIES[name] = run
    SQL[name] = oracle or text.replace("@", "")


_sql_source("source_filter_sql", """SELECT "c_custkey" AS key, trim("c_name") AS name FROM @customer WHERE "c_name" IS NOT NULL AND trim("c_name") != '' AND ("c_mktsegment" IN ('BUILDING', 'MACHINERY') OR "c_nationkey" NOT IN (1, 2, 3))""")
_sql_source("source_distinct", """SELECT DISTINCT "p_brand" AS brand, "p_size" AS size FROM @part""")
_sql_source("source_unnest_list", "SELECT vec_id, unnest(embedding) AS x FROM @embeddings WHERE embedding IS NOT NULL", "SELECT vec_id, unnest(embedding) AS x FROM embeddings WHERE embedding IS NOT NULL")
_sql_source("source_lateral_unnest", "SELECT vec_id, label, x FROM @embeddings AS e, unnest(e.embedding) AS t(x) WHERE x > 0", "SELECT vec_id, label, x FROM (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings) WHERE x > 0")
_sql_source("source_json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM @events")
_sql_source("source_regexp_strip", r"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS address FROM @pages")
_sql_source("source_cross_join", "SELECT r_name, n_name FROM @region AS r, @nation AS n")
