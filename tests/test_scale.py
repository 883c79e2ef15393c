"""Steps whose work must not grow faster than their rows: what they read, deal out and hold."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from loomspan import kb_queries
from loomspan.functions import values as vl
from loomspan.functions.terms import SPACE, strip
from loomspan.names import ITEM, PROPERTY, STATEMENT, XSD
from loomspan.operators import dataplane, reconcile, upsert
from loomspan.operators.dataplane import build
from loomspan.operators.store import LOOKUP, SCHEMAS, Store
from loomspan.plans.compiler import compile_mapping
from loomspan.scratch import empty, small, written

TERMS = "iri string, kind string, lang string, value string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, again=False):
    orders = [(k, k % 5, "OFP"[k % 3], float(k), date(2020, 1, 1 + k % 28), "1-URGENT") for k in range(40)]
    orders += orders[:3] if again else []
    return {"orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"), "customer": spark.createDataFrame([(k, f"c{k}") for k in range(4)], "c_custkey long, c_name string")}


def test_rows_of_a_keyed_source_are_not_made_distinct(spark):
    plan = compile_mapping(kb_queries.MAPPING)
    keyed, twice = build(spark, plan, tables=tables(spark)), build(spark, plan, tables=tables(spark, True))
    assert "Aggregate" not in plan_of(keyed.statements)
    assert "Aggregate" in plan_of(twice.statements)
    for name in ("statements", "ref_snaks"):
        a, b = getattr(keyed, name).collect(), getattr(twice, name).collect()
        assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == len(set(map(str, a))) > 0


def test_one_file_from_ordered_ranges(spark, tmp_path):
    path = str(tmp_path / "numbers.nt")
    kb_queries._one_text(spark.range(0, 5000, 1, 7).select(F.col("id").cast("string").alias("value"), "id").orderBy("id").select("value"), path)
    assert (tmp_path / "numbers.nt").read_text().splitlines() == list(map(str, range(5000)))


def test_stored_values_are_those_of_normalize_and_convert(spark):
    default = "de"
    texts = ["", " x ", "5", "+5", "-1e3", "2020-01-05", "2020-13-05", "-0044", "2020-01-05T10:00:00Z", "2020-01-05T10:00:00+02:00", " 2020 ", " y ", "a\n", ITEM + "a", PROPERTY + "b", "http://x/y", "urn:wikibase:z", None]
    kinds = ["string", "external-id", "url", "quantity", "time", "monolingualtext", "wikibase-item", "wikibase-property", "other", None]
    types = [None, XSD + "string", XSD + "integer", XSD + "date", XSD + "gYear", XSD + "gYearMonth", XSD + "dateTime", XSD + "anyURI", "urn:t"]
    rows = [(kind, x, t, lang) for x in texts for kind, t, lang in [("iri", None, None), ("literal", None, "fr"), *[("literal", t, None) for t in types]]]
    df = spark.createDataFrame(rows, "kind string, lex string, datatype string, lang string").select(F.struct("kind", "lex", "datatype", "lang").alias("value"), F.lit("Q1").alias("value_id"))
    df = df.withColumn("want", F.explode(F.array(*[F.lit(k).cast("string") for k in kinds])))
    df = written(df, "values")
    want = written(df.withColumn("n", vl.normalize(F.col("value"), F.col("want"), default)), "normal").withColumn("reject", F.col("n.reject")).withColumn("v", F.col("n.value"))
    want = written(want.drop("n"), "split").withColumn("wiki", vl.convert(F.col("v"), F.col("want"), F.col("value_id"), default)).drop("v")
    got = vl.stored(df, "want", "value_id", default).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_strip_is_that_of_the_expressions(spark):
    df = spark.createDataFrame([(x,) for x in ("", " ", "a", " a", "a ", " a b ", "é", " é", "a\r\n", "a\x85", "\x1ca", None)], "x string")
    slow = F.regexp_replace(F.regexp_replace("x", "^" + SPACE, ""), SPACE + "$", "")
    assert all(r["a"] == r["b"] for r in df.select(strip(F.col("x")).alias("a"), slow.alias("b")).collect())


def test_small_tables_are_known_to_the_optimizer(spark):
    rows = [("it's", "a\\b", 1), ("\n", None, 2)]
    df = small(spark, rows, "a string, b string, n long")
    assert sorted(map(tuple, df.collect())) == sorted(rows) and df.schema.simpleString() == "struct<a:string,b:string,n:bigint>"
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000


def statement(name, subject, prop, lex, rank="normal", kind="literal", n=1):
    return (STATEMENT + name, ITEM + subject, PROPERTY + prop, (kind, lex, None, None), rank, n)


def test_statements_that_recur_and_those_of_the_store(spark):
    lookup = small(spark, [(ITEM + "a", "Q1", "item", None), (ITEM + "b", "Q2", "item", None), (PROPERTY + "p", "P1", "property", "string"), (PROPERTY + "i", "P2", "property", "wikibase-item"), (ITEM + "p", "P1", "property", "string")], LOOKUP)
    rows = [statement("2", "a", "p", "x", "preferred"), statement("1", "a", "p", " x "), statement("3", "a", "p", "y"), statement("3", "a", "p", "z"), statement("4", "b", "i", ITEM + "a", kind="iri"), statement("5", "b", "i", ITEM + "gone", kind="iri"), statement("6", "b", "p", "w"), statement("6", "b", "p", "w", n=2), statement("7", "p", "p", "v")]
    df = spark.createDataFrame(rows, dataplane.STATEMENTS)
    store, new, all_, bad = upsert.add_statements(Store.empty(spark), df, lookup, "en")
    got = {(r["subject_id"], r["pid"], r["value_key"], r["rank"]) for r in store.claims.collect()}
    assert got == {("Q1", "P1", "x", "normal"), ("Q2", "P2", "Q1", "normal"), ("Q2", "P1", "w", "normal"), ("P1", "P1", "v", "normal")} and store.claims.count() == 4
    assert sorted(r["stmt_iri"][-1] for r in new.collect()) == list("12467") and all_.count() == 5
    assert {(r["key"][-1], r["severity"]) for r in bad.collect()} == {("3", "warning"), ("5", "warning")}
    again, new, _, _ = upsert.add_statements(store, df, lookup, "en")
    assert new.isEmpty() and again.claims.count() == 4
    with pytest.raises(reconcile.Violation, match="ranks"):
        upsert.add_statements(Store.empty(spark), df.union(spark.createDataFrame([statement("4", "b", "i", ITEM + "a", "preferred", "iri")], df.schema)), lookup, "en")
    with pytest.raises(reconcile.Violation, match="subjects"):
        upsert.add_statements(Store.empty(spark), spark.createDataFrame([statement("1", "nobody", "p", "x")], df.schema), lookup, "en")


def test_nothing_is_searched_for_when_all_is_known(spark, monkeypatch):
    entities = small(spark, [(ITEM + "a", None), (ITEM + "b", None)], "iri string, datatype string")
    terms = small(spark, [(ITEM + "a", "label", "en", "a"), (ITEM + "b", "label", "en", "b")], TERMS)
    first = reconcile.resolve(entities, terms, empty(spark, LOOKUP), Store.empty(spark), "item")
    monkeypatch.setattr(reconcile, "search_matches", None)
    again = reconcile.resolve(entities, terms, first.ids, Store.empty(spark), "item")
    assert sorted(map(tuple, again.ids.collect())) == sorted(map(tuple, first.ids.collect())) == [(ITEM + "a", "Q1", "item", None), (ITEM + "b", "Q2", "item", None)] and again.created.isEmpty()


def test_entities_without_shared_names_are_gone_through_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(reconcile, "written", lambda df, name, f=reconcile.written: (made.append(name), f(df, name))[1])
    entities = small(spark, [(f"{ITEM}{k}", None) for k in range(6)], "iri string, datatype string")
    apart = small(spark, [(f"{ITEM}{k}", "label", "en", f"n{k}") for k in range(6)], TERMS)
    assert reconcile.resolve(entities, apart, empty(spark, LOOKUP), Store.empty(spark), "item").ids.select("id").distinct().count() == 6
    assert made.count("who") == 1
    chained = apart.union(small(spark, [(f"{ITEM}{k}", "alias", "en", f"N{k + 1}") for k in range(0, 5) if k != 2], TERMS))
    ids = dict(map(tuple, reconcile.resolve(entities, chained, empty(spark, LOOKUP), Store.empty(spark), "item").ids.select("iri", "id").collect()))
    assert [ids[f"{ITEM}{k}"] for k in range(6)] == ["Q1"] * 3 + ["Q2"] * 3


def test_payload_groups_snaks_within_a_reference(spark):
    snak = lambda p, text: (p, ("string", text) + (None,) * 10)
    df = spark.createDataFrame([("g", "h", [snak("P2", "b"), snak("P1", "z"), snak("P1", "a")]), ("g", "k", [])], SCHEMAS["references"])
    out = upsert.snaks_by_property(df)
    assert "Exchange" not in plan_of(out)
    assert [(r["ref_hash"], r["snaks"]) for r in out.collect()] == [("h", {"P1": ['{"value":"a","type":"string"}', '{"value":"z","type":"string"}'], "P2": ['{"value":"b","type":"string"}']})]
