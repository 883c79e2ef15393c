from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from loomspan.functions import terms as tm
from loomspan.functions import values as vl
from loomspan.names import ITEM, XSD
from loomspan.sources.readers import bad_lines, read_csv, read_ntriples, translate_sql


def one(spark, expr, **row):
    df = spark.createDataFrame([tuple(row.values()) or (0,)], ", ".join(f"{k} string" for k in row) or "x int")
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text", ["a b*c~d/é+%", "", "漢字 -._", "100%"])
def test_pct(spark, text):
    assert one(spark, tm.pct(F.col("x")), x=text) == quote(text, safe="-._~")


@pytest.mark.parametrize(("text", "clean", "normal"), [("  a    b\t", "a    b", "a b"), (" NaN ", None, "NaN"), ("", None, ""), (None, None, None), ("\x1ca", "a", "a")])
def test_cleaning(spark, text, clean, normal):
    assert one(spark, tm.clean_text(F.col("x")), x=text) == clean
    assert one(spark, tm.normalize_text(F.col("x")), x=text) == normal


def test_nested_fields_with_dots(spark):
    df = spark.createDataFrame([({"Sp. Attack": 5, "HP": 7},)], "base struct<`Sp. Attack`:int,HP:int>")
    assert df.select(tm.field(df, "base.Sp. Attack").alias("x")).first()["x"] == "5"
    assert df.select(tm.field(df, "base.none").alias("x")).first()["x"] is None


def value(kind, lex, datatype=None, lang=None):
    return F.struct(F.lit(kind).alias("kind"), F.lit(lex).cast("string").alias("lex"), F.lit(XSD + datatype if datatype else None).cast("string").alias("datatype"), F.lit(lang).cast("string").alias("lang"))


@pytest.mark.parametrize(
    ("lex", "want", "kept"),
    [("+5", "quantity", True), ("-0.5", "quantity", True), ("1e3", "quantity", True), (".5", "quantity", True), ("nan", "quantity", False), ("inf", "quantity", False), ("1_000", "quantity", False), ("12d", "quantity", False), ("", "quantity", False)]
    + [("2020", "time", True), ("-44", "time", True), ("20230105", "time", True), ("2023-01-05", "time", True), ("2023-02-30", "time", False), ("2023-1-5", "time", False), ("soon", "time", False)]
    + [("x", "string", True), ("x", "url", True), ("x", "external-id", True), ("x", "monolingualtext", True), ("x", "wikibase-item", False), ("x", "wikibase-property", False)],
)
def test_plain_values(spark, lex, want, kept):
    r = one(spark, vl.normalize(value("literal", lex), F.lit(want)))
    assert (r["reject"] is None) == kept


@pytest.mark.parametrize(
    ("v", "fits"),
    [
        (("literal", "x", None, "de"), {"string", "external-id", "monolingualtext"}),
        (("literal", "x", "string"), {"string", "monolingualtext"}),
        (("literal", "1", "integer"), {"quantity", "monolingualtext"}),
        (("literal", "2020-01-01", "date"), {"time", "monolingualtext"}),
        (("literal", "http://x", "anyURI"), {"url", "monolingualtext"}),
        (("iri", ITEM + "a"), {"wikibase-item"}),
        (("iri", "urn:wikibase:property:a"), {"wikibase-property"}),
        (("iri", "http://x"), {"url"}),
    ],
)
def test_normalisation_matrix(spark, v, fits):
    every = ["string", "external-id", "url", "quantity", "time", "monolingualtext", "wikibase-item", "wikibase-property"]
    df = spark.createDataFrame([(w,) for w in every], "w string")
    got = {r["w"] for r in df.select("w", vl.normalize(value(*v), F.col("w")).alias("n")).where("n.reject is null").collect()}
    assert got == fits


@pytest.mark.parametrize(
    ("lex", "datatype", "time", "precision"),
    [("2020", "gYear", "+2020-00-00T00:00:00Z", 9), ("-0044", "gYear", "-0044-00-00T00:00:00Z", 9), ("2020-05", "gYearMonth", "+2020-05-00T00:00:00Z", 10), ("2020-05-06", "date", "+2020-05-06T00:00:00Z", 11), ("2020-05-06T07:08:09Z", "dateTime", "+2020-05-06T07:08:09Z", 11), ("2020-05-06T01:00:00+02:00", "dateTime", "+2020-05-05T23:00:00Z", 11)],
)
def test_times(spark, lex, datatype, time, precision):
    w = one(spark, vl.convert(value("literal", lex, datatype), F.lit("time"), F.lit(None).cast("string")))
    assert (w["time"], w["precision"]) == (time, precision)


def test_envelopes_for_all_datatypes(spark):
    for want, v in {"quantity": ("literal", "3"), "external-id": ("literal", "x"), "monolingualtext": ("literal", "x", None, "de"), "time": ("literal", "2020-01-01", "date"), "wikibase-property": ("iri", "urn:wikibase:property:a")}.items():
        w = vl.convert(value(*v), F.lit(want), F.lit("P9"))
        assert one(spark, vl.envelope(w)).startswith("{")
        assert one(spark, vl.match_key(w)) is not None


def test_sql_dialect(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1,"l":["x","y"],"m":[["p","q"]]},{"id":2,"l":null,"m":[]}]')
    sql = "SELECT id, json_extract_string(e, '$[1]') AS \"the second\" FROM read_json('a.json'), unnest(m) AS t(e) WHERE m IS NOT NULL"
    assert [tuple(r) for r in spark.sql(translate_sql(spark, sql, str(tmp_path))).collect()] == [(1, "q")]
    assert spark.sql(translate_sql(spark, "SELECT DISTINCT unnest(l) AS x FROM read_json('a.json')", str(tmp_path))).count() == 2


def test_csv_with_mark_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿Nom,"B ""q"""\n"x\ny",2\n'.encode())
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Nom", 'B "q"'] and df.first()["Nom"] == "x\ny"


def test_ntriples(spark, tmp_path):
    p = tmp_path / "a.nt"
    p.write_text('<urn:a> <urn:b> "x\\n\\"y\\\\"@en .\n\n_:b <urn:b> <urn:c> .\n<urn:a> <urn:n> "1"^^<urn:int> .\n')
    rows = {(r["s"], r["p"]): r["o"] for r in read_ntriples(spark, str(p)).collect()}
    assert rows["urn:a", "urn:b"]["lex"] == 'x\n"y\\' and rows["urn:a", "urn:b"]["lang"] == "en"
    assert rows["_:b", "urn:b"]["kind"] == "iri" and rows["urn:a", "urn:n"]["datatype"] == "urn:int"
    p.write_text("<urn:a> <urn:b> <urn:c> .\nbroken\n")
    assert [r["line"] for r in bad_lines(spark, str(p)).collect()] == [2]
    with pytest.raises(Exception, match="malformed N-Triples line 2: broken"):
        read_ntriples(spark, str(p)).collect()


