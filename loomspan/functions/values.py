"""Values: inferred datatype, coercion, the normalisation matrix, conversion, and the key by which claims match.

A value is STRUCT<kind, lex, datatype, lang>: kind is iri or literal. Every
function is a plain expression; a value that a property can't hold becomes a
reject reason, never an error of the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import CALENDAR, DATATYPES, ITEM, ITEM_ID, LOCAL, PROPERTY, PROPERTY_ID, XSD
from .terms import strip

VALUE = "struct<kind:string,lex:string,datatype:string,lang:string>"
WIKI = "struct<type:string,text:string,language:string,amount:string,unit:string,time:string,precision:int,timezone:int,before:int,after:int,calendarmodel:string,id:string>"

#: Plain decimal numbers, with or without an exponent: no names of infinities, no digit groups, no suffixes.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
YEAR = r"^[+-]*[0-9]+$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def literal(lex: Column, datatype: str | None = None, lang: str | None = None) -> Column:
    return F.struct(F.lit("literal").alias("kind"), lex.alias("lex"), F.lit(datatype).cast("string").alias("datatype"), F.lit(lang).cast("string").alias("lang"))


def iri(lex: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit("iri").alias("kind"), lex.alias("lex"), none.alias("datatype"), none.alias("lang"))


def infer(v: Column) -> Column:
    """The store datatype that a value has by itself; NULL if it is undetermined."""
    x = v["lex"]
    out = F.when(v["kind"] == "iri", F.when(x.startswith(ITEM) | x.startswith(ITEM_ID), "wikibase-item").when(x.startswith(PROPERTY) | x.startswith(PROPERTY_ID), "wikibase-property").when(~x.startswith(LOCAL), "url"))
    out = out.when(v["lang"].isNotNull(), "monolingualtext")
    for kind, names in DATATYPES.items():
        out = out.when(v["datatype"].isin(*[XSD + n for n in names]), kind)
    return out


def _typed(kind: str, lex: Column, datatype: Column, lang: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), lex.alias("lex"), datatype.alias("datatype"), lang.alias("lang"))


def normalize(v: Column, want: Column, default_language: str = "en") -> Column:
    """STRUCT<value, reject>: the value as a property of datatype ``want`` holds it, or why it can't."""
    has, x = infer(v), strip(v["lex"])
    none, text = F.lit(None).cast("string"), F.lit(XSD + "string")
    kept = v.cast(VALUE)
    plain = (v["kind"] == "literal") & has.isNull()
    as_string = _typed("literal", x, text, none)
    valid_date = x.rlike(DATE) & F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).isNotNull()
    in_default = _typed("literal", v["lex"], none, F.lit(default_language))
    value = (
        F.when(want.isin("string", "external-id") & (has == "monolingualtext"), _typed("literal", v["lex"], text, none))
        .when((want == has) & want.isin("string", "url", "time", "wikibase-item", "wikibase-property", "monolingualtext"), kept)
        .when((want == "quantity") & (has == "quantity") & x.rlike(NUMBER), kept)
        .when(plain & want.isin("string", "external-id"), as_string)
        .when(plain & (want == "url"), _typed("iri", x, none, none))
        .when(plain & (want == "quantity") & x.rlike(NUMBER), _typed("literal", x, F.lit(XSD + "decimal"), none))
        .when(plain & (want == "time") & x.rlike(YEAR), _typed("literal", x, F.lit(XSD + "gYear"), none))
        .when(plain & (want == "time") & valid_date, _typed("literal", x, F.lit(XSD + "date"), none))
        .when((want == "monolingualtext") & (v["kind"] == "literal"), in_default)
    )
    reason = F.concat(F.coalesce(has, F.lit("plain value")), F.lit(" does not fit "), F.coalesce(want, F.lit("no datatype")))
    return F.struct(value.alias("value"), F.when(value.isNull(), reason).alias("reject"))


def time_text(lex: Column, datatype: Column) -> tuple[Column, Column]:
    """The store's time text and precision: a year 9, a year and month 10, all else 11."""
    sign = F.when(lex.startswith("-"), "-").otherwise("+")
    bare = F.when(lex.startswith("+") | lex.startswith("-"), F.regexp_replace(lex, "^[+-]+", "")).otherwise(lex)
    date = ~bare.contains("T") & ~bare.contains("Z") & ~bare.contains(":")  # nothing to search for
    utc = F.regexp_replace(bare, r"(Z|[+-][0-9]{2}:[0-9]{2})$", "")
    shifted = F.date_format(F.try_to_timestamp(bare), "yyyy-MM-dd'T'HH:mm:ss")  # an offset is taken to UTC
    whole = F.when(bare.rlike(r"T.*[+-][0-9]{2}:[0-9]{2}$"), F.coalesce(shifted, utc)).otherwise(utc)
    year, month = datatype == XSD + "gYear", datatype == XSD + "gYearMonth"
    text = F.when(year, F.concat(bare, F.lit("-00-00T00:00:00Z"))).when(month, F.concat(bare, F.lit("-00T00:00:00Z"))).when(date, F.concat(bare, F.lit("T00:00:00Z"))).when(whole.contains("T"), F.concat(whole, F.lit("Z"))).otherwise(F.concat(whole, F.lit("T00:00:00Z")))
    return F.concat(sign, text), F.when(year, 9).when(month, 10).otherwise(11)


def quantity_text(lex: Column) -> Column:
    x = strip(lex)
    return F.when(x.startswith("+") | x.startswith("-"), x).otherwise(F.concat(F.lit("+"), x))


def convert(v: Column, want: Column, value_id: Column, default_language: str = "en") -> Column:
    """A normalised value as the store writes it. ``value_id``: the id of the entity it names."""
    x = strip(v["lex"])
    time, precision = time_text(x, v["datatype"])
    when = lambda cond, then, cast="string": F.when(cond, then).cast(cast)
    is_time = want == "time"
    return F.when(
        v.isNotNull(),
        F.struct(
            want.alias("type"),
            when(want.isin("string", "url", "external-id", "monolingualtext"), x).alias("text"),
            when(want == "monolingualtext", F.coalesce(v["lang"], F.lit(default_language))).alias("language"),
            when(want == "quantity", quantity_text(x)).alias("amount"),
            when(want == "quantity", F.lit("1")).alias("unit"),
            when(is_time, time).alias("time"),
            when(is_time, precision, "int").alias("precision"),
            *[when(is_time, F.lit(0), "int").alias(n) for n in ("timezone", "before", "after")],
            when(is_time, F.lit(CALENDAR)).alias("calendarmodel"),
            when(want.isin("wikibase-item", "wikibase-property"), value_id).alias("id"),
        ),
    ).cast(WIKI)


def stored(rows: DataFrame, want: str, value_id: str, default_language: str = "en") -> DataFrame:
    """``rows`` with ``reject`` and ``wiki``: what ``normalize`` and then ``convert`` make of ``value`` for the datatype and the entity's id in two columns.

    Text and datatype are worked out once for a row, and each step's code stays small enough to be compiled.
    """
    v, w, x, has = F.col("value"), F.col(want), F.col("__x"), F.col("__has")
    plain = (v["kind"] == "literal") & has.isNull()
    valid_date = x.rlike(DATE) & F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).isNotNull()
    fits = (
        F.when(w.isin("string", "external-id"), (has == "monolingualtext") | plain | ((w == "string") & (has == w)))
        .when(w == "quantity", (plain | (has == w)) & x.rlike(NUMBER))
        .when(w == "time", (has == w) | (plain & (x.rlike(YEAR) | valid_date)))
        .when(w == "url", plain | (has == w))
        .when(w == "monolingualtext", (v["kind"] == "literal") | (has == w))
        .when(w.isin("wikibase-item", "wikibase-property"), has == w)
    )
    reject = F.concat(F.coalesce(has, F.lit("plain value")), F.lit(" does not fit "), F.coalesce(w, F.lit("no datatype")))
    datatype = F.when(has.isNotNull(), v["datatype"]).when(x.rlike(YEAR), XSD + "gYear")
    time, precision = time_text(F.col("__t"), F.col("__dt"))
    when = lambda kind, then, cast="string": F.when(w == kind, then).cast(cast)
    wiki = F.struct(
        w.alias("type"),
        F.when(w.isin("string", "url", "external-id", "monolingualtext"), x).alias("text"),
        when("monolingualtext", F.coalesce(v["lang"], F.lit(default_language))).alias("language"),
        when("quantity", F.when(x.startswith("+") | x.startswith("-"), x).otherwise(F.concat(F.lit("+"), x))).alias("amount"),
        when("quantity", F.lit("1")).alias("unit"),
        F.col("__time").alias("time"),
        F.col("__precision").alias("precision"),
        *[when("time", F.lit(0), "int").alias(n) for n in ("timezone", "before", "after")],
        when("time", F.lit(CALENDAR)).alias("calendarmodel"),
        F.when(w.isin("wikibase-item", "wikibase-property"), F.col(value_id)).alias("id"),
    )
    out = rows.withColumns({"__x": strip(v["lex"]), "__has": infer(v)})
    out = out.withColumns({"reject": F.when(~F.coalesce(fits, F.lit(False)), reject), "__t": when("time", x), "__dt": when("time", datatype)})
    out = out.withColumns({"__time": F.when(F.col("__t").isNotNull(), time), "__precision": when("time", precision, "int")})
    return out.withColumn("wiki", F.when(F.col("reject").isNull(), wiki).cast(WIKI)).drop("__x", "__has", "__t", "__dt", "__time", "__precision")


def match_key(w: Column) -> Column:
    """Two claims of a property match when their keys are equal: entity id; text; text and language; amount; time and precision."""
    return (
        F.when(w["type"].isin("wikibase-item", "wikibase-property"), w["id"])
        .when(w["type"].isin("string", "url", "external-id"), w["text"])
        .when(w["type"] == "monolingualtext", F.to_json(F.struct(w["text"].alias("text"), w["language"].alias("language"))))
        .when(w["type"] == "quantity", w["amount"])
        .when(w["type"] == "time", F.concat(w["time"], F.lit("/"), w["precision"].cast("string")))
    )


def envelope(w: Column) -> Column:
    """The datavalue in JSON, for every datatype."""
    entity = F.to_json(F.struct(F.struct(F.when(w["type"] == "wikibase-item", "item").otherwise("property").alias("entity-type"), w["id"].alias("id")).alias("value"), F.lit("wikibase-entityid").alias("type")))
    text = F.to_json(F.struct(w["text"].alias("value"), F.lit("string").alias("type")))
    mono = F.to_json(F.struct(F.struct(w["text"].alias("text"), w["language"].alias("language")).alias("value"), F.lit("monolingualtext").alias("type")))
    amount = F.to_json(F.struct(F.struct(w["amount"].alias("amount"), w["unit"].alias("unit")).alias("value"), F.lit("quantity").alias("type")))
    time = F.to_json(F.struct(F.struct(*[w[n].alias(n) for n in ("time", "timezone", "before", "after", "precision", "calendarmodel")]).alias("value"), F.lit("time").alias("type")))
    return F.when(w["type"].isin("wikibase-item", "wikibase-property"), entity).when(w["type"].isin("string", "url", "external-id"), text).when(w["type"] == "monolingualtext", mono).when(w["type"] == "quantity", amount).when(w["type"] == "time", time)
