"""Adding to the store only what it lacks: terms, claims, qualifiers and references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..names import RDFS
from ..scratch import empty, small, written
from .reconcile import REJECTS, demand_none
from .store import LOOKUP, Store

INSTANCE_OF = "urn:wikibase:property:instanceOf"
SUBCLASS_OF = "urn:wikibase:property:subclassOf"
BUILTINS = ((INSTANCE_OF, "instance of"), (SUBCLASS_OF, "subclass of"))
CLAIM = ["guid", "subject_id", "pid", "datatype", "value", "value_key", "rank", "snaktype"]


def terms_diff(wanted: DataFrame, store: Store) -> DataFrame:
    """Rows (id, kind, lang, value) to add: labels and descriptions only in languages without one; aliases unless the text is an alias or the label already."""
    one = wanted.where("kind <> 'alias'").groupBy("id", "kind", "lang").agg(F.min("value").alias("value")).join(store.terms, ["id", "kind", "lang"], "left_anti")
    labels = one.where("kind = 'label'").unionByName(store.terms.where("kind = 'label'")).select("id", "lang", "value")
    aliases = wanted.where("kind = 'alias'").distinct().join(labels.unionByName(store.terms.where("kind = 'alias'").select("id", "lang", "value")), ["id", "lang", "value"], "left_anti")
    return one.unionByName(aliases.select(*one.columns))


def kept_terms(wanted: DataFrame, store: Store) -> DataFrame:
    """Rejects for labels and descriptions that the store has otherwise: it keeps its own."""
    both = wanted.where("kind <> 'alias'").join(store.terms.withColumnRenamed("value", "has"), ["id", "kind", "lang"]).where("value <> has")
    return both.select(F.lit("terms").alias("stage"), "id", F.concat_ws(" ", "kind", F.lit("in"), "lang", F.lit("is kept as"), "has").alias("reason")).select("stage", F.col("id").alias("key"), "reason", F.lit("warning").alias("severity"))


def add_terms(store: Store, terms: DataFrame, ids: DataFrame) -> tuple[Store, DataFrame]:
    """The store with what ``terms`` (iri, ...) add, and what was kept back."""
    all_ = terms.join(ids.select("iri", "id"), "iri").select("iri", "id", "kind", "lang", "value").distinct()
    # Of several entities that are one, the first by IRI gives the label and the description of a language.
    first = all_.where("kind <> 'alias'").groupBy("id", "kind", "lang").agg(F.min(F.struct("iri", "value"))["value"].alias("value"))
    wanted = first.unionByName(all_.where("kind = 'alias'").select("id", "kind", "lang", "value").distinct())
    return store.append(terms=written(terms_diff(wanted, store), "terms")), kept_terms(all_.select("id", "kind", "lang", "value").distinct(), store)


def claims_for(pairs: DataFrame) -> DataFrame:
    """Item claims from (subject_id, pid, value_id)."""
    item = F.struct(F.lit("iri").alias("kind"), F.col("value_id").alias("lex"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    value = values.convert(item, F.lit("wikibase-item"), F.col("value_id"))
    return with_guid(pairs.select("subject_id", "pid", F.lit("wikibase-item").alias("datatype"), value.alias("value"), F.lit("normal").alias("rank")))


def with_guid(claims: DataFrame) -> DataFrame:
    key = values.match_key(F.col("value"))
    guid = F.concat(F.col("subject_id"), F.lit("$"), F.sha2(F.concat_ws("|", "pid", key), 256))
    return claims.withColumn("value_key", key).withColumn("guid", guid).withColumn("snaktype", F.lit("value"))


def missing_claims(claims: DataFrame, store: Store) -> DataFrame:
    """Claims without a match in the store, one each; only claims that have a value can match."""
    there = store.claims.where("snaktype = 'value'").select("subject_id", "pid", "value_key")
    return claims.dropDuplicates(["subject_id", "pid", "value_key"]).join(there, ["subject_id", "pid", "value_key"], "left_anti").select(*CLAIM)


def add_instance_of(store: Store, types: DataFrame, items: DataFrame, pid: str) -> Store:
    """instance-of claims for (iri, class_iri); every class and entity must have an id."""
    ids = items.select("iri", "id")
    joined = types.join(ids.withColumnRenamed("id", "subject_id"), "iri", "left").join(ids.select(F.col("iri").alias("class_iri"), F.col("id").alias("value_id")), "class_iri", "left")
    bad = joined.where("subject_id is null or value_id is null")
    demand_none(bad.select(F.coalesce("iri", "class_iri").alias("key"), F.lit("has no id").alias("reason")), "instance of")
    return store.append(claims=written(missing_claims(claims_for(joined.select("subject_id", F.lit(pid).alias("pid"), "value_id")), store), "types"))


def add_subclass_of(spark: SparkSession, store: Store, classes: list, items: DataFrame, pid: str) -> Store:
    """subclass-of claims between declared classes."""
    pairs = small(spark, [(d.iri, p) for d in classes for p in d.parents], "iri string, class_iri string")
    return add_instance_of(store, pairs, items, pid)


def cardinality(statements: DataFrame) -> DataFrame:
    """Rejects: statements with more than one subject, property or value; more than one rank has severity error."""
    parts = {"subject": "subject_iri", "property": "prop_iri", "value": "value", "rank": "rank"}
    n = statements.groupBy("stmt_iri").agg(*[(F.min(c) != F.max(c)).alias(k) for k, c in parts.items()])
    several = F.concat_ws(", ", *[F.when(F.col(k), k) for k in parts])
    out = n.select("stmt_iri", several.alias("several"), "rank").where("several <> ''")
    return out.select(F.lit("statements").alias("stage"), F.col("stmt_iri").alias("key"), F.concat(F.lit("more than one "), "several").alias("reason"), F.when(F.col("rank"), "error").otherwise("warning").alias("severity"))


def _few(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """``df``, sent to all tasks if a count says that it has few rows: names of properties recur in all rows, so joining by them would deal rows to few tasks."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _valued(rows: DataFrame, lookup: DataFrame, default: str, stage: str, key: str) -> DataFrame:
    """``rows`` with pid, datatype (want), the id of the entity named, the store's value (wiki) and the reason of a reject, written."""
    properties = lookup.where("kind = 'property'").select(F.col("iri").alias("prop_iri"), F.col("id").alias("pid"), F.col("datatype").alias("want"))
    entities = lookup.select(F.col("iri").alias("__iri"), F.col("id").alias("value_id"))
    joined = rows.join(_few(properties), "prop_iri", "left")
    # Literals find no entity; their keys spread them over all tasks.
    names = F.when(F.col("value.kind") == "iri", F.col("value.lex")).otherwise(F.concat(F.lit("\0"), F.xxhash64(key, "value.lex").cast("string")))
    joined = joined.withColumn("__name", names).join(entities, F.col("__name") == F.col("__iri"), "left").drop("__iri", "__name")
    done = values.stored(joined, "want", "value_id", default)
    named = F.col("want").isin("wikibase-item", "wikibase-property")
    reason = (
        F.when(F.col("pid").isNull(), F.concat(F.lit("no property "), F.col("prop_iri")))
        .when(F.col("want").isNull(), F.concat(F.lit("no datatype for "), F.col("prop_iri")))
        .when(F.col("reject").isNotNull(), F.col("reject"))
        .when(named & F.col("value_id").isNull(), F.concat(F.lit("no id for "), F.col("value.lex")))
    )
    return written(done.withColumn("reason", reason).drop("reject", "value", "prop_iri"), stage)


def _rejected(done: DataFrame, stage: str, key: str) -> DataFrame:
    return done.where("reason is not null").select(F.lit(stage).alias("stage"), F.col(key).alias("key"), "reason", F.lit("warning").alias("severity"))


def with_values(rows: DataFrame, lookup: DataFrame, default: str, stage: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with pid, datatype and the store's value; and rejects. Property and value names join the lookup."""
    done = _valued(rows, lookup, default, stage, key)
    return done.where("reason is null"), _rejected(done, stage, key)


def _single(statements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stmt_iri, subject_iri, prop_iri, value, rank) of the statements that have one of each, once; and rejects for the others. Only rows of names that recur are compared."""
    own = statements.select("stmt_iri", "subject_iri", "prop_iri", "value", "rank")
    again = written(own.groupBy("stmt_iri").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("stmt_iri"), "again")
    if again.isEmpty():
        return own, empty(own.sparkSession, REJECTS)
    bad = written(cardinality(own.join(again, "stmt_iri", "left_semi")), "several")
    demand_none(bad.where("severity = 'error'"), "ranks")
    return own.join(bad.select(F.col("key").alias("stmt_iri")), "stmt_iri", "left_anti").distinct(), bad


def add_statements(store: Store, statements: DataFrame, lookup: DataFrame, default: str) -> tuple[Store, DataFrame, DataFrame, DataFrame]:
    """The store with new claims; (stmt_iri, guid) of the new; of all; and rejects. ``lookup`` has an IRI once for each kind.

    A statement that the store has keeps its rank, qualifiers and references.
    """
    once, bad = _single(statements)
    # Items come before properties where both have the IRI.
    items = lookup.where("kind = 'item'").select(F.col("iri").alias("subject_iri"), F.col("id").alias("item_id"))
    properties = _few(lookup.where("kind = 'property'").select(F.col("iri").alias("subject_iri"), F.col("id").alias("property_id")))
    joined = once.join(items, "subject_iri", "left").join(properties, "subject_iri", "left")
    done = _valued(joined.withColumn("subject_id", F.coalesce("item_id", "property_id")).drop("item_id", "property_id"), lookup, default, "statements", "stmt_iri")
    demand_none(done.where("subject_id is null").select(F.col("subject_iri").alias("key"), F.lit("has no id").alias("reason")).distinct(), "subjects")
    claims = done.where("reason is null").select("stmt_iri", "subject_id", "pid", F.col("want").alias("datatype"), F.col("wiki").alias("value"), "rank").withColumn("value_key", values.match_key(F.col("value")))
    # Statements that mean one claim: the first by name tells its rank.
    same = ["subject_id", "pid", "value_key"]
    first = claims.repartition(*same).groupBy(*same).agg(F.min(F.struct("stmt_iri", "datatype", "value", "rank")).alias("one"))
    there = store.claims.where("snaktype = 'value'").select(*same)
    own = first.join(there, same, "left_anti").select("subject_id", "pid", "one.datatype", "one.value", "one.rank")
    new = written(with_guid(own).select(*CLAIM), "claims")
    guids = written(with_guid(claims.join(new.select(*same), same, "left_semi")).select("stmt_iri", "guid"), "new")
    return store.append(claims=new), guids, with_guid(claims).select("stmt_iri", "guid").distinct(), bad.unionByName(_rejected(done, "statements", "stmt_iri"))


def add_qualifiers(store: Store, qualifiers: DataFrame, new: DataFrame, lookup: DataFrame, default: str) -> tuple[Store, DataFrame]:
    """Qualifiers of new statements only."""
    if new.isEmpty():
        return store, empty(new.sparkSession, REJECTS)
    valued, rejects = with_values(qualifiers.join(new, "stmt_iri"), lookup, default, "qualifiers", "stmt_iri")
    rows = valued.select("guid", "pid", F.col("wiki").alias("value")).distinct()
    return store.append(qualifiers=written(rows, "rows")), rejects


def add_references(store: Store, snaks: DataFrame, new: DataFrame, lookup: DataFrame, default: str) -> tuple[Store, DataFrame]:
    """References of new statements: all valid snaks of a reference together; one without any is skipped. A reference has one statement."""
    owners = snaks.groupBy("ref_iri").agg(F.count_distinct("stmt_iri").alias("n")).where("n <> 1")
    demand_none(owners.select(F.col("ref_iri").alias("key"), F.lit("belongs to several statements").alias("reason")), "references")
    if new.isEmpty():
        return store, empty(new.sparkSession, REJECTS)
    valued, rejects = with_values(snaks.select("stmt_iri", "ref_iri", "prop_iri", "value").join(new, "stmt_iri"), lookup, default, "references", "ref_iri")
    # Rows are dealt by statement once: its references are grouped, and compared, where they are.
    grouped = valued.select("guid", "ref_iri", "pid", "wiki").repartition("guid").groupBy("guid", "ref_iri").agg(F.array_sort(F.collect_set(F.struct("pid", F.col("wiki").alias("value")))).alias("snaks"))
    rows = grouped.select("guid", F.sha2(F.to_json("snaks"), 256).alias("ref_hash"), "snaks").distinct()
    return store.append(references=written(rows, "refs")), rejects


def snaks_by_property(references: DataFrame) -> DataFrame:
    """References as the store's payload groups them: a map from property to its snaks' values in JSON.

    A row is a whole reference, so nothing is grouped across rows.
    """
    told = F.transform("snaks", lambda s: F.struct(s["pid"].alias("pid"), values.envelope(s["value"]).alias("body")))
    of = lambda p: F.array_sort(F.transform(F.filter("told", lambda s: s["pid"] == p), lambda s: s["body"]))
    pids = F.array_sort(F.array_distinct(F.col("told.pid")))
    out = references.where("size(snaks) > 0").select("guid", "ref_hash", told.alias("told"))
    return out.select("guid", "ref_hash", F.map_from_entries(F.transform(pids, lambda p: F.struct(p.alias("pid"), of(p).alias("values")))).alias("snaks"))


def outside_properties(lookup: DataFrame, instance_of: str, subclass_of: str) -> DataFrame:
    """Lookup rows for outside predicates that mean a built-in property."""
    rdf_type = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    return lookup.unionByName(small(lookup.sparkSession, [(RDFS + "subClassOf", subclass_of, "property", "wikibase-item"), (rdf_type, instance_of, "property", "wikibase-item")], LOOKUP))
