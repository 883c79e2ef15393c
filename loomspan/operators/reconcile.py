"""Finding or creating entities, set by set.

One at a time, an entity would be looked up in the cache, searched by label,
and else created, its names visible to the next. As sets: known ids join; search
keys join the store's labels and aliases and those of the run's own entities,
until no entity finds a lesser one any more, whatever their order; entities that
the store would refuse, because label and description are taken, are the one that
has them. What is left is new, and numbered in order of IRI.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.terms import clean_text, iri_suffix, normalize_text
from ..names import ITEM, ITEM_ID, PROPERTY, PROPERTY_ID
from ..scratch import empty, small, written
from .store import Store

REJECTS = "stage string, key string, reason string, severity string"


class Violation(ValueError):
    """Problems of configuration, schema or identity; they stop a run."""


def demand_none(bad: DataFrame, what: str, limit: int = 20) -> None:
    """Raise with the first few of ``bad`` (key, reason), which should be empty."""
    found = bad.select("key", "reason").orderBy("key").limit(limit).collect()
    if found:
        raise Violation(f"{what}: " + "; ".join(f"{r['key']}: {r['reason']}" for r in found))


def dense_numbers(df: DataFrame, order: str, out: str) -> DataFrame:
    """Numbers 1, 2, ... in order of a column, without one task seeing all rows.

    Rows are dealt by ranges of the column and written; each part's size then
    tells where its numbers begin. What the driver gets is a row per part.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    held = written(ranged, "numbers")
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first")).orderBy("__part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["__part"], total - r["first"] + 1))
        total += r["n"]
    offsets = F.broadcast(small(spark, starts, "__part int, __offset long"))  # a row per part
    return held.join(offsets, "__part").withColumn(out, F.col("__at") + F.col("__offset")).drop("__part", "__at", "__offset")


def distinct_iris(subjects: DataFrame, *columns: str) -> DataFrame:
    """All IRIs in some columns, each once."""
    return subjects.select(F.explode(F.array(*columns)).alias("iri")).where("iri is not null").distinct()


# Terms -------------------------------------------------------------------------


def resolve_languages(terms: DataFrame, default: str, supported: set[str] | None = None) -> DataFrame:
    """Terms without a language get the default; unsupported languages stop the run."""
    out = terms.withColumn("lang", F.coalesce("lang", F.lit(default)))
    if supported:
        demand_none(out.where(~F.col("lang").isin(*sorted(supported))).select(F.col("iri").alias("key"), F.concat(F.lit("unsupported language "), F.col("lang")).alias("reason")).distinct(), "languages")
    return out


def collect_terms(terms: DataFrame, check: bool = True) -> DataFrame:
    """Cleaned distinct terms; two different labels or descriptions in one language stop the run."""
    clean = terms.withColumn("value", normalize_text(clean_text(F.col("value")))).where("value is not null").distinct()
    if check:
        demand_none(term_conflicts(clean), "terms")
    return clean


def term_conflicts(terms: DataFrame) -> DataFrame:
    two = terms.where("kind <> 'alias'").groupBy("iri", "kind", "lang").agg(F.count_distinct("value").alias("n")).where("n > 1")
    return two.select(F.col("iri").alias("key"), F.concat_ws(" ", F.lit("has"), F.col("n"), F.lit("different"), F.concat("kind", F.lit("s")), F.lit("in"), "lang").alias("reason"))


def with_fallback_labels(iris: DataFrame, terms: DataFrame, default: str) -> DataFrame:
    """``terms`` and, for each of ``iris`` without any label, its key as a label in the default language."""
    bare = iris.join(terms.where("kind = 'label'").select("iri"), "iri", "left_anti")
    return terms.unionByName(bare.select("iri", F.lit("label").alias("kind"), F.lit(default).alias("lang"), iri_suffix(F.col("iri"), ITEM, PROPERTY).alias("value")))


def search_keys(terms: DataFrame, default: str) -> DataFrame:
    """(iri, lang, key): the label in the default language, else in the least language there is."""
    order = F.struct((F.col("lang") != default).alias("other"), "lang", "value")
    best = terms.where("kind = 'label'").groupBy("iri").agg(F.min(order).alias("b"))
    return best.select("iri", "b.lang", F.lower(F.trim("b.value")).alias("key"))


# Resolution ----------------------------------------------------------------------


def id_number(x: Column) -> Column:
    return F.substr(x, F.lit(2), F.length(x)).cast("long")


def search_matches(keys: DataFrame, store: Store, kind: str, datatype: bool = False) -> DataFrame:
    """(iri, id, matches): the first entity by number whose label or alias is the key; with ``datatype``, of the same datatype."""
    labels = store.terms.where(F.col("kind").isin("label", "alias")).select("id", "lang", F.lower(F.trim("value")).alias("key")).distinct()
    kinds = store.entities.where(F.col("kind") == kind).select("id", F.col("datatype").alias("has"))
    hits = keys.join(labels.join(kinds, "id"), ["lang", "key"])
    if datatype:
        hits = hits.where(F.col("has") == F.col("datatype"))
    return hits.groupBy("iri").agg(F.min_by("id", id_number(F.col("id"))).alias("id"), F.count_distinct("id").alias("matches"))


@dataclass
class Resolution:
    """ids: (iri, id, kind, datatype) of all entities asked for; created: those that are new."""

    ids: DataFrame
    created: DataFrame


#: How entities compare: those that have an id by its number, before new ones by the IRI that leads them.
_WHO = "struct<new:boolean,number:bigint,lead:string>"


def _names(terms: DataFrame) -> DataFrame:
    """(iri, lang, key) of all labels and aliases."""
    return terms.where(F.col("kind").isin("label", "alias")).select("iri", "lang", F.lower(F.trim("value")).alias("key")).distinct()


def _taken_names(terms: DataFrame, who: str, kind: str) -> DataFrame:
    """(``who``, lang, label, about) that only one entity may have: the label, of items with the description."""
    label = terms.where("kind = 'label'").select(who, "lang", F.col("value").alias("label"))
    if kind == "property":
        return label.withColumn("about", F.lit(""))
    return label.join(terms.where("kind = 'description'").select(who, "lang", F.col("value").alias("about")), [who, "lang"])


def _merged(now: DataFrame, mine: DataFrame, names: DataFrame | None, keys: DataFrame, same: list[str]) -> DataFrame:
    """``now`` (iri, datatype, cached, who), where entities that mean one have the least ``who`` of them all.

    A name that one entity alone has moves nothing, so only names that several
    share, and the entities that have them, are gone through again and again.
    """
    taken = ["lang", "label", "about"]
    shared = lambda df, by: df.join(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by), by, "left_semi")
    # Tables that grow with the entities are small on disk and large in memory: they are never sent to all tasks.
    dealt = lambda df: df.hint("merge")
    mine = written(shared(mine.select("iri", *taken).distinct(), taken), "mine")
    searched = names is not None
    if searched:
        key = ["lang", "key", *same]
        names = written(shared(names.join(now.select("iri", *same), "iri").select("iri", *key), key), "names")
        searched = not names.isEmpty()
        keys = keys.join(names.select(*key).distinct(), key, "left_semi").select("iri", *key)
        keys = written(keys, "keys") if searched else keys
    if not searched and mine.isEmpty():
        return now
    who = mine.select("iri").union(names.select("iri")) if searched else mine.select("iri")
    part = written(now.join(dealt(who.distinct()), "iri", "left_semi"), "who")
    moved = False
    while True:
        at = part.select("iri", "who")
        nearer = [dealt(at).join(mine, "iri").groupBy(*taken).agg(F.min("who").alias("least")).join(dealt(mine), taken).select("iri", "least")]
        if searched:
            nearer.append(dealt(at).join(names, "iri").groupBy(*key).agg(F.min("who").alias("least")).join(dealt(keys), key).select("iri", "least"))
        best = reduce(DataFrame.unionByName, nearer).groupBy("iri").agg(F.min("least").alias("least"))
        then = part.join(dealt(best), "iri", "left").withColumn("moves", ~F.col("cached") & F.coalesce(F.col("least") < F.col("who"), F.lit(False)))
        then = written(then.withColumn("who", F.when(F.col("moves"), F.col("least")).otherwise(F.col("who"))).drop("least"), "who")
        if then.where("moves").isEmpty():
            break
        part, moved = then.drop("moves"), True
    if not moved:
        return now
    return written(now.join(dealt(part.select("iri", F.col("who").alias("least"))), "iri", "left").withColumn("who", F.coalesce("least", "who")).drop("least"), "who")


def resolve(entities: DataFrame, terms: DataFrame, lookup: DataFrame, store: Store, kind: str, default: str = "en", search: bool = True) -> Resolution:
    """Ids for ``entities`` (iri, datatype): cached, else found by label, else one new id for all that mean one entity.

    Without ``search``, or where it finds none, an entity takes over an id if its
    label (and for items its description) in some language is taken, as the
    store would refuse a second one.
    """
    known = entities.join(lookup.where(F.col("kind") == kind).select("iri", "id", F.col("datatype").alias("cached")), "iri", "left")
    known = written(known.select("iri", "id", "cached", "datatype"), "known")
    if kind == "property":
        wrong = known.where((F.col("cached") != F.col("datatype")))
        demand_none(wrong.select(F.col("iri").alias("key"), F.concat(F.lit("is "), F.col("cached"), F.lit(" in the cache, not "), F.col("datatype")).alias("reason")), "datatypes")
    if known.where("id is null").isEmpty():
        letter = F.lit("Q" if kind == "item" else "P")
        return Resolution(known.select("iri", F.concat(letter, id_number(F.col("id")).cast("string")).alias("id"), F.lit(kind).alias("kind"), F.coalesce("datatype", "cached").alias("datatype")), empty(known.sparkSession, "id string, kind string, datatype string"))
    none = F.lit(None).cast("string")
    number = lambda x: F.struct(F.lit(False).alias("new"), id_number(x).alias("number"), none.alias("lead")).cast(_WHO)
    self_ = F.struct(F.lit(True).alias("new"), F.lit(None).cast("long").alias("number"), F.col("iri").alias("lead")).cast(_WHO)
    known = known.select("iri", F.coalesce("datatype", "cached").alias("datatype"), F.col("id").isNotNull().alias("cached"), F.when(F.col("id").isNotNull(), number(F.col("id"))).otherwise(self_).alias("who"))
    keys = search_keys(terms, default).join(known.where("not cached").select("iri", "datatype"), "iri")
    if search:
        hits = search_matches(keys, store, kind, kind == "property")
        if kind == "property":
            anything = search_matches(keys, store, kind).select("iri")
            demand_none(anything.join(hits, "iri", "left_anti").select(F.col("iri").alias("key"), F.lit("its label belongs to a property of another datatype").alias("reason")), "properties")
        known = known.join(hits.select("iri", F.col("id").alias("hit")), "iri", "left").withColumn("who", F.when(F.col("hit").isNotNull(), number(F.col("hit"))).otherwise(F.col("who"))).drop("hit")
    own = terms.join(entities.select("iri"), "iri", "left_semi")
    mine = _taken_names(own, "iri", kind)
    theirs = _taken_names(store.terms.join(store.entities.where(F.col("kind") == kind).select("id"), "id", "left_semi"), "id", kind)
    refused = mine.join(theirs, ["lang", "label", "about"]).groupBy("iri").agg(F.min_by("id", id_number(F.col("id"))).alias("other"))
    known = known.join(refused, "iri", "left").withColumn("who", F.when(F.col("who.new") & F.col("other").isNotNull(), number(F.col("other"))).otherwise(F.col("who"))).drop("other")
    now = written(known, "who")
    now = _merged(now, mine, _names(own) if search else None, keys, ["datatype"] if kind == "property" else [])
    letter = "Q" if kind == "item" else "P"
    last = store.entities.where(F.col("kind") == kind).agg(F.coalesce(F.max(id_number(F.col("id"))), F.lit(0)).alias("n")).first()["n"]
    new = now.where("who.new")
    leads = new.select(F.col("who.lead").alias("lead")).distinct()
    few = new.limit(10_001).count() <= 10_000  # what one task may number
    numbered = leads.withColumn("n", F.row_number().over(Window.orderBy("lead")).cast("long")) if few else dense_numbers(leads, "lead", "n")
    ids = now.select("iri", "datatype", "who.number", "who.lead").join(numbered, "lead", "left")
    ids = written(ids.select("iri", F.concat(F.lit(letter), F.coalesce("number", F.col("n") + last).cast("string")).alias("id"), F.lit(kind).alias("kind"), "datatype", F.col("n").isNotNull().alias("fresh")), "ids")
    new = ids.where("fresh").groupBy("id").agg(F.min("datatype").alias("datatype"))
    return Resolution(ids.drop("fresh"), written(new.select("id", F.lit(kind).alias("kind"), "datatype"), "created"))


def direct_id_problems(found: DataFrame, store: Store) -> DataFrame:
    """(key, reason) for rows (iri, kind, id) whose id has a wrong form, doesn't exist, or is a property's without a datatype."""
    form = F.when(F.col("kind") == "item", F.col("id").rlike("^Q[0-9]+$")).otherwise(F.col("id").rlike("^P[0-9]+$"))
    joined = found.join(store.entities.select("id", F.col("kind").alias("has"), "datatype"), "id", "left")
    bare = (F.col("kind") == "property") & F.col("datatype").isNull()
    reason = F.when(~form, "is no id").when(F.col("has").isNull() | (F.col("has") != F.col("kind")), "does not exist").when(bare, "has no datatype")
    return joined.select(F.col("iri").alias("key"), reason.alias("reason")).where("reason is not null")


def direct_ids(iris: DataFrame, store: Store) -> DataFrame:
    """Lookup rows for IRIs that hold an id; ids of a wrong form, that don't exist, or without a datatype stop the run."""
    found = iris.where(F.col("iri").startswith(ITEM_ID) | F.col("iri").startswith(PROPERTY_ID)).select("iri").distinct()
    found = found.withColumn("kind", F.when(F.col("iri").startswith(ITEM_ID), "item").otherwise("property")).withColumn("id", iri_suffix(F.col("iri"), ITEM_ID, PROPERTY_ID))
    demand_none(direct_id_problems(found, store), "direct ids")
    return found.join(store.entities.select("id", "datatype"), "id").select("iri", "id", "kind", "datatype")


def single_property_types(declared: DataFrame) -> DataFrame:
    """(iri, datatype) of declared properties; any number of types but one stops the run."""
    kinds = declared.groupBy("iri").agg(F.collect_set("datatype").alias("types"))
    demand_none(kinds.where(F.size("types") != 1).select(F.col("iri").alias("key"), F.concat(F.lit("has "), F.size("types"), F.lit(" property types")).alias("reason")), "property types")
    return kinds.select("iri", F.element_at("types", 1).alias("datatype"))


def first_by_number(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: the one whose id has the least number."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(id_number(F.col("id"))))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def empty_rejects(spark: SparkSession) -> DataFrame:
    return empty(spark, REJECTS)
