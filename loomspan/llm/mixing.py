"""Operator 9: mixing sources to target weights.

Sources, ordered by code point with null last, weigh 3, 1, 2, 3, ... and share
150 % of all words. A target stops at twice its source's words; the excess goes
to the others by weight. Whole epochs of a source come first. For the rest,
documents get Efraimidis-Spirakis keys -ln(u) / w, where u comes from a hash of
the document and w is its quality weight; sorted by key, they are taken while
their prefix sum of words is within the budget; one more is the document that
comes nearest to what is then missing.

Keys are cut into ranges, and ranges are summed before documents are, so a
source that holds most rows is dealt over many tasks.

Nulls: a null text has 0 words; a null source is a source of its own; rows with
a null doc_id are drawn by their text. Ties in keys (repeated rows) are ordered
by doc_id, then by words: repeated rows are interchangeable. A source
without words has target 0. Empty tables give empty results; extra columns are
ignored by :func:`mix_report` and kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, as_rows, staged, text_key

#: Rows in a range of keys, about.
RANGE_ROWS = 4_000
#: The unit interval is cut at 52 bits of the hash.
UNIT = float(1 << 52)


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.5 to 1.5: half, and the share of characters that are neither symbols nor digits."""
    whole = F.coalesce(text, F.lit(""))
    plain = F.length(F.translate(whole, "#*$%&|<>0123456789", ""))
    return F.when(whole == "", F.lit(0.5)).otherwise(0.5 + plain / F.length(whole))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))).cast("binary"))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / (UNIT + 1)
    return docs.select("doc_id", "source", text_key("text").alias("key"), word_count(F.col("text")).alias("size"), (-F.log(unit) / quality_weight(F.col("text"))).alias("draw"))


def targets(sources: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0), epochs: float = 2.0) -> DataFrame:
    """(source, source_size) with ``target``: weights share ``share`` of all words, up to ``epochs`` times a source.

    The least level L at which sum(min(L * weight, cap)) is the budget is found
    from sums over sources in order of cap / weight.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", epochs * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("budget", share * F.sum("source_size").over(Window.partitionBy(F.lit(0))))
    full = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").isNull(), "source")
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level)
    # A source is full if the level reached before it would exceed its ratio; the others share the first level that does not.
    s = s.withColumn("is_full", F.col("level") > F.col("ratio"))
    shared = F.max(F.when(~F.col("is_full"), F.col("level"))).over(Window.partitionBy(F.lit(0)))
    return s.select("source", "source_size", F.when(F.col("is_full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * shared)).alias("target"))


def mix_report(docs: DataFrame, seed: int = 17, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0), epochs: float = 2.0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and ``copies`` in the mix."""
    rows = staged(_sized(docs, seed), "sized").withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    per = staged(rows.groupBy("source", "no_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "sources")
    named = per.withColumn("source", F.when(~F.col("no_source"), F.col("source")))
    goal = targets(named.select("source", "source_size"), share, weights, epochs).withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    goal = staged(per.drop("source_size").join(goal, ["source", "no_source"]), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = goal.withColumn("ranges", 1 + F.floor(F.col("docs") / RANGE_ROWS))
    # A few rows per source, sent to all tasks only while small: Spark checks the size.
    rows = rows.join(goal, ["source", "no_source"])
    spread = F.floor((1 - F.exp(-F.col("draw"))) * F.col("ranges")).cast("long")
    rows = rows.withColumn("range", spread)
    sums = staged(rows.groupBy("source", "no_source", "range").agg(F.sum("size").alias("range_size")), "ranges")
    ahead = Window.partitionBy("source", "no_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "no_source", "range", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "no_source", "range").orderBy("draw", "doc_id", "size", "key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within)).join(sums, ["source", "no_source", "range"])
    rows = staged(rows.withColumn("end", F.col("ahead") + F.col("upto")), "drawn")
    # Documents that end within the budget are taken, and then the one that comes nearest to what is missing.
    parts = ["source", "no_source", "range"]
    used = rows.groupBy("source", "no_source").agg(F.coalesce(F.max(F.when(F.col("end") <= F.col("rest"), F.col("end"))), F.lit(0)).alias("used"))
    rows = rows.join(staged(sums.select(*parts).join(used, ["source", "no_source"]), "used"), parts).withColumn("miss", F.abs(F.col("rest") - F.col("used") - F.col("size")))
    open_ = (F.col("end") > F.col("rest")) & (F.col("miss") < F.col("rest") - F.col("used"))
    last = rows.where(open_).groupBy("source", "no_source").agg(F.min(F.struct("miss", "draw", "end", "range")).alias("last"))
    last = last.select("source", "no_source", "last.range", F.col("last.miss").alias("last_miss"), F.col("last.draw").alias("last_draw"), F.col("last.end").alias("last_end"))
    rows = rows.join(last, parts, "left")
    is_last = (F.col("miss") == F.col("last_miss")) & (F.col("draw") == F.col("last_draw")) & (F.col("end") == F.col("last_end"))
    drawn = (F.col("end") <= F.col("rest")) | (open_ & is_last)
    copies = F.col("whole") + F.when(F.coalesce(drawn, F.lit(False)) & (F.col("whole") < epochs), 1).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "key", F.when(~F.col("no_source"), F.col("source")).alias("source"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    took = mix_report(docs, **options).where("copies > 0").groupBy("doc_id", "source", "key").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("same"))
    rows = as_rows(docs).withColumns({"id": F.col("row")["doc_id"], "from": F.col("row")["source"], "text_key": text_key("row.text")})
    alike = rows["id"].eqNullSafe(took["doc_id"]) & rows["from"].eqNullSafe(took["source"]) & (rows["text_key"] == took["key"])
    joined = rows.join(took, alike)
    # Repeated rows share their copies evenly, the rest goes to whichever comes first.
    at = F.row_number().over(Window.partitionBy("id", "from", "text_key").orderBy(F.lit(0))) - 1
    base = F.floor(F.col("all") / F.col("same"))
    times = F.when(F.col("same") == 1, F.col("all")).otherwise(base + F.when(at < F.col("all") % F.col("same"), 1).otherwise(0))
    out = joined.withColumn("times", times.cast("int"))
    return out.withColumn("copy", F.explode(F.expr("if(times > 0, sequence(1, times), array())"))).select("row.*")
