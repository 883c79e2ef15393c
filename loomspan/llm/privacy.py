"""Operator 6: information-theoretic sanitisation, in DataFrame functions only.

Patterns find e-mail addresses, IP addresses, payment cards, phone numbers and
secrets (long tokens of mixed letters and digits): the protected entities.
Terms are counted with them over the whole distinct texts of the corpus. A term
discloses an entity if enough of the texts with the term have the entity
(P(entity | term)) and the term gives away enough of the entity's information:
pointwise mutual information against -log2 P(entity). Disclosing terms become
spans wherever they stand, in documents without the entity too; terms inside
e-mail addresses are part of those. :func:`sanitise` replaces entities by their
kind, generalises terms, and removes those that all but name the entity.

How it stays wide: each distinct text is worked on once (only texts that may
have copies are shuffled); terms that stand in one and the same set of texts
are one class, and so are entities, so that pairs are counted between classes;
a table of bits of fixed size keeps most terms from being shuffled again before
the exact join. When that table fills up, it costs time, not results.

Nulls: a null text is empty and has no spans; rows with a null doc_id are
searched like others. Ties in order go by kind. Repeated rows and copies of a
text are found alike and count once in the statistics. Texts of any length are
near-linear work: every pattern starts at one place of a run only and takes the
run whole, and lists grow in blocks. Empty tables give empty results; extra
columns are ignored, whatever their names, and kept by :func:`sanitise`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone", "secret", "term")
BASE = 4  # kinds of the base

# Each pattern matches what the plain form in the contract matches, from left to
# right: a run of characters is entered at its beginning or where the last match
# ended, and taken whole, so no text makes the matcher go back and forth.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Stands for a single blank or hyphen between digits, so that a card is one class of characters.
JOINT = "\ue000"
CARD = f"[0-9][0-9{JOINT}]++"
#: A run of token characters; long ones of mixed letters and digits are secrets.
SECRET = r"(?<![A-Za-z0-9_+=-])[A-Za-z0-9_+=-]{20,}+"
TERM = r"\p{L}[\p{L}'’]{2,}+"
#: Stand before and after a term to be marked.
OPEN, SHUT = "\ue002", "\ue003"

_NONE = "cast(array() as array<struct<start:int,end:int,match:string>>)"
_NO_SPANS = "cast(array() as array<struct<start:int,rank:int,end:int,entity:string>>)"


#: log2 of the bits in a table that screens terms or texts before a join.
TABLE_BITS = 24
#: Items by which a list grows at a time.
BLOCK = 512


@dataclass(frozen=True)
class Disclosure:
    """texts: distinct texts with both; share: P(entity | term); information: part of the entity's information that the term gives; remove: share from which a term is removed."""

    texts: int = 1
    share: float = 0.6
    information: float = 0.5
    remove: float = 0.9


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _folded(items: Column, step, none: str) -> Column:
    """The outcomes of ``step(at, item)`` -> (next at, outcome) over ``items``, from left to right.

    A list is copied when it grows, so outcomes are gathered by blocks first.
    """

    def one(state: Column, item: Column) -> Column:
        at, out = step(state["at"], item)
        return F.struct(at.cast("int").alias("at"), F.concat(state["out"], F.array(out)).alias("out"))

    def whole(xs: Column) -> Column:
        def block(state: Column, k: Column) -> Column:
            begin = F.struct(state["at"].alias("at"), F.expr(none).alias("out"))
            return F.aggregate(F.slice(xs, k * BLOCK + 1, F.lit(BLOCK)), begin, one, lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], s["out"]).alias("out")))

        blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK)).cast("int"))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.expr(none).alias("out")), block, lambda s: s["out"])

    return _let(items, whole)


def _parts(text: Column, pattern: str) -> Column:
    """(gap, match) for each of the leftmost non-overlapping matches; what follows the last is left out."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("match"))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their code-point positions, from what lies between them."""

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        return end, F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))

    return _folded(_parts(text, pattern), step, _NONE)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.floor(2 * x / 10).cast("int") + (2 * x) % 10
        return (total + F.when(i % 2 == 0, twice).otherwise(x)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _kept(found: Column, keep, kind: str, entity) -> Column:
    spans = F.filter(found, keep) if keep else found
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.concat(F.lit(f"{kind}:"), entity(s["match"])).alias("entity")))


def base_spans(text: Column) -> Column:
    """The entities of a text, by start and then kind: (start, rank of kind, end, entity)."""
    none = F.expr(_NO_SPANS)
    joined = F.regexp_replace(F.translate(text, JOINT, "\ue001"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    email = _kept(matches(text, EMAIL), None, "email", F.lower)
    ip = _kept(matches(text, IP), lambda s: F.forall(F.split(s["match"], r"\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")), "ip", lambda m: m)
    long_ = lambda s: (F.length(_digits(s["match"])) >= 12) & (F.length(_digits(s["match"])) <= 19)
    card = _kept(F.filter(matches(joined, CARD), long_), lambda s: _luhn(_digits(s["match"])), "card", _digits)
    phone = _kept(matches(text, PHONE), lambda s: (F.length(_digits(s["match"])) >= 9) & (F.length(_digits(s["match"])) <= 15), "phone", _digits)
    count = lambda m, kept: F.length(F.regexp_replace(m, kept, ""))
    mixed = lambda s: (count(s["match"], "[^0-9]") >= 5) & (count(s["match"], "[^A-Za-z]") >= 5)
    # Not those inside an e-mail address.
    secret = _kept(matches(_plain(text), SECRET), mixed, "secret", lambda m: m)
    parts = [
        F.when(F.contains(text, F.lit("@")), email).otherwise(none),
        F.when(text.rlike(r"[0-9]\.[0-9]"), ip).otherwise(none),
        F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), card).otherwise(none),
        F.when(F.contains(text, F.lit("+")), phone).otherwise(none),
        F.when(text.rlike("[A-Za-z0-9_+=-]{20}"), secret).otherwise(none),
    ]
    return F.array_sort(F.concat(*parts))


def _plain(text: Column) -> Column:
    """``text`` with blanks in place of e-mail addresses, the only entities that may hold terms; all positions as they were."""
    blanked = F.array_join(F.transform(_parts(text, EMAIL), lambda p: F.concat(p["gap"], F.repeat(F.lit(" "), F.length(p["match"])))), "")
    return F.when(F.contains(text, F.lit("@")), F.concat(blanked, F.element_at(F.split(text, EMAIL, -1), -1))).otherwise(text)


def _terms(plain: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0)), F.lower))


def _term_spans(plain: Column, terms: Column, remove: float) -> Column:
    """Spans of those terms of a text that are keys of ``terms`` (term: share).

    They are marked in one pass, so that only they, not all terms, are folded.
    """
    clean = F.translate(plain, OPEN + SHUT, "\ue001\ue001")
    mark = lambda m: F.when(F.map_contains_key(terms, F.lower(m)), F.concat(F.lit(OPEN), m, F.lit(SHUT))).otherwise(m)
    marked = F.array_join(F.transform(_parts(clean, TERM), lambda p: F.concat(p["gap"], mark(p["match"]))), "")
    pairs = _let(F.split(marked, SHUT, -1), lambda ends: F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda x: F.struct(F.substring_index(x, OPEN, 1).alias("gap"), F.substring_index(x, OPEN, -1).alias("match"))))

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        how = F.when(F.element_at(terms, F.lower(pair["match"])) >= remove, F.lit("remove")).otherwise(F.lit("generalise"))
        return end, F.struct(start.alias("start"), F.lit(KINDS.index("term")).alias("rank"), end.alias("end"), how.alias("entity"))

    return _folded(pairs, step, _NO_SPANS)


def _shown(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def _text_key(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _screen(hashes: DataFrame) -> Column:
    """Bits of fixed size, 2^``TABLE_BITS``, with one set for each long in the column h: for :func:`_maybe`."""
    spark = hashes.sparkSession
    at = F.col("h").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    words = hashes.select(F.shiftright(at, 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    every = spark.range(0, 1 << (TABLE_BITS - 6), 1, 1).withColumnRenamed("id", "w").join(words, "w", "left")
    bits = every.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).alias("b")))).alias("x"))
    return bits.select(F.transform("x", lambda x: x["b"])).scalar()


def _maybe(bits: Column, h: Column) -> Column:
    """False for longs that :func:`_screen` surely doesn't hold."""
    word = F.get(bits, F.shiftright(h.bitwiseAND(F.lit((1 << TABLE_BITS) - 1)), 6).cast("int"))
    return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (key, text), each text once; only texts that may have copies are shuffled."""
    twice = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.xxhash64("key").alias("h")), "twice")
    maybe = _maybe(_screen(twice), F.xxhash64("key"))
    return rows.where(~maybe).unionByName(rows.where(maybe).dropDuplicates(["key"]))


def _sets(rows: DataFrame, name: str) -> DataFrame:
    """How many texts hold each ``name`` of ``rows`` (key, name, ...), and what stands for the set of them: n, x, y."""
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))


def disclosing(found: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """(term, share, bits) of the terms that disclose an entity, by the entity that each tells best.

    ``found`` has a row per distinct text: key, spans, terms. Terms that can't
    reach the limits with any entity, by their own counts, are left out before
    pairs are made; that loses no pair. Terms and entities in one and the same
    set of texts are counted as one.
    """
    total = float(max(found.count(), 1))
    held = F.size("spans") > 0
    each = found.select("key", held.cast("int").alias("beside"), F.explode("terms").alias("term"))
    words = each.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("beside").alias("beside"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    words = staged(words.where((F.col("beside") >= limits.texts) & (F.col("beside") >= limits.share * F.col("n"))).drop("beside"), "terms")
    mentions = staged(found.where(held).select("key", F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity")), "mentions")
    entities = mentions.join(_sets(mentions, "entity"), "entity").where(F.col("n") >= limits.texts)
    entities = entities.select("key", F.struct("n", "x", "y").alias("e")).distinct()
    beside = found.where(held).select("key", F.explode("terms").alias("term"))
    beside = beside.where(_maybe(_screen(words.select(F.xxhash64("term").alias("h"))), F.xxhash64("term")))
    kinds = beside.join(words, "term").select("key", F.struct("n", "x", "y").alias("t")).distinct()
    pairs = entities.join(kinds, "key").where(F.col("e.n") >= limits.share * F.col("t.n"))
    both = pairs.groupBy("e", "t").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= limits.texts)
    both = both.withColumn("share", F.col("both") / F.col("t.n")).withColumn("bits", F.log2(F.col("both") * F.lit(total) / (F.col("t.n") * F.col("e.n"))))
    enough = (F.col("share") >= limits.share) & (F.col("bits") > 0) & (F.col("bits") >= limits.information * F.log2(F.lit(total) / F.col("e.n")))
    best = both.where(enough).groupBy("t").agg(F.max(F.struct("share", "bits")).alias("best"))
    told = best.select(F.col("t.n").alias("n"), F.col("t.x").alias("x"), F.col("t.y").alias("y"), "best.share", "best.bits")
    return words.join(told, ["n", "x", "y"]).select("term", "share", "bits")


def private_texts(docs: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """One row per distinct text: key, its entities as ``spans``, and ``added``, its disclosing terms."""
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(_text_key(F.col("text")).alias("key"), "text")
    once = _distinct_texts(rows)
    found = staged(once.select("key", base_spans(F.col("text")).alias("spans"), _terms(_plain(F.col("text"))).alias("terms")), "private")
    shares = staged(disclosing(found, limits), "disclosing")
    terms = found.select("key", F.explode("terms").alias("term")).where(_maybe(_screen(shares.select(F.xxhash64("term").alias("h"))), F.xxhash64("term")))
    held = terms.join(shares, "term").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("held"))
    held = staged(held, "held")
    texts = rows.where(_maybe(_screen(held.select(F.xxhash64("key").alias("h"))), F.xxhash64("key"))).dropDuplicates(["key"]).join(held, "key")
    added = texts.select("key", _term_spans(_plain(F.col("text")), F.col("held"), limits.remove).alias("added"))
    return found.select("key", "spans").join(added, "key", "left").withColumn("added", F.coalesce("added", F.expr(_NO_SPANS)))


def private_report(docs: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """One row per document: doc_id, counts by kind, base_sha256, spans, n_private (entities of all kinds) and n_term."""
    texts = private_texts(docs, limits)
    base = F.filter("spans", lambda s: s["rank"] < BASE)
    number = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    told = texts.select("key", *[number(k) for k in range(BASE)], F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.array_sort(F.concat("spans", "added"))).alias("all"), number(BASE), F.size("spans").cast("long").alias("n_private"), F.size("added").cast("long").alias("n_term"))
    keyed = docs.select("doc_id", _text_key(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"))
    return keyed.join(told, "key").drop("key").withColumnRenamed("all", "spans")


def sanitise(docs: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with private data in ``text`` replaced by its kind, disclosing terms generalised to [TERM] or removed."""
    spans = private_texts(docs, limits).select(F.col("key"), F.array_sort(F.concat("spans", "added")).alias("spans")).where(F.size("spans") > 0)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")["text"]
    joined = rows.withColumn("key", _text_key(F.coalesce(text.cast("string"), F.lit("")))).join(spans, "key", "left")
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        mark = F.when(s["entity"] == "remove", F.lit("")).otherwise(F.element_at(marks, s["rank"] + 1))
        kept = F.substr(text, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        return F.greatest(at, s["end"]), F.struct(F.greatest(at, s["end"]).alias("end"), F.when(s["start"] < at, F.lit("")).otherwise(F.concat(kept, mark)).alias("text"))

    pieces = _folded(F.col("spans"), step, "cast(array() as array<struct<end:int,text:string>>)")
    clean = _let(pieces, lambda ps: F.concat(F.array_join(F.transform(ps, lambda p: p["text"]), ""), F.substr(text, F.element_at(ps, -1)["end"] + 1, F.length(text))))
    return joined.select(*[(F.when(F.col("spans").isNotNull(), clean).otherwise(text) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
