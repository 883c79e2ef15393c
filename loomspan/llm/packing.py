"""Operator 2: packing documents into sequences by cutting-stock column generation.

A document's tokens are cut into whole sequences and one remainder. The
remainders' lengths, in units of ``UNIT`` tokens, make a histogram of fixed
size. A linear program over patterns (what may lie together in a sequence)
covers it with the fewest sequences: a knapsack dynamic program prices new
patterns from the dual values until none improves. Patterns are rounded down
and given to the remainders by their rank among those of one length. The few
that rounding leaves over are laid end to end and cut where a sequence ends;
the last tokens are cut into sequences whose lengths are powers of two, which
need no padding.

Nulls: a null text is empty, so its row has the end token alone; null doc_ids
pass through. Repeated rows are packed each. Empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FORGET, map_batches, salted_rank, staged, text_key

LENGTH = 2048
UNIT = 16
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Bytes of each of a tokenizer's two caches, about; a full cache is emptied, and both when a task ends.
CACHE_BYTES = 48 << 20
#: Bytes that an entry takes beside its key and ids.
ENTRY = 170
#: The linear program stops within this share of its lower bound.
GAP = 0.002
#: Steps of the simplex method, at most; any step's patterns are a valid cover.
STEPS = 3000


class WordTokenizer:
    """Ids of a vocabulary whose tokens never cross white space, with a cache of words.

    Printable ASCII and Latin words are normalised here and go to the tokenizer's own
    model; all others, and those that may hold special tokens, go through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.forget()
        FORGET.append(self.forget)
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.split_ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
        # Byte-level vocabularies write bytes as visible characters: printable Latin-1 as it is, the rest from 256 on.
        seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(seen)]
        self.letters = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def forget(self) -> None:
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.held = [0, 0]

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if self.held[1] > CACHE_BYTES:
                self.pieces.clear()
                self.held[1] = 0
            shown = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            found = self.pieces[piece] = self.packed([t.id for t in self.model.tokenize(shown)])
            self.held[1] += ENTRY + len(piece) + len(found)
        return found

    def word(self, raw: bytes) -> bytes:
        if raw.isalpha():  # of ASCII letters, one piece
            ids = self.piece(raw.lower().decode())
        elif "<|" in (text := raw.decode()) or max(text) > "ɏ" or not text.isprintable():
            ids = self.packed(self.whole.encode(text, add_special_tokens=False).ids)
        elif text.isascii():
            ids = b"".join(map(self.piece, self.split_ascii(text.lower())))
        else:
            ids = b"".join(map(self.piece, self.split(unicodedata.normalize("NFC", text).lower())))
        if len(raw) < 64:
            self.words[raw] = ids
            self.held[0] += ENTRY + len(raw) + len(ids)
        return ids

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.held[0] > CACHE_BYTES:
            self.words.clear()
            self.held[0] = 0
        get, word = self.words.get, self.word
        return b"".join([i if (i := get(w)) is not None else word(w) for w in text.encode().split()])


@lru_cache(maxsize=1)
def tokenizer(path: str | None) -> WordTokenizer:
    """One per Python worker; the path is looked up where the code runs."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return WordTokenizer(path)


def document_ids(text: str | None, path: str | None = None) -> bytes:
    return tokenizer(path).encode(text or "") + END.to_bytes(4, "little")


# The linear program ---------------------------------------------------------


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most value of items of rising ``sizes`` within ``capacity``, and how many of each."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], fit = best[room - 1], fits[room]
        if fit:
            worth = values[:fit] + best[room - sizes[:fit]]
            k = worth.argmax()
            if worth[k] > best[room] + 1e-12:
                best[room], choice[room] = worth[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), counts


def cover(demand: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Patterns (sizes, counts, how often) that cover ``demand`` (size: how many) with about the fewest bins, by column generation."""
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    need = np.array([demand[s] for s in sizes], float)
    m = len(sizes)
    if not m:
        return []
    # A basis to begin with: of two sizes that fill a bin, the rarer stands with the other, which else stands alone.
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    for k, other in enumerate(np.searchsorted(sizes, capacity - sizes)):
        if other < m and other != k and sizes[other] == capacity - sizes[k] and (need[k], k) < (need[other], other):
            columns[:, k] = 0
            columns[[k, other], k] = 1
            inverse[k, k], inverse[other, k] = 1, -inverse[other, other]
    bound = (sizes * need).sum() / capacity
    for _ in range(STEPS):
        amounts = np.maximum(inverse @ need, 0)
        value, counts = best_pattern(inverse.sum(axis=0), sizes, capacity)
        total = amounts.sum()
        bound = max(bound, total / max(value, 1))
        if value <= 1 + 1e-9 or total - bound <= gap * total:
            break
        direction = inverse @ counts
        ratio = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        columns[:, leave] = counts
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
    amounts = np.maximum(inverse @ need, 0)
    return [(sizes, columns[:, k].astype(np.int64), float(amounts[k])) for k in range(m) if amounts[k] > 0]


def slots(demand: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rounded patterns as rows (size, from rank, to rank, copies in a sequence, first sequence), and how many sequences they fill."""
    rows, given, sequences = [], dict.fromkeys(demand, 0), 0
    for sizes, counts, amount in cover(demand, capacity):
        times = int(amount + 1e-9)
        for s, c in zip(sizes.tolist(), counts.tolist()):
            if c:  # an overfull cover gives no more than there are
                times = min(times, (demand[s] - given[s]) // c)
        if times <= 0:
            continue
        for s, c in zip(sizes.tolist(), counts.tolist()):
            if c:
                rows.append((s, given[s], given[s] + times * c, c, sequences))
                given[s] += times * c
        sequences += times
    return rows, sequences


def cut_points(total: int, length: int) -> list[int]:
    """Where sequences begin when ``total`` tokens are laid end to end: whole ones, then powers of two."""
    points, at = [0], 0
    while at < total:
        left = total - at
        at += length if left >= length else 1 << (left.bit_length() - 1)
        points.append(at)
    return points


# The operator ---------------------------------------------------------------

_TOKENS = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType()))]
)
_CUTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def count_tokens(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """row, doc_id, key, doc_tokens, and the CRC-32 of each piece of ``length`` ids."""
    state = {"n": 0}

    def rows(part: dict[str, list]) -> dict[str, list]:
        first = (TaskContext.get().partitionId() << 36) + state["n"]
        state["n"] += len(part["text"])
        ids = [document_ids(t, path) for t in part["text"]]
        crcs = [[zlib.crc32(i[k : k + 4 * length]) for k in range(0, len(i), 4 * length)] for i in ids]
        return {"row": list(range(first, first + len(ids))), "doc_id": part["doc_id"], "key": part["key"], "doc_tokens": [len(i) // 4 for i in ids], "crcs": crcs}

    return staged(map_batches(docs.select(F.col("doc_id").cast("long"), "text", text_key("text").alias("key")), rows, _TOKENS), "tokens")


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    counted = count_tokens(docs, length, path)
    rest = F.col("doc_tokens") % length
    units = F.ceil(rest / UNIT).cast("int")
    # At most length / UNIT rows, whatever the input.
    found = counted.groupBy(units.alias("units")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("doc_tokens") / length)).alias("whole")).collect()
    demand = {r["units"]: r["n"] for r in found if r["units"]}
    rows, patterned = slots(demand, length // UNIT)
    parts = 1 + sum(r["n"] for r in found) // 2_000
    salt = F.pmod(F.xxhash64("row"), F.lit(parts))

    pieces = counted.where(rest > 0).select("row", "doc_id", "key", "doc_tokens", (F.col("doc_tokens") - rest).alias("start"), rest.alias("length"), F.element_at("crcs", -1).alias("ids_crc32"), units.alias("units"))
    pieces = salted_rank(pieces, ["units"], [F.col("row")], salt, "rank")
    plan = spark.createDataFrame(rows, "p_units int, low long, high long, copies int, first long")
    # At most a row per pattern and length: (length / UNIT)^2, whatever the input.
    at = (F.col("units") == F.col("p_units")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = staged(pieces.join(F.broadcast(plan), at, "left").withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("copies"))), "placed")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.where("sequence_id is not null").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    # What rounding left: fewer than the patterns' items, whatever the input; so it is cut on the driver.
    left = placed.where("sequence_id is null").select("row", "doc_id", "key", "doc_tokens", "start", "length").orderBy("row").collect()
    points = np.array(cut_points(sum(r["length"] for r in left), length), np.int64)
    cuts, pos = [], 0
    for r in left:
        done = 0
        while done < r["length"]:
            k = int(np.searchsorted(points, pos, side="right")) - 1
            take = min(r["length"] - done, int(points[k + 1]) - pos)
            cuts.append((r["doc_id"], r["key"], r["start"] + done, take, r["doc_tokens"], patterned + k, pos - int(points[k])))
            done, pos = done + take, pos + take
    cut = spark.createDataFrame(cuts, "doc_id long, key long, start long, length long, doc_tokens long, sequence_id long, offset long")
    cut = cut.join(_cut_crcs(docs, [c[1:4] for c in cuts], path), ["key", "start", "length"])

    base = patterned + len(points) - 1
    full = counted.where(F.col("doc_tokens") >= length).select("row", "doc_id", "doc_tokens", F.posexplode(F.slice("crcs", 1, F.floor(F.col("doc_tokens") / length).cast("int"))).alias("k", "ids_crc32"))
    full = salted_rank(full.withColumn("all", F.lit(0)), ["all"], [F.col("row"), F.col("k")], salt, "rank")
    full = full.select("doc_id", (F.col("k") * length).cast("long").alias("start"), F.lit(length).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("rank") + base).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.select(*_PIECE).unionByName(cut.select(*_PIECE)).unionByName(full.select(*_PIECE))


def _cut_crcs(docs: DataFrame, wanted: list[tuple[int, int, int]], path: str | None) -> DataFrame:
    """CRC-32 of the pieces (key, start, length) of documents that rounding left over."""
    by_key: dict[int, list[tuple[int, int]]] = {}
    for key, start, length in dict.fromkeys(wanted):
        by_key.setdefault(key, []).append((start, length))
    spark = docs.sparkSession
    keys = F.broadcast(spark.createDataFrame([(k,) for k in by_key], "key long"))

    def rows(part: dict[str, list]) -> dict[str, list]:
        out = []
        for key, text in zip(part["key"], part["text"]):
            ids = document_ids(text, path)
            out += [(key, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for s, n in by_key[key]]
        return dict(zip(("key", "start", "length", "ids_crc32"), map(list, zip(*out)))) if out else {c: [] for c in ("key", "start", "length", "ids_crc32")}

    texts = docs.select(text_key("text").alias("key"), "text").join(keys, "key", "left_semi")
    return map_batches(texts, rows, _CUTS).distinct()


def sequences(docs: DataFrame, pieces: DataFrame, path: str | None = None) -> DataFrame:
    """The packed sequences: sequence_id and its ids, for ``pieces`` of :func:`pack` and documents with distinct doc_ids."""
    cut = docs.select("doc_id", "text").join(pieces.select("doc_id", "start", "length", "sequence_id", "offset"), "doc_id")
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])

    def rows(part: dict[str, list]) -> dict[str, list]:
        ids = [np.frombuffer(document_ids(t, path), "<u4")[s : s + n].tolist() for t, s, n in zip(part["text"], part["start"], part["length"])]
        return {"sequence_id": part["sequence_id"], "offset": part["offset"], "ids": ids}

    parts = map_batches(cut, rows, schema)
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
