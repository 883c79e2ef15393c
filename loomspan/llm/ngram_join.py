"""Operator 8: n-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct shingles of ``size`` lower-cased words, as
64-bit hashes; documents with one set are one class. Two similar sets of n
shingles share at least one of the first p = n - ceil(t n) + 1 of each, in any
common order; and l of the first p + l - 1. Shingles are ordered by what they
are estimated to cost as candidates, which is at most how often their rarest
word occurs in the corpus, and then by hash. A document whose first p shingles
are still dear gets a longer prefix, and more shared shingles (l) are asked of
it before a pair is verified. Words are counted over all documents in a table
of hashed counters of fixed size; their error costs time, never a link.

Pairs of classes that meet in as many shingles as are asked are verified on
their whole sets. Where many meet in one shingle, tiles of bounded size compare
bit sketches, whose distance is at most the difference of the sets, so no link
is lost; where many pairs survive that (a group of near copies), first a
spanning forest of them is verified, then those pairs that are still in two
components.

Nulls: a null text is empty; a document without words links with nothing and is
its own component. A null doc_id counts as the largest. Repeated rows are one
class. Empty tables give empty results; extra columns are ignored by
:func:`near_duplicates` and kept by :func:`near_filter`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FORGET, as_rows, map_batches, shuffles_freed, small_batches, staged, text_key, tidied
from .components import components

#: log2 of the counters of words, and of the bits that tell shingles which more than one class has in its prefix.
COUNTER_BITS = 22
SEEN_BITS = 26
BLOCK = 1 << 16
#: A shingle is dear from this class of cost on (a class doubles), and a prefix grows by this many shingles at most.
DEAR = 2
LONGER = 2
#: Members of a tile from which on sketches thin out its pairs.
CROWD = 64
TILE = 1500
#: Surviving pairs for each member of a tile, above which a forest comes first.
DENSE = 4
#: Words whose hashes a worker holds; a full cache is emptied, and any when a task ends.
CACHE = 60_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_words = _WordHashes()
FORGET.append(_words.clear)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int = 4, costs: np.ndarray | None = None) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of a text's shingles; with the words' ``costs``, also each shingle's cost."""
    words = (text or "").encode().lower().split()
    if not words:
        none = np.empty(0, np.uint64)
        return none if costs is None else (none, np.empty(0, np.uint8))
    at = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(size, len(at))
    n = len(at) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + at[k : n + k])
    if costs is None:
        return np.unique(h)
    own = costs[_counter(at)]
    least = own[:n]
    for k in range(1, width):
        least = np.minimum(least, own[k : n + k])
    h, first = np.unique(h, return_index=True)
    return h, least[first]


def _counter(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def prefix(shingles: np.ndarray, cost: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """A set's prefix, and how many shingles of two prefixes must be shared."""
    n = len(shingles)
    p = n - -(-percent * n // 100) + 1
    order = np.lexsort((shingles, cost))
    more = min(LONGER, n - p, int((cost[order[:p]] >= DEAR).sum()))
    return shingles[order[: p + more]], 1 + more


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of hashed shingles: two sketches differ in no more bits than the sets differ in members."""
    bits = 256
    while bits < 4 * len(shingles) and bits < 8192:
        bits *= 2
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(x: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return x


def _alike(na: int, nb: int, percent: int) -> bool:
    return 100 * min(na, nb) >= percent * max(na, nb)


def survivors(ids: list[int], sizes: list[int], sketches: list[bytes], sides: list[int], apart: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Index pairs that length and sketch allow, one after the other; with ``apart``, only between two sides."""
    less, more = 100 - percent, 100 + percent  # sets differ in at most less / more of their summed sizes
    m = len(ids)
    if m <= 12:
        whole = [int.from_bytes(s, "little") for s in sketches]
        for i in range(m):
            for j in range(i):
                if ids[i] != ids[j] and _alike(sizes[i], sizes[j], percent) and not (apart and sides[i] == sides[j]):
                    bits = 8 * min(len(sketches[i]), len(sketches[j]))
                    a, b = (_folded(whole[k], 8 * len(sketches[k]), bits) for k in (i, j))
                    if more * (a ^ b).bit_count() <= less * (sizes[i] + sizes[j]):
                        yield i, j
        return
    size, side, own = np.array(sizes), np.array(sides), np.array(ids)
    width = np.array([8 * len(s) for s in sketches])
    rows = [np.frombuffer(s, np.uint64) for s in sketches]
    for bits in np.unique(width):
        # Those of this width with each other and with the next, whose sketches are folded once; sizes further apart aren't alike.
        at = np.flatnonzero((width == bits) | (width == 2 * bits))
        flat = np.stack([rows[k] if width[k] == bits else np.bitwise_xor(*rows[k].reshape(2, -1)) for k in at])
        for i in range(len(at)):
            if width[at[i]] != bits:
                continue
            others = np.flatnonzero((np.arange(len(at)) < i) | (width[at] != bits))
            other = at[others]
            ok = (100 * np.minimum(size[other], size[at[i]]) >= percent * np.maximum(size[other], size[at[i]])) & (own[other] != own[at[i]])
            if apart:
                ok &= side[other] != side[at[i]]
            others = others[ok]
            if len(others):
                distance = np.bitwise_count(flat[others] ^ flat[i]).sum(axis=1)
                for j in at[others[more * distance.astype(np.int64) <= less * (size[at[others]] + size[at[i]])]].tolist():
                    yield int(at[i]), j


class _Forest:
    """A spanning forest of the pairs added."""

    def __init__(self):
        self.root: dict[int, int] = {}
        self.pairs: list[tuple[int, int]] = []

    def _find(self, x: int) -> int:
        root = self.root
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def add(self, i: int, j: int) -> None:
        a, b = self._find(i), self._find(j)
        if a != b:
            self.root[a] = b
            self.pairs.append((i, j))


def _summed(df: DataFrame, blocks: int, kind: type, count, add) -> np.ndarray:
    """Tables of ``blocks`` parts, one from each task by ``count(batches)``, added up part by part; of fixed size, so the driver gets the sum."""
    schema = "block int, part binary"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = count(batches)
        if whole is not None:
            whole = whole.reshape(blocks, -1)
            some = np.flatnonzero(whole.any(axis=1))
            for k in range(0, len(some), 16):
                yield pa.RecordBatch.from_arrays([pa.array(some[k : k + 16], pa.int32()), pa.array([whole[b].tobytes() for b in some[k : k + 16]], pa.binary())], names=["block", "part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(part.as_buffer(), kind)
                sums[b] = add(sums[b], own) if b in sums else own.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "part"])

    small_batches(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        rows = df.mapInArrow(tidied(emit), schema).repartition(32, "block").mapInArrow(tidied(merge), schema).collect()
    width = len(rows[0]["part"]) // np.dtype(kind).itemsize if rows else 1
    total = np.zeros((blocks, width), kind)
    for r in rows:
        total[r["block"]] = np.frombuffer(r["part"], kind)
    return total.ravel()


def word_costs(docs: DataFrame) -> np.ndarray:
    """For each counter the log2 of how often its words occur; counts cover all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = np.zeros(1 << COUNTER_BITS, np.uint32)
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            for text in batch.column(0):
                words = (text.as_py() or "").encode().lower().split()
                held.append(_counter(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))))
                waiting += len(words)
                if waiting > 1_000_000:
                    total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.uint32)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.uint32)
        return total if total.any() else None

    add = lambda a, b: a + np.minimum(b, np.uint32(2**32 - 1) - a)
    total = _summed(docs.select("text"), 1 << (COUNTER_BITS - 16), np.uint32, count, add)
    if len(total) < 1 << COUNTER_BITS:
        return np.zeros(1 << COUNTER_BITS, np.uint8)
    return np.ceil(np.log2(total + 1.0)).astype(np.uint8)


def _bit(tokens: np.ndarray) -> np.ndarray:
    return (_mixed(tokens.astype(np.uint64)) >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def seen_bits(tokens: DataFrame) -> np.ndarray:
    """A bit for each hashed token of ``tokens`` (token)."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        bits = np.zeros(1 << (SEEN_BITS - 3), np.uint8)
        for batch in batches:
            at = _bit(batch.column(0).to_numpy())
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return bits if bits.any() else None

    found = _summed(tokens.select("token"), 1 << (SEEN_BITS - 3 - 16), np.uint8, count, np.bitwise_or)
    return found if len(found) == 1 << (SEEN_BITS - 3) else np.zeros(1 << (SEEN_BITS - 3), np.uint8)


_ROW = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("asked", T.IntegerType()), T.StructField("sketch", T.BinaryType())])
_SET = T.StructType([T.StructField("cls", T.LongType()), T.StructField("members", T.BinaryType()), T.StructField("prefix", T.BinaryType()), T.StructField("asked", T.IntegerType())])


def _signatures(docs: DataFrame, costs: Broadcast, size: int, percent: int) -> DataFrame:
    state = {"n": 0}

    def rows(part: dict[str, list]) -> dict[str, list]:
        first = (TaskContext.get().partitionId() << 36) + state["n"]
        state["n"] += len(part["text"])
        out: dict[str, list] = {"n": [], "cls": [], "tokens": [], "asked": [], "sketch": []}
        for text in part["text"]:
            own, cost = shingle_set(text, size, costs.value)
            out["n"].append(len(own))
            out["cls"].append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
            tokens, asked = prefix(own, cost, percent) if len(own) else ([], 1)
            out["tokens"].append(np.asarray(tokens, np.uint64).astype(np.int64))
            out["asked"].append(asked)
            out["sketch"].append(sketch(own))
        return {"row": list(range(first, first + len(out["n"]))), "doc_id": part["doc_id"], "key": part["key"], **out}

    return staged(map_batches(docs.select(F.col("doc_id").cast("long"), "text", text_key("text").alias("key")), rows, _ROW, 2048), "signatures")


def _maybe(bits: Broadcast, column: Column) -> Column:
    """False for longs that :func:`seen_bits` surely doesn't hold."""

    @F.pandas_udf("boolean")
    def look(x: pd.Series) -> pd.Series:
        at = _bit(x.to_numpy())
        return pd.Series((bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return look(column)


def _shared_tokens(one: DataFrame) -> DataFrame:
    """(cls, n, asked, token, docs) of prefix shingles that more than one class has.

    A table of bits of fixed size tells most of those that one class alone has
    before they would be shuffled again; the join is exact.
    """
    posted = one.select("cls", "n", F.explode("tokens").alias("token"))
    shared = staged(posted.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1"), "shared")
    bits = one.sparkSession.sparkContext.broadcast(seen_bits(shared))
    schema = T.StructType([T.StructField("cls", T.LongType()), T.StructField("n", T.LongType()), T.StructField("asked", T.IntegerType()), T.StructField("token", T.LongType())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(3)
            flat = tokens.flatten().to_numpy(zero_copy_only=False)
            whose = np.repeat(np.arange(batch.num_rows), tokens.value_lengths().fill_null(0).to_numpy())
            at = _bit(flat)
            ok = (bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            rows = pa.array(whose[ok])
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(3)), pa.array(flat[ok], pa.int64())], names=["cls", "n", "asked", "token"])

    return one.select("cls", "n", "asked", "tokens").mapInArrow(tidied(keep), schema).join(shared, "token")


def _grouped(key_columns: int, tile):
    """For ``mapInArrow`` over rows sorted by key: what ``tile(key, members)`` makes of each key's rows, in columns a, b, token, i, j, asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, out = None, [], []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 6
            done = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "token", "i", "j", "asked"])
            out.clear()
            return done

        for b in batches:
            columns = [b.column(k).to_pylist() for k in range(b.num_columns)]
            for at, row in zip(zip(*columns[:key_columns]), zip(*columns[key_columns:])):
                if at != key:
                    if len(members) > 1:
                        out += tile(key, members)
                        if len(out) > 20_000:
                            yield batch()
                    key, members = at, []
                members.append(row)
        if len(members) > 1:
            out += tile(key, members)
        yield batch()

    return tidied(run)


_MET = "a long, b long, token long, i long, j long, asked long"


def _small_tiles(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, asked) that tiles of few members allow by length; a row (token, i, j) for each that is crowded."""

    def tile(key: tuple, members: list[tuple]) -> list[tuple]:
        members = list({m[1]: m for m in members}.values())
        if len(members) > CROWD:
            return [(None, None, *key, None)]
        apart, out = key[1] != key[2], []
        for x, (side, cls, n, asked) in enumerate(members):
            for other, cls2, n2, asked2 in members[:x]:
                if _alike(n, n2, percent) and not (apart and side == other):
                    out.append((min(cls, cls2), max(cls, cls2), None, None, None, min(asked, asked2)))
        return out

    rows = tiles.select("token", "i", "j", "side", "cls", "n", "asked").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return rows.mapInArrow(_grouped(3, tile), _MET)


def _meet(tiles: DataFrame, sketches: DataFrame, roots: DataFrame | None, percent: int) -> DataFrame:
    """Surviving pairs (a, b) of each tile. Without ``roots``: a forest where a tile is dense, with a row (token, i, j) for it; with them, all pairs between two components."""
    each = sketches
    root, dense_in = F.col("cls"), F.lit(None).cast("array<long>")
    if roots is not None:
        # A pair that meets in several dense tiles is told in the first of them: each class brings its own, at most so many as its prefix has in parts.
        own = tiles.groupBy("cls").agg(F.array_sort(F.collect_set(F.xxhash64("token", "i", "j"))).alias("dense_in"))
        each = own.join(sketches, "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        root, dense_in = F.coalesce("root", "cls"), F.col("dense_in")
    rows = tiles.join(each, "cls").select("token", "i", "j", "side", "cls", "n", "sketch", root.alias("root"), dense_in.alias("dense_in"), F.xxhash64("token", "i", "j").alias("own")).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    first = roots is None

    def tile(key: tuple, members: list[tuple]) -> list[tuple]:
        members = list({m[1]: m for m in members}.values())  # a class is once in a side
        if len(members) < 2:
            return []
        side, cls, n, bits, own, dense_in, here = map(list, zip(*members))
        if not first:
            sets = [frozenset(d) for d in dense_in]
            pairs = [(i, j) for i, j in survivors(cls, n, bits, own, True, percent) if min(sets[i] & sets[j]) == here[0]]
            return [(cls[i], cls[j], None, None, None, 1) for i, j in pairs]
        # All pairs are held only while they are few.
        few, forest, most = [], _Forest(), DENSE * len(members)
        for i, j in survivors(cls, n, bits, side, key[1] != key[2], percent):
            forest.add(i, j)
            if len(few) <= most:
                few.append((i, j))
        dense = len(few) > most
        out = [(cls[i], cls[j], None, None, None, 1) for i, j in (forest.pairs if dense else few)]
        return out + [(None, None, *key, None)] if dense else out

    return rows.mapInArrow(_grouped(3, tile), _MET)


def _sets(docs: DataFrame, wanted: DataFrame, costs: Broadcast, size: int, percent: int) -> DataFrame:
    """The whole sets of the classes in ``wanted`` (doc_id, key, cls: a document of each), with their prefixes."""
    # A table of bits keeps most other texts from being shuffled; the join is exact.
    bits = docs.sparkSession.sparkContext.broadcast(seen_bits(wanted.select(F.col("key").alias("token"))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("key"), "text").where(_maybe(bits, F.col("key")))
    w = wanted.select(F.col("doc_id").alias("w_id"), F.col("key").alias("w_key"), "cls")
    found = texts.join(w, (texts["key"] == w["w_key"]) & texts["doc_id"].eqNullSafe(w["w_id"])).select("cls", "text")

    def rows(part: dict[str, list]) -> dict[str, list]:
        made = [shingle_set(t, size, costs.value) for t in part["text"]]
        prefixes = [prefix(own, cost, percent) for own, cost in made]
        return {"cls": part["cls"], "members": [own.tobytes() for own, _ in made], "prefix": [p.tobytes() for p, _ in prefixes], "asked": [n for _, n in prefixes]}

    return staged(map_batches(found, rows, _SET).dropDuplicates(["cls"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose prefixes share enough and whose sets are similar."""
    x = sets.select(F.col("cls").alias("a"), F.col("members").alias("x"), F.col("prefix").alias("px"), F.col("asked").alias("ax"))
    y = sets.select(F.col("cls").alias("b"), F.col("members").alias("y"), F.col("prefix").alias("py"), F.col("asked").alias("ay"))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def rows(part: dict[str, list]) -> dict[str, list]:
        kept = []
        for a, b, x, y, px, py, ax, ay in zip(*(part[c] for c in ("a", "b", "x", "y", "px", "py", "ax", "ay"))):
            if len(np.intersect1d(np.frombuffer(px, np.uint64), np.frombuffer(py, np.uint64), assume_unique=True)) >= min(ax, ay):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    kept.append((a, b))
        return {"a": [k[0] for k in kept], "b": [k[1] for k in kept]}

    return map_batches(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "px", "py", "ax", "ay"), rows, schema, 512)


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 85, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id, and the document (first_id, first_key) that its component begins with."""
    costs = docs.sparkSession.sparkContext.broadcast(word_costs(docs))  # 2^COUNTER_BITS bytes, whatever the input
    signed = _signatures(docs, costs, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "row")
    classes = staged(signed.where("n > 0").groupBy("cls").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")), "classes")
    c = classes.select("cls", F.col("first.doc_id").alias("c_id"), F.col("first.key").alias("c_key"))
    # Most classes have one document; only the documents of the others are joined to find each class's first.
    again = staged(signed.where("n > 0").select("cls", "row").join(classes.where("copies > 1").select("cls"), "cls", "left_semi"), "again")
    bits = docs.sparkSession.sparkContext.broadcast(seen_bits(again.select(F.col("row").alias("token"))))
    marked = signed.where("n > 0").withColumn("maybe", _maybe(bits, F.col("row"))).select("row", "cls", "n", "tokens", "asked", "sketch", "maybe")
    later = again.join(classes.select(F.col("first.row").alias("row")), "row", "left_anti").select("row")
    one = marked.where("not maybe").unionByName(marked.where("maybe").join(later, "row", "left_anti")).drop("maybe", "row")
    one = staged(one, "one")

    parts = F.ceil(F.col("docs") / tile).cast("long")
    met = _shared_tokens(one).withColumn("parts", parts).withColumn("side", F.pmod(F.xxhash64("cls"), F.col("parts")))
    met = met.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1L)")))
    tiles = staged(met.select("token", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "cls", "n", "asked"), "tiles")
    sketches = one.select("cls", "sketch")

    few = staged(_small_tiles(tiles, percent), "few")
    enough = few.where("a is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.max("asked").alias("asked")).where("met >= asked").select("a", "b")
    # What meets in a crowded tile may meet elsewhere too; there sketches tell, not counts.
    crowded = staged(tiles.join(few.where("a is null").select("token", "i", "j"), ["token", "i", "j"], "left_semi"), "crowded")
    met = staged(_meet(crowded, sketches, None, percent), "met")
    found = met.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = staged(enough.unionByName(found).distinct(), "pairs")
    again = crowded.join(met.where("a is null").select("token", "i", "j"), ["token", "i", "j"], "left_semi")
    # Sets of all that can be in a pair, now or in the second round.
    seen = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(again.select("cls")).distinct()
    firsts = c.join(seen, "cls", "left_semi").select(F.col("c_id").alias("doc_id"), F.col("c_key").alias("key"), "cls")
    sets = _sets(docs, staged(firsts, "firsts"), costs, size, percent)
    links = staged(_verified(pairs, sets, percent), "verified")
    roots = components(links)
    rest = staged(_meet(again, sketches, roots, percent).where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rest")
    more = _verified(rest.join(pairs, ["a", "b"], "left_anti"), sets, percent)
    roots = components(links.unionByName(more))

    labelled = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    begins = labelled.groupBy("root").agg(F.min("first").alias("begin"))
    found = labelled.join(begins, "root").select("cls", "begin")
    out = signed.select("doc_id", "key", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(found, "cls", "left")
    alone = F.col("begin").isNull()
    return out.select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("begin.doc_id")).alias("component_id"), F.when(alone, F.col("key")).otherwise(F.col("begin.key")).alias("first_key")
    )


def near_filter(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that begin their component, with all their columns."""
    kept = near_duplicates(docs, size, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("first_key")))
    # Plain columns, null ids apart: one shuffle of the texts serves the join and finds repeated rows.
    same = ["no_id", "id", "text_key"]
    keyed = lambda id, key: {"no_id": id.isNull(), "id": F.coalesce(id, F.lit(0)), "text_key": key}
    kept = kept.select(*[c.alias(n) for n, c in keyed(F.col("doc_id"), F.col("key")).items()]).distinct()
    rows = as_rows(docs).withColumns(keyed(F.col("row")["doc_id"].cast("long"), text_key("row.text")))
    return rows.join(kept, same, "left_semi").dropDuplicates(same).select("row.*")
