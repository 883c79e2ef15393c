"""Operator 3: language-model scoring by online logistic context mixing.

A text is scored as its lower-cased words and an end. Words are counted over
all training documents; the most frequent ones have paths of bits of their own
in a prefix code, other words are an escape and their bytes. Each bit is
predicted by three tables: by the bit's place in the code alone, and by two
hashed contexts (for words: the most frequent of the last sixteen words, which
tells language and topic, and the word before; inside a spelled word: the last
two bytes with that most frequent word, and three bytes with the place in the
word). Their counts of zeros and ones are 32-bit sums over all training
documents, so they don't depend on how documents are dealt to tasks. In one
context, ``NEAR`` levels of a path are neighbours in a table, as random reads
and writes of memory are much of the cost.

The predictions' logits are added with weights that a gate picks (the bit's
depth in the code, and how often its contexts were seen). Gated weights and the
refinement (how predictions of this size turned out) are learned beforehand from
every bit of all training documents, each without its own count: the bits are
counted by gate and by their logits in ``LEVELS`` levels, the counts are summed
whole, and Newton's steps on those sums give the weights. Every document begins
from them; while it is scored, its weights and its refinement
are corrected after 32 bits at first and later after each eighth of what was
read. A text's score depends on the model and the text alone: contexts begin
anew with each text, and very long texts are read in segments with all state
carried along.

Beside it stands a base score from add-one word counts; words in the code bring
their counts along, only the rare others are joined.

Training documents are those whose crc32(doc_id as text) mod 7 is not 2.
Nulls: a null text is empty (the end alone); rows with a null doc_id are
trained on. Repeated rows count and are scored each. Texts of any length are
read whole, in segments that end between words; one word is never cut, so a
word of many MB takes some hundred times its size while it is spelled. Empty
tables give empty results; extra columns are ignored.

Bounds: ``VOCABULARY`` words in the code and 2^``MAX_BITS`` slots in a table,
whose number follows the training bytes below that; a full table blends
contexts, never drops them. Counts to learn from are ``CLASSES`` numbers at
most, however many bits they tell of.
"""

from __future__ import annotations

import ctypes
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, map_batches, slices, small_batches, staged, tidied

#: Words with a path of their own: so many at most, each seen this often; what words seen once look like tells what new ones do.
VOCABULARY, OFTEN = 1 << 17, 2
HASHED = 2
#: log2 of a table's slots, at least and at most; about one for each ``SLOT_BYTES`` of training text.
MIN_BITS, MAX_BITS, SLOT_BYTES = 16, 22, 16
BLOCK = 1 << 16
#: Bytes of texts that are gone through together; a longer text is read in segments of about so many.
SEGMENT = 220_000
LONG_TEXT = 400_000
#: So many levels of a path lie together in a table, in one or two lines of the processor's cache.
NEAR = 4
#: Texts that are scored side by side, at most.
SIDE_BY_SIDE = 1000
#: Bytes of texts whose words are counted together, and different words that a task keeps, and their bytes, about.
COUNTED, KINDS, KIND_BYTES = 1 << 20, 200_000, 24 << 20
#: Units whose paths wait to be counted together, about, and pairs of a context and a unit that are gone along together.
HELD, PAIRS = 1_000_000, 50_000
LOOK_BACK = 16  # a power of two
#: So many of the most frequent words are told apart as a topic.
TOPICS = 64
#: Steps of learning for a bit in a document: they fall with the bits read.
RATE, SLOWER = 0.004, 4000.0
FIRST_STEP, SHARE_STEP = 32, 8
#: What a count begins with, and how much faster the refinement is corrected than weights.
PRIOR, REFINE = 0.4, 2.0
#: Logits are kept as bytes, in sixteenths.
SCALE = 16.0
#: Mixed logits from -8 to 8 in steps: of the probability, and cells of the refinement, a power of two of those each.
FINE, COARSE, MIDDLE, CELLS = 64, 32, 512, 33
GATES = 2 * 16 * 4 * 4
#: What weights are before any bit is seen, and how much (as a sum of squared logits) holds them there; Newton's steps, at most.
FIRST_WEIGHT, HOLD, NEWTON = 0.3, 300.0, 30
#: Logits in levels, finer around zero, which is one of them, and classes of bits: by gate and the levels of all logits.
_LEVEL = 2 * np.sinh(0.28 * np.arange(-8, 9))
LEVELS = len(_LEVEL)
CLASSES = GATES * LEVELS ** (1 + HASHED)

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_AC = np.uint32(0x9E3779B1 * 0xC2B2AE35 & 0xFFFFFFFF)


def pick(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values`` at places that are in range; not asking numpy to make sure of that takes a fraction of the time."""
    return values.take(at, mode="wrap")


def add_ones(totals: np.ndarray, at: np.ndarray) -> None:
    """One more at each place, as often as it is named; an array of ones is added in a fraction of the time that one number takes."""
    np.add.at(totals, at.astype(np.intp), np.ones(len(at), totals.dtype))


def stream(text: bytes | None) -> bytes:
    return (text or b"").lower()


# The code --------------------------------------------------------------------


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Huffman's code: lengths, where each symbol's path begins, the paths' nodes and bits, and the counts of zeros and ones at each node."""
    n = len(counts)
    heap = [(float(c) + 0.01, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, side = np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.uint8)
    split = np.zeros((max(n - 1, 1), 2))
    node = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]] = parent[b[1]] = node
        side[b[1]] = 1
        split[node - n] = a[0], b[0]
        heapq.heappush(heap, (a[0] + b[0], node))
        node += 1
    # All paths are followed up to the root side by side.
    at, ups, turns = np.arange(n), [], []
    while (open_ := parent[at] >= 0).any():
        turns.append(np.where(open_, side[at], 2))
        at = np.where(open_, parent[at], at)
        ups.append(at - n)
    lengths = sum(((t != 2) for t in turns), np.zeros(n, np.int64))
    starts = np.cumsum(lengths) - lengths
    nodes, bits = np.zeros(int(lengths.sum()), np.int32), np.zeros(int(lengths.sum()), np.uint8)
    for k, (up, turn) in enumerate(zip(ups, turns)):
        own = np.flatnonzero(turn != 2)
        place = starts[own] + lengths[own] - 1 - k
        nodes[place], bits[place] = up[own], turn[own]
    return lengths, starts, nodes, bits, split


_ODD, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, _ODD)), np.cumprod(np.full(n, _BACK))


def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of some streams, which of them are white space, and where words begin and end."""
    flat = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    space = (flat == 32) | (flat - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    return flat, space, edges[::2], edges[1::2]


@dataclass
class Words:
    """The words of some streams: the bytes, where each word begins and ends, its hash, and how many each stream has."""

    flat: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        flat, _, starts, ends = split(texts)
        # A word's bytes times rising powers, and then the powers up to it taken out: the same wherever it stands.
        power, back = _powers(1 << (len(flat) - 1).bit_length())
        sums = np.cumsum((flat + np.uint64(1)) * power[: len(flat)])
        h = (sums[ends - 1] - sums[starts - 1]) * back[starts]
        h ^= h >> np.uint64(32)
        h *= _ODD
        h ^= h >> np.uint64(29)
        h[h == 0] = 1
        bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        return cls(flat, starts, ends, h, np.diff(np.searchsorted(starts, bounds, side="right"), prepend=0))


class _Ids:
    """Ids of words by their 64-bit hashes, in a table with open addresses."""

    def __init__(self, words: list[bytes]):
        self.escape = len(words)
        self.bits = max(4, (4 * len(words)).bit_length())
        self.keys, self.ids = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, self.escape, np.int32)
        if words:
            for h, k in zip(Words.of([b" ".join(words)]).hashes.tolist(), range(len(words))):
                at = h >> (64 - self.bits)
                while self.keys[at]:
                    at = (at + 1) & ((1 << self.bits) - 1)
                self.keys[at], self.ids[at] = h, k

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.intp)
        there = pick(self.keys, at)
        out = pick(self.ids, at)
        open_ = np.flatnonzero((there != hashes) & (there != 0))
        out[(there != hashes) & (there == 0)] = self.escape
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there, wanted = self.keys[at[open_]], hashes[open_]
            out[open_] = np.where(there == wanted, self.ids[at[open_]], self.escape)
            open_ = open_[(there != wanted) & (there != 0)]
        return out


@dataclass
class Code:
    """Words by falling count, then the escape, the end, 256 bytes and the end of a spelled word; ``zeros_ones`` of each node.

    ``table_bits``: log2 of the slots of the tables that go with it, in which ``NEAR`` levels of a path are neighbours.
    """

    words: list[bytes]
    counts: np.ndarray
    escaped: float
    ends: float
    byte_counts: np.ndarray
    table_bits: int = MAX_BITS
    ids: _Ids = field(init=False)

    def __post_init__(self):
        v = len(self.words)
        self.ids = _Ids(self.words)
        self.escape, self.end, self.bytes_from = v, v + 1, v + 2
        first = prefix_code(np.concatenate([self.counts, [self.escaped, self.ends]]))
        second = prefix_code(self.byte_counts)
        self.lengths = np.concatenate([first[0], second[0]])
        self.starts = np.concatenate([first[1], second[1] + len(first[2])])
        self.nodes = np.concatenate([first[2], second[2] + (v + 1)]).astype(np.int32)
        self.bits = np.concatenate([first[3], second[3]])
        self.zeros_ones = np.concatenate([first[4], second[4]])
        self.depth = np.zeros(len(self.zeros_ones), np.uint8)
        level = np.arange(len(self.nodes), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), self.lengths)
        self.depth[self.nodes] = np.minimum(level, 15)
        # A node's slot is that of the node ``level % NEAR`` levels above, and as many further as the turns from there tell.
        above = level % NEAR
        turns = sum(np.where(above >= k, np.roll(self.bits, k) << np.uint8(k - 1), np.uint8(0)) for k in range(1, NEAR))
        salts = self.nodes[np.arange(len(self.nodes)) - above].view(np.uint32) * _AC + ((1 << above) - 1 + turns << 32 - self.table_bits).astype(np.uint32)
        self.spelled = (np.arange(len(self.zeros_ones)) > v).astype(np.uint8)
        self.steps = np.stack([(self.nodes << 1 | self.bits).view(np.uint32), salts], axis=1)  # node and bit, and what tells the slot


@dataclass
class Runs:
    """Bits of one step of learning lie together, in a run for each text that goes so far, text after text.

    ``bounds`` are the steps; of each run its step, its text, its length, and where it begins now and where before; ``order`` arranges bits so.
    """

    bounds: np.ndarray
    steps: np.ndarray
    texts: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray
    sources: np.ndarray

    @property
    def order(self) -> np.ndarray:
        return np.arange(int(self.lengths.sum())) + np.repeat(self.sources - self.offsets, self.lengths)

    @classmethod
    def of(cls, ends: np.ndarray, pos: int) -> Runs:
        """For texts that end at ``ends`` and have read ``pos`` bits before."""
        begins = np.concatenate([[0], ends[:-1]])
        sizes = ends - begins
        bounds = _bounds(pos, int(sizes.max(initial=0)))
        runs = np.clip(sizes - bounds[:-1, None], 0, np.diff(bounds)[:, None])
        steps, texts = np.nonzero(runs)
        lengths = runs[steps, texts]
        return cls(bounds, steps, texts, lengths, np.cumsum(lengths) - lengths, begins[texts] + bounds[steps])


@dataclass
class Bits:
    """The bits of some texts: what each is, its node, its slots before they are cut to a table's size, and where each text ends."""

    bit: np.ndarray
    node: np.ndarray
    hashes: list[np.ndarray]
    ends: np.ndarray
    #: Tokens of each text, one after the other, how many each has, and the words that are spelled.
    tokens: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    rare: list[bytes] | None = None
    #: The runs that the bits are arranged in; None if texts follow each other.
    runs: Runs | None = None


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * _B
    return h ^ (h >> np.uint32(13))


@dataclass
class Units:
    """What some streams are made of: words, ends, and escapes with the bytes and the end of a spelled word; each one's contexts.

    ``upto``: how many units each stream ends at; ``tokens`` and ``sizes`` as of ``Bits``; ``rare``: which words are spelled.
    """

    unit: np.ndarray
    context: list[np.ndarray]
    upto: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    words: Words
    rare: np.ndarray


def units(texts: list[bytes], code: Code, before: bytes = b"", last: bool = True) -> Units:
    """The units of some streams. ``before``: the words ahead of a single one; ``last``: the end follows."""
    escape = code.ids.escape
    skip = len(before.split())
    words = Words.of([before + b" " + texts[0], *texts[1:]] if skip else texts)
    sizes = words.sizes + last
    found = code.ids.find(words.hashes)
    if last:  # ends come in between
        tok = np.full(int(sizes.sum()), code.end, np.int32)
        inner = np.ones(len(tok), bool)
        inner[np.cumsum(sizes) - 1] = False
        tok[inner] = found
    else:
        tok = found
    n = len(tok)
    upto = np.cumsum(sizes)
    if not n:
        return Units(tok, [np.empty(0, np.uint32)] * HASHED, upto, tok, sizes, words, np.empty(0, np.intp))
    off = np.arange(n, dtype=np.int32) - np.repeat((upto - sizes).astype(np.int32), sizes)
    rare_at = np.flatnonzero(tok == escape)
    rare = np.flatnonzero(found == escape)
    name = tok.astype(np.uint32)
    name[rare_at] = (words.hashes[rare] >> np.uint64(33)).astype(np.uint32) | np.uint32(1 << 31)
    reach = lambda x, k, none: np.where(off >= k, np.concatenate([x[:k], x[:-k]]) if n > k else x, none)
    one = reach(name, 1, np.uint32(0xFFFFFFFF))
    topic = reach(tok, 1, np.int32(escape + 3))
    for k in (1, 2, 4, 8):  # windows of two, four, ... words
        topic = np.minimum(topic, reach(topic, k, np.int32(escape + 3)))
    topic = np.minimum(topic, TOPICS).astype(np.uint32)
    # Units: a word, or an escape and the bytes of a word and their end.
    reps = np.ones(n, np.int64)
    rare_len = words.ends[rare] - words.starts[rare] + 1
    reps[rare_at] += rare_len
    if skip:
        gone = int((rare_at < skip).sum())
        rare, rare_len, rare_at = rare[gone:], rare_len[gone:], rare_at[gone:]
        reps[:skip] = 0
    unit = np.repeat(tok, reps)
    context = [np.repeat(c, reps) for c in (_mixed(topic * _A + np.uint32(2)), _mixed(one * _A + np.uint32(1)))]
    if len(rare):
        rare_to = np.cumsum(rare_len)
        within = np.arange(int(rare_to[-1])) - np.repeat(rare_to - rare_len, rare_len)
        shown = pick(words.flat, np.repeat(words.starts[rare], rare_len) + within).astype(np.int64)
        shown[rare_to - 1] = 256
        first = (np.cumsum(reps) - reps)[rare_at]
        where = np.repeat(first + 1, rare_len) + within
        unit[where] = code.bytes_from + shown
        b1, b2, b3, b4 = (np.where(within >= k, np.concatenate([shown[:k], shown[:-k]])[: len(shown)] + 1, 0).astype(np.uint32) for k in (1, 2, 3, 4))
        two_bytes = b1 * np.uint32(259) + b2
        context[0][where] = _mixed((two_bytes * _A) ^ (np.repeat(topic[rare_at], rare_len) * _B))
        context[1][where] = _mixed((two_bytes * np.uint32(259) + b3) * _A + np.minimum(within, 7).astype(np.uint32) * _B)
    sizes[:1] -= skip
    return Units(unit, context, np.concatenate([[0], np.cumsum(reps)])[upto], tok[skip:], sizes, words, rare)


def expand(code: Code, place: np.ndarray, n_bits: np.ndarray, context: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Nodes and bits of paths, or parts of them, that begin at some places of the code, and the slots in some contexts before they are cut to a table's size."""
    to = np.cumsum(n_bits)
    # Places follow each other, but for the first of a path.
    at = np.ones(int(to[-1]) if len(to) else 0, np.intp)
    at[:1] = place[:1]
    at[to[:-1]] = place[1:] - place[:-1] - n_bits[:-1] + 1
    steps = code.steps.take(np.cumsum(at, out=at), axis=0, mode="wrap")
    both = np.repeat(np.stack([c * _C for c in context], axis=1), n_bits, axis=0)
    return steps[:, 0], [h + steps[:, 1] for h in both.T]


def spell(texts: list[bytes], code: Code, before: bytes = b"", last: bool = True, pos: int | None = None, told: bool = False) -> Bits:
    """The bits of some streams. ``before``: the words ahead of a single one; ``last``: the end follows; ``pos``: bits read before, to arrange them in runs; ``told``: with the words that are spelled."""
    u = units(texts, code, before, last)
    context = u.context
    n_bits = pick(code.lengths, u.unit)
    to = np.cumsum(n_bits)
    ends = np.concatenate([[0], to])[u.upto]
    place = pick(code.starts, u.unit)
    runs = Runs.of(ends, pos) if pos is not None and len(to) else None
    if runs:  # the units of each run, of which the first and the last may belong to it in part
        begin, end = runs.sources, runs.sources + runs.lengths
        first, final = np.searchsorted(to, begin, side="right"), np.searchsorted(to, end)
        many = final - first + 1
        upto_runs = np.cumsum(many)
        which = np.arange(int(upto_runs[-1])) + np.repeat(first - upto_runs + many, many)
        gone = begin - (to - n_bits)[first]
        over = to[final] - end
        n_bits, place, context = pick(n_bits, which), pick(place, which), [pick(c, which) for c in context]
        n_bits[upto_runs - many] -= gone
        place[upto_runs - many] += gone
        n_bits[upto_runs - 1] -= over
    path, hashes = expand(code, place, n_bits, context)
    node = (path >> np.uint32(1)).view(np.int32)
    bit = path.astype(np.uint8)
    bit &= np.uint8(1)
    if told:
        flat = u.words.flat.tobytes()
        told_words = [flat[a:b] for a, b in zip(u.words.starts[u.rare].tolist(), u.words.ends[u.rare].tolist())]
    return Bits(bit, node, hashes, ends, u.tokens, u.sizes, told_words if told else None, runs)


def segments(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """A stream in parts of about ``SEGMENT`` bytes that end between words, and whether they are the last."""
    at = 0
    while len(data) > LONG_TEXT and len(data) - at > SEGMENT:
        gap = _SPACE.search(data, at + SEGMENT)
        if not gap:
            break
        yield data[at : gap.start()], False
        at = gap.end()
    yield data[at:] if at else data, True


def ahead(before: bytes, part: bytes) -> bytes:
    """The last ``LOOK_BACK`` words of what was read."""
    return b" ".join([*before.split(), *part.rsplit(None, LOOK_BACK)[-LOOK_BACK:]][-LOOK_BACK:])


# Prediction --------------------------------------------------------------------


def _strength(n: np.ndarray) -> np.ndarray:
    """How often a context was seen, as a byte: exact up to 15, then in quarters of powers of two."""
    return np.where(n <= 15, n, np.minimum(255, 15 + np.rint(4 * np.log2(np.maximum(n, 15) / 15)))).astype(np.uint16)


_SEEN = np.array([k if k <= 15 else 15 * 2 ** ((k - 15) / 4) for k in range(256)])
#: Packed counts from which on a context was seen once, a few and many times.
_SOME = tuple(np.uint16(int(np.searchsorted(_SEEN, n)) << 8) for n in (1, 4, 30))


def _logits(packed: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    x = np.subtract(packed & np.uint16(255), np.float32(128), out=out, dtype=np.float32)
    x *= np.float32(1 / SCALE)
    return x


def packed_counts(zeros_ones: np.ndarray) -> np.ndarray:
    """Counts as 16 bits: how often, and the logit."""
    both = zeros_ones.reshape(-1, 2).astype(np.float64)
    logit = np.clip(np.rint(SCALE * np.log((both[:, 1] + PRIOR) / (both[:, 0] + PRIOR))), -127, 127).astype(np.int16) + 128
    return (_strength(both.sum(axis=1)) << 8 | logit.astype(np.uint16)).astype(np.uint16)


@dataclass
class Model:
    """The code, the packed tables, gated weights and the refinement; ``log_count``: log10 of the words' counts and one, for the base."""

    code: Code
    tables: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray
    log_count: np.ndarray
    end_known: bool = True

    def __post_init__(self):
        z = self.code.zeros_ones
        self.alone = np.log((z[:, 1] + PRIOR) / (z[:, 0] + PRIOR)).astype(np.float32)
        self.place = (self.code.spelled.astype(np.uint16) << 8 | self.code.depth.astype(np.uint16) << 4).astype(np.uint16)
        self.kind = self.code.spelled.astype(np.int32) * CELLS
        self.bits = int(self.tables[0].size).bit_length() - 1

    def inputs(self, b: Bits) -> tuple[np.ndarray, np.ndarray]:
        """Logits by table, and each bit's gate."""
        raw = [pick(t, h >> np.uint32(32 - self.bits)) for t, h in zip(self.tables, b.hashes)]
        node = b.node.astype(np.intp)
        x = np.empty((1 + HASHED, len(node)), np.float32)
        self.alone.take(node, mode="wrap", out=x[0])
        for own, r in zip(x[1:], raw):
            _logits(r, own)
        gate = pick(self.place, node)
        for k, r in enumerate(raw):
            level = (r >= _SOME[0]).view(np.uint8)
            for least in _SOME[1:]:
                level += r >= least
            level <<= np.uint8(2 * k)
            gate |= level
        return x, gate.astype(np.intp)


@dataclass
class Classes:
    """Tells the class of a bit, as if the bit had not been counted, from its path and from what the tables say; twice the class and the bit."""

    paths: np.ndarray
    packed: list[np.ndarray]

    @classmethod
    def of(cls, model: Model) -> Classes:
        def level(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
            x = np.log((np.maximum(ones, 0) + PRIOR) / (np.maximum(zeros, 0) + PRIOR))
            return np.searchsorted((_LEVEL[1:] + _LEVEL[:-1]) / 2, x)

        bit = np.arange(2)
        z = model.code.zeros_ones[:, :, None]
        parts = 2 * (model.place.astype(np.int64)[:, None] * LEVELS**3 + level(z[:, 1] - bit, z[:, 0] - 1 + bit) * LEVELS**2) + bit
        all_ = np.arange(1 << 16, dtype=np.uint16)
        seen = _SEEN[all_ >> 8]
        ones = np.clip((seen + 2 * PRIOR) / (1 + np.exp(-_logits(all_).astype(np.float64))) - PRIOR, 0, seen)[:, None]
        left = np.maximum(all_ >> 8, 1) - 1 << 8
        often = sum((left >= least).astype(np.int64) for least in _SOME)[:, None]
        levels = level(ones - bit, seen[:, None] - ones - 1 + bit)
        packed = [2 * ((often << 2 * k) * LEVELS**3 + levels * LEVELS ** (1 - k)) for k in range(HASHED)]
        return cls(parts.astype(np.int32).ravel(), [p.astype(np.int32).T.ravel() for p in packed])  # all for a zero, then for a one

    def find(self, b: Bits, tables: list[np.ndarray], bits: int) -> np.ndarray:
        out = pick(self.paths, b.node << 1 | b.bit)
        bit = b.bit.astype(np.uint32) << np.uint32(16)
        for table, own, h in zip(tables, self.packed, b.hashes):
            out += pick(own, bit | pick(table, h >> np.uint32(32 - bits)))
        return out


@dataclass
class State:
    """What some texts have learned so far: corrections of weights and of the refinement; all have read ``pos`` bits."""

    change: np.ndarray
    shift: np.ndarray
    pos: int = 0

    @classmethod
    def fresh(cls, n: int) -> State:
        return cls(np.zeros((1 + HASHED, n), np.float32), np.zeros(n * 2 * CELLS, np.float32))


def _bounds(begin: int, bits: int) -> np.ndarray:
    """Where corrections fall among ``bits`` bits after the first ``begin``."""
    found = [0]
    while found[-1] < bits:
        found.append(found[-1] + max(FIRST_STEP, (begin + found[-1]) // SHARE_STEP))
    found[-1] = bits
    return np.array(found)


_CHANCE = (1 / (1 + np.exp(-(np.arange(2 * MIDDLE + 1) - MIDDLE) / FINE))).astype(np.float32)


def _levels(mixed: np.ndarray) -> np.ndarray:
    """Where logits stand among ``_CHANCE``; the array is used up."""
    mixed *= np.float32(FINE)
    mixed += np.float32(MIDDLE + 0.5)
    np.clip(mixed, 0, 2 * MIDDLE, out=mixed)
    return mixed.astype(np.intp)


def log_probabilities(b: Bits, model: Model, state: State) -> np.ndarray:
    """log10 probability of each text of ``b``; ``state`` learns along."""
    n = len(b.ends)
    if not len(b.bit):
        return np.zeros(n)
    runs = b.runs
    if runs is None:
        runs = Runs.of(b.ends, state.pos)
        b = Bits(b.bit.take(runs.order), b.node.take(runs.order), [h.take(runs.order) for h in b.hashes], b.ends)
    bounds, steps, texts, lengths, offsets = runs.bounds, runs.steps, runs.texts, runs.lengths, runs.offsets
    x, gate = model.inputs(b)
    base = pick(model.weights[0], gate)
    base *= x[0]
    for k in range(1, 1 + HASHED):
        more = pick(model.weights[k], gate)
        more *= x[k]
        base += more
    row = np.repeat(texts * (2 * CELLS), lengths)
    row += (b.node > len(model.code.words)) * np.intp(CELLS)
    one = b.bit.astype(np.float32)
    cost = np.empty(len(one), np.float32)
    change, known = state.change, np.tile(model.refined.astype(np.float32), n)
    table = known + state.shift
    first = np.searchsorted(steps, np.arange(len(bounds)))
    for j in range(len(bounds) - 1):
        own = slice(first[j], first[j + 1])
        who, each, at = texts[own], lengths[own], offsets[own]
        s = slice(at[0], at[-1] + each[-1])
        y, xs = one[s], x[:, s]
        mixed = base[s]
        parts = np.repeat(change.take(who, axis=1), each, axis=1)
        parts *= xs
        for more in parts:
            mixed += more
        cell = _levels(mixed)
        p = pick(_CHANCE, cell)
        cell >>= COARSE.bit_length() - 1
        cell += row[s]
        refined = pick(table, cell)
        np.clip(refined, 0.0005, 0.9995, out=refined)
        np.add(p, refined, out=cost[s])
        rate = RATE / (1 + (state.pos + int(bounds[j])) / SLOWER)
        miss = (y - p) * np.float32(rate)
        np.multiply(xs, miss, out=parts)
        change[:, who] += np.add.reduceat(parts, at - at[0], axis=1)
        refined -= y
        table -= np.bincount(cell, weights=refined, minlength=len(table)) * np.float32(rate * REFINE)
    state.shift[:] = table - known
    state.pos += int(bounds[-1])
    # Of a bit that is zero, what its chance to be one leaves.
    cost *= np.float32(0.5)
    cost -= np.subtract(np.float32(1), one, out=one)
    logs = np.log(np.abs(cost, out=cost), out=cost).astype(np.float64)  # numpy's log10 takes several times as long
    return np.bincount(texts, weights=np.add.reduceat(logs, offsets), minlength=n) / np.log(10)


@dataclass
class Scored:
    """What is told of a text: its log10 probability, tokens, and of the base the words with a path and the others."""

    score: float = 0.0
    tokens: int = 0
    known: int = 0
    logs: float = 0.0
    others: Counter[bytes] = field(default_factory=Counter)

    def add(self, score: float, tokens: int, known: int, logs: float, rare: list[bytes]) -> None:
        self.score, self.tokens, self.known, self.logs = self.score + score, self.tokens + tokens, self.known + known, self.logs + logs
        self.others.update(rare)


def score_texts(texts: list[bytes], model: Model) -> list[Scored]:
    """What is told of each stream: the same whatever stands beside it."""
    out = [Scored() for _ in texts]
    wait: list[int] = []
    held = 0

    def told(keys: list[int], b: Bits, state: State) -> None:
        scores = log_probabilities(b, model, state)
        whose = np.repeat(np.arange(len(keys)), b.sizes)
        known = np.bincount(whose, weights=b.tokens != model.code.escape, minlength=len(keys)).astype(np.int64).tolist()
        logs = np.bincount(whose, weights=model.log_count.take(b.tokens), minlength=len(keys)).tolist()
        at = 0
        for k, score, n, own, log in zip(keys, scores.tolist(), b.sizes.tolist(), known, logs):
            out[k].add(score, n, own, log, b.rare[at : at + n - own])
            at += n - own

    def done() -> None:
        nonlocal held
        told(wait, spell([texts[k] for k in wait], model.code, pos=0, told=True), State.fresh(len(wait)))
        wait.clear()
        held = 0

    for k, data in enumerate(texts):
        if len(data) > LONG_TEXT:
            state, before = State.fresh(1), b""
            for part, last in segments(data):
                told([k], spell([part], model.code, before, last, state.pos, True), state)
                before = ahead(before, part)
            continue
        if wait and (held + len(data) > SEGMENT or len(wait) >= SIDE_BY_SIDE):
            done()
        wait.append(k)
        held += len(data) + 1
    if wait:
        done()
    return out


# Training -------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_words(learn: DataFrame) -> DataFrame:
    """(word, c) over all texts, summed in each task before they are shuffled."""

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []
        wait: list[bytes] = []
        size = 0

        def add() -> None:
            flat, space, starts, ends = split(wait)
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat[~space])])
            found.append(pa.Table.from_arrays(words.value_counts().flatten(), names=["word", "n"]))
            wait.clear()

        def merge() -> None:
            whole = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")])
            found[:] = [whole.select(["word", "n_sum"]).rename_columns(["word", "n"])]

        for batch in batches:
            for part in slices(batch, 256):
                for text in part.column(0).to_pylist():
                    for words, _ in segments(stream(text)):
                        wait.append(words)
                        size += len(words)
                        if size > COUNTED:
                            add()
                            size = 0
                            if sum(map(len, found)) > 3 * KINDS or sum(t.nbytes for t in found) > 3 * KIND_BYTES:
                                merge()
                                if len(found[0]) > KINDS or found[0].nbytes > KIND_BYTES:
                                    yield from found.pop().to_batches(max_chunksize=KINDS)
        add()
        merge()
        yield from found.pop().to_batches(max_chunksize=KINDS)

    small_batches(learn.sparkSession)
    return staged(learn.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")


def count_bytes(rare: DataFrame) -> np.ndarray:
    """How often each byte, and the end, stands in the words (word, c) that are spelled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257, np.int64)
        for batch in batches:
            words, n = batch.column(0), batch.column(1).to_numpy()
            lengths = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1])
            flat = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
            total[:256] += np.bincount(flat, weights=np.repeat(n, lengths), minlength=256).astype(np.int64)
            total[256] += int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(257), pa.int32()), pa.array(total)], names=["byte", "n"])

    rows = rare.select("word", "c").mapInArrow(count, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(257)
    for r in rows:
        total[r["byte"]] = r["n"]
    return total


def keep_memory() -> None:
    """Have the worker keep some freed memory while its task runs: arrays of a few MB come and go, and each anew would be filled with zeros by the system."""
    setting = getattr(ctypes.CDLL(None), "mallopt", None)
    if setting:
        setting(-1, 64 << 20)  # M_TRIM_THRESHOLD
        setting(-3, 32 << 20)  # M_MMAP_THRESHOLD


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], bytes, bool]]:
    """All texts in the first column as ``spell`` takes them: some texts, or a segment of a long one, at a time."""
    keep_memory()
    wait: list[bytes] = []
    size = 0
    for batch in batches:
        for part in slices(batch, 1024):
            for text in part.column(0).to_pylist():
                data = stream(text)
                if len(data) > LONG_TEXT:
                    before = b""
                    for piece, last in segments(data):
                        yield [piece], before, last
                        before = ahead(before, piece)
                    continue
                wait.append(data)
                size += len(data) + 1
                if size > SEGMENT:
                    yield wait, b"", True
                    wait, size = [], 0
    if wait:
        yield wait, b"", True


def spelled(batches: Iterator[pa.RecordBatch], code: Code) -> Iterator[Bits]:
    """The bits of all texts in the first column."""
    for texts, before, last in parts(batches):
        yield spell(texts, code, before, last)


def count_slots(batches: Iterator[pa.RecordBatch], code: Code, bits: int) -> np.ndarray | None:
    """How often each slot's bit was zero and one, by table, over all texts in the first column; None if there are none."""
    zeros_ones = np.zeros((HASHED, 2 << bits), np.uint32)
    wait: list[list[np.ndarray]] = [[] for _ in range(HASHED)]
    seen, held = False, 0

    def add() -> None:
        # A unit that comes again in the same context takes the same path: it is gone along once, with its number.
        for total, keys in zip(zeros_ones, wait):
            pairs = np.concatenate(keys)
            keys.clear()
            pairs.sort()
            first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            times, pairs = np.diff(first, append=len(pairs)).astype(np.uint32), pairs[first]
            for k in range(0, len(pairs), PAIRS):
                some = pairs[k : k + PAIRS]
                unit = some & np.uint64(0xFFFFFFFF)
                n_bits = pick(code.lengths, unit.astype(np.intp))
                path, (slot,) = expand(code, pick(code.starts, unit.astype(np.intp)), n_bits, [(some >> np.uint64(32)).astype(np.uint32)])
                slot >>= np.uint32(32 - bits)
                slot <<= np.uint32(1)
                slot |= path & np.uint32(1)
                np.add.at(total, slot.astype(np.intp), np.repeat(times[k : k + PAIRS], n_bits))

    for texts, before, last in parts(batches):
        u = units(texts, code, before, last)
        seen, held = True, held + len(u.unit)
        for keys, c in zip(wait, u.context):
            keys.append(c.astype(np.uint64) << np.uint64(32) | u.unit.astype(np.uint64))
        if held > HELD:
            add()
            held = 0
    if held:
        add()
    return zeros_ones if seen else None


def count_contexts(learn: DataFrame, code: Code, bits: int) -> list[np.ndarray]:
    """The packed tables: every task counts its part, and the parts are added up slot by slot."""
    blocks = max(1, (2 << bits) // (2 * BLOCK))
    schema = "block int, counts binary"
    shared = learn.sparkSession.sparkContext.broadcast(code)  # at most VOCABULARY words

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros_ones = count_slots(batches, shared.value, bits)
        if zeros_ones is not None:
            for k in range(HASHED):
                own = zeros_ones[k].reshape(blocks, -1)
                for b in range(0, blocks, 8):
                    # All low bytes, then the next ones: the higher ones are mostly zero and take next to no room when compressed.
                    planes = [own[x].view(np.uint8).reshape(-1, 4).T.tobytes() for x in range(b, min(blocks, b + 8))]
                    yield pa.RecordBatch.from_arrays([pa.array(range(k * blocks + b, k * blocks + b + len(planes)), pa.int32()), pa.array(planes, pa.binary())], names=["block", "counts"])

    @tidied
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.ascontiguousarray(np.frombuffer(part.as_buffer(), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
                if b in sums:
                    sums[b] += own
                else:
                    sums[b] = own.astype(np.int64)
        for b, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed_counts(own).tobytes()], pa.binary())], names=["block", "counts"])

    small_batches(learn.sparkSession)
    rows = learn.select("text").mapInArrow(count, schema).repartition(48, "block").mapInArrow(merge, schema).collect()  # tables of bounded size
    tables = np.full((HASHED, 1 << bits), 128, np.uint16)
    for r in rows:
        k, b = divmod(r["block"], blocks)
        own = np.frombuffer(r["counts"], np.uint16)
        tables[k, b * len(own) : (b + 1) * len(own)] = own
    shared.unpersist()
    return list(tables)


def count_classes(learn: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The classes that bits of the training texts fall into, in order, and how many zeros and ones each has: sums of whole numbers, however texts are dealt to tasks."""
    shared = learn.sparkSession.sparkContext.broadcast((model.code, model.tables, Classes.of(model), model.bits))

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables, classes, bits = shared.value
        total = np.zeros(2 * CLASSES, np.uint32)
        held = 0

        def told() -> pa.RecordBatch:
            own = np.flatnonzero(total)
            out = pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], names=["class", "n"])
            total[own] = 0
            return out

        for found in spelled(batches, code):
            if held + len(found.bit) >= 1 << 32:
                yield told()
                held = 0
            held += len(found.bit)
            add_ones(total, classes.find(found, tables, bits))
        if held:
            yield told()

    small_batches(learn.sparkSession)
    rows = learn.select("text").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()  # 2 * CLASSES at most
    shared.unpersist()
    at, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    classes, row = np.unique(at >> 1, return_inverse=True)
    zeros_ones = np.zeros((len(classes), 2))
    zeros_ones[row, at & 1] = n
    return classes, zeros_ones


def fit(model: Model, classes: np.ndarray, zeros_ones: np.ndarray) -> None:
    """Gated weights by Newton's steps over counted classes of bits; then the refinement."""
    n, ones = zeros_ones.sum(axis=1), zeros_ones[:, 1]
    gate = classes // LEVELS ** (1 + HASHED)
    x = np.stack([_LEVEL[classes // LEVELS ** (HASHED - k) % LEVELS] for k in range(1 + HASHED)])
    sums = lambda v: np.bincount(gate, weights=v, minlength=GATES)
    weights = np.full((1 + HASHED, GATES), FIRST_WEIGHT)
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip((weights[:, gate] * x).sum(axis=0), -30, 30)))
        slope = np.stack([sums((ones - n * p) * v) for v in x]) - HOLD * (weights - FIRST_WEIGHT)
        bend = np.array([[sums(n * p * (1 - p) * v * w) for w in x] for v in x]).transpose(2, 0, 1) + HOLD * np.eye(1 + HASHED)
        step = np.clip(np.linalg.solve(bend, slope.T[:, :, None])[:, :, 0].T, -0.5, 0.5)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = weights.astype(np.float32)
    cell = gate // (GATES // 2) * CELLS + _levels((weights[:, gate] * x).sum(axis=0).astype(np.float32)) // COARSE
    seen, turned = (np.bincount(cell, weights=v, minlength=2 * CELLS) for v in (n, ones))
    middle = 1 / (1 + np.exp(-(np.arange(CELLS) - 15.5) / 2))
    model.refined = (turned + 40 * np.tile(middle, 2)) / (seen + 40)


def train(docs: DataFrame) -> tuple[Model, DataFrame, dict]:
    """The model, the counts of words that it has no path for, and totals, from all training rows of ``docs``."""
    learn = docs.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    seen = count_words(learn)
    ends = learn.count()
    # From which count on there are few enough words, by a sixteenth of a power of two; so no task sends more than there are.
    grade = F.floor(F.log2(F.col("c").cast("double")) * 16)
    grades = seen.groupBy((F.col("c") >= OFTEN).alias("often"), grade.alias("grade")).agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n"), F.sum(F.col("c") * (F.length("word") + 1)).alias("bytes")).collect()  # at most 1024 rows
    sums = {k: sum(r[k] for r in grades) for k in ("v", "n", "bytes")}
    least, held = float("inf"), 0
    for r in sorted((r for r in grades if r["often"]), key=lambda r: -r["grade"]):
        held += r["v"]
        if held > VOCABULARY:
            break
        least = r["grade"]
    often = (F.col("c") >= OFTEN) & (grade >= F.lit(least))
    top = sorted(((r["c"], bytes(r["word"])) for r in seen.where(often).collect()), key=lambda x: (-x[0], x[1]))
    words, counts = [w for _, w in top], np.array([c for c, _ in top], np.float64)
    rare = seen.where(~often)
    bits = min(MAX_BITS, max(MIN_BITS, int(sums["bytes"] // SLOT_BYTES).bit_length()))
    code = Code(words, counts, float(sums["n"] - counts.sum()), float(ends), count_bytes(rare), bits)
    weights, refined = np.full((1 + HASHED, GATES), FIRST_WEIGHT, np.float32), np.zeros(2 * CELLS)
    model = Model(code, count_contexts(learn, code, bits), weights, refined, np.log10(np.concatenate([counts, [0, ends]]) + 1), ends > 0)
    fit(model, *count_classes(learn, model))
    return model, rare, {"tokens": sums["n"] + ends, "kinds": sums["v"] + (ends > 0)}


# The operator ---------------------------------------------------------------------

_ROW = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("score", T.DoubleType())]
    + [T.StructField("logs", T.DoubleType()), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType()))]
)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    model, rare, totals = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # VOCABULARY words, HASHED * 2^MAX_BITS slots at most
    state = {"n": 0}

    def rows(part: dict[str, list]) -> dict[str, list]:
        keep_memory()
        m = shared.value
        first = (TaskContext.get().partitionId() << 36) + state["n"]
        state["n"] += len(part["text"])
        texts = [stream(t) for t in part["text"]]
        told = score_texts(texts, m)
        return {
            "row": list(range(first, first + len(texts))), "doc_id": part["doc_id"], "held_out": part["held"],
            "n_tokens": [t.tokens for t in told], "n_known": [t.known - (not m.end_known) for t in told], "n_bytes": [len(x.translate(None, SPACES.encode())) + max(t.tokens - 1, 1) for x, t in zip(texts, told)],
            "score": [round(t.score, 6) for t in told], "logs": [t.logs for t in told], "words": [list(t.others) for t in told], "counts": [list(t.others.values()) for t in told],
        }

    narrow = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held"), F.col("text").cast("string").cast("binary").alias("text"))
    scored = staged(map_batches(narrow, rows, _ROW, 4096), "scored")
    below = F.lit(float(np.log10(totals["tokens"] + totals["kinds"] + 1)))
    pairs = scored.select("row", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    more = pairs.join(rare, "word").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"), F.sum("n").alias("found"))
    out = scored.drop("words", "counts").join(more, "row", "left")
    base = F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * below
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"), F.lit(totals["tokens"]).cast("long").alias("train_tokens"), base.alias("base_score"), "score", (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte")
    )
