import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import components as cc
from loomspan.llm import ngram_join as nj
from loomspan.llm import packing as pk
from loomspan.llm.common import staged

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def brute_join(rows, size=4, percent=85):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    root[find(a)] = find(b)
    least = defaultdict(lambda: (True, 0))
    for k, (i, _) in enumerate(rows):
        own = (i is None, i)
        least[find(k)] = min(least.get(find(k), own), own, key=lambda x: (x[0], x[1] or 0))
    return sorted((str(i), len(sets[k]), str(least[find(k)][1])) for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("crowd", "tile"), [(64, 1500), (8, 25)])
def test_join_finds_all_links(spark, monkeypatch, crowd, tile):
    monkeypatch.setattr(nj, "CROWD", crowd)
    monkeypatch.setattr(nj, "DENSE", 1)
    rng = random.Random(crowd)
    word = lambda: rng.choice("the of and in to a".split()) if rng.random() < 0.4 else f"w{rng.randrange(4000)}"
    texts = []
    for n in (1, 3, 5, 12, 40, 90, 150):
        texts += family(rng, [word() for _ in range(n)], 40, max(1, n // 25))
    passage = " ".join(word() for _ in range(60))
    texts += [f"{passage} {' '.join(word() for _ in range(rng.randint(5, 200)))}" for _ in range(60)]
    texts += [" ".join(word() for _ in range(80)) for _ in range(60)] + ["", None, " ", "A b", "a B", "solo"]
    rng.shuffle(texts)
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(None, texts[0]), (9, texts[3]), (9, texts[3])]
    df = frame(spark, rows).selectExpr("*", "1L as cls", "2 as token")
    assert got(nj.near_duplicates(df, tile=tile)) == brute_join(rows)
    if crowd == 64:
        kept = nj.near_filter(df)
        n = len({c for _, size, c in brute_join(rows) if size}) + sum(1 for _, size, _ in brute_join(rows) if not size)
        assert kept.columns == df.columns and kept.count() == n
        assert got(nj.near_duplicates(df, 5, 80)) == brute_join(rows, 5, 80)


def test_join_of_nothing(spark):
    assert nj.near_duplicates(frame(spark, [])).count() == 0
    assert got(nj.near_duplicates(frame(spark, [(1, None), (2, ""), (3, "x")]))) == [("1", 0, "1"), ("2", 0, "2"), ("3", 1, "3")]


def shuffled(spark):
    """Bytes that this session has written to shuffles."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))


def test_filter_shuffles_texts_once(spark):
    rng = random.Random(17)
    text = lambda: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=60)) for _ in range(100))
    texts = [text() for _ in range(600)]
    near = [t.rsplit(" ", 1)[0] + " end" for t in texts[:5]]
    rows = list(enumerate(texts)) + [(1000 + k, t) for k, t in enumerate(near)] + [(7, texts[7]), (7, texts[7]), (2000, texts[8]), (None, texts[9]), (None, None), (None, None), (3000, ""), (7, text())]
    df = frame(spark, rows).selectExpr("*", "true as text_key", "2L as no_id")
    before = shuffled(spark)
    kept = nj.near_filter(df, 5, 80).collect()
    moved = shuffled(spark) - before
    want = [*enumerate(texts), (None, None), (3000, ""), rows[-1]]
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == sorted((str(k), str(t)) for k, t in want)
    assert all(r["text_key"] is True and r["no_id"] == 2 for r in kept)
    assert moved < 1.5 * sum(len(t or "") for _, t in rows), moved


def test_staged_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}

    before = files()
    assert len(staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "freed").collect()) == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    for _ in range(50):  # they go in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**63, rng.integers(0, 200)).astype(np.uint64)]))
        if not len(b):
            continue
        x, y = nj.sketch(a), nj.sketch(b)
        bits = 8 * min(len(x), len(y))
        d = (nj._folded(int.from_bytes(x, "little"), 8 * len(x), bits) ^ nj._folded(int.from_bytes(y, "little"), 8 * len(y), bits)).bit_count()
        assert d <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("task_edges", [5, 10**6])
def test_components(spark, task_edges):
    rng = random.Random(7)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = cc.components(spark.createDataFrame(links, "a long, b long"), task_edges).collect()
    assert {(r["node"], r["root"]) for r in found} == {(x, find(x)) for x in list(root) if find(x) != x}


# Packing ----------------------------------------------------------------------------


def whole_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(pk.VOCABULARY))
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for x in texts]


TEXTS = ["Hello, World! it's 12 o'clock", "naïve café ÀÉÎ ß Straße", "ΑΣ σας ΟΔΟΣ", "漢字かな 한국어", "é é Å", "<|endoftext|> x<|endoftext|>y <|start", "a b c", "", None, "İstanbul ǅ ﬁ", "🙂🙃 x²", "don't I'LL we'Ve", "x" * 5000, "\x00\x1c a"]


def test_fast_tokenizer_equals_the_whole_one():
    assert [pk.document_ids(t) for t in TEXTS] == whole_ids(TEXTS)


def first_fit(demand, capacity):
    """Bins of first-fit decreasing."""
    room = []
    for s in sorted((s for s, k in demand.items() for _ in range(k)), reverse=True):
        at = next((k for k, r in enumerate(room) if r >= s), None)
        if at is None:
            room.append(capacity - s)
        else:
            room[at] -= s
    return len(room)


def test_knapsack_and_cover():
    value, counts = pk.best_pattern(np.array([0.2, 0.5, 0.6]), np.array([2, 4, 5]), 9)
    assert abs(value - 1.1) < 1e-9 and counts.tolist() == [0, 1, 1]
    rng = random.Random(3)
    for _ in range(5):
        demand = {s: rng.randint(0, 300) for s in rng.sample(range(1, 129), 40)}
        rows, n = pk.slots(demand, 128)
        used = defaultdict(int)
        for s, low, high, copies, first in rows:
            assert (high - low) % copies == 0
            for k in range((high - low) // copies):
                used[first + k] += s * copies
        assert len(used) == n and max(used.values(), default=0) <= 128
        given = {s: sum(h - lo for x, lo, h, _, _ in rows if x == s) for s in demand}
        assert all(given[s] <= demand[s] for s in demand)
        assert n + sum((demand[s] - given[s]) * s for s in demand) / 128 <= 1.01 * first_fit(demand, 128) + 1
    assert pk.slots({}, 128) == ([], 0)
    assert pk.cut_points(2048 + 7, 2048) == [0, 2048, 2052, 2054, 2055] and pk.cut_points(0, 2048) == [0]


def test_packing_round_trip(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "On", "mats,"]) for _ in range(rng.choice([3, 40, 400, 1500, 5000]))) for _ in range(120)] + TEXTS
    rows = [(k, t) for k, t in enumerate(texts)]
    docs = frame(spark, rows).selectExpr("*", "'x' as key", "1 as row")
    pieces = pk.pack(docs).collect()
    ids = dict(zip(range(len(texts)), whole_ids(texts)))
    parts, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p["doc_id"]].append((p["start"], p["length"]))
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) // 4
        assert p["ids_crc32"] == zlib.crc32(own[4 * p["start"] : 4 * (p["start"] + p["length"])])
    for k, own in ids.items():
        at = 0
        for start, n in sorted(parts[k]):
            assert start == at
            at += n
        assert at == len(own) // 4
    padding = 0
    for own in seqs.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert padding < 0.03 * 2048 * len(seqs)
    packed = {r["sequence_id"]: r["ids"] for r in pk.sequences(docs, pk.pack(docs)).collect()}
    assert sum(map(len, packed.values())) == sum(len(x) // 4 for x in ids.values())
    assert pk.pack(frame(spark, [])).count() == 0
    odd = pk.pack(frame(spark, [(None, None), (1, "a"), (1, "a")])).collect()
    assert len(odd) >= 3 and sum(p["length"] for p in odd) == 1 + 2 + 2
