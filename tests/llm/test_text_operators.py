import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from loomspan.llm import extraction as ex
from loomspan.llm import language as la
from loomspan.llm import privacy as pv
from loomspan.llm import scoring as sc
from loomspan.llm.sharding import Conflict, Shard, ShardStore, shard_report

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


# Extraction -----------------------------------------------------------------------


def test_marginals_are_exact_on_small_trees():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n = int(rng.integers(1, 8))
        parents = [-1, *(int(rng.integers(0, k)) for k in range(1, n))]
        features, edges = [[int(rng.integers(0, 3))] for _ in range(n)], [int(rng.integers(0, 3)) for _ in range(n)]
        model = ex.Model(rng.normal(size=len(ex.FEATURES)), rng.normal(size=(3, 2, 2)))
        total, one = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            s = sum(model.unary[features[k]].sum() * y[k] for k in range(n)) + sum(model.pair[edges[k], y[parents[k]], y[k]] for k in range(1, n))
            total += math.exp(s)
            one += math.exp(s) * np.array(y)
        belief, _ = ex.marginals(model, features, edges, parents)
        assert np.allclose(belief, one / total)


def test_held_out_layouts():
    model = ex.default_model()
    hits = chars = want = 0
    for page, wanted in ex.layout_pages(120, seed=77):
        nodes = ex.parse(page)
        expected = " ".join(t for _, t in sorted(t for n in nodes for t in n.texts if t[1] in wanted))
        got = ex.main_text(page, model)
        a, b = Counter(got.split()), Counter(expected.split())
        hits, chars, want = hits + (a & b).total(), chars + a.total(), want + b.total()
    assert hits / chars > 0.9 and hits / want > 0.85


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>The  title &amp; more</h1><p><b>First<i>ly</i>
 paragraph, of some length.<br>After a break &lt;b&gt; &#233;<p>Second one, which is also long enough.</p><!-- <p>no</p> --></article><section class="comments"><p>Nice post, thanks.</p></section><footer>&copy; me</footer></body></html>"""


def test_extraction(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (None, None, None), (2, "v", ""), (2, "v", "<p"), (3, "w", "<div>" * 3000 + "deep")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    rows = {r["page_id"]: r for r in ex.extract(pages).where("page_id is null or page_id in (1, 3)").collect()}
    assert rows[1]["text"] == "The title & more Firstly paragraph, of some length. After a break <b> é Second one, which is also long enough."
    assert rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[None]["text"] == "" and rows[None]["n_chars"] == 0
    assert ex.extract(pages).count() == 5 and ex.extract(pages.limit(0)).count() == 0


def test_no_text_is_cut_before_the_model():
    model = ex.default_model()
    one, two = "A first paragraph, which is long enough to count.", "A second paragraph, which is also long enough."
    for tag in ("video", "object", "svg", "math", "canvas", "audio", "select", "noscript", "textarea", "script"):
        page = f"<html><body><article><h1>Title</h1><p>{one}</p><{tag} id=x><p>{two}</p></article></body></html>"
        assert ex.main_text(page, model) == f"Title {one} {two}", tag
    inner = "<object data=a><object data=b>inner</object> outer</object> and <math><mi>x</mi><mo>+</mo><mn>1</mn></math>"
    assert ex.main_text(f"<article><h1>Title</h1><p>{one} {inner}</p><script>var x;</script><p>{two}</p></article>", model) == f"Title {one} inner outer and x+1 {two}"
    for unit in ("<script>", "<a ", '<a "', "<!", "<head>", "<p", "<div></span>", "<b></a>", "<li></li>", "<td>", "<svg>"):  # linear work
        ex.parse(unit * (300_000 // len(unit)) + "end")
    for name in ("byline", "author", "date", "rating"):
        assert ex.main_text(f'<nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Title</h1><div class="{name}">By Some One, May 2020</div><p>{one}</p><p>{two}</p></article>', model) == f"Title By Some One, May 2020 {one} {two}", name
    tags = '<ul class="tags"><li><a href=x>green tea</a></li><li><a href=y>pots</a></li></ul>'
    assert ex.main_text(f"<article><h1>Title</h1><p>{one}</p><p>{two}</p>{tags}</article>", model).endswith(f"{two} green tea pots")


def test_pages_whose_names_tell_nothing():
    model = ex.default_model()
    one, two = "A first paragraph, which is long enough to count.", "A second paragraph, which is also long enough."
    for page, text in (
        (f"<div><p>{one}</p><p>{two}</p></div>", f"{one} {two}"), ("<article><p>Hi.</p></article>", "Hi."), ("plain text only", "plain text only"),
        (f'<html><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>Away</a></li></ul></nav><div class="zone2"><p>{one} {two}</p></div></body></html>', f"{one} {two}"),
        (f'<p title="it is>{one}</p>', one), ('<p>a < b and c > d "quoted" it\'s</p>', 'a < b and c > d "quoted" it\'s'), (f"<p>{one}</p><p unfinished", one), (f"<p a='>' b=\">\">{one}</p>", one),
    ):
        assert ex.main_text(page, model) == text, page
    hits = chars = want = 0
    for page, wanted in ex.layout_pages(120, seed=91, known=0.0):
        expected = " ".join(t for _, t in sorted(t for n in ex.parse(page) for t in n.texts if t[1] in wanted))
        a, b = Counter(ex.main_text(page, model).split()), Counter(expected.split())
        hits, chars, want = hits + (a & b).total(), chars + a.total(), want + b.total()
    assert hits / chars > 0.95 and hits / want > 0.85


# Scoring ----------------------------------------------------------------------------


def small_model(rng, texts, bits=8):
    """A model with counted tables and random weights."""
    count = Counter(w for t in texts for w in t.split())
    words = [w for w, n in count.most_common() if n > 1]
    rare = Counter(b for w, n in count.items() if n == 1 for b in w)
    code = sc.Code(words, np.array([count[w] for w in words], float), float(sum(n == 1 for n in count.values())), float(len(texts)), np.array([rare.get(b, 0) for b in range(256)] + [len(rare)], float))
    whole = sc.spell(texts, code)
    tables = []
    for h in whole.hashes:
        zeros_ones = np.zeros(2 << bits, np.int64)
        for slot, bit in zip((h >> np.uint32(32 - bits)).tolist(), whole.bit.tolist()):
            zeros_ones[2 * slot + bit] += 1
        tables.append(sc.packed_counts(zeros_ones))
    return sc.Model(code, tables, rng.uniform(0.1, 0.5, (1 + sc.HASHED, sc.GATES)).astype(np.float32), rng.uniform(0.1, 0.9, 2 * sc.CELLS), np.zeros(len(words) + 2)), whole


def random_texts(rng, n, low=0, high=120):
    words = [b"the", b"of", b"tea", b"pot", b"green", b"cup", b"brew"]
    return [b" ".join(rng.choice(words) if rng.random() < 0.9 else bytes(rng.choices(range(97, 123), k=rng.randint(1, 9))) for _ in range(rng.randint(low, high))) for _ in range(n)]


def test_code_is_a_prefix_code():
    counts = np.random.default_rng(1).integers(0, 1000, 300).astype(float)
    lengths, starts, nodes, bits, split = sc.prefix_code(counts)
    assert abs(sum(2.0 ** -int(n) for n in lengths) - 1) < 1e-9
    assert len({tuple(bits[s : s + n]) for s, n in zip(starts, lengths)}) == 300
    for k in (0, 17, 299):
        at = starts[k]
        assert split[nodes[at]].sum() > counts.sum() - 1 and split[nodes[at + lengths[k] - 1], bits[at + lengths[k] - 1]] == counts[k] + 0.01


def test_probabilities_sum_to_one():
    rng = random.Random(3)
    model, _ = small_model(np.random.default_rng(3), random_texts(rng, 40))
    # All that may come first: a word with a path, the end, or an escape.
    code, total = model.code, 0.0
    for unit in range(code.bytes_from):
        text = code.words[unit] if unit < len(code.words) else b"" if unit == code.end else b"zzzzzz"
        b, n = sc.spell([text], code), int(code.lengths[unit])
        assert n <= sc.FIRST_STEP and list(b.node[:n]) == list(code.nodes[code.starts[unit] :][:n])
        total += 10 ** sc.log_probabilities(sc.Bits(b.bit[:n], b.node[:n], [h[:n] for h in b.hashes], np.array([n])), model, sc.State.fresh(1))[0]
    assert abs(total - 1) < 1e-4


def test_mixing_against_brute_force():
    rng = random.Random(4)
    model, _ = small_model(np.random.default_rng(4), random_texts(rng, 60))
    texts = random_texts(rng, 12, 1, 200) + [b""]
    got = [t.score for t in sc.score_texts(texts, model)]
    for text, found in zip(texts, got):
        assert sc.score_texts([text], model)[0].score == pytest.approx(found, abs=1e-5)  # the same beside any other
        b = sc.spell([text], model.code)
        x, gate = model.inputs(b)
        change, shift, total, at, read = np.zeros(1 + sc.HASHED), np.zeros(2 * sc.CELLS), 0.0, 0, []
        limit = 0
        for k in range(len(b.bit)):
            if k == limit:
                rate = sc.RATE / (1 + at / sc.SLOWER)
                for cell, y, p, refined, xs in read:
                    change += rate * (y - p) * xs
                    shift[cell] -= rate * sc.REFINE * (refined - y)
                at, read = limit, []
                limit = min(len(b.bit), limit + max(sc.FIRST_STEP, limit // sc.SHARE_STEP))
            xs, y, node = np.array([v[k] for v in x], float), int(b.bit[k]), b.node[k]
            mixed = min(8, max(-8, float(((model.weights[:, gate[k]] + change) * xs).sum())))
            level = int(mixed * 64 + 512.5)
            p = 1 / (1 + math.exp(-(level - 512) / 64))
            cell = int(model.kind[node]) + level // 32
            refined = min(0.9995, max(0.0005, model.refined[cell] + shift[cell]))
            final = 0.5 * (p + refined)
            total += math.log10(final if y else 1 - final)
            read.append((cell, y, p, refined, xs))
        assert found == pytest.approx(total, abs=2e-3, rel=1e-4)


def test_words_are_found_by_hash():
    rng = random.Random(9)
    texts = [b"".join(rng.choice([b"a", b"B", b"\xc3\xa9", b" ", b"\t", b"\n", b"\x0b\x0c\r", b"\xc2\xa0", b"\x1c"]) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [b"", b" ", b"a"]
    words = sc.Words.of(texts)
    each = [bytes(words.flat[a:b]) for a, b in zip(words.starts, words.ends)]
    assert each == [w for t in texts for w in t.split()] and words.sizes.tolist() == [len(t.split()) for t in texts]
    known = sorted(set(each))[::2]
    ids = sc._Ids(known)
    assert ids.find(words.hashes).tolist() == [known.index(w) if w in known else len(known) for w in each]
    assert len(set(words.hashes.tolist())) == len(set(each)) and sc._Ids([]).find(words.hashes).max() == 0


def test_slots_of_a_word_lie_together():
    rng = random.Random(11)
    words = sorted({bytes(rng.choices(range(97, 123), k=rng.randint(2, 9))) for _ in range(4000)})
    counts, rare = np.sort(np.random.default_rng(11).pareto(1, len(words)) + 1)[::-1], np.arange(1.0, 258)
    texts = [b" ".join(rng.choice(words[:300] if rng.random() < 0.7 else words) for _ in range(60)) + b" xqzj" for _ in range(300)]
    for bits in (12, 16, 22):
        code = sc.Code(words, counts, 50.0, 20.0, rare, bits)
        b, units = sc.spell(texts, code), sc.spell([b" ".join(words)], code)
        to = np.cumsum(code.lengths[: len(words)])
        for h in units.hashes:  # some levels of a path are neighbours, in any table
            for end, n in zip(to.tolist(), code.lengths.tolist()):
                slots = (h[end - n : end] >> np.uint32(32 - bits)).astype(np.int64)
                for k in range(0, n, 4):
                    assert ((slots[k : k + 4] - slots[k]) % (1 << bits)).max() <= 14 and len(set(slots[k : k + 4].tolist())) == len(slots[k : k + 4])
        used = sc.spell([w + b" " + v for w, v in zip(rng.sample(words, 900), rng.sample(words, 900))], code)
        n = len(set(zip(used.hashes[1].tolist(), used.node.tolist())))  # what differs is dealt to slots as evenly as by chance
        even = (1 - math.exp(-n / (1 << bits))) * (1 << bits)
        assert len(set((used.hashes[1] >> np.uint32(32 - bits)).tolist())) > 0.95 * even
        for pos in (0, 1000):  # in runs: the same bits, arranged
            runs = sc.spell(texts, code, pos=pos)
            order = runs.runs.order
            assert sorted(order.tolist()) == list(range(len(b.bit))) and np.array_equal(runs.ends, b.ends)
            assert np.array_equal(runs.bit, b.bit[order]) and np.array_equal(runs.node, b.node[order]) and all(np.array_equal(x, y[order]) for x, y in zip(runs.hashes, b.hashes))


def test_repeated_pairs_are_counted_once(monkeypatch):
    rng = random.Random(12)
    model, _ = small_model(np.random.default_rng(12), random_texts(rng, 40))
    texts = random_texts(rng, 150, 0, 90) + [b"", b"tea " * 500, b"Xqzj of " * 300]
    monkeypatch.setattr(sc, "LONG_TEXT", 1200)
    monkeypatch.setattr(sc, "SEGMENT", 700)
    batches = lambda some: iter([pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["text"])])
    whole = list(sc.spelled(batches(texts), model.code))
    gone, expand = [], sc.expand
    monkeypatch.setattr(sc, "expand", lambda code, place, n_bits, context: gone.append(int(n_bits.sum())) or expand(code, place, n_bits, context))
    for held, at_once in ((1_000_000, 50_000), (500, 7), (1, 3)):
        monkeypatch.setattr(sc, "HELD", held)
        monkeypatch.setattr(sc, "PAIRS", at_once)
        gone.clear()
        got = sc.count_slots(batches(texts), model.code, 10)
        for k in range(sc.HASHED):
            want = Counter(x for b in whole for x in zip((b.hashes[k] >> np.uint32(22)).tolist(), b.bit.tolist()))
            assert {divmod(x, 2): n for x, n in enumerate(got[k].tolist()) if n} == want
        if held == 1_000_000:
            assert sum(gone) < 0.5 * sc.HASHED * sum(len(b.bit) for b in whole)
    assert sc.count_slots(iter([]), model.code, 10) is None and sc.count_slots(batches([b""]), model.code, 10).any()


def test_long_texts_are_read_in_segments(monkeypatch):
    rng = random.Random(5)
    model, _ = small_model(np.random.default_rng(5), random_texts(rng, 40))
    text = b" \n".join(random_texts(rng, 30, 20, 60))
    whole = sc.spell([text], model.code)
    monkeypatch.setattr(sc, "LONG_TEXT", 100)
    monkeypatch.setattr(sc, "SEGMENT", 37)
    parts, before = [], b""
    for part, last in sc.segments(text):
        parts.append(sc.spell([part], model.code, before, last))
        before = sc.ahead(before, part)
    assert len(parts) > 100
    assert np.array_equal(np.concatenate([p.bit for p in parts]), whole.bit)
    assert all(np.array_equal(np.concatenate([p.hashes[k] for p in parts]), whole.hashes[k]) for k in range(sc.HASHED))
    cut = sc.score_texts([text], model)[0]
    monkeypatch.undo()
    one = sc.score_texts([text], model)[0]
    assert (cut.tokens, cut.known, cut.others) == (one.tokens, one.known, one.others) and cut.score == pytest.approx(one.score, rel=0.02)


def test_scores_and_base(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["red", "blue", "green", "Tea", "for", "two"]) for _ in range(rng.randint(1, 60)))) for k in range(150)]
    new = next(k for k in range(200, 300) if zlib.crc32(str(k).encode()) % 7 == 2)
    rows += [(None, "red tea"), (300, None), (301, ""), (new, "xqzj kkvw"), (3, rows[3][1]), (302, "once red " * 3), (303, "only Twice only")]
    got = sc.score(frame(spark, rows).withColumn("score", F.lit(1))).collect()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = Counter()
    for i, t in rows:
        if not held[i]:
            count.update([*(t or "").lower().split(), None])
    n, v = count.total(), len(count)
    want = sorted(round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*(t or "").lower().split(), None]), 6) for _, t in rows)
    assert sorted(round(r["base_score"], 6) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert all(r["train_tokens"] == n and r["held_out"] == held[r["doc_id"]] for r in got)
    known = {i: sum(w in count for w in [*(t or "").lower().split(), None]) for i, t in rows}
    assert {r["doc_id"]: r["n_known"] for r in got} == known and by[new]["n_known"] == 1 and by[new]["n_tokens"] == 3
    assert by[new]["bits_per_byte"] > 2 * by[5]["bits_per_byte"]
    assert sc.score(frame(spark, [])).count() == 0


def test_scores_do_not_depend_on_partitions(spark):
    rng = random.Random(7)
    texts = [t.decode() for t in random_texts(rng, 200, 1, 80)]
    one = sc.score(frame(spark, list(enumerate(texts))).repartition(1)).select("doc_id", "score", "base_score", "n_known")
    many = sc.score(frame(spark, list(enumerate(texts))).repartition(6)).select("doc_id", "score", "base_score", "n_known")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_mixing_beats_word_counts_on_held_out_text(spark):
    rng = random.Random(8)
    pick = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(k, pick([f"{'ab'[k % 2]}{x}{y}" for x in "cdfgh" for y in "aeiou"])) for k in range(400)]
    got = [r for r in sc.score(frame(spark, rows)).collect() if r["held_out"]]
    assert len(got) > 20 and sum(r["score"] for r in got) > 0.9 * sum(r["base_score"] for r in got)


def test_weights_are_learned_from_every_training_bit(spark):
    rng = random.Random(10)
    texts = [t.decode() for t in random_texts(rng, 1800, 0, 4)]
    texts += [" ".join(rng.choice(["oolong", "kettle", "Leaf"]) + str(rng.randint(0, 9)) for _ in range(n)) for n in (12_000, 60_000)]  # over 64 kB, and one read in segments
    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 != 2][: len(texts)]
    other = next(k for k in range(3000, 4000) if zlib.crc32(str(k).encode()) % 7 == 2)
    docs = frame(spark, [*zip(ids, texts), (other, "never learned")]).repartition(5)
    model, _, _ = sc.train(docs)
    assert np.abs(sc.train(docs.where(F.length("text") > 1 << 16))[0].weights - 0.3).max() > 0.05  # long texts alone teach, too
    learn = docs.where(F.col("doc_id") != other).select(F.col("text").cast("binary").alias("text"))
    classes, zeros_ones = sc.count_classes(learn, model)
    whole = sc.spell([sc.stream(t.encode()) for t in texts], model.code)
    assert zeros_ones.sum(axis=0).tolist() == [(whole.bit == 0).sum(), (whole.bit == 1).sum()]
    again = sc.Model(model.code, model.tables, model.weights * 0, model.refined * 0, model.log_count)
    sc.fit(again, classes, zeros_ones)
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.refined, model.refined)


def test_classes_and_weights_against_brute_force():
    rng = random.Random(11)
    texts = random_texts(rng, 50, 0, 60)
    model, whole = small_model(np.random.default_rng(11), texts)
    want = Counter()
    nearest = lambda zeros, ones: min(range(sc.LEVELS), key=lambda k: abs(math.log((max(ones, 0) + sc.PRIOR) / (max(zeros, 0) + sc.PRIOR)) - sc._LEVEL[k]))
    for k in range(len(whole.bit)):
        node, y = int(whole.node[k]), int(whole.bit[k])
        zeros, ones = model.code.zeros_ones[node]
        levels = [nearest(zeros - 1 + y, ones - y)]
        gate = int(model.code.spelled[node]) << 8 | int(model.code.depth[node]) << 4
        for t in range(sc.HASHED):
            packed = int(model.tables[t][int(whole.hashes[t][k]) >> (32 - model.bits)])
            n, logit = sc._SEEN[packed >> 8], ((packed & 255) - 128) / sc.SCALE
            ones = min(n, max(0, (n + 2 * sc.PRIOR) / (1 + math.exp(-logit)) - sc.PRIOR))
            levels.append(nearest(n - ones - 1 + y, ones - y))
            rest = max(packed >> 8, 1) - 1
            gate |= sum(rest >= int(np.searchsorted(sc._SEEN, least)) for least in (1, 4, 30)) << 2 * t
        where = gate
        for level in levels:
            where = where * sc.LEVELS + level
        want[2 * where + y] += 1
    found = sc.Classes.of(model).find(whole, model.tables, model.bits)
    assert Counter(found.tolist()) == want
    classes = np.array(sorted({c >> 1 for c in want}))
    zeros_ones = np.array([[want[2 * c], want[2 * c + 1]] for c in classes.tolist()], float)
    sc.fit(model, classes, zeros_ones)

    def loss(weights):
        total = sc.HOLD / 2 * float(((weights - sc.FIRST_WEIGHT) ** 2).sum())
        for c, (zeros, ones) in zip(classes.tolist(), zeros_ones):
            x = [sc._LEVEL[c // sc.LEVELS**k % sc.LEVELS] for k in range(sc.HASHED, -1, -1)]
            mixed = float(weights[:, c // sc.LEVELS**3] @ x)
            total += zeros * np.logaddexp(0, mixed) + ones * np.logaddexp(0, -mixed)
        return total

    best = model.weights.astype(float)
    for gate in sorted({c // sc.LEVELS**3 for c in classes.tolist()})[:12]:
        for k in range(1 + sc.HASHED):
            for off in (-0.02, 0.02):
                moved = best.copy()
                moved[k, gate] += off
                assert loss(moved) > loss(best)
    assert (np.delete(best, classes // sc.LEVELS**3, axis=1) == np.float32(sc.FIRST_WEIGHT)).all()


# Sharding ---------------------------------------------------------------------------


def test_shards_round_trip(spark, tmp_path):
    rows = [(k, f"text {k} " * (k % 50)) for k in range(400)] + [(None, None), (1, "again"), (1, "again"), (2, "")]
    df = frame(spark, rows).selectExpr("*", "7 as __run", "8 as run", "9 as row", "'n' as name", "1 as `a.b`")
    store = ShardStore(spark, str(tmp_path / "s"), target=20_000, fan_in=3)
    for k in range(4):
        store.append(df.repartition(5).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(4)) == k))
        store.compact()
    before = len(store.manifest())
    store.compact(all_tiers=True)
    assert len(store.manifest()) < before
    assert store.read().columns == df.columns
    assert sorted(map(str, store.read().collect())) == sorted(map(str, df.collect()))
    assert store.read(1).count() < store.read().count()  # old versions can be read until they are vacuumed
    assert store.vacuum() == 0 and store.read(1).count() > 0  # young files stay
    assert store.vacuum(0, 1) > 0 and store.read().count() == len(rows) and len(store.versions()) == 1
    report = shard_report(frame(spark, rows), str(tmp_path / "r"), target=20_000)
    assert report.count() == len(rows)
    assert store.append(df.limit(0)) and store.read().count() == len(rows)


def test_commit_conflicts(spark, tmp_path):
    store = ShardStore(spark, str(tmp_path / "s"))
    assert store.commit([Shard("a", 1)], 0) == 1
    with pytest.raises(Conflict):
        store.commit([Shard("b", 1)], 0)
    assert store.manifest() == [Shard("a", 1)] and store.versions() == [1]


def test_append_beside_another_writer(spark, tmp_path):
    store, other = (ShardStore(spark, str(tmp_path / "s")) for _ in range(2))
    store.append(frame(spark, [(1, "a")]))
    commit, first = store.commit, []

    def late(shards, after):
        if not first:  # the other one commits in between, and deletes what nobody names
            first.append(other.append(frame(spark, [(2, "b")])))
            other.vacuum(keep=1)
        return commit(shards, after)

    store.commit = late
    assert store.append(frame(spark, [(3, "c")])) == 3
    assert sorted(r["doc_id"] for r in store.read().collect()) == [1, 2, 3]


# Privacy ----------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def test_base_spans(spark):
    rng = random.Random(8)
    bits = ["a@b.cd", "a@b", "x.y+z@q-r.s.t", "@", ".", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111", "5500005555555559", "+1 (555) 010-9999", "+", "12", " ", "-", "_", "é", "🙂", "\n", "٣", "", "b.c_d@e.f@g.h"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [None, "", "9" * 20_000, "a" * 20_000 + "@", "1 " * 10_000, "1." * 10_000, "+1" * 5000, "+1 " + "(" * 20_000]
    got = pv.private_report(frame(spark, list(enumerate(texts))).withColumn("spans", F.lit(1))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), texts[r["doc_id"]][:200]
        assert r["n_email"] == want.count("email:") and r["n_phone"] == want.count("phone:")


def brute_terms(texts, limits):
    """term: share of the terms that disclose an entity, from sets of distinct texts."""
    terms, entities = {}, {}
    for k, t in enumerate(texts):
        plain = re.sub(BASE["email"], lambda m: " " * len(m[0]), t)
        for w in {w.lower() for w in regex.findall(r"\p{L}[\p{L}'’]{2,}+", plain)}:
            terms.setdefault(w, set()).add(k)
        for m in re.finditer(BASE["email"], t):
            entities.setdefault("email:" + m[0].lower(), set()).add(k)
    shares = {}
    for w, has in terms.items():
        for own in entities.values():
            both = len(has & own)
            if both >= limits.texts and both / len(has) >= limits.share:
                bits = math.log2(both * len(texts) / len(has) / len(own))
                if bits > 0 and bits >= limits.information * math.log2(len(texts) / len(own)):
                    shares[w] = max(shares.get(w, 0), both / len(has))
    return shares


def test_terms_against_brute_force(spark):
    rng = random.Random(12)
    mails = [f"m{k}@x.org" for k in range(6)]
    words = ["the", "office", "is", "open", "quib", "nar", "zorb", "latt", "Vexo's", "Ünal", "of"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 6)) + rng.choices(mails, k=rng.choice([0, 0, 0, 1, 2])) + [f"w{'abcdefghij'[k % 10]}{'klmnop'[k % 6]}"]) for k in range(90)]
    rows = list(enumerate(texts)) + [(k + 500, texts[k % 7]) for k in range(40)] + [(900, None), (901, "")]
    for limits in (pv.Disclosure(), pv.Disclosure(2, 0.5, 0.3), pv.Disclosure(texts=3)):
        distinct = sorted({t or "" for _, t in rows})
        shares = brute_terms(distinct, limits)
        got = pv.private_report(frame(spark, rows), limits).collect()
        assert len(got) == len(rows)
        for r in got:
            t = dict(rows)[r["doc_id"]] or ""
            plain = re.sub(BASE["email"], lambda m: " " * len(m[0]), t)
            want = [(m.start(), 5, m.end(), "term") for m in regex.finditer(r"\p{L}[\p{L}'’]{2,}+", plain) if m[0].lower() in shares] + [(m.start(), 0, m.end(), "email") for m in re.finditer(BASE["email"], t)]
            assert r["spans"] == ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(want)), t
    assert brute_terms(distinct, pv.Disclosure())  # there are some


def test_disclosing_terms_and_sanitising(spark):
    rows = [(k, f"note {k} write to Zorblatt at z@example.org or call the office now") for k in range(6)] + [(k, f"the office {k} is open, call now or write to them at noon; note it") for k in range(10, 60)]
    rows += [(60, None), (61, ""), (62, "only q@example.org once by Vexo, key = a81bc81bdeadbeef99aa0021cd")]
    df = frame(spark, rows).selectExpr("*", "1 as key", "2 as spans", "3 as row")
    report = {r["doc_id"]: r for r in pv.private_report(df).collect()}
    t = rows[0][1]
    at = t.index("Zorblatt")
    assert report[0]["spans"] == f"term:{at}:{at + 8},email:{t.index('z@')}:{t.index('z@') + 13}"
    assert report[10]["spans"] == "" and report[10]["n_private"] == 0
    t = rows[-1][1]
    assert f"secret:{t.index('a81')}:{len(t)}" in report[62]["spans"] and report[62]["n_secret"] == 1 and report[62]["n_private"] == 2
    assert f"term:{t.index('Vexo')}:{t.index('Vexo') + 4}" in report[62]["spans"]  # an entity in one text is judged as well
    clean = pv.sanitise(df)
    assert clean.columns == df.columns
    clean = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean[0] == "note 0 write to  at [EMAIL] or call the office now" and clean[10] == rows[6][1] and clean[60] is None
    assert "[SECRET]" in clean[62]
    assert pv.private_report(frame(spark, [])).count() == 0 and pv.sanitise(frame(spark, [])).count() == 0


def test_copies_count_once_in_disclosure(spark):
    rows = [(k, f"number {k}: Quibnar has the address y@example.org here") for k in range(3)] + [(k, f"filler number {k} of the address here has nothing") for k in range(100, 180)]
    rows += [(k, rows[0][1]) for k in range(10, 50)]
    got = {r["doc_id"]: r for r in pv.private_report(frame(spark, rows)).collect()}
    assert {k: r["n_term"] for k, r in got.items()} == {k: int(k < 100) for k, _ in rows}
    assert all(got[k]["spans"] == "term:10:17,email:34:47" for k in range(3))


def test_disclosing_terms_are_found_in_whole_texts(spark):
    far = "words that say nothing at all, " * 5
    rows = [(k, f"number {k}: mail y@example.org {far}ask for Quibnar") for k in range(4)] + [(k, f"number {k}: mail {far}ask for nothing, or one alone") for k in range(100, 180)]
    rows += [(200, "QUIBNAR, İ alone; a@Quibnar.net 🙂 quibnar's Quibnar")]
    df = frame(spark, rows)
    limits = pv.Disclosure(texts=3)
    got = {r["doc_id"]: r for r in pv.private_report(df, limits).collect()}
    assert all(got[k]["n_term"] == 1 for k in range(4))
    t = rows[84][1]
    at, mail = t.rindex("Quibnar"), t.index("a@")
    assert got[200]["spans"] == f"term:0:7,email:{mail}:{mail + 13},term:{at}:{at + 7}"
    assert got[150]["n_term"] == 0
    clean = {r["doc_id"]: r["text"] for r in pv.sanitise(df, limits).collect()}
    assert clean[200] == "[TERM], İ alone; [EMAIL] 🙂 quibnar's [TERM]" and "Quibnar" not in clean[0]


def test_many_matches_in_one_text(spark):
    t = " ".join(f"a{k}@b.cd" for k in range(30_000))
    got = pv.private_report(frame(spark, [(1, t)])).first()
    assert got["n_email"] == 30_000 and got["base_sha256"] == hashlib.sha256(brute_spans(t).encode()).hexdigest()


# Language ---------------------------------------------------------------------------

VOCABULARY = {"en": "the thing with other which that".split(), "de": "der und nicht schön zwischen über".split(), "fr": "le être avec où très même".split()}


def some_pages(rng, n):
    text = lambda lang, k: " ".join(rng.choice(VOCABULARY[lang]) for _ in range(k))
    pages = []
    for k in range(n):
        lang = ["en", "de", "fr"][k % 3]
        pages.append((k, f"http://{lang}{k % 2}.site.{'de' if lang == 'de' else 'com'}/{k}", f'<html lang="{lang}"><script>the the</script><body>{text(lang, 40)}</body></html>'))
    pages += [(100, "http://de0.site.de/x", '<html lang="de"><body>42</body></html>'), (101, None, None), (102, "no address", "<p>der und nicht zwischen</p>"), (103, "http://fr1.site.com/y", '<html lang="en"><body>' + text("fr", 60) + "</body></html>")]
    labelled = [(k, text(lang, 50), lang) for k, lang in enumerate(["en", "de", "fr"] * 20)]
    return pages, labelled


def brute_language(pages, labelled):
    """The posterior of each page by sums over dictionaries."""
    languages, table = la.train([(t, lang) for _, t, lang in labelled])
    rows = []
    for page_id, url, page in pages:
        grams = la.trigrams(la.visible_text(page))
        scores = table[grams].sum(axis=0, dtype=np.float64) * min(1.0, la.TRIGRAMS / max(1, len(grams)))
        p = np.exp(scores - scores.max())
        host = la.host_of(url)
        rows.append((page_id, p / p.sum(), {"declared": la.declared_language(page), "suffix": host.split(".")[-1], "host": host, "domain": ".".join(host.split(".")[-2:])}))
    n, k = len(rows), len(languages)
    prior = (sum(p for _, p, _ in rows) + 1) / (n + k)
    held = {}
    for _, p, own in rows:
        for key in own.items():
            total, count = held.get(key, (np.zeros(k), 0))
            held[key] = total + p, count + 1
    out = {}
    for page_id, p, own in rows:
        score = np.log(p + 1e-12)
        for name in ("declared", "suffix"):
            total, count = held[name, own[name]]
            if own[name]:
                score = score + np.log((total - p + la.SMOOTHING * count / n * prior) / (n * prior) + 1e-6)
        (domain, dn), (host, hn) = held["domain", own["domain"]], held["host", own["host"]]
        wide = (domain - p + la.SMOOTHING * prior) / (dn - 1 + la.SMOOTHING)
        score = score + np.log(np.maximum((host - p + la.SMOOTHING * wide) / (hn - 1 + la.SMOOTHING), 1e-9))
        odds = np.exp(score - score.max())
        out[page_id] = languages[int(score.argmax())], 1 / odds.sum()
    return out


def test_evidence_is_fused(spark):
    pages, labelled = some_pages(random.Random(9), 90)
    known = spark.createDataFrame(labelled, "doc_id long, text string, lang string")
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as declared", "2 as lang")
    got = {r["page_id"]: r for r in la.identify(df, known).collect()}
    want = brute_language(pages, labelled)
    for k, (lang, confidence) in want.items():
        assert got[k]["lang"] == lang and got[k]["confidence"] == pytest.approx(confidence, rel=1e-6), k
    assert all(got[k]["lang"] == ["en", "de", "fr"][k % 3] for k in range(90))
    assert got[100]["lang"] == "de"  # nothing but declaration, suffix and host
    assert got[102]["lang"] == "de" and got[103]["lang"] == "fr" and 101 in got
    twice = la.identify(df.unionByName(df.where("page_id = 0")), known).where("page_id = 0").select("lang", "confidence").collect()
    assert len(twice) == 2 and twice[0] == twice[1]  # repeated rows are judged alike
    assert la.identify(df.limit(0), known).count() == 0
    assert {r["lang"] for r in la.identify(df, known.limit(0)).collect()} == {None}


def test_text_and_declarations_of_odd_pages():
    assert la.visible_text("a<!-- b --><SCRIPT>c</script >d<style>e").split() == ["a", "d", "e"]
    assert la.visible_text("x <!-- y --> z").split() == ["x", "z"] and la.visible_text("x <!-- y").split() == ["x", "<!--", "y"]
    assert la.visible_text("1 < 2 &amp; 3").split() == ["1", "<", "2", "&", "3"] and la.visible_text(None) == ""
    assert la.declared_language("<HTML dir=ltr xml:lang='FR-fr'>") == "fr" and la.declared_language("<html><p lang=de>") == ""
    assert la.declared_language('<meta http-equiv="content-language" content="es">') == "es" and la.declared_language("<html lang=") == ""
    for unit in ("<script ", "<!--", "<html ", "<meta ", "<", "<style>x"):  # linear work
        long = unit * (400_000 // len(unit))
        la.visible_text(long)
        la.declared_language(long)


