import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomspan.llm import fuse
from loomspan.llm.exact_dedup import add_snapshot, dedup_filter, dedup_report
from loomspan.llm.mixing import mix, mix_report, targets
from loomspan.llm.quality import QualityRules, quality_filter, quality_report, repeated_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


ODD = [(None, None, None), (1, None, "a"), (1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "x", "a"), (4, "x", "a"), (4, "y", "a"), (5, "word " * 30_000, "b")]


#: Names that the operators use inside, as columns of the input.
CLASH = [f"'{k}' as `{k}`" for k in "row id key text_key digest length kept gone cut from all same times copy copies line over words batch chars sha __text __digest __length __id __sum __times __copy the.dot".split()]


def brute_repeats(words, w=5):
    windows = Counter(tuple(words[k : k + w]) for k in range(len(words) - w + 1))
    return len({p for k in range(len(words) - w + 1) if windows[tuple(words[k : k + w])] > 1 for p in range(k, k + w)})


@pytest.mark.parametrize("seed", range(30))
def test_repeated_words(seed):
    rng = random.Random(seed)
    words = [rng.choice([b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]) for _ in range(rng.randint(0, 60))]
    assert repeated_words(words, 5) == brute_repeats(words)


def test_quality_on_odd_rows(spark):
    rows = quality_report(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    by = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert by[None, 0]["base_failed"] and not by[None, 0]["kept"]
    assert by[5, 30_000]["n_repeat_words"] == 30_000
    assert quality_filter(frame(spark, ODD)).count() == 0
    assert quality_report(frame(spark, [])).count() == 0


def test_lines_of_many_documents_go_and_depleted_documents_with_them(spark):
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    common = text(30)
    rows = [(k, f"{common}\n{text(60)}", "h") for k in range(20)]  # keep enough of their own
    rows += [(k, f"{common}\n{text(5)}", "h") for k in range(20, 30)]  # little but the common line
    rows += [(k, rows[0][1], "h") for k in range(30, 60)]  # copies count once
    rows += [(k, f"{common}\n{text(5)}", "other") for k in range(60, 65)]  # not common on this host
    df = frame(spark, rows).selectExpr("*", *CLASH)
    report = {r["doc_id"]: r for r in quality_report(df).collect()}
    assert [k for k in report if not report[k]["kept"]] == list(range(20, 30))
    assert all(report[k]["removed_words"] == 30 for k in (0, 1, 25, 35)) and report[60]["removed_words"] == 0
    kept = quality_filter(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 10
    assert quality_report(df, QualityRules(max_docs=100)).where("not kept").count() == 0


def test_kept_texts_lose_their_lines_over_the_limit(spark):
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(12))
    rows = [(k, f"Top {k}\n\n  Shared  LINE of all\n{own(k)}\nshared line\tof all\n", "h") for k in range(12)]
    rows += [(20, rows[0][1], "h"), (21, f"shared line of all\n{own(21)}", "other"), (22, f"shared line of all\n{own(22)}", None)]
    df = frame(spark, rows).selectExpr("*", *CLASH)
    got = {r["doc_id"]: r for r in quality_filter(df).collect()}
    assert len(got) == len(rows)
    for k, text, _ in rows:
        want = f"Top {0 if k == 20 else k}\n\n{own(0 if k == 20 else k)}\n" if k <= 20 else text
        assert got[k]["text"] == want and got[k]["n_chars"] == len(want), k
    assert quality_report(quality_filter(df)).agg({"removed_words": "sum"}).first()[0] == 0


def test_fuse_filter():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 2**63, n)
        f = fuse.build(np.concatenate([keys, keys[: n // 2]]))
        assert fuse.contains(f, keys).all()
        assert fuse.contains(f, rng.integers(0, 2**63, 20_000)).mean() < (0.01 if n else 1e-9)


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i))
    return groups


def test_dedup(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a b", "ab", " a b ", "c", "", None, f"t{k}"]), "s") for k in range(200)] + ODD[3:]
    report = dedup_report(frame(spark, rows)).collect()
    groups = brute_dedup(rows)
    assert len(report) == len(rows)
    sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for r in report:
        g = sha[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (min(g)[2], len(g))
    assert sum(r["kept"] for r in report) == len(groups)
    df = frame(spark, rows).selectExpr("*", *CLASH)
    assert dedup_filter(df).columns == df.columns and dedup_filter(df).count() == len(groups)
    odd = dedup_report(frame(spark, ODD)).collect()
    assert len(odd) == len(ODD) and sum(r["kept"] for r in odd) == len(brute_dedup(ODD))
    assert dedup_report(frame(spark, [])).count() == 0


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    first = add_snapshot(frame(spark, [(1, "a b", "s"), (2, "c", "s"), (3, "ab", "s")]), path, 1)
    second = add_snapshot(frame(spark, [(4, "c ", "s"), (5, "d", "s")]), path, 2, [f"{path}/v1"])
    assert (first.count(), second.count()) == (2, 1)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = dict(zip(names, [3, 1, 2] * len(names)))
    total, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        out = {s: 2 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if out[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 100, 1000, 10_000]) for s in ["b", "a", "é", "Z", None, "c"]}
    got = {r["source"]: r["target"] for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    for s, t in brute_targets(sizes).items():
        assert math.isclose(got[s], t, rel_tol=1e-9, abs_tol=1e-6)


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(k, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 40))), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(600)]
    rows += [(7, rows[7][1], rows[7][2])] * 3
    df = frame(spark, rows)
    report = mix_report(df).collect()
    again = mix_report(df.repartition(7)).collect()
    assert sorted(map(str, report)) == sorted(map(str, again))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    goal = brute_targets(dict(sizes))
    taken = Counter()
    for r in report:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and math.isclose(r["target"], goal[r["source"]], rel_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 20
    clash = df.selectExpr("*", *CLASH)
    mixed = mix(clash)
    assert mixed.columns == clash.columns
    assert Counter(r["source"] for r in mixed.collect() for _ in (r["text"] or "").split()) == +taken
    assert len(mix_report(frame(spark, ODD)).collect()) == len(ODD)
    assert mix_report(frame(spark, [])).count() == 0 and mix(frame(spark, [])).count() == 0
