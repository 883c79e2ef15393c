import random
from collections import Counter, defaultdict

import corpus_pipeline as cp

from .test_join_packing import brute_join, whole_ids
from .test_rules_dedup_mixing import CLASH, brute_dedup, brute_repeats, brute_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [" ".join(word() for _ in range(rng.randint(12, 90))) for _ in range(60)]
    texts += texts[:10] + [t + " " for t in texts[5:12]]
    for t in texts[20:30]:
        w = t.split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += ["too short", "", None, "again and again and so on " * 8]
    rows = [(k, t, rng.choice(["a", "b", None])) for k, t in enumerate(texts)]
    spark.createDataFrame([(k, t, "en", s, len(t or "")) for k, t, s in rows], DOCS).write.parquet(str(tmp_path / "documents.parquet"))

    kept = [r for r in rows if len((r[1] or "").split()) >= 10 and 100 * brute_repeats((r[1] or "").split()) <= 20 * len(r[1].split())]
    by_id = {r[0]: r for r in kept}
    kept = [by_id[min(g)[2]] for g in brute_dedup(kept).values()]
    least = {int(i): int(c) for i, _, c in brute_join([(k, t) for k, t, _ in kept], 5, 80)}
    kept = [r for r in kept if least[r[0]] == r[0]]

    docs = cp.table(spark, str(tmp_path), "documents")
    columns = docs.columns
    for name, stage in cp.STAGES[:3]:
        docs = cp.staged(stage(spark, docs, str(tmp_path)), "test")
        assert docs.columns == columns, name
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r[0] for r in kept)
    mixed = cp.staged(cp.STAGES[3][1](spark, docs, str(tmp_path)), "test")
    assert mixed.columns == columns
    sizes, taken, copies = Counter(), Counter(), Counter()
    for _, t, s in kept:
        sizes[s] += len(t.split())
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].split())
        copies[r["doc_id"]] += 1
    for s, goal in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - goal) <= 45
    assert max(copies.values()) <= 2

    pieces = cp.run(spark, str(tmp_path)).collect()
    ids = dict(zip([r[0] for r in kept], whole_ids([r[1] for r in kept])))
    covered, used = Counter(), defaultdict(list)
    for p in pieces:
        covered[p["doc_id"]] += p["length"]
        used[p["sequence_id"]].append((p["offset"], p["length"]))
    assert covered == Counter({k: n * len(ids[k]) // 4 for k, n in copies.items()})
    for own in used.values():
        assert sum(n for _, n in own) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:]))


def test_odd_rows_lines_and_columns(spark, tmp_path):
    rng = random.Random(13)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    line = "the same line at the head of them all"
    rows = [(k, f"{line}\n{words(30)}", "h") for k in range(14)]  # lose a line
    rows += [(20, f"{line}\n{words(3)}", "h")]  # little but that line
    rows += [(None, words(20), None), (None, None, None), (21, "", "h"), (22, words(40), None), (22, rows[3][1], "h"), (23, words(9000), "h")]
    rows += [rows[5], rows[5], (24, words(15) + " ", "h")]
    df = spark.createDataFrame([(k, t, "en", s, len(t or "")) for k, t, s in rows], DOCS).selectExpr("*", *CLASH)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = cp.table(spark, str(tmp_path), "documents")
    for _, stage in cp.STAGES[:3]:
        docs = cp.staged(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.columns == df.columns
    kept = docs.collect()
    want = {(k, t.removeprefix(line + "\n")) for k, t, _ in rows if t and len(t) > 100 and k != 20}
    want -= {(22, rows[3][1].removeprefix(line + "\n"))}  # a copy of document 3
    assert {(r["doc_id"], r["text"]) for r in kept} == want and len(kept) == len(want)
    assert all(r["n_chars"] == len(r["text"]) and r["row"] == "row" for r in kept)
    mixed = cp.STAGES[3][1](spark, docs, str(tmp_path))
    assert mixed.columns == df.columns and mixed.count() > 0
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} <= {k for k, _ in want}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
