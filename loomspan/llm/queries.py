"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def op1_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .extraction import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .scoring import score

    return score(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import dedup_report

    return dedup_report(table(spark, sf_dir, "documents")).drop("text_chars")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from .common import scratch_dir
    from .sharding import shard_report

    return shard_report(table(spark, sf_dir, "documents"), f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}")


def op6_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .privacy import private_report

    return private_report(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extraction": op1_extraction,
    "op2_packing": op2_packing,
    "op3_scoring": op3_scoring,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op6_privacy": op6_privacy,
    "op7_language": op7_language,
    "op8_ngram_join": op8_ngram_join,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
}

_WORDS = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k""",
    "op9_mixing": rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS.format(t="coalesce(text, '')")}) AS BIGINT) AS size,
  -ln((CAST('0x' || substr(md5('17:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 1) / 4503599627370497.0) / (CASE WHEN coalesce(text, '') = '' THEN 0.5 ELSE 0.5 + length(translate(text, '#*$%&|<>0123456789', '')) / CAST(length(text) AS DOUBLE) END) AS draw FROM documents),
s AS (SELECT source, sum(size) AS source_size, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM d GROUP BY source),
c AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS ratio, 1.5 * sum(source_size) OVER () AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, CASE WHEN level > ratio THEN cap ELSE least(cap, weight * max(CASE WHEN level <= ratio THEN level END) OVER ()) END AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
u AS (SELECT *, coalesce(max(CASE WHEN upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS used FROM r),
m AS (SELECT *, abs(rest - used - size) AS miss, upto > rest AND abs(rest - used - size) < rest - used AS open FROM u),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN open THEN 0 ELSE 1 END, miss, draw, upto) AS place FROM m)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN (upto <= rest OR open AND place = 1) AND whole < 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM b""",
    "op10_quality_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, {_WORDS.format(t="t")} AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i : i + 4], ' ') AS k FROM w, unnest(range(1, len(ws) - 3)) AS u(i) WHERE len(ws) >= 5),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS v(p) GROUP BY r),
l AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^ 	-
]')),
dup AS (SELECT r, sum(c - 1) AS n FROM (SELECT r, l, count(*) AS c FROM l GROUP BY r, l) GROUP BY r),
words AS (SELECT r, {_WORDS.format(t="translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM l),
own AS (SELECT r, array_to_string(ws, ' ') AS line, sum(len(ws)) AS n FROM words GROUP BY r, line),
held AS (SELECT own.*, d.source, d.doc_id, d.t FROM own JOIN d USING (r)),
over_ AS (SELECT source, line FROM held GROUP BY source, line HAVING count(DISTINCT t) > 10),
gone AS (SELECT h.r, sum(h.n) AS n FROM held h JOIN over_ o ON h.source IS NOT DISTINCT FROM o.source AND h.line = o.line GROUP BY h.r),
f AS (SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(d.t, '[ 	-
]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND NOT (removed_words > 0 AND (n_words - removed_words < 10 OR n_words - removed_words < 0.3 * n_words)) AS kept FROM j""",
}
