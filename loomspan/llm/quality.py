"""Operator 10: quality rules with cross-document line frequency.

Lines are normalised (A-Z lowered, white space collapsed) and hashed to 64
bits. For each host (here ``source``) the distinct documents that hold a line
are counted; exact copies of a text count as one document. A line in more than
``max_docs`` documents of its host is removed from all of them, and a document
left with too few words is rejected, as is one that fails the base rules. :func:`quality_filter` gives the
kept documents without the removed lines.

Nulls: a null text has no words, so its row fails the base rule; a null source
is a host of its own; a null doc_id is an id below all others. Empty texts and
empty tables are fine. Repeated rows are judged alike. Extra columns are
ignored by :func:`quality_report` and kept by :func:`quality_filter`; of them
only ``n_chars`` follows a text that loses lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows, map_batches, staged, text_key

SYMBOLS = b"#*$%&|<>"
SPACE_BYTES = b" \t\n\x0b\x0c\r"

SCHEMA = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("lines", T.ArrayType(T.LongType())),
        T.StructField("line_words", T.ArrayType(T.IntegerType())),
    ]
)


@dataclass(frozen=True)
class QualityRules:
    """Limits. ``max_docs``: documents of a host that may share a line; ``min_left``: share of its words that a document must keep."""

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_docs: int = 10
    min_left: float = 0.3


def repeated_words(words: list[bytes], window: int) -> int:
    """Words in ``window``-word windows that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # Pairs of ids are ranked again and again, so windows compare exactly.
    code, width, size = at, 1, len(ids)
    while width < window:
        step = min(width, window - width)
        joined = code[: len(code) - step] * np.int64(size) + code[step:]
        distinct, code = np.unique(joined, return_inverse=True)
        size, width = len(distinct), width + step
    twice = (np.bincount(code, minlength=size) > 1)[code]
    edge = np.zeros(len(words) + 1, np.int32)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """64 bits of a normalised line, given its lower-cased words."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def without_lines(text: str, hashes: list[int]) -> str:
    """``text`` without the lines whose normalised form has one of ``hashes``; other lines stay as they are."""
    gone = set(hashes)

    def stays(line: str) -> bool:
        own = line.encode().lower().split()
        return not own or line_hash(own) not in gone

    return "\n".join(line for line in text.split("\n") if stays(line))


def document_figures(text: str | None, window: int = 5) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and words by hash of normalised line."""
    raw = (text or "").encode()
    words = raw.split()
    chars = len(text or "") - len(raw) + len(raw.translate(None, SPACE_BYTES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    twice = 0
    for line in raw.split(b"\n"):
        own = line.lower().split()
        if own:
            twice += line in seen
            seen.add(line)
            h = line_hash(own)
            lines[h] = lines.get(h, 0) + len(own)
    return len(words), chars, symbols, twice, repeated_words(words, window), lines


def _figures(docs: DataFrame, rules: QualityRules) -> DataFrame:
    window, state = rules.window, {"n": 0}

    def rows(part: dict[str, list]) -> dict[str, list]:
        first = (TaskContext.get().partitionId() << 36) + state["n"]
        state["n"] += len(part["text"])
        found = [document_figures(t, window) for t in part["text"]]
        return {
            "row": list(range(first, first + len(found))), "doc_id": part["doc_id"], "source": part["source"], "key": part["key"],
            "n_words": [f[0] for f in found], "word_chars": [f[1] for f in found], "n_symbols": [f[2] for f in found], "n_dup_lines": [f[3] for f in found], "n_repeat_words": [f[4] for f in found],
            "lines": [list(f[5]) for f in found], "line_words": [list(f[5].values()) for f in found],
        }

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text", text_key("text").alias("key"))
    return staged(map_batches(narrow, rows, SCHEMA), "quality")


def _judged(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """The report and ``removed_lines``, the hashes of each row's lines over the limit (null if it has none)."""
    base = _figures(docs, rules)
    lines = base.select("row", "doc_id", "source", "key", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "row", "doc_id", F.coalesce("source", F.lit("")).alias("host"), F.col("source").isNull().alias("no_host"), "key", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words")
    )
    over = (
        lines.groupBy("host", "no_host", "line")
        .agg(F.count_distinct("key").alias("docs"))
        .where(F.col("docs") > rules.max_docs)
        .select("host", "no_host", "line")
    )
    removed = lines.join(over, ["host", "no_host", "line"]).groupBy("row").agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < rules.min_words) | (left < rules.min_left * F.col("n_words")))
    return (
        base.drop("lines", "line_words")
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("row")
    )


def quality_report(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per document: figures, ``base_failed``, ``removed_words`` (in lines over the limit) and ``kept``."""
    return _judged(docs, rules).drop("removed_lines")


def _without_lines(text: pa.Array, hashes: pa.Array) -> pa.Array:
    return pa.array([None if h is None else without_lines(t, h) for t, h in zip(text.to_pylist(), hashes.to_pylist())], pa.string())


def quality_filter(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, their texts without lines over the limit."""
    judged = _judged(docs, rules).where(~F.col("kept") | F.col("removed_lines").isNotNull())
    # Rows alike in id, source and text are judged alike: one of them stands for all.
    marks = judged.groupBy("doc_id", "source", "key").agg(F.first("kept").alias("kept"), F.first("removed_lines").alias("gone"))
    rows = as_rows(docs).withColumns({"id": F.col("row")["doc_id"].cast("long"), "from": F.col("row")["source"].cast("string"), "text_key": text_key("row.text")})
    same = rows["id"].eqNullSafe(marks["doc_id"]) & rows["from"].eqNullSafe(marks["source"]) & (rows["text_key"] == marks["key"])
    kept = rows.join(marks, same, "left").where(F.coalesce("kept", F.lit(True)))
    # Only texts that lose lines go to Python.
    changed = F.col("gone").isNotNull()
    kept = kept.withColumn("cut", F.arrow_udf(_without_lines, "string")(F.when(changed, F.col("row")["text"]), "gone"))
    new = {"text": F.when(changed, F.col("cut")).otherwise(F.col("row")["text"])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("cut").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row")["n_chars"])
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
