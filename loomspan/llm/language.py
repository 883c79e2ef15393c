"""Operator 7: language identification by Bayesian evidence fusion.

A naive Bayes model of hashed byte trigrams gives text likelihoods. Grouped
sums of the text posteriors over all pages give, smoothed, how likely a
declared language or an address suffix is for each language, and priors of
hosts: a host's counts lean on its domain's, those on all pages'. A page's own
share is taken out of its host's and domain's counts. The evidence is multiplied.

The model is fitted on at most ``sample`` documents that have a language, the
first by hash of doc_id; all other statistics cover all pages. A language that
none of the sample has is never told.

Nulls: a page without html, text or url is judged by the evidence there is.
Hosts and declarations that are missing count as values of their own. Repeated
rows are judged each. Without any labelled document the language is null.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import html as html_
import re
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, staged

SAMPLE = 3000
BUCKETS = 1 << 16
#: So many trigrams' worth of evidence a text has at most: neighbouring trigrams aren't independent.
TRIGRAMS = 60.0
SMOOTHING = 4.0

_HIDDEN = re.compile(r"<!--|<(script|style|template|noscript)\b", re.I)
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "template", "noscript")} | {"": re.compile("-->")}
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\b(?:xml:)?lang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_CONTENT = re.compile(r"\bcontent\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")


def visible_text(page: str | None) -> str:
    """The text outside tags, comments and hidden elements; of those without an end only the start is left out. Each character is looked at a few times, whatever the page."""
    page = page or ""
    parts, at, endless = [], 0, set()
    for start in _HIDDEN.finditer(page):
        if start.start() < at:
            continue
        tag = (start[1] or "").lower()
        end = None if tag in endless else _END[tag].search(page, start.end())
        if not end:
            endless.add(tag)
            continue
        parts += [page[at : start.start()], " "]
        at = end.end()
    whole = "".join(parts) + page[at:]
    last = whole.rfind(">") + 1  # beyond it no tag ends
    return html_.unescape(_TAG.sub(" ", whole[:last]) + whole[last:])


def declared_language(page: str | None) -> str:
    """Of the html element, or of a meta element that tells the content's language."""
    page = page or ""
    start = _HTML.search(page)
    if start:
        end = page.find(">", start.end())
        found = _LANG.search(page, start.end(), end) if end >= 0 else None
        if found:
            return found[1].lower()
    for meta in _META.finditer(page, 0, page.rfind(">") + 1):
        found = _CONTENT.search(meta[1]) if "content-language" in meta[1].lower() else None
        if found:
            return found[1].lower()
    return ""


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text; runs of other than letters are one space."""
    plain = re.sub(r"[\W\d_]+", " ", text.lower())
    b = np.frombuffer(f" {plain.strip()} ".encode(), np.uint8).astype(np.uint32)
    if len(b) < 3 or not plain.strip():
        return np.empty(0, np.int64)
    return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def train(labelled: list[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
    """Languages and the log likelihood of each trigram bucket in each, from (text, language) pairs."""
    languages = sorted({lang for _, lang in labelled})
    counts = np.zeros((BUCKETS, len(languages)))
    for text, lang in labelled:
        counts[:, languages.index(lang)] += np.bincount(trigrams(text), minlength=BUCKETS)
    counts += 0.1
    return languages, np.log(counts / counts.sum(axis=0)).astype(np.float32)


_EVIDENCE = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()), T.StructField("domain", T.StringType()), T.StructField("suffix", T.StringType())]
    + [T.StructField("declared", T.StringType()), T.StructField("n_trigrams", T.LongType()), T.StructField("text", T.ArrayType(T.DoubleType()))]
)


def identify(pages: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, url, lang, confidence, text_lang, declared, host. ``labelled`` has doc_id, text and lang."""
    spark = pages.sparkSession
    known = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    # By a threshold on keys first: about twice the sample is ordered, whatever the table.
    share = min(1.0, 2 * sample / max(1, labelled.where("lang is not null").count()))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).select("text", "lang").limit(sample).collect()
    languages, table = train([(r["text"], r["lang"]) for r in some])
    if not languages:
        return pages.select("page_id", "url", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"))
    model = spark.sparkContext.broadcast(table)  # BUCKETS rows, a column per language

    def rows(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {f.name: [] for f in _EVIDENCE}
        for page_id, url, page in zip(part["page_id"], part["url"], part["html"]):
            grams = trigrams(visible_text(page))
            scores = model.value[grams].sum(axis=0, dtype=np.float64) * min(1.0, TRIGRAMS / max(1, len(grams)))
            p = np.exp(scores - scores.max())
            host = host_of(url)
            labels = host.split(".")
            values = (page_id, url, host, ".".join(labels[-2:]), labels[-1], declared_language(page), len(grams), (p / p.sum()).tolist())
            for name, v in zip(out, values):
                out[name].append(v)
        return out

    seen = staged(map_batches(pages.select(F.col("page_id").cast("long"), "url", "html"), rows, _EVIDENCE, 64), "evidence")
    every = range(len(languages))
    p = [F.element_at("text", k + 1) for k in every]
    sums = [F.sum(p[k]).alias(f"s{k}") for k in every]
    total = seen.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n = total["n"] or 1
    prior = [((total[f"s{k}"] or 0) + 1) / (n + len(languages)) for k in every]

    def grouped(column: str, short: str) -> DataFrame:
        return seen.groupBy(column).agg(F.count(F.lit(1)).alias(f"{short}n"), *[F.sum(p[k]).alias(f"{short}{k}") for k in every])

    out = seen
    for column, short in (("declared", "d"), ("suffix", "x"), ("host", "h"), ("domain", "o")):
        out = out.join(grouped(column, short), column)
    score = []
    for k in every:
        # How likely this declaration and this suffix are where the language is k.
        given = [F.when(F.col(column) == "", F.lit(0.0)).otherwise(F.log((F.col(f"{s}{k}") - p[k] + SMOOTHING * F.col(f"{s}n") / n * prior[k]) / (n * prior[k]) + F.lit(1e-6))) for column, s in (("declared", "d"), ("suffix", "x"))]
        domain = (F.col(f"o{k}") - p[k] + SMOOTHING * prior[k]) / (F.col("on") - 1 + SMOOTHING)
        host = (F.col(f"h{k}") - p[k] + SMOOTHING * domain) / (F.col("hn") - 1 + SMOOTHING)
        score.append(F.log(p[k] + F.lit(1e-12)) + reduce(lambda a, b: a + b, given) + F.log(F.greatest(host, F.lit(1e-9))))
    names = F.array(*[F.lit(x) for x in languages])
    out = out.withColumn("scores", F.array(*score)).withColumn("best", F.array_max("scores"))
    weight = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    return out.select(
        "page_id", "url", F.element_at(names, F.array_position("scores", F.col("best")).cast("int")).alias("lang"), (1 / weight).alias("confidence"), F.element_at(names, F.array_position("text", F.array_max("text")).cast("int")).alias("text_lang"), "declared", "host"
    )
