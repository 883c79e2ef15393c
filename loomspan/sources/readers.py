"""Logical sources as DataFrames: JSON, CSV and Parquet files, tables, and SQL with its file functions."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.ir import Source

_FILE = re.compile(r"\bread_(json|csv|parquet)(?:_auto)?\s*\(\s*'((?:[^']|'')*)'[^()]*\)", re.I)
_QUOTED = re.compile(r"'(?:[^']|'')*'|\"((?:[^\"]|\"\")*)\"|--[^\n]*|/\*.*?\*/", re.S)
_ELEMENT = re.compile(r"\bjson_extract_string\s*\(\s*([\w.`]+)\s*,\s*'\$\[(\d+)\]'\s*\)", re.I)
_KEY = re.compile(r"\bjson_extract_string\s*\(\s*([\w.`]+)\s*,\s*'(\$\.[^']*)'\s*\)", re.I)
_LATERAL = re.compile(r",\s*unnest\s*\(\s*([^()]+?)\s*\)\s*(?:AS\s+)?(\w+)\s*\(\s*(\w+)\s*\)", re.I)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array or one JSON value; the elements of a top-level array are rows.

    Such a file is one task. Large sources are lines of JSON, ``*.jsonl`` or ``*.ndjson``, which are split.
    """
    by_line = re.search(r"\.(jsonl|ndjson)(\.\w+)?/?$", path, re.I)
    return spark.read.option("multiLine", not by_line).json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; quoted cells may hold line breaks, doubled quotes and a byte-order mark comes off.

    Cells with line breaks make a file one task. A large source has none and is ``*.tsv`` (tab-separated) or ``*.lines.csv``, which are split.
    """
    tabs = bool(re.search(r"\.tsv(\.\w+)?/?$", path, re.I))
    by_line = tabs or bool(re.search(r"\.lines\.csv(\.\w+)?/?$", path, re.I))
    return spark.read.options(header=True, multiLine=not by_line, escape='"', encoding="UTF-8", sep="\t" if tabs else ",").csv(path)


def translate_sql(spark: SparkSession, query: str, root: str = "") -> str:
    """The mapping dialect's SQL as Spark SQL; files named in it become temporary views.

    Double-quoted identifiers, ``read_json`` and ``read_csv``, ``unnest`` in
    SELECT and FROM, and ``json_extract_string`` are rewritten; all else passes.
    """

    def view(m: re.Match) -> str:
        kind, path = m[1].lower(), m[2].replace("''", "'")
        full = path if not root or re.match(r"[a-z0-9]+:|/", path) else f"{root.rstrip('/')}/{path}"
        name = f"file_{kind}_{zlib.crc32(full.encode()):08x}"
        if not spark.catalog.tableExists(name):
            {"json": read_json, "csv": read_csv, "parquet": lambda s, p: s.read.parquet(p)}[kind](spark, full).createOrReplaceTempView(name)
        return name

    sql = _FILE.sub(view, query)
    sql = _QUOTED.sub(lambda m: "`" + m[1].replace('""', '"').replace("`", "``") + "`" if m[1] is not None else m[0], sql)
    sql = _LATERAL.sub(lambda m: f" LATERAL VIEW explode({m[1]}) {m[2]} AS {m[3]}", sql)
    sql = re.sub(r"\bunnest\s*\(", "explode(", sql, flags=re.I)
    sql = _ELEMENT.sub(lambda m: f"get({m[1]}, {m[2]})", sql)
    return _KEY.sub(lambda m: f"get_json_object({m[1]}, '{m[2]}')", sql)


def _joined(path: str, root: str) -> str:
    return path if not root or re.match(r"[a-z0-9]+:|/", path) else f"{root.rstrip('/')}/{path}"


def load(spark: SparkSession, source: Source, root: str = "", tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of a logical source. ``tables`` names DataFrames that stand in for paths, tables and views."""
    if source.path and source.path in (tables or {}):
        return tables[source.path]
    if source.kind == "sql":
        for name, df in (tables or {}).items():
            if re.fullmatch(r"\w+", name):
                df.createOrReplaceTempView(name)
        return spark.sql(translate_sql(spark, source.query, root))
    if source.kind == "table":
        return spark.table(source.path)
    path = _joined(source.path, root)
    if source.kind == "csv":
        return read_csv(spark, path)
    if source.kind == "parquet":
        return spark.read.parquet(path)
    df = read_json(spark, path)
    steps = [s for s in re.findall(r"\.([^.\[\]$*]+)|\[\s*'([^']+)'\s*\]", source.iterator)]
    for name in (a or b for a, b in steps):  # below the root: $.items[*] and the like
        inner = df.select(F.col(f"`{name}`").alias("x"))
        inner = inner.select(F.explode("x").alias("x")) if inner.schema["x"].dataType.typeName() == "array" else inner
        df = inner.select("x.*") if inner.schema["x"].dataType.typeName() == "struct" else inner
    return df


# N-Triples -------------------------------------------------------------------

_TRIPLE = r"^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(.*\S)\s*\.\s*$"


class MalformedLine(ValueError):
    """A line of N-Triples that begins with neither < nor _:."""


def read_ntriples(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """(s, p, o): o is STRUCT<kind, lex, datatype, lang>. ``check``: the file's first malformed line raises, with its number."""
    if check:
        check_ntriples(spark, path)
    lines = spark.read.text(path)
    part = lambda k: F.regexp_extract("value", _TRIPLE, k)
    rows = lines.where(F.trim("value") != "").select(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"))
    plain = lambda x: F.regexp_replace(x, "^<|>$", "")
    text = r'^"(.*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?$'
    is_text = F.col("o").startswith('"')
    group = lambda k: F.nullif(F.regexp_extract("o", text, k), F.lit(""))
    value = F.struct(
        F.when(is_text, "literal").otherwise("iri").alias("kind"), F.when(is_text, unescape(F.regexp_extract("o", text, 1))).otherwise(plain(F.col("o"))).alias("lex"), F.when(is_text, group(3)).alias("datatype"), F.when(is_text, group(2)).alias("lang")
    )
    return rows.select(plain(F.col("s")).alias("s"), "p", value.alias("o"))


def check_ntriples(spark: SparkSession, path: str) -> None:
    first = bad_lines(spark, path).orderBy("file", "line").limit(1).collect()
    if first:
        raise MalformedLine(f"malformed N-Triples line {first[0]['line']}: {first[0]['value'][:200].rstrip()}")


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of the lines that are no triples; lines count from 1 in each file, however it is split.

    Each split's lines are counted; what lies ahead of it in its file tells
    where its numbers begin.
    """
    at = ["file", "block"]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    own = F.ltrim("value")
    bad = lines.where((own != "") & ~own.startswith("<") & ~own.startswith("_:"))
    sizes = lines.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    return bad.join(sizes, at).select("file", (F.col("ahead") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def escape(x):
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def unescape(x):
    hold = ""
    x = F.replace(x, F.lit("\\\\"), F.lit(hold))
    for a, b in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.replace(x, F.lit(hold), F.lit("\\"))


def ntriple(s, p, o):
    """One line of N-Triples from columns s, p and the value struct o."""
    tail = F.when(o["lang"].isNotNull(), F.concat(F.lit("@"), o["lang"])).when(o["datatype"].isNotNull(), F.concat(F.lit("^^<"), o["datatype"], F.lit(">"))).otherwise("")
    obj = F.when(o["kind"] == "iri", F.concat(F.lit("<"), o["lex"], F.lit(">"))).otherwise(F.concat(F.lit('"'), escape(o["lex"]), F.lit('"'), tail))
    return F.concat(F.lit("<"), s, F.lit("> <"), p, F.lit("> "), obj, F.lit(" ."))
