"""Column builders for terms: fields, templates, percent-encoding and cleaning. All stay in Spark's own functions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import NA_VALUES
from ..plans.ir import Template

#: What counts as white space beside Java's Unicode classes.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


_NUMERAL = re.compile(r"-?[0-9]+(-[0-9]+)*|true|false")


class UnknownField(ValueError):
    pass


def pct(x: Column) -> Column:
    """RFC 3986 percent-encoding of all but unreserved characters (Spark's url_encode is form encoding)."""
    form = F.url_encode(x)
    return F.replace(F.replace(F.replace(form, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def field_path(schema: T.StructType, name: str) -> tuple[list[str], T.DataType]:
    """The nested path that a dotted name means: the longest field name that fits comes first, so names may hold dots."""

    def walk(at: T.DataType, rest: str) -> tuple[list[str], T.DataType] | None:
        if not rest:
            return [], at
        if not isinstance(at, T.StructType):
            return None
        for f in sorted(at.fields, key=lambda f: -len(f.name)):
            if rest == f.name or rest.startswith(f.name + "."):
                below = walk(f.dataType, rest[len(f.name) + 1 :])
                if below is not None:
                    return [f.name, *below[0]], below[1]
        return None

    found = walk(schema, name)
    if found is None:
        raise UnknownField(f"no field {name}; there are {', '.join(schema.names)}")
    return found


def _plain(kind: T.DataType) -> bool:
    """Whether values of a type are written in unreserved characters only."""
    return isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType))


def field(df: DataFrame, name: str, na: Iterable[str] = NA_VALUES, encoded: bool = False) -> Column:
    """A field as text, NULL where it is missing or one of ``na``. A field that no row of the source has is NULL. ``encoded``: percent-encoded."""
    try:
        path, kind = field_path(df.schema, name)
    except UnknownField:
        return F.lit(None).cast("string")
    x = F.col(".".join(f"`{p}`" for p in path))
    x = F.to_json(x) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else x.cast("string")
    if _plain(kind) and not any(_NUMERAL.fullmatch(n) for n in na):
        return x  # neither missing nor to be encoded; that keeps generated code small enough to be compiled
    x = na_filter(x, na)
    return x if _plain(kind) or not encoded else pct(x)


def na_filter(x: Column, na: Iterable[str] = NA_VALUES) -> Column:
    return F.when(~x.isin(*na), x)


def template(df: DataFrame, text: Template, encoded: bool, na: Iterable[str] = NA_VALUES) -> Column:
    """A template's text; NULL if a field of it is. ``encoded``: its fields are percent-encoded."""
    parts = [field(df, p, na, encoded) if is_field else F.lit(p) for p, is_field in text.parts]
    return F.concat(*parts) if parts else F.lit("")


def clean_text(x: Column) -> Column:
    """Stripped text; blank, none, null and nan (in any case) are NULL."""
    own = strip(x)
    return F.when(~F.lower(own).isin("", "none", "null", "nan"), own)


def strip(x: Column) -> Column:
    """Text without white space at its ends; most texts have none there, which two characters tell."""
    mark = lambda c: F.ascii(c).between(33, 126)
    return F.when(mark(x) & mark(F.substring(x, -1, 1)), x).otherwise(F.regexp_replace(F.regexp_replace(x, "^" + SPACE, ""), SPACE + "$", ""))


def normalize_text(x: Column) -> Column:
    """Stripped text with every run of white space as one space."""
    return F.trim(F.regexp_replace(x, SPACE, " "))


def str_after(x: Column, mark: str) -> Column:
    """What follows the first ``mark``; empty if there is none."""
    at = F.instr(x, mark)
    return F.when(at > 0, F.substr(x, at + len(mark), F.length(x))).when(x.isNotNull(), F.lit(""))


def iri_suffix(x: Column, *prefixes: str) -> Column:
    """The IRI without the first of ``prefixes`` that it begins with."""
    out = x
    for p in reversed(prefixes):
        out = F.when(x.startswith(p), F.substr(x, F.lit(len(p) + 1), F.length(x))).otherwise(out)
    return out
