"""A remote store behind its HTTP API: requests as rows, sent by tasks with a session each.

Writes carry the claim's own id, so a request that is sent again (a task that is
tried again) changes nothing. A session logs in once, fetches an edit token, and
fetches another one when the store says that the token is bad.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from http.cookiejar import CookieJar
from urllib.parse import urlencode
from urllib.request import HTTPCookieProcessor, Request, build_opener

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import envelope

#: Seconds that a call may take.
TIMEOUT = 30
REPLY = "key string, ok boolean, reply string"


class RemoteError(RuntimeError):
    """What the store answered instead."""


class Session:
    def __init__(self, url: str, user: str | None = None, password: str | None = None):
        self.url, self.open = url, build_opener(HTTPCookieProcessor(CookieJar())).open
        self.edit: str | None = None
        if user:
            found = self.call({"action": "login", "lgname": user, "lgpassword": password, "lgtoken": self.token("login")}, True)
            if found.get("login", {}).get("result") != "Success":
                raise RemoteError(f"login: {found}")

    def call(self, params: dict, post: bool = False) -> dict:
        text = urlencode({k: v for k, v in {**params, "format": "json"}.items() if v is not None})
        request = Request(self.url, text.encode()) if post else Request(f"{self.url}?{text}")
        with self.open(request, timeout=TIMEOUT) as answer:
            return json.load(answer)

    def token(self, kind: str) -> str:
        return self.call({"action": "query", "meta": "tokens", "type": kind})["query"]["tokens"][f"{kind}token"]

    def write(self, params: dict) -> dict:
        """A call with the edit token; one more try if the store rejects the token."""
        for last in (False, True):
            self.edit = self.edit or self.token("csrf")
            found = self.call({**params, "token": self.edit}, True)
            if found.get("error", {}).get("code") != "badtoken" or last:
                return found
            self.edit = None
        return found


def claim_requests(claims: DataFrame) -> DataFrame:
    """(key, body) that set each claim with its rank."""
    snak = F.concat(F.lit('{"snaktype":"value","property":"'), "pid", F.lit('","datavalue":'), envelope(F.col("value")), F.lit("}"))
    claim = F.concat(F.lit('{"type":"statement","id":"'), "guid", F.lit('","rank":"'), "rank", F.lit('","mainsnak":'), snak, F.lit("}"))
    return claims.select(F.col("guid").alias("key"), F.to_json(F.struct(F.lit("wbsetclaim").alias("action"), claim.alias("claim"))).alias("body"))


def qualifier_requests(qualifiers: DataFrame) -> DataFrame:
    """(key, body) that add each qualifier to its claim."""
    value = F.get_json_object(envelope(F.col("value")), "$.value")
    return qualifiers.select(F.col("guid").alias("key"), F.to_json(F.struct(F.lit("wbsetqualifier").alias("action"), F.col("guid").alias("claim"), F.lit("value").alias("snaktype"), F.col("pid").alias("property"), value.alias("value"))).alias("body"))


def send(requests: DataFrame, url: str, user: str | None = None, password: str | None = None) -> DataFrame:
    """(key, ok, reply) of each request (key, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = None
        for batch in batches:
            session = session or Session(url, user, password)
            found = [session.write(json.loads(b)) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["error" not in f for f in found]), pa.array([json.dumps(f) for f in found])], names=["key", "ok", "reply"])

    return requests.select("key", "body").mapInArrow(run, REPLY)


def conflicting_id(text: Column) -> Column:
    """The id of the entity that an error's text links to as the one with these terms; NULL if it links to none."""
    link = F.regexp_extract(text, r"\[\[(?:Item:Q|Property:P)[0-9]+", 0)
    return F.nullif(F.regexp_extract(link, "[QP][0-9]+$", 0), F.lit(""))
