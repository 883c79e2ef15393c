import json
import random
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit

import pytest
from pyspark.sql import functions as F

from loomspan.config import Config, ConfigError
from loomspan.functions import values
from loomspan.operators import reconcile as rc
from loomspan.operators.dataplane import build, triples
from loomspan.operators.store import LOOKUP, SCHEMAS, Store, evict_stale, load_lookup, save_lookup
from loomspan.operators.upsert import snaks_by_property
from loomspan.plans.compiler import compile_mapping
from loomspan.plans.ir import EntitySpec, MappingBlock, Plan, PropertyRef, Source, StatementMap, Template, TermMap, ValueSpec
from loomspan.run import counters, execute, update
from loomspan.sources import remote
from loomspan.sources.readers import MalformedLine, bad_lines, load, read_ntriples
from loomspan.streaming.incremental import stream_updates

from .mappings import FULL, VOYAGES

LOG = {
    "log": [
        {"code": "a7", "vessel": "Marga", "leg": {"to": "RTM", "sailed": "1911-04", "tons": 310}},
        {"code": "b2", "vessel": "Odin", "leg": {"to": "HAM", "sailed": "1911-05", "tons": None}},
        {"code": "c1", "vessel": "Marga", "leg": {"to": "XXX", "sailed": "1912-01", "tons": 12}},
        {"code": "d4", "vessel": "Odin", "leg": {"to": "RTM", "sailed": "1913-09", "tons": 95}},
    ]
}
PORTS = "code,town\nRTM,Rotterdam\nHAM,Hamburg\nLEH,Le Havre\n"
LEG = "code string, vessel string, leg struct<to:string,sailed:string,tons:int>"


@pytest.fixture
def harbour(tmp_path):
    (tmp_path / "voyages.json").write_text(json.dumps(LOG))
    (tmp_path / "ports.csv").write_text(PORTS)
    return tmp_path


def count(store):
    return {k: df.count() for k, df in store.tables.items()}


def staff(spark):
    rows = [(1, "An", "Lee", None, "3", "2001-02-03"), (2, "Bo", "Ray", 1, "4.5", "2002"), (3, "Cy", "Fox", 9, "junk", "soon")]
    return spark.createDataFrame(rows, "id int, first string, last string, boss int, size string, since string")


def test_voyages_data_plane(spark, harbour):
    rows = build(spark, compile_mapping(VOYAGES), str(harbour))
    assert (rows.types.count(), rows.terms.count(), rows.statements.count(), rows.qualifiers.count()) == (4, 11, 3, 3)  # XXX is no port, and b2 has no tons
    by = {r["stmt_iri"].rpartition(":")[2]: r["value"]["lex"] for r in rows.statements.collect()}
    assert by == {"Voyage a7_1_RTM": "urn:wikibase:item:Port RTM", "Voyage b2_1_HAM": "urn:wikibase:item:Port HAM", "Voyage d4_1_RTM": "urn:wikibase:item:Port RTM"}
    assert triples(rows).count() == 4 + 11 + 3 * 3 + 3


def test_rows_are_distinct(spark):
    """Equal rows come out once, whether or not templates tell source rows apart."""
    rows = [("x_1", "y", 1, 5), ("x", "1_y", 1, 5), ("x", "1_y", 1, 6), ("x", "1_y", 1, 5), (None, "y", 2, 7), ("nan", "y", 2, 7)]
    df = spark.createDataFrame(rows, "a string, b string, k int, n int")
    made = lambda key: MappingBlock("#t", Source("table", "t"), EntitySpec("item", Template(key), None, ("c",)), (TermMap("label", ValueSpec("reference", "a", language="en")),), (StatementMap(1, PropertyRef("p"), ValueSpec("reference", "n")), StatementMap(2, PropertyRef("p"), ValueSpec("constant", "c"))))
    for key, entities, statements in (("{a}_{b}", 1, 3), ("{k}", 2, 5), ("{k}_{b}", 3, 7), ("{missing}", 0, 0), ("one", 1, 4)):
        out = build(spark, Plan([made(key)]), tables={"t": df})
        assert (out.types.count(), out.statements.count()) == (entities, statements), key
        for found in (out.types, out.terms, out.statements):
            assert found.count() == found.distinct().count()


def test_every_kind_of_value(spark):
    rows = build(spark, compile_mapping(FULL), tables={"staff": staff(spark)})
    by = {r["stmt_iri"].removeprefix("urn:wikibase:statement:"): r for r in rows.statements.collect()}
    assert by["Staff_2_1_Bo Ray"]["value"]["lex"] == "Bo Ray" and by["Staff_2_1_Bo Ray"]["rank"] == "preferred"
    assert by["Staff_2_2"]["value"]["lex"] == "fixed"
    assert by["Staff_2_3_1"]["value"]["lex"] == "urn:wikibase:item:Staff_1"
    assert not any(n.startswith("Staff_3_3") for n in by)  # boss 9 joins nobody
    assert by["Q5_6_An"]["prop_iri"] == "urn:wikibase:propertyIRI:P7"
    q = {r["value"]["lex"] for r in rows.qualifiers.where("stmt_iri like '%Staff\\_2\\_1%'").collect()}
    assert q == {"4.5", "urn:wikibase:item:Staff_1", "urn:wikibase:item:Town", "q 2", "urn:wikibase:item:Staff_2"}
    assert rows.ref_snaks.where("stmt_iri like '%Staff\\_2\\_1%'").select("ref_iri").distinct().count() == 2


def test_run_is_idempotent_and_persists(spark, harbour):
    config = Config(root=str(harbour), store=str(harbour / "kb"), lookup=str(harbour / "lookup.json"), triples_output=str(harbour / "nt"), schema_output=str(harbour / "schema.ttl"), plan_output=str(harbour / "plan.ttl"))
    first = update(spark, VOYAGES, config)
    assert count(first.store) == {"entities": 12, "terms": 17, "claims": 7, "qualifiers": 2, "references": 0}
    assert first.rejects.count() == 0
    assert {(r["stage"], r["event"]): r["n"] for r in counters(first).collect()} == {("entities", "added"): 12, ("terms", "added"): 17, ("claims", "added"): 7, ("qualifiers", "added"): 2}
    assert len(json.loads((harbour / "lookup.json").read_text())["items"]) == 8
    assert "TriplesMap" in (harbour / "plan.ttl").read_text() and "voyage" in (harbour / "schema.ttl").read_text()
    again = update(spark, VOYAGES, config)
    assert count(again.store) == count(first.store) and counters(again).count() == 0
    assert spark.read.text(str(harbour / "nt")).count() == 27
    parts = json.loads((harbour / "kb" / "current").read_text())
    assert len(parts["claims"]) == 1 and len(parts["entities"]) == 1  # nothing new, nothing written


def test_full_run_rejects_and_attaches(spark):
    kb = Store.empty(spark).append(entities=spark.createDataFrame([("Q5", "item", None), ("P7", "property", "string")], SCHEMAS["entities"]))
    out = execute(spark, compile_mapping(FULL), kb, spark.createDataFrame([], LOOKUP), tables={"staff": staff(spark)})
    reasons = {r["reason"] for r in out.rejects.collect()}
    assert "plain value does not fit quantity" in reasons and "plain value does not fit time" in reasons
    ranks = {r["rank"]: r["count"] for r in out.store.claims.groupBy("rank").count().collect()}
    assert ranks["preferred"] == 3
    # Staff_9 is only named as a boss: it exists with its key as label.
    assert out.store.terms.where("value = 'Staff_9'").count() == 1
    refs = snaks_by_property(out.store.references).collect()
    assert len(refs) == 3 + 1  # one each of three, and a boss for Bo
    assert out.store.claims.where("subject_id = 'Q5'").first()["value"]["text"] == "An"
    subclass = [r for r in out.store.claims.collect() if r["pid"] == "P9" or r["pid"] == "P2"]
    assert subclass


def test_same_label_is_one_entity_and_existing_ones_are_found(spark):
    terms = spark.createDataFrame([("a", "label", "en", "Tea"), ("b", "label", "en", " tea"), ("c", "label", "en", "Coffee"), ("d", "label", "de", "Kakao")], "iri string, kind string, lang string, value string")
    entities = terms.select("iri", F.lit(None).cast("string").alias("datatype"))
    kb = Store.empty(spark).append(entities=spark.createDataFrame([("Q9", "item", None), ("Q10", "item", None)], SCHEMAS["entities"]), terms=spark.createDataFrame([("Q10", "alias", "en", "COFFEE"), ("Q9", "label", "en", "coffee")], SCHEMAS["terms"]))
    none = spark.createDataFrame([], LOOKUP)
    ids = {r["iri"]: r["id"] for r in rc.resolve(entities, terms, none, kb, "item").ids.collect()}
    assert ids == {"a": "Q11", "b": "Q11", "c": "Q9", "d": "Q12"}
    ids = {r["iri"]: r["id"] for r in rc.resolve(entities, terms, none, kb, "item", search=False).ids.collect()}
    assert len(set(ids.values())) == 4
    cached = spark.createDataFrame([("a", "Q1", "item", None)], LOOKUP)
    assert {r["iri"]: r["id"] for r in rc.resolve(entities, terms, cached, kb, "item").ids.collect()}["a"] == "Q1"


def test_violations(spark):
    kb = Store.empty(spark).append(entities=spark.createDataFrame([("P1", "property", None)], SCHEMAS["entities"]))
    iri = lambda x: spark.createDataFrame([(x,)], "iri string")
    for bad, what in (("urn:wikibase:itemIRI:X1", "is no id"), ("urn:wikibase:itemIRI:Q1", "does not exist"), ("urn:wikibase:propertyIRI:P1", "has no datatype")):
        with pytest.raises(rc.Violation, match=what):
            rc.direct_ids(iri(bad), kb)
    two = spark.createDataFrame([("p", "string"), ("p", "url")], "iri string, datatype string")
    with pytest.raises(rc.Violation, match="2 property types"):
        rc.single_property_types(two)
    labels = spark.createDataFrame([("a", "label", "en", "x"), ("a", "label", "en", "y")], "iri string, kind string, lang string, value string")
    with pytest.raises(rc.Violation, match="different labels"):
        rc.collect_terms(labels)
    with pytest.raises(rc.Violation, match="unsupported language"):
        rc.resolve_languages(labels, "en", {"de"})


def test_store_operations(spark, tmp_path):
    kb = Store.empty(spark).append(entities=spark.createDataFrame([(f"Q{k}", "item", None) for k in range(1, 6)], SCHEMAS["entities"]), terms=spark.createDataFrame([("Q2", "label", "en", "Tea")], SCHEMAS["terms"]))
    assert [r[0] for r in kb.search(" TEA", "en").collect()] == ["Q2"]
    left, gone, skipped = kb.delete_range(spark, "Q", 2, 7)
    assert (left.entities.count(), gone, skipped, left.terms.count()) == (1, 4, 2, 0)
    with pytest.raises(ValueError, match="after"):
        kb.delete_range(spark, "Q", 3, 2)
    lookup = spark.createDataFrame([("a", "Q1", "item", None), ("b", "Q99", "item", None), ("p", "P1", "property", "url")], LOOKUP)
    assert {r["iri"] for r in evict_stale(lookup, kb).collect()} == {"a"}
    for path in (str(tmp_path / "l.json"), str(tmp_path / "l")):
        save_lookup(lookup, path)
        assert load_lookup(spark, path).count() == 3
    assert load_lookup(spark, str(tmp_path / "none.json")).count() == 0


def test_store_keeps_what_it_names(spark, tmp_path):
    path = str(tmp_path / "kb")
    one = lambda k: spark.createDataFrame([(f"Q{k}", "item", None)], SCHEMAS["entities"])
    Store.empty(spark).append(entities=one(1)).write(path)
    for k in range(2, 19):
        Store.load(spark, path).append(entities=one(k)).write(path)
    assert Store.load(spark, path).entities.count() == 18
    assert len(json.loads((tmp_path / "kb" / "current").read_text())["entities"]) <= 16  # joined into one on the way
    one(99).write.parquet(f"{path}/entities-broken-off")  # a run that broke off before it named its part
    assert Store.load(spark, path).entities.count() == 18
    assert Store.vacuum(spark, path) == 0 and Store.vacuum(spark, path, 0) > 16 and Store.load(spark, path).entities.count() == 18


def test_dense_numbers(spark):
    df = spark.createDataFrame([(f"{(k * 7919) % 1000:04d}",) for k in range(500)], "iri string")
    rows = rc.dense_numbers(df, "iri", "n").orderBy("iri").collect()
    assert [r["n"] for r in rows] == list(range(1, 501))


def test_config():
    c = Config.from_env({"VERBOSE": "2", "SEARCH_WIKIBASE": "no", "RML_OUTPUT_PATH": "x", "SCHEMA_OUTPUT_PATH": "s.xml", "STORE_FILE": "F", "LOOKUP_FILE": "l.json"}, "/b")
    assert (c.verbose, c.search, c.schema_output, c.lookup) == (2, False, "/b/s.ttl", None)
    for env in ({"VERBOSE": "x"}, {"STORE_FILE": "maybe"}, {"VERBOSE": "7"}, {"LANGUAGE": "xx", "LANGUAGES": "en,de"}):
        with pytest.raises(ConfigError):
            Config.from_env(env)


def test_stream_adds_each_batch_once(spark, harbour, tmp_path):
    rows = [(v["code"], v["vessel"], (v["leg"]["to"], v["leg"]["sailed"], v["leg"]["tons"])) for v in LOG["log"]]
    spark.createDataFrame(rows[:2], LEG).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LEG).parquet(str(tmp_path / "in"))
    config = Config(store=str(tmp_path / "kb"), lookup=str(tmp_path / "lookup"), root=str(harbour))
    go = lambda: stream_updates(stream, "voyages.json", VOYAGES, config, str(tmp_path / "cp")).awaitTermination()
    go()
    assert Store.load(spark, config.store).claims.count() == 2 + 2
    spark.createDataFrame(rows[1:], LEG).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    update(spark, VOYAGES, config, {"voyages.json": spark.read.parquet(str(tmp_path / "in"))})
    assert Store.load(spark, config.store).claims.count() == 4 + 3


def sequential(entities, cached, store):
    """Ids one at a time, again and again until nothing changes: names of all entities count for all."""
    who = {x: (0, store_id, "") if (store_id := cached.get(x)) else (1, 0, x) for x in entities}
    for x, (label, _) in entities.items():
        hits = [i for i, names in store.items() if label in names]
        if x not in cached and hits:
            who[x] = (0, min(hits), "")
    while True:
        then = {x: w if x in cached else min([w, *(who[y] for y, (own, aliases) in entities.items() if entities[x][0] in {own, *aliases})]) for x, w in who.items()}
        if then == who:
            return who
        who = then


def test_resolution_against_one_by_one(spark):
    rng = random.Random(5)
    for round_ in range(3):
        names = [f"n{k}" for k in range(18)]
        entities = {f"i{k:02d}": (rng.choice(names), rng.sample(names, rng.choice([0, 0, 1, 2]))) for k in range(24)}
        store = {k: set(rng.sample(names, 2)) for k in (3, 8, 9)}
        cached = {"i05": 8, "i11": 3}
        terms = [(x, "label", "en", " " + label.upper()) for x, (label, _) in entities.items()] + [(x, "alias", "en", a) for x, (_, own) in entities.items() for a in own]
        kb = Store.empty(spark).append(entities=spark.createDataFrame([(f"Q{k}", "item", None) for k in store], SCHEMAS["entities"]), terms=spark.createDataFrame([(f"Q{k}", "alias", "en", n) for k, own in store.items() for n in own], SCHEMAS["terms"]))
        lookup = spark.createDataFrame([(x, f"Q{k}", "item", None) for x, k in cached.items()], LOOKUP)
        got = {r["iri"]: r["id"] for r in rc.resolve(spark.createDataFrame([(x, None) for x in entities], "iri string, datatype string"), spark.createDataFrame(terms, "iri string, kind string, lang string, value string"), lookup, kb, "item").ids.collect()}
        want = sequential(entities, cached, store)
        leaders = sorted({w[2] for w in want.values() if w[0]})
        assert got == {x: f"Q{w[1]}" if not w[0] else f"Q{10 + leaders.index(w[2])}" for x, w in want.items()}, round_


def test_line_numbers_across_splits(spark, tmp_path):
    lines = [f"<urn:{k}> <urn:p> <urn:o> ." if k % 97 else f"bad {k}" for k in range(1, 3000)]
    for name in ("a.nt", "b.nt"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        found = bad_lines(spark, str(tmp_path)).collect()
        with pytest.raises(MalformedLine, match="line 97: bad 97"):
            read_ntriples(spark, str(tmp_path / "a.nt"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["line"] for r in found) == sorted([*range(97, 3000, 97)] * 2) and all(r["value"] == f"bad {r['line']}" for r in found)


def test_splittable_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k":1}\n{"k":2}\n')
    (tmp_path / "a.tsv").write_text("k\tv\n1\tx\n")
    assert load(spark, Source("json", "a.jsonl"), str(tmp_path)).count() == 2
    assert load(spark, Source("csv", "a.tsv"), str(tmp_path)).first()["v"] == "x"


def test_remote_store(spark):
    """A store that wants a login, forgets its first token, and refuses a taken label."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        tokens = 0

        def reply(self, params):
            seen.append(params)
            if params["action"] == "login":
                found = {"login": {"result": "Success" if params["lgpassword"] == "p" else "Failed"}}
            elif params["action"] == "query":
                Handler.tokens += 1
                found = {"query": {"tokens": {f"{params['type']}token": f"t{Handler.tokens}"}}}
            elif params["token"] == "t2":
                found = {"error": {"code": "badtoken"}}
            elif "refuse" in params["claim"]:
                found = {"error": {"code": "failed", "info": "taken by [[Item:Q42|Q42]]"}}
            else:
                found = {"success": 1}
            body = json.dumps(found).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.reply(dict(parse_qsl(urlsplit(self.path).query)))

        def do_POST(self):
            self.reply(dict(parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode())))

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/api"
    value = values.convert(values.literal(F.col("text"), "http://www.w3.org/2001/XMLSchema#string"), F.lit("string"), F.lit(None).cast("string"))
    claims = spark.createDataFrame([("g1", "a \"b\" é"), ("g2", "refuse")], "guid string, text string").coalesce(1).select("guid", F.lit("P1").alias("pid"), value.alias("value"), F.lit("normal").alias("rank"))
    replies = {r["key"]: r for r in remote.send(remote.claim_requests(claims), url, "u", "p").withColumn("id", remote.conflicting_id(F.col("reply"))).collect()}
    assert replies["g1"]["ok"] and not replies["g2"]["ok"] and replies["g2"]["id"] == "Q42" and replies["g1"]["id"] is None
    sent = [json.loads(p["claim"]) for p in seen if p["action"] == "wbsetclaim" and p["token"] != "t2"]
    assert sent[0]["mainsnak"]["datavalue"] == {"value": 'a "b" é', "type": "string"} and len(sent) == 2
    with pytest.raises(remote.RemoteError):
        remote.Session(url, "u", "wrong")
    server.shutdown()
