import pytest
from hypothesis import given
from hypothesis import strategies as st

from loomspan.plans.compiler import MappingError, compile_mapping, encode, plan_graph, schema_graph, strip_mapping
from loomspan.sources.turtle import Graph, Iri, Literal, TurtleError, parse_turtle, write_ntriples, write_turtle

from .mappings import FULL, VOYAGES, X


def test_voyages_compile():
    plan = compile_mapping(VOYAGES)
    voyages, ports = plan.blocks
    assert (voyages.source.kind, voyages.source.iterator, ports.source.kind) == ("json", "$.log[*]", "csv")
    assert voyages.entity.classes == ("urn:wikibase:item:Voyage",) and ports.entity.classes == ()
    made = voyages.statements[0]
    assert made.value.conditions == (("leg.to", "code"),) and made.name(voyages.entity).text == "Voyage {code}_1_{leg.to}"
    assert {d.iri.rpartition(":")[2]: d.property_types for d in plan.properties} == {"tonnage": ("quantity",), "berth": ("wikibase-item",)}


def test_plan_as_rml():
    graph = parse_turtle(write_turtle(plan_graph(compile_mapping(VOYAGES))))
    rr = "http://www.w3.org/ns/r2rml#"
    names = [s.value.partition("#")[2] for s in graph.subjects("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", Iri(rr + "TriplesMap"))]
    assert names == ["Voyages", "Voyages/statement/1", "Ports"]
    assert Literal("urn:wikibase:statement:Voyage {code}_1_{leg.to}") in {o for _, _, o in graph.triples}
    assert [o.text for s in graph.subjects(rr + "joinCondition") for c in graph.objects(s, rr + "joinCondition") for o in graph.objects(c, rr + "child")] == ["leg.to"]


def test_property_resolution_order():
    plan = compile_mapping(FULL)
    props = [s.property.iri for b in plan.blocks for s in b.statements]
    assert "urn:wikibase:propertyIRI:P7" in props  # an id first
    assert "urn:wikibase:property:typed" in props  # a declared node by its #name
    assert "http://www.w3.org/2000/01/rdf-schema#subClassOf" in props  # an outside one as it is


def test_statement_names_share_one_suffix_rule():
    plan = compile_mapping(FULL)
    names = {s.value.kind: s.name(b.entity).text for b in plan.blocks for s in b.statements}
    assert names["template"].endswith("_{first} {last}")
    assert names["constant"].count("_") == 2
    assert names["parent"].endswith("_{boss}")


@pytest.mark.parametrize(
    ("text", "what"),
    [
        (X + "<#M> a m:StatementsMap ; m:entityMap [ m:entityTemplate 'a' ] .", "logical source"),
        (X + "<#M> a m:StatementsMap ; rml:logicalSource [ rml:source 'x.json' ] ; m:entityMap [ m:class [ a m:Class ; m:entityTemplate 'C' ] ] .", "entityTemplate"),
        (X + "<#M> a m:StatementsMap ; rml:logicalSource [ rml:source 'x.json' ] ; m:entityMap [ m:entityTemplate 'a' ; m:entityType m:Property ] .", "propertyType"),
        (X + "<urn:p> a m:Property ; m:propertyType m:string .", "#name"),
        (X + "<#p> a m:Property ; m:propertyType m:colour .", "no property type"),
        (X + "<#M> a m:StatementsMap ; rml:logicalSource [ rml:source 'x.json' ] ; m:entityMap [ m:entityTemplate 'a' ] ; m:statementMap [ m:propertyId 'P1' ; m:valueMap [ m:parentStatementsMap <#N> ] ] .", "join condition"),
    ],
)
def test_problems_are_told(text, what):
    with pytest.raises(MappingError, match=what):
        compile_mapping(text)


def test_schema_graph_and_stripping():
    graph = schema_graph(compile_mapping(VOYAGES))
    assert Literal("trip", None, "en") in {o for _, _, o in graph.triples}
    kept = strip_mapping(parse_turtle(VOYAGES + "<urn:a> <urn:b> 'c' . <#berth> <urn:seen> 1 ."))
    assert {s.value.rpartition("#")[2] for s, _, _ in kept.triples if isinstance(s, Iri)} == {"urn:a", "berth", "Voyages", "Ports"}
    assert {p.value.rpartition("#")[2] for _, p, _ in kept.triples} == {"urn:b", "urn:seen", "logicalSource", "source", "iterator"}


def test_turtle_forms():
    g = parse_turtle('@base <http://a/b> . @prefix p: <http://p#> .\n<#x> a p:T ; p:n 1, 2.5, 1e3, true ; p:s """two\nlines "q" """, \'x\'@de-AT, "y"^^p:d ; . # end\n[] p:l ("a" <c>) .', "http://a/b")
    objects = list(o for _, _, o in g.triples)
    assert Iri("http://a/b#x") in {s for s, _, _ in g.triples}
    assert Literal('two\nlines "q" ') in objects and Literal("x", None, "de-at") in objects and Literal("y", "http://p#d") in objects
    assert parse_turtle(write_turtle(g)).triples.keys() == g.triples.keys()
    with pytest.raises(TurtleError, match="line 2"):
        parse_turtle("<a> <b>\n { .")


@given(st.text(max_size=40))
def test_literals_round_trip(text):
    g = Graph([(Iri("urn:s"), Iri("urn:p"), Literal(text, None, "en"))])
    assert parse_turtle(write_ntriples(g)).triples.keys() == g.triples.keys()


@given(st.text(max_size=40))
def test_encoding_round_trips(text):
    from urllib.parse import unquote

    assert unquote(encode(text)) == text


