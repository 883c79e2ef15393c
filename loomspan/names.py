"""Names that inputs and outputs are spelled with."""

# The key system of entities, statements and references.
ITEM = "urn:wikibase:item:"
ITEM_ID = "urn:wikibase:itemIRI:"
PROPERTY = "urn:wikibase:property:"
PROPERTY_ID = "urn:wikibase:propertyIRI:"
STATEMENT = "urn:wikibase:statement:"
REFERENCE_NODE = "urn:wikibase:statementreference:"
QUALIFIER = "urn:wikibase:qualifier:"
QUALIFIER_ID = "urn:wikibase:qualifierIRI:"
REFERENCE = "urn:wikibase:reference:"
REFERENCE_ID = "urn:wikibase:referenceIRI:"
LOCAL = "urn:wikibase:"

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
XSD = "http://www.w3.org/2001/XMLSchema#"
RML = "http://semweb.mmlab.be/ns/rml#"
RR = "http://www.w3.org/ns/r2rml#"
QL = "http://semweb.mmlab.be/ns/ql#"
MAPPING_BASE = "urn:mapping"

# Declared property types and the store's datatypes.
PROPERTY_TYPES = {"item": "wikibase-item", "string": "string", "url": "url", "externalId": "external-id", "quantity": "quantity", "time": "time", "monolingualText": "monolingualtext"}
DATATYPES = {
    "quantity": ["integer", "int", "long", "short", "decimal", "float", "double"],
    "string": ["string", "boolean"],
    "url": ["anyURI"],
    "time": ["date", "dateTime", "time", "gYear", "gYearMonth"],
}
RANKS = {"PreferredRank": "preferred", "NormalRank": "normal", "DeprecatedRank": "deprecated"}
NA_VALUES = ("", "nan", "None", "none", "null", "NULL")
CALENDAR = "http://www.wikidata.org/entity/Q1985727"
