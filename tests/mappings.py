"""Mappings of the tests, in a vocabulary of their own: the namespace is told from the document."""

V = "https://example.org/mapping#"
X = f"@prefix m: <{V}> . @prefix rml: <http://semweb.mmlab.be/ns/rml#> . @prefix ql: <http://semweb.mmlab.be/ns/ql#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .\n"

#: Two sources: a log of voyages in JSON, and ports in CSV that voyages lead to.
VOYAGES = X + """
<#tonnage> a m:Property ; m:propertyType m:quantity .
<#berth> a m:Property ; m:label "berth"@en ; m:propertyType m:item .
<#Voyage> a m:Class ; m:label "voyage"@en ; m:alias "trip"@en .
<#Voyages> a m:StatementsMap ;
  rml:logicalSource [ rml:source "voyages.json" ; rml:iterator "$.log[*]" ] ;
  m:entityMap [ m:entityTemplate "Voyage {code}" ; m:class <#Voyage> ] ;
  m:labelMap [ m:template "{vessel}, {leg.sailed}" ; m:language "en" ] ; m:aliasMap [ m:reference "vessel" ; m:language "nl" ] ;
  m:statementMap [ m:property <#berth> ; m:valueMap [ m:parentStatementsMap <#Ports> ; m:joinCondition [ m:child "leg.to" ; m:parent "code" ] ] ; m:qualifierMap [ m:property <#tonnage> ; m:valueMap [ m:reference "leg.tons" ] ] ] .
<#Ports> a m:StatementsMap ;
  rml:logicalSource [ rml:source "ports.csv" ] ;
  m:entityMap [ m:entityTemplate "Port {code}" ] ;
  m:labelMap [ m:reference "town" ; m:language "en" ] .
"""

#: Every kind of value in every place.
FULL = X + """
<#typed> a m:Property ; m:label "typed"@en ; m:propertyType m:string .
<#when> a m:Property ; m:label "when"@en ; m:propertyType m:time .
<#size> a m:Property ; m:label "size"@en ; m:propertyType m:quantity .
<#of> a m:Property ; m:label "of"@en ; m:propertyType m:item .
<#Thing> a m:Class ; m:label "thing"@en ; m:subclassOf <#Root> .
<#Root> a m:Class ; m:label "root"@en .
<#Staff> a m:StatementsMap ;
  rml:logicalSource [ rml:source "staff" ] ;
  m:entityMap [ m:entityTemplate "Staff_{id}" ; m:class <#Thing> ] ;
  m:labelMap [ m:template "{first} {last}" ; m:language "en" ] ; m:descriptionMap [ m:constant "a person" ; m:language "en" ] ; m:aliasMap [ m:reference "last" ; m:language "fr" ] ;
  m:statementMap [ m:property <#typed> ; m:valueMap [ m:template "{first} {last}" ] ; m:rank m:PreferredRank ;
    m:qualifierMap [ m:property <#size> ; m:valueMap [ m:reference "size" ] ] ; m:qualifierMap [ m:property <#of> ; m:valueMap [ m:entityTemplate "Staff_{boss}" ] ] ;
    m:qualifierMap [ m:property <#of> ; m:valueMap [ m:entityTemplate "Town" ] ] ; m:qualifierMap [ m:property <#typed> ; m:valueMap [ m:template "q {id}" ] ] ;
    m:qualifierMap [ m:property <#of> ; m:valueMap [ m:parentStatementsMap <#Staff> ] ] ;
    m:referenceMap [ m:referenceRecord [ m:property <#typed> ; m:valueMap [ m:constant "book" ] ] ; m:referenceRecord [ m:property <#when> ; m:valueMap [ m:reference "since" ] ] ] ;
    m:referenceMap [ m:referenceRecord [ m:property <#of> ; m:valueMap [ m:parentStatementsMap <#Staff> ; m:joinCondition [ m:child "boss" ; m:parent "id" ] ] ] ] ] ;
  m:statementMap [ m:property <#typed> ; m:valueMap [ m:constant "fixed" ] ] ;
  m:statementMap [ m:property <#of> ; m:valueMap [ m:parentStatementsMap <#Staff> ; m:joinCondition [ m:child "boss" ; m:parent "id" ] ] ] ;
  m:statementMap [ m:property rdfs:subClassOf ; m:valueMap [ m:entityTemplate "Town" ] ] ;
  m:statementMap [ m:property <#size> ; m:valueMap [ m:reference "size" ] ] .
<#Direct> a m:StatementsMap ;
  rml:logicalSource [ rml:query "SELECT id, first FROM staff WHERE id = 1" ] ;
  m:entityMap [ m:entityId "Q5" ] ;
  m:statementMap [ m:propertyId "P7" ; m:valueMap [ m:reference "first" ] ] .
"""
