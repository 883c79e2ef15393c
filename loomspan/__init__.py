"""A declarative knowledge-graph engine on Spark: mappings compile to DataFrame plans."""
