"""Record schemas, text parsers and connectors."""
