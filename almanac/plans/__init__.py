"""The published tables: silver, fact, aggregates, marts, reports, and the registry that builds them."""
