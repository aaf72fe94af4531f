"""Column builders: canonical text, predicates, geometry and freshness scalars."""
