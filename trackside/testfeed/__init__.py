"""Feed data derived from the given tables, for the registered queries and the tests."""
