"""Feature tables, testdata bindings and the query catalog."""
