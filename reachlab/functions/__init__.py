"""Column builders: geometry, cells, parsing, encoding and the cost model."""
