"""DataFrame to DataFrame operators: relational helpers, spatial joins, graphs, trees, bands, gates and fits."""
