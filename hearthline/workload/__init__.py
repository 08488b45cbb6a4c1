"""Device events derived from the benchmark tables, with the registered queries and their SQL twins."""
