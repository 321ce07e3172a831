"""DataFrame operators: upsert, index, search, suggestions, facets, geo, counters."""
