"""DataFrame operators: rules, lookups, merges, grouping, integrity, sampling, generation."""
