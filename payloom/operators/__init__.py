"""DataFrame-to-DataFrame operators: first-per-key, merges, keys, lookups, checks."""
