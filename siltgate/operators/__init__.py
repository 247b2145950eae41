"""DataFrame operators: the quality split, multiset difference, latest row per key, snapshot merges, counts."""
