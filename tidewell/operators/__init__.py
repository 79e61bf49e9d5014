"""DataFrame operators: cleaning, checks, statistics, merges, scoring."""
