"""DataFrame operators: picks, lookups, merges, program sync, nested data, quality checks, reports."""
