"""DataFrame operators: profiling, learned cleaning, splitting, encoding, metrics and drift."""
