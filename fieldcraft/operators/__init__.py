"""DataFrame-in, DataFrame-out operators grouped by family."""
