"""Column-level helpers and the distributed ordering helpers."""
