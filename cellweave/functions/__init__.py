"""Column-level helpers: null rules, statistics, curve codes, scratch space."""
