"""Column-level functions: keys, text parsing, JSON mapping, audit stamps."""
