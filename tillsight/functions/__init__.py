"""Column-level building blocks: keys, scalar expressions and ordered rule lists."""
