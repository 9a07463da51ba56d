"""Column expressions: paths, content hashes, resume positions."""
