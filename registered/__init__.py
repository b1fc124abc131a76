"""The registered queries, the stored tables they share, and their SQL twins."""
