"""The operators applied to the supplied tables, and the same results in plain SQL."""
