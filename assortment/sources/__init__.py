"""Schemas, table reads and writes, derived inputs, lineage cuts."""
