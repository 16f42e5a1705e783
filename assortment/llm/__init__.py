"""Operators over training data: filters, near duplicates, archives, shards, packing, chat windows."""
