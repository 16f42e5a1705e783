"""Whole catalogue runs composed from the operators."""
