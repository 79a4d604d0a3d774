"""Whole queries (registry used by ``__spark_entry__``) and their SQL oracles."""
