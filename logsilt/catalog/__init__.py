"""Catalog tables, the partition ledger, rules and registered schemas."""
