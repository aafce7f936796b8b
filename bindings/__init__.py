"""Queries on the TPC-H-like driver tables: views that play the warehouse, and SQL twins."""
