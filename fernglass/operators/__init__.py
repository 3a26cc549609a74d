"""Relational, entity-resolution, search and quality operators over DataFrames."""
